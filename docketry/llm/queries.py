"""One thin query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import licences
from docketry.llm.common import table

#: Parameter: where the tokenizer file lies; never copied into the repository.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.katz import Katz

    return Katz(table(spark, sf_dir, "documents"), order=2).scores()


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.quality_rules import COUNTS, quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents")).select("doc_id", *COUNTS, "base_failed", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_deleted", "text")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_disclosure_sanitising(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.pii import KINDS, all_spans, disclosures, listed

    found = disclosures(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    n = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    return found.select("doc_id", *n, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(all_spans(F.col("base"), F.col("terms"))).alias("spans"))


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "copy", "shuffle_key", "text")


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.licences import scan_licences

    return scan_licences(table(spark, sf_dir, "documents"))


def op8_kernel_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.classifier import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), width=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docketry.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_katz_backoff, op2_quality_rules, op3_line_dedup, op4_best_fit_packing, op5_disclosure_sanitising, op6_poisson_mixing, op7_licence_scan, op8_kernel_classifier, op9_simhash_near_dedup, op10_pruned_graph_search)}
ORACLE: dict[str, str] = {"op7_licence_scan": licences.oracle()}

ORACLE["op2_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z!]+', '', 'g')) AS n_upper, length(regexp_replace(t, '[^!-/:-@\[-`{-~]+', '', 'g')) AS n_marks FROM d),
g AS (SELECT r, unnest(generate_series(1, len(ws) - 2)) AS p, unnest(list_transform(generate_series(1, len(ws) - 2), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2])) AS gram FROM w WHERE len(ws) > 2),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p + o) AS n_repeat FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
c AS (SELECT d.r, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines, n_upper, n_marks FROM d JOIN w USING (r) LEFT JOIN rep USING (r)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1000 * n_marks // greatest(1, word_chars) AS mark_share, 1000 * n_upper // greatest(1, word_chars) AS upper_share,
        10 * word_chars // greatest(1, n_words) AS word_length, 1000 * n_repeat_words // greatest(1, n_words) AS repeat_share, 1000 * n_dup_lines // greatest(1, n_lines) AS dup_line_share FROM c),
x AS (UNPIVOT (SELECT r, lang, source, mark_share::BIGINT AS mark_share, upper_share::BIGINT AS upper_share, word_length::BIGINT AS word_length, repeat_share::BIGINT AS repeat_share, dup_line_share::BIGINT AS dup_line_share FROM m WHERE NOT base_failed)
      ON mark_share, upper_share, word_length, repeat_share, dup_line_share INTO NAME measure VALUE v),
rule AS (SELECT * FROM (VALUES ('mark_share', 25, 75, 6, 2, false), ('upper_share', 25, 75, 6, 2, false), ('word_length', 25, 75, 6, 1, true), ('repeat_share', 50, 99, 2, 50, false), ('dup_line_share', 50, 99, 2, 100, false)) t(measure, lo, hi, spread, grain, lower)),
s AS (SELECT lang, source, measure, (v >> b) << b AS v FROM (SELECT *, greatest(0, length(bin(v)) - 7)::BIGINT AS b FROM x)),
own AS (SELECT lang, source, measure, quantile_disc(v, [0.25, 0.5, 0.75, 0.99]) AS q, count(*) AS n FROM s GROUP BY ALL),
bylang AS (SELECT lang, measure, quantile_disc(v, [0.25, 0.5, 0.75, 0.99]) AS q, count(*) AS n FROM s GROUP BY ALL),
every AS (SELECT measure, quantile_disc(v, [0.25, 0.5, 0.75, 0.99]) AS q FROM s GROUP BY ALL),
p AS (SELECT o.lang, o.source, o.measure, CASE WHEN o.n >= 200 THEN o.q WHEN l.n >= 200 THEN l.q ELSE e.q END AS q
      FROM own o JOIN bylang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure JOIN every e ON o.measure = e.measure),
f AS (SELECT lang, source, p.measure, CASE lo WHEN 25 THEN q[1] ELSE q[2] END AS low, CASE hi WHEN 75 THEN q[3] ELSE q[4] END AS high, spread, grain, lower FROM p JOIN rule USING (measure)),
bad AS (SELECT DISTINCT x.r FROM x JOIN f ON x.lang IS NOT DISTINCT FROM f.lang AND x.source IS NOT DISTINCT FROM f.source AND x.measure = f.measure
        WHERE x.v > high + spread * greatest(grain, high - low) OR (lower AND x.v < low - spread * greatest(grain, high - low)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept FROM m
"""

ORACLE["op6_poisson_mixing"] = """
WITH d AS (SELECT *, coalesce('=' || source, '') AS src, coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) AS key FROM documents),
s AS (SELECT src, sum(coalesce(length(text), 0))::DOUBLE AS chars FROM d GROUP BY src),
r AS (SELECT src, CASE WHEN chars > 0 THEN sqrt(chars) / (SELECT sum(sqrt(chars)) FROM s) * (SELECT sum(chars) FROM s) / chars ELSE 1.0 END AS rate FROM s),
p AS (SELECT src, i, sum(exp(-rate + i * ln(rate) - lgamma(i + 1))) OVER (PARTITION BY src ORDER BY i) AS cdf
      FROM r, LATERAL (SELECT unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 20)::INT)) AS i)),
u AS (SELECT doc_id, lang, source, text, src, key, (('0x' || substr(md5('17|' || key), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u FROM d),
n AS (SELECT *, (SELECT count(*) FROM p WHERE p.src = u.src AND p.cdf < u.u) AS n FROM u),
c AS (SELECT doc_id, lang, source, text, key, unnest(generate_series(1, n))::INT AS copy FROM n WHERE n > 0)
SELECT doc_id, lang, source, copy, (('0x' || substr(md5('17:order|' || key || '|' || copy::VARCHAR), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS shuffle_key, text FROM c
"""

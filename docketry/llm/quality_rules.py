"""Quality rules with adaptive thresholds, DataFrame functions only.

Every document gets counts of its whole text and from them five integer measures. Each (lang, source) keeps, per
measure, a quantile sketch of its documents that pass the base rule: counts of cells, where a value keeps its
leading `BITS` binary digits. A cell is so at most 1/64 of its value wide, small values are exact, the number of cells
grows with the logarithm of the range alone, and sketches merge by adding counts: they are built with map-side
combining, do not depend on partitioning or retries, and a small group is judged by a merged one: its own sketch if it
holds `min_docs` documents, else its language's, else the corpus's.

Thresholds are fences outside two quantiles of the sketch: high + spread * (high - low), and low - spread * (high -
low) where a measure has a lower one. Measures with a bulk (marks, capitals, word length) go by the quartiles; measures
that are 0 for most documents (repeats) go by the median and the 99th percentile. So all move with language and
source and replace fixed cutoffs; `grain` is the least distance that counts where a group has no spread at all, and
only the two fixed base rules stay. Documents then meet their group's thresholds in a join on (lang, source), which
has a row per group, and are kept or not.

The measures sit in each row, so the only shuffles carry sketches and thresholds, never texts: the text table
is joined on the map side when the thresholds are few (size checked by the optimiser), else by a join that
adaptive execution splits where one source holds a third of the rows. The driver sees the corpus's sketch, which is
bounded by its cells.

Edge cases: null text has no words and fails the base rule, as does an empty one; a null lang or source is a
group like any other; repeated rows each count and each get their row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import Scratch, let, words_of

#: Binary digits of a value that a sketch keeps.
BITS = 7
#: measure: (low quantile, high quantile, spread, least distance of the quantiles, whether there is a lower fence)
MEASURES = {"mark_share": (25, 75, 6, 2, False), "upper_share": (25, 75, 6, 2, False), "word_length": (25, 75, 6, 1, True), "repeat_share": (50, 99, 2, 50, False), "dup_line_share": (50, 99, 2, 100, False)}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _covered(starts: Column) -> Column:
    """Ascending starts of repeated windows -> words they cover: each adds 3, less what the next one covers too."""
    gaps = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)


def with_repeats(rows: DataFrame) -> DataFrame:
    """Add n_repeat_words: words in 3-word windows found twice or more in `ws`, by the windows' 64-bit hashes.

    Each step is a column of its own, so that generated code handles whole arrays of longs and only texts
    with a repeated window do the rest. Few distinct repeats are looked up in a list, many by sorting.
    """
    rows = rows.withColumn("h", F.when(F.size("ws") > 3, F.transform(F.sequence(F.lit(0), F.size("ws") - 3), lambda k: F.xxhash64(F.get("ws", k), F.get("ws", k + 1), F.get("ws", k + 2)))).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("o", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array("h")))
    rows = rows.withColumn("twice", F.when(F.col("o").isNotNull(), F.array_distinct(F.filter("o", lambda x, k: F.coalesce(F.get("o", k - 1) == x, F.lit(False))))))
    listed = F.filter(F.transform("h", lambda x, k: F.when(F.array_contains("twice", x), k)), lambda k: k.isNotNull())

    def sorted_starts(pairs: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(pairs, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(pairs, same), lambda x: x["p"]))

    many = let(F.sort_array(F.transform("h", lambda x, k: F.struct(x.alias("h"), k.alias("p")))), sorted_starts)
    rows = rows.withColumn("starts", F.when(F.size("twice") <= 64, listed).when(F.size("twice") > 64, many))
    return rows.withColumn("n_repeat_words", F.coalesce(_covered(F.col("starts")), F.lit(0).cast("long"))).drop("h", "o", "twice", "starts")


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Slim rows: id, group, base counts, base verdict, measures as sketch bins."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chars = lambda others: F.length(F.regexp_replace("t", f"{others}+", "")).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), *also, t.alias("t"))
    rows = rows.withColumns({"ws": words_of(F.col("t")), "ls": F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), "n_symbols": chars(r"[^#*$%&|<>]"), "n_upper": chars("[^A-Z!]"), "n_marks": chars(r"\P{Punct}")}).drop("t")
    rows = rows.withColumns({"n_words": F.size("ws").cast("long"), "word_chars": F.length(F.array_join("ws", "")).cast("long"), "n_lines": F.size("ls").cast("long"), "n_dup_lines": (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long")})
    rows = with_repeats(rows).drop("ws", "ls")
    share = lambda part, whole, scale: F.floor(scale * F.col(part) / F.greatest(F.lit(1), F.col(whole))).cast("long")
    rows = rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return rows.withColumns({"mark_share": share("n_marks", "word_chars", 1000), "upper_share": share("n_upper", "word_chars", 1000), "word_length": share("word_chars", "n_words", 10), "repeat_share": share("n_repeat_words", "n_words", 1000), "dup_line_share": share("n_dup_lines", "n_lines", 1000)})


def cell(value: Column) -> Column:
    """The least value of a sketch's cell: all but the leading binary digits are 0."""
    drop = F.greatest(F.lit(0), F.length(F.bin(value)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n): the mergeable sketches, a row per filled cell."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), cell(F.col(m)).alias("value")) for m in MEASURES]))
    return rows.where("not base_failed").select("lang", "source", cells.alias("x")).groupBy("lang", "source", "x.measure", "x.value").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, low, high, total): each measure's two quantiles from a sketch of those keys."""
    by = Window.partitionBy(*keys, "measure")
    run = sketch.withColumns({"upto": F.sum("n").over(by.orderBy("value")), "total": F.sum("n").over(by)})

    def at(k: int) -> Column:
        asked = F.create_map(*[x for m, rule in MEASURES.items() for x in (F.lit(m), F.lit(rule[k]))])[F.col("measure")]
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * asked, F.col("value")))

    return run.groupBy(*keys, "measure").agg(at(0).alias("low"), at(1).alias("high"), F.max("total").alias("total"))


def _of_all(cells: list) -> Column:
    """The same over the whole corpus, as a map from the measure; `cells` is its sketch."""
    found = []
    for m, rule in MEASURES.items():
        mine = sorted((r.value, r.n) for r in cells if r.measure == m)
        total, upto, q = sum(n for _, n in mine), 0, {}
        for value, n in mine:
            upto += n
            for k in (0, 1):
                if upto * 100 >= total * rule[k]:
                    q.setdefault(k, value)
        found += [F.lit(m), F.struct(F.lit(q.get(0, 0)).cast("long").alias("low"), F.lit(q.get(1, 0)).cast("long").alias("high"), F.lit(total).cast("long").alias("total"))]
    return F.create_map(*found)


def fences(sketch: DataFrame, min_docs: int) -> DataFrame:
    """Thresholds per (lang, source): columns <measure>_low and <measure>_high."""
    merged = lambda keys: sketch.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    own = quantiles(sketch, ["lang", "source"])
    lang = quantiles(merged(["lang"]), ["lang"]).select(F.col("lang").alias("l"), F.col("measure").alias("lm"), F.struct("low", "high", "total").alias("by_lang"))
    every = _of_all(merged([]).collect())  # a row per cell, a few hundred for each measure
    best = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("lm")))
    pick = F.when(F.col("total") >= min_docs, F.struct("low", "high", "total")).when(F.col("by_lang.total") >= min_docs, F.col("by_lang")).otherwise(every[F.col("measure")])
    best = best.select("lang", "source", "measure", pick.alias("q"))
    of = lambda m, e: F.max(F.when(F.col("measure") == m, e))
    out = []
    for m, (_, _, spread, grain, lower) in MEASURES.items():
        gap = spread * F.greatest(F.lit(grain), F.col("q.high") - F.col("q.low"))
        out.append(of(m, F.col("q.high") + gap).alias(f"{m}_high"))
        if lower:
            out.append(of(m, F.col("q.low") - gap).alias(f"{m}_low"))
    return best.groupBy("lang", "source").agg(*out)


def _judged(rows: DataFrame, limits: DataFrame) -> tuple[DataFrame, Column]:
    limits = limits.withColumnsRenamed({"lang": "_l", "source": "_s"})
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    fine = ~F.col("base_failed")
    for m, rule in MEASURES.items():
        fine = fine & (F.col(m) <= F.col(f"{m}_high"))
        if rule[-1]:
            fine = fine & (F.col(m) >= F.col(f"{m}_low"))
    return joined, F.coalesce(fine, F.lit(False))


def quality_verdicts(docs: DataFrame, min_docs: int = 200, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, base counts, base_failed, kept, and the measures."""
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.write(measured(docs, id_col, text_col, lang_col, source_col), "measures")
    joined, kept = _judged(rows, scratch.write(fences(sketches(rows), min_docs), "limits"))
    return joined.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), *MEASURES)


def filter_documents(docs: DataFrame, min_docs: int = 200, **columns: str) -> DataFrame:
    """The rows of `docs` that pass, with their columns as they were.

    Each text is measured once, and its row written beside the measures: the sketches then read the slim columns
    alone, and the verdict neither measures again nor shuffles a text. Callers release that copy.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    names = {"id_col": "doc_id", "text_col": "text", "lang_col": "lang", "source_col": "source"} | columns
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), *[F.col(names[k]).alias(k) for k in names])
    rows = scratch.write(measured(packed, **{k: k for k in names}, also=("_row",)), "measures")
    joined, kept = _judged(rows, scratch.write(fences(sketches(rows), min_docs), "limits"))
    return joined.where(kept).select("_row.*")

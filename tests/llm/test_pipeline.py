"""run() against plain Python, stage by stage, and the contract of the stages."""

import random
from collections import Counter, defaultdict

import corpus_pipeline as P
from docketry.llm.quality_rules import quality_verdicts

from .test_line_dedup import brute as deduped
from .test_mixing import brute as mixed
from .test_packing import plain_ids
from .test_simhash import brute_components


def wide_fp(text):
    """brute_fp with five-word shingles."""
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 5]).encode(), 42) for i in range(max(1, len(words) - 4))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def corpus():
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefghij") * rng.randint(2, 6) + str(rng.randint(0, 300))
    line = lambda: " ".join(word() for _ in range(12))
    rows, shared = [], [line() for _ in range(4)]
    for i in range(120):
        rows.append((i, "\n".join([line() for _ in range(rng.randint(5, 30))] + rng.sample(shared, 1)), "en", f"s{i % 3}"))
    rows += [(200 + i, rows[i][1], "en", "s0") for i in range(10)]
    rows += [(300, "spam " * 80, "en", "s1"), (301, None, None, None), (302, "", "en", "s0"), (None, rows[40][1] + "\n" + line(), "en", "s2"), rows[7], (400, " ".join(word() for _ in range(6000)), "en", "s2")]
    return [(i, t, a, s, len(t or "")) for i, t, a, s in rows]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def expected(spark, rows):
    docs = spark.createDataFrame(rows, COLUMNS)
    kept = Counter(r.doc_id for r in quality_verdicts(docs).collect() if r.kept)
    live = [r for r in rows if kept[r[0]]]
    gone = deduped([(i, t) for i, t, *_ in live])
    live = [(i, gone[2**63 - 1 if i is None else i, t][0], a, s) for i, t, a, s, _ in live]
    fps = [wide_fp(t) for _, t, *_ in live]
    root, best = brute_components(fps), {}
    for r, f in zip(live, fps):
        key = (2**63 - 1 if r[0] is None else r[0],)
        if root[f] not in best or key < best[root[f]][0]:
            best[root[f]] = (key, r)
    copies = mixed([(i, t, s) for _, (i, t, _, s) in best.values()])
    want = Counter()
    for (i, t, _, _), n in copies.items():
        size = len(plain_ids(t)) + 1
        start, piece = 0, 0
        while start < size:
            m = (size - start) % 2048 or 2048
            want[i, piece, start, m] += n
            start, piece = start + m, piece + 1
    return want


def test_run_matches_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    got = P.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == expected(spark, rows)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 2048


def test_stages_keep_columns_and_take_empty_tables(spark):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "packing"]
    docs = spark.createDataFrame([], COLUMNS)
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, "")
        assert out.collect() == []
        if k < 4:
            assert sorted(out.columns) == sorted(docs.columns)

import random
import re
from collections import Counter

from docketry.llm.quality_rules import COUNTS, cell, fences, filter_documents, measured, quality_verdicts, sketches

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORDS.findall(text)
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    marked = {k + j for k, g in enumerate(zip(ws, ws[1:], ws[2:])) if grams[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked))
    return *n, n[0] < 50 or 100 * n[4] > 50 * n[0]


TEXTS = [None, "", " \n\t", "a", "a b c d", "a b a b a b", "x\x0by\x0cz #*$ <|>%&", "l one\nl one\n \n\n\nl one\r\n", "é à é à é à 😀 😀", "w " * 500, "a b c " * 100 + "x y z", " ".join(f"r{i % 90}" for i in range(400))]


def test_counts_against_brute_force(spark):
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 120))) for _ in range(80)]
    docs = spark.createDataFrame([(k, t, rng.choice(["en", None]), rng.choice(["s", None]), 1) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, t int")
    got = {r.doc_id: r for r in quality_verdicts(docs).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        assert (*[got[k][c] for c in COUNTS], got[k].base_failed) == brute(t), repr(t)
        assert not (got[k].base_failed and got[k].kept)


def test_thresholds_follow_the_group(spark):
    """A share of symbols that is usual in one source is out of bounds in another."""
    rng = random.Random(1)
    words = lambda: [rng.choice("abcdefghij") * rng.randint(4, 6) + str(rng.randint(0, 9999)) for _ in range(80)]
    rows = []
    for k in range(600):
        ws = words()
        code = k % 2
        if code:
            ws = [w + "<>" for w in ws]
        rows.append((k, " ".join(ws), "en", "code" if code else "prose"))
    rows.append((1000, " ".join(w + "<>" for w in words()), "en", "prose"))
    rows += [(1001, None, None, None), (1001, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = sorted(r.doc_id for r in filter_documents(docs).collect())
    assert kept == list(range(600))
    assert filter_documents(docs).columns == docs.columns
    assert sorted(r.doc_id for r in quality_verdicts(docs).collect() if r.kept) == kept


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality_verdicts(docs).collect() == [] and filter_documents(docs).collect() == []


def test_cells_are_narrow_and_in_order(spark):
    from pyspark.sql import functions as F

    values = [*range(3000), *(7**k + j for k in range(4, 20) for j in (-1, 0, 1))]
    got = [r.c for r in spark.createDataFrame([(v,) for v in sorted(values)], "v long").select(cell(F.col("v")).alias("c")).collect()]
    assert got == sorted(got)
    assert all(c <= v and (v - c) * 64 <= v and (v >= 128 or c == v) for v, c in zip(sorted(values), got))


def test_every_threshold_moves_with_the_group(spark):
    """Groups that differ in one measure get other thresholds for it, and judge a document by their own."""
    rng = random.Random(9)

    def text(marks=0.0, upper=0.0, length=5, repeats=0, same_lines=0):
        ws = ["".join(rng.choice("abcdefghijklmnop") for _ in range(length + rng.randint(-1, 1))) for _ in range(300)]
        ws = [w.upper() if rng.random() < upper else w for w in ws]
        ws = [w + "+" if rng.random() < marks else w for w in ws]
        lines = [" ".join(ws[k : k + 10]) for k in range(0, 300, 10)]
        return "\n".join(lines + [lines[0]] * same_lines + [" ".join(ws[40:43])] * repeats)

    kinds = {"plain": {}, "marks": {"marks": 0.5}, "upper": {"upper": 0.3}, "long": {"length": 11}, "repeats": {"repeats": 40}, "lines": {"same_lines": 12}}
    rows = [(k, text(**(kw if name in ("marks", "upper", "long") or k % 20 == 0 else {})), "en", name) for name, kw in kinds.items() for k in range(220)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    limits = {r.source: r for r in fences(sketches(measured(docs, "doc_id", "text", "lang", "source").cache()), 200).collect()}
    for name, measure in {"marks": "mark_share_high", "upper": "upper_share_high", "long": "word_length_high", "repeats": "repeat_share_high", "lines": "dup_line_share_high"}.items():
        assert limits[name][measure] > 1.2 * limits["plain"][measure], name
    planted = [(5000 + k, text(marks=0.5), "en", s) for k, s in enumerate(("plain", "marks"))]
    verdict = {r.doc_id: r.kept for r in quality_verdicts(docs.union(spark.createDataFrame(planted, docs.schema))).collect()}
    assert (verdict[5000], verdict[5001]) == (False, True)


def test_very_long_text(spark):
    rng = random.Random(5)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200_000)) + "\n" + "one same line " * 3
    docs = spark.createDataFrame([(1, long, "en", "s"), (2, "word", "en", "s")], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_verdicts(docs).collect()}
    assert (*[got[1][c] for c in COUNTS], got[1].base_failed) == brute(long)

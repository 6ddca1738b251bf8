import hashlib
import math
from collections import Counter

import pytest

from docketry.llm.mixing import mix_sources


def unit(*parts):
    return (int(hashlib.md5("|".join(parts).encode()).hexdigest()[:12], 16) + 0.5) / 2**48


def brute(rows, targets=None, temper=0.5, seed=17):
    chars = Counter()
    for _, text, src in rows:
        chars[src] += len(text or "")
    every = sum(chars.values())
    weight = {s: (targets or {}).get(s, n / every) if targets else n**temper for s, n in chars.items()}
    rate = {s: weight[s] / sum(weight.values()) * every / n if n else 1.0 for s, n in chars.items()}
    out = Counter()
    for i, text, src in rows:
        key = f"{'' if i is None else i}|{hashlib.md5((text or '').encode()).hexdigest()}"
        u, n = unit(str(seed), key), 0
        chance = lambda k, r=rate[src]: math.exp(k * math.log(r) - r - math.lgamma(k + 1)) if r else float(k == 0)
        c = chance(0)
        while c < u:
            n += 1
            c += chance(n)
        for k in range(1, n + 1):
            out[i, text, src, k] += 1
    return out


ROWS = [(i, f"text {i} " * (i % 9 + 1), "big" if i % 3 else f"s{i % 5}") for i in range(300)] + [(None, None, None), (None, "x", None), (5, "", "empty"), (7, "dup", "big"), (7, "dup", "big")]


@pytest.mark.parametrize("targets", [None, {"big": 0.2, "s0": 0.5, "none such": 0.1}])
def test_against_brute_force(spark, targets):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumnRenamed("nothing", "x")
    got = Counter((r.doc_id, r.text, r.source, r["copy"]) for r in mix_sources(docs, targets).collect())
    assert got == brute(ROWS, targets)


def test_shares_and_columns(spark):
    rows = [(i, "word " * 20, "a" if i < 2700 else "b", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rate int")
    out = mix_sources(docs, {"a": 0.5, "b": 0.5}, details=False)
    assert out.columns == docs.columns
    n = Counter(r.source for r in out.collect())
    assert abs(n["a"] / (n["a"] + n["b"]) - 0.5) < 0.06


@pytest.mark.parametrize("rate", [0.01, 50.0, 800.0, 5000.0])
def test_rates_of_any_size(spark, rate):
    """A source of 40 documents drawn at `rate`: the draws are those of the plain definition, their mean and spread Poisson's."""
    small = [(i, f"t{i:03d}", "s") for i in range(40)]
    rows = small + [(1000, "x" * 10_000_000, "big")]
    share = rate * 160 / 10_000_160
    targets = {"s": share, "big": 1 - share}
    got = Counter(r.doc_id for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), targets).select("doc_id").collect())
    want = Counter()
    for (i, *_), n in brute(rows, targets).items():
        want[i] += n
    assert got == want
    assert abs(sum(got[i] for i, *_ in small) / 40 - rate) <= 5 * math.sqrt(rate / 40) + 0.05
    assert rate < 50 or len({got[i] for i, *_ in small}) > 5


def test_clashing_columns(spark):
    names = ["copy", "rate", "shuffle_key", "src", "_key", "_row", "first", "cdf"]
    rows = [(i, f"t{i}", "s", *names) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    assert mix_sources(docs, details=False).columns == docs.columns
    out = mix_sources(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    assert {type(r["copy"]) for r in out.collect()} == {int}


def test_empty(spark):
    assert mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []

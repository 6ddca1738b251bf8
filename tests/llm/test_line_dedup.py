import random
from collections import Counter

from docketry.llm.line_dedup import dedup_lines, passes, runs_of


def test_passes_keep_order_and_lose_nothing():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(0, 12)
        pairs = [(k, rng.randrange(8)) for k in range(n)]
        got = passes(pairs)
        assert sorted(k for series in got for k in series) == list(range(n))
        for series in got:
            assert series == sorted(series)
            assert all(pairs[a][1] <= pairs[b][1] for a, b in zip(series, series[1:]))
        # as many series as the longest strictly falling one has members: no partition has fewer
        fall = [0] * n
        for i in range(n):
            fall[i] = 1 + max((fall[j] for j in range(i) if pairs[j][1] > pairs[i][1]), default=0)
        assert len(got) == max(fall, default=0)


def test_runs():
    rng = random.Random(4)
    for _ in range(300):
        sizes, least = [rng.randint(1, 4) for _ in range(rng.randint(0, 9))], rng.randint(1, 6)
        want = set()
        for i in range(len(sizes)):
            want |= set([(i, j) for j in range(i, len(sizes)) if sum(sizes[i : j + 1]) >= least][:1])
            want |= set([(j, i) for j in range(i, -1, -1) if sum(sizes[j : i + 1]) >= least][:1])
        assert runs_of(sizes, least) == sorted(want)


def brute(rows, min_words=3):
    """Texts after deletion, by holding every document against every earlier one: lines in common blocks with enough words go."""
    docs = sorted({(2**63 - 1 if i is None else i, t) for i, t in rows if t}, key=lambda d: d)
    lines = {d: [(pos, x.split()) for pos, x in enumerate(d[1].split("\n")) if x.split()] for d in docs}
    out = {}
    for n, later in enumerate(docs):
        gone, a = set(), lines[later]
        for earlier in docs[:n]:
            b = lines[earlier]
            for i in range(len(a)):
                for j in range(len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k][1] == b[j + k][1]:
                        k += 1
                    if sum(len(w) for _, w in a[i : i + k]) >= min_words:
                        gone |= {pos for pos, _ in a[i : i + k]}
        out[later] = ("\n".join(x for k, x in enumerate(later[1].split("\n")) if k not in gone), len(gone))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, t, len(t or ""), "k") for i, t in rows], "doc_id long, text string, n_chars long, key string")
    got = Counter((r.doc_id, r.text, r.n_chars, r.n_deleted, r.key) for r in dedup_lines(df).collect())
    want = brute(rows)
    expect = Counter()
    for i, t in rows:
        text, n = want[(2**63 - 1 if i is None else i, t)] if t else (t, 0)
        expect[i, text, len(text or ""), n, "k"] += 1
    assert got == expect


def test_planted(spark):
    a = "alpha beta gamma\nsecond line here\n\nthird line here\nshort"
    rows = [(1, a), (2, "own start of two\n" + a + "\nown end of two"), (3, "third line here\nown middle\nsecond line here"), (4, "short"), (5, None), (6, ""), (None, a), (1, a), (1, "other text same id\nsecond  line here"), (7, "rep line one\nrep line one"), (8, "rep line one\nrep line one\nrep line one")]
    check(spark, rows)


def kept(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in dedup_lines(df).orderBy("doc_id").collect()]


def test_blocks_shared_with_a_document_that_held_none_of_their_lines_first(spark):
    assert kept(spark, "two words", "two words\nother pair", "two words\nother pair") == ["two words", "two words\nother pair", ""]
    menu = "home\nabout us\nnews"
    assert kept(spark, "home\nx1 x2 x3", "y1 y2 y3\nabout us", "news\nz1 z2 z3", f"{menu}\nfourth own line", f"fifth own line\n{menu}")[4] == "fifth own line"


def test_moved_blocks(spark):
    p, q = ("\n".join(f"{x} passage line {k}" for k in range(30)) for x in "pq")
    assert kept(spark, f"{p}\nmiddle of first\n{q}", f"{q}\nmiddle of second\n{p}", f"{q}\nmiddle of third\n{p}")[1:] == ["middle of second", "middle of third"]


def test_copies_and_long_texts(spark):
    long = "\n".join(f"line {k} of it" if k % 3 else f"w{k}" for k in range(20000))
    got = kept(spark, long, "\n".join(reversed(long.split("\n"))), long, long + "\nand one more line")
    assert got[0] == long and got[2] == "" and got[3] == "and one more line"
    assert got[1] == "\n".join(x for x in reversed(long.split("\n")) if x.startswith("w"))


def test_random_against_brute_force(spark):
    rng = random.Random(7)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(25)] + [""]
    rows = [(rng.choice([k, None]) if rng.random() < 0.1 else k, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for k in range(60)]
    check(spark, rows + [rows[3]] * 5)


def test_clashing_columns(spark):
    names = ["id", "th", "key", "row", "gone", "n_deleted", "pos"]
    rows = [(1, "a b c d\nx y z w", *names), (2, "own line it is\na b c d", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = sorted(tuple(r) for r in dedup_lines(docs, count_col=None).collect())
    assert got == [rows[0], (2, "own line it is", *names)]
    assert {r.n_deleted for r in dedup_lines(docs).collect()} == {0, 1}


def test_empty(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []

import random
import re
from collections import Counter

import numpy as np
import xxhash

from docketry.llm import simhash as S
from docketry.llm.common import Scratch


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def same_partition(got, want):
    return Counter(frozenset(k for k, v in got.items() if v == r) for r in set(got.values())) == Counter(frozenset(k for k, v in want.items() if v == r) for r in set(want.values()))


TEXTS = ["", None, " \n", "One", "one two", "A b C", "É é x Y", "a b c d e f g", "a\x1cb \x85 c d e", "w " * 3000]


def test_fingerprint():
    for t in TEXTS:
        assert S.fingerprint(t, 3) == brute_fp(t), repr(t)


def flips(rng, base, n, most):
    out = {base}
    while len(out) < n:
        x = rng.choice(sorted(out)) if rng.random() < 0.3 else base
        for b in rng.sample(range(64), rng.randint(1, most)):
            x ^= 1 << b
        out.add(x)
    return out


def test_links_match_brute_force(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)} | {0}
    for _ in range(10):
        fps |= flips(rng, rng.getrandbits(64), 12, 4)
    fps |= flips(rng, rng.getrandbits(64), 500, 6)
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = brute_components(fps)
    for dense in (4096, 40):
        scratch = Scratch(spark, "t")
        roots = S.connected_components(S.fingerprint_links(nodes, scratch, dense), scratch)
        got = {f: f for f in fps} | {int(np.int64(r.node).view(np.uint64)): int(np.int64(r.root).view(np.uint64)) for r in roots.collect()}
        assert same_partition(got, want)


def test_near_duplicates_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base, 1), (4, base, 1), (4, base, 1), (7, base + " tail", 1), (1, "", 1), (None, None, 1), (2, "other words here", 1), (None, "alone with null", 1)] + [(20 + i, t, 1) for i, t in enumerate(TEXTS)]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    want = brute_components([brute_fp(t) for _, t, _ in rows])
    least = {}
    for i, t, _ in rows:
        if i is not None:
            k = want[brute_fp(t)]
            least[k] = min(i, least.get(k, i))
    expect = Counter((i, brute_fp(t), least.get(want[brute_fp(t)])) for i, t, _ in rows)
    assert Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got) == expect


def test_one_row_of_each_group_stays(spark):
    names = ["id", "th", "row", "fp", "root", "n"]
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base, *names), (4, base, *names), (4, base, *names), (None, base + " tail", *names), (3, "a clean one", *names), (None, None, *names), (8, "", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = S.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == sorted([rows[1], rows[4], rows[6]])
    assert S.drop_near_duplicates(docs.limit(0)).collect() == []


def grams(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_kept(rows):
    """Least id of each component of all pairs of Jaccard >= 0.8."""
    sets = {i: grams(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return sorted(i for i in sets if find(i) == i)


def test_similar_texts_go_as_brute_force_jaccard_says(spark):
    rng, rows = random.Random(8), []
    for k in range(60):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 40, 120, 700]))]
        for share in (0, 0.005, 0.01, 0.02, 0.03, 0.05):
            rows.append((rng.randrange(10**9), " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in base)))
    want = brute_kept(rows)
    assert 60 < len(want) < 330
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (8_000_000, 400):
        assert sorted(r.doc_id for r in S.drop_near_duplicates(docs, most=most, spread=most).collect()) == want


def test_chains_and_large_groups_of_near_copies(spark):
    """Texts that meet under a key and differ from its hub: chains of small steps, and a large group with looser copies beside it."""
    rng, rows = random.Random(9), []
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for step in range(12):  # neighbours share all but a stretch, ends share little
            rows.append((rng.randrange(10**9), " ".join(words)))
            words = words[:]
            words[12 * step : 12 * step + rng.choice([4, 8, 12])] = [f"x{rng.randrange(10**6)}" for _ in range(8)]
    base = [f"b{i}" for i in range(200)]
    for k in range(150):
        text = base[:]
        for _ in range(rng.choice([1, 1, 1, 2, 5, 8])):
            text[rng.randrange(200)] = f"y{rng.randrange(10**6)}"
        rows.append((rng.randrange(10**9), " ".join(text)))
    want = brute_kept(rows)
    assert 3 < len(want) < 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (8_000_000, 1000):
        assert sorted(r.doc_id for r in S.drop_near_duplicates(docs, most=most, spread=most).collect()) == want


def test_wide_fingerprint():
    """The majority of each hash bit, over texts longer than one block of sums; by plain integers."""
    rng = random.Random(5)
    for n in (1, 2, 5, 300):
        grams = [rng.getrandbits(64) for _ in range(n)]
        want = bytearray()
        for turn in S.TURNS.tolist():
            hs = []
            for g in grams:
                x = g * turn % 2**64
                x = (x ^ x >> 32) * int(S.MIX) % 2**64
                hs.append((x ^ x >> 29).to_bytes(8, "little"))
            want += bytes(sum(1 << b for b in range(8) if 2 * sum(h[i] >> b & 1 for h in hs) > n) for i in range(8))
        assert S.wide_fingerprint(np.asarray(grams, np.uint64)) == bytes(want)
    assert S.wide_fingerprint(np.empty(0, np.uint64)) == b""


def sets_alike(rng, both, one, other):
    grams = rng.integers(0, 2**64, both + one + other, np.uint64)
    return np.sort(grams[: both + one]), np.sort(np.concatenate([grams[:both], grams[both + one :]]))


def test_index_of_byte_positions(spark):
    """Groups are what the definition connects, pair by pair, and pairs of Jaccard 0.8 meet in one."""
    rng = np.random.default_rng(8)
    sets = [s for k in range(150) for s in sets_alike(rng, *[(80, 10, 10), (8, 1, 1), (400, 100, 0), (240, 30, 30)][k % 4])]
    sets += [s for _ in range(50) for s in sets_alike(rng, 30, 60, 60)]
    fps = [S.wide_fingerprint(s) for s in sets]
    rows = spark.createDataFrame([(i, len(s), f) for i, (s, f) in enumerate(zip(sets, fps))] + [(9999, 0, b"")], "node long, size long, fp binary")
    got = {}
    for key, hub, node, size in S.groups_of(rows, Scratch(spark, "test")).collect():
        got.setdefault(key, {hub}).add(node)
        assert hub < node and size == len(sets[node])
    want, m = Counter(), np.frombuffer(b"".join(fps), np.uint8).reshape(-1, S.WIDE)
    for i in range(len(m)):
        for j in range(i + 1, len(m)):
            for p in np.flatnonzero((m[i, ::2] == m[j, ::2]) & (m[i, 1::2] == m[j, 1::2])).tolist():
                at = [(2 * p + 2 + k) % S.WIDE for k in range(S.WINDOW)]
                x = m[i, at] ^ m[j, at]
                if 2 + (x == 0).sum() >= S.WIDE_BYTES and np.bitwise_count(x).sum() <= S.WIDE_BITS:
                    want[i, j] += 1
    meet = Counter((i, j) for g in got.values() for i in g for j in g if i < j)
    assert set(meet) >= set(want) and all(meet[k] >= n for k, n in want.items())
    assert sum(meet.values()) <= 1.05 * sum(want.values())
    assert all((2 * k, 2 * k + 1) in meet for k in range(150)) and sum(i >= 300 for i, _ in meet) <= 1


def test_long_postings_group_as_short_ones():
    """A posting beyond the bound, with two groups of near copies and single texts, and one that goes over batches."""
    import pyarrow as pa

    rng = np.random.default_rng(10)
    base = rng.integers(-(2**62), 2**62, (2, 2))
    w = np.concatenate([np.repeat(base, 60, axis=0) ^ (np.int64(1) << rng.integers(0, 62, (120, 2))), rng.integers(-(2**62), 2**62, (30, 2))])
    batches = [pa.RecordBatch.from_arrays([pa.array(np.full(50, 7)), pa.array(np.arange(a, a + 50)), pa.array(np.full(50, 9)), pa.array(w[a : a + 50, 0]), pa.array(w[a : a + 50, 1])], names=["key", "node", "size", "w0", "w1"]) for a in (0, 50, 100)]
    found = []
    for most in (1024, 20):
        groups = {}
        for b in S.posting_groups(most)(iter(batches)):
            for key, hub, node, _ in zip(*(c.to_pylist() for c in b.columns)):
                groups.setdefault(key, {hub}).add(node)
        found.append(groups)
    assert found[0] == found[1]
    assert sorted(map(sorted, found[0].values())) == [list(range(60)), list(range(60, 120))]


def test_pivots_and_the_rest():
    """Every link of a pivot counts, through others too; what only the rest connects among itself is left out."""
    of = lambda *xs: np.asarray(sorted(xs), np.uint64)
    one, two, far = of(*range(20)), of(*range(1, 21)), of(*range(100, 120))
    assert S.similar_spanning([1, 2, 3], [one, two, far], 1) == [(1, 2)]
    assert S.similar_spanning([3, 1, 2], [far, one, two], 1) == []
    assert S.similar_spanning([1, 2, 4], [one, two, of(*range(3, 23))], 1) == [(1, 2), (2, 4)]


def test_empty(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []

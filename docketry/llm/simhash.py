"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Fingerprints within 3 bits differ in at most 3 bytes, so they share
at least 5 positional bytes: the guaranteed minimum. Equal fingerprints are collapsed first, so a group of
exact copies is one entry. The index holds each distinct fingerprint under eight postings, the triples of byte
positions inside either half: of any 5 shared positions at least 3 lie in one half, so every linked pair meets
in a posting. There the shared positional bytes of each pair are tallied, pairs under 5 are dropped, the rest
are verified by counting differing bits.

A posting longer than `dense` is split by two more byte positions (any linked pair agrees on at least two of
the other five), leaving 24 free bits. In such a block links come from a table of one-bit neighbours: within 3
bits of each other are exactly those where something within 2 bits of one is within 1 bit of the other. That
is linear in the block and bounded by 2^24 entries, so no group is ever compared pair by pair at scale, and
nothing is capped. Tasks emit links that span each posting, not all pairs.

`drop_near_duplicates`, a stage on word shingles, has a rule of its own: Jaccard similarity of at least 0.8. That is
about 9 of 64 bits, too far for 64 bits to guarantee a shared byte, so its SimHash fingerprints are wider: WIDE positional
bytes, by the same majority of the shingles' hash bits. The inverted index holds each text under PLACES pairs of byte
positions. In a posting the shared positional bytes of each pair are counted, the key's and those of a window behind it;
pairs under WIDE_BYTES, or with more than WIDE_BITS differing bits in the window, are dropped. What the rest connect is a
group, and groups are verified by the shingle sets themselves: all with the least node of their group first, which settles
near copies in linear time, then within each group only those that differ from it.

Edge cases: null, empty and blank texts have fingerprint zero and link like others; repeated rows each get
their row; a null id gets its component's least known id (null if it has none); empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import Scratch
from docketry.llm.components import connected_components

MOST_BITS, LEAST_BYTES, SEED = 3, 5, 42
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def shingles(words: list[bytes], width: int) -> bytes:
    """XXH64 of every run of `width` words, eight bytes each; of all words where they are fewer."""
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_digest(line, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - width].tolist() if width > 1 else (ends - sizes).tolist()
    digest = xxhash.xxh64_digest
    return b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())])


def fingerprint(text: str | None, width: int) -> int:
    """64 bits; a bit is set if it is set in over half the shingles' XXH64."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    bits = np.unpackbits(np.frombuffer(shingles(words, width), np.uint8).reshape(-1, 8), axis=1)
    counts = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp[, also...]) per row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, width) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *also])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).cast("long") for c in also])
    return slim.mapInArrow(run, ", ".join(["doc_id long", "fp long", *[f"{c} long" for c in also]]))


def tallied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs share the least number of positional bytes and then differ in few enough bits."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    x = a ^ b
    shared = np.bitwise_count(~((((x & low) + low) | x) | low))  # one bit for each byte of x that is zero
    return (shared >= LEAST_BYTES) & (np.bitwise_count(x) <= MOST_BITS)


def spanning(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among the fingerprints of one posting, each found from a neighbour."""
    out, rest = [], fps
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            node, front = front[0], front[1:]
            hit = tallied(np.full(1, node), rest)
            if hit.any():
                new = rest[hit]
                out.append((np.full(len(new), node), new))
                front, rest = np.concatenate([front, new]), rest[~hit]
    return out


def offsets(bits: int, most: int) -> np.ndarray:
    return np.asarray([sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(bits), n)], np.uint32)


def dense_spanning(fps: np.ndarray, free: tuple[int, int, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same for a block whose members may differ in three byte positions only: linear, by one-bit neighbours."""
    rest = np.zeros(len(fps), np.uint32)
    for k, byte in enumerate(free):
        rest |= (fps >> np.uint64(8 * byte) & np.uint64(255)).astype(np.uint32) << np.uint32(8 * k)
    near = np.full(1 << 24, -1, np.int32)
    for o in offsets(24, 1):
        near[rest ^ o] = np.arange(len(fps), dtype=np.int32)
    label, ball = np.arange(len(fps), dtype=np.int32), offsets(24, 2)
    while True:
        old = label.copy()
        for o in ball:
            y = near[rest ^ o]
            x = np.flatnonzero(y >= 0)
            y = y[x]
            m = np.minimum(label[x], label[y])
            np.minimum.at(label, x, m)
            np.minimum.at(label, y, m)
        label = label[label]
        if (label == old).all():
            break
    far = label != np.arange(len(fps))
    return [(fps[label[far]], fps[far])]


def posting_links(refined: bool, dense: int):
    """Stream of (key, place, fp) rows sorted by key -> links (u, v)."""

    def links(key_place: int, fps: np.ndarray) -> list:
        if refined and len(fps) > dense:
            return dense_spanning(fps, FREE[key_place])
        return spanning(fps)

    def small(keys: np.ndarray, fps: np.ndarray) -> list:
        """All short postings at once: row i against row i + d of the same posting."""
        out, at = [], np.arange(len(keys))
        for d in range(1, 33):
            at = at[at < len(keys) - d]
            at = at[keys[at] == keys[at + d]]
            if not len(at):
                break
            hit = at[tallied(fps[at], fps[at + d])]
            out.append((fps[hit], fps[hit + d]))
        return out

    def solve(keys: np.ndarray, places: np.ndarray, fps: np.ndarray) -> list:
        edge = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (places[1:] != places[:-1])]))
        size = np.diff(np.append(edge, len(keys)))
        group = np.repeat(np.arange(len(edge)), size)
        short = np.repeat((size > 1) & (size <= 32), size)
        out = small(group[short], fps[short])
        for k in np.flatnonzero(size > 32):
            out += links(int(places[edge[k]]), fps[edge[k] : edge[k] + size[k]])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        enough = 200_000

        def flush(last: bool):
            nonlocal held, enough
            if not held:
                return None
            k, p, f = (np.concatenate(x) for x in zip(*held))
            cut = len(k) if last else int(np.flatnonzero((k == k[-1]) & (p == p[-1]))[0])
            held = [(k[cut:], p[cut:], f[cut:])] if cut < len(k) else []
            enough = max(200_000, 2 * (len(k) - cut))  # a long posting is not put together again for every batch
            found = solve(k[:cut], p[:cut], f[:cut]) if cut else []
            if not found:
                return None
            u, v = (np.concatenate(x).view(np.int64) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)))
            if sum(len(x[0]) for x in held) >= enough:
                if (out := flush(False)) is not None:
                    yield out
        if (out := flush(True)) is not None:
            yield out

    return run


#: Refined place -> the three byte positions left free.
FREE = {100 + 10 * t + j: tuple(sorted(set(range(8)) - set(triple) - set(pair))) for t, triple in enumerate(TRIPLES) for j, pair in enumerate(combinations(sorted(set(range(8)) - set(triple)), 2))}


def _bytes_at(places: tuple[int, ...]):
    """The chosen byte positions (0: lowest) of fp, packed into a long."""
    out = F.lit(0).cast("long")
    for p in places:
        out = F.shiftleft(out, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255))
    return out


def fingerprint_links(nodes: DataFrame, scratch: Scratch, dense: int = 4096) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that connect exactly what is linked."""
    posted = nodes.select("fp", F.explode(F.array(*[F.struct(_bytes_at(t).alias("key"), F.lit(k).alias("place")) for k, t in enumerate(TRIPLES)])).alias("p")).select("p.key", "p.place", "fp")
    sizes = scratch.write(posted.groupBy("key", "place").agg(F.count("*").alias("n")).where(F.col("n") > dense), "hot_postings")
    schema = "u long, v long"
    plain = posted.join(sizes, ["key", "place"], "left_anti").repartition("key", "place").sortWithinPartitions("key", "place")
    hot = posted.join(sizes, ["key", "place"], "left_semi")
    finer = F.lit(None)
    for t, triple in enumerate(TRIPLES):
        pairs = list(combinations(sorted(set(range(8)) - set(triple)), 2))
        finer = F.when(F.col("place") == t, F.array(*[F.struct(_bytes_at((*triple, *pair)).alias("key"), F.lit(100 + 10 * t + j).alias("place")) for j, pair in enumerate(pairs)])).otherwise(finer)
    split = hot.select("fp", F.explode(finer).alias("p")).select("p.key", "p.place", "fp").repartition("key", "place").sortWithinPartitions("key", "place")
    return plain.mapInArrow(posting_links(False, dense), schema).unionByName(split.mapInArrow(posting_links(True, dense), schema))


def near_duplicates(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = (), dense: int = 4096) -> DataFrame:
    """Per row of `docs`: doc_id, fp (signed long), component_id, root (least fingerprint of the component)[, also...]."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, width, id_col, text_col, also), "fingerprints")
    nodes = scratch.write(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    links = fingerprint_links(nodes.select("fp"), scratch, dense)
    roots = connected_components(links, scratch)
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "root", *also)


#: Wide fingerprints: byte positions, the pairs of them that are keys, and the passes that index them.
PLACES, PASSES, WINDOW = 160, 5, 16
WIDE = 2 * PLACES
#: The count filter: least shared bytes, of the key's two and the window's, and most differing bits in the window's 128.
WIDE_BYTES, WIDE_BITS = 3, 40
TURNS = np.asarray([xxhash.xxh64_intdigest(f"wide:{i}") for i in range(WIDE // 8)], np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, width: int) -> tuple[int, np.ndarray]:
    """A hash of the words, and the sorted distinct shingle hashes."""
    words = (text or "").encode().lower().split()
    name = xxhash.xxh64_intdigest(b" ".join(words), SEED)
    return name, np.unique(np.frombuffer(shingles(words, width), np.uint64)) if words else np.empty(0, np.uint64)


def wide_fingerprint(grams: np.ndarray) -> bytes:
    """WIDE bytes; a bit is set if it is set in over half the shingles' hashes, which are drawn out to that width. None for an empty set."""
    if not len(grams):
        return b""
    counts = np.zeros(8 * WIDE, np.int64)
    for at in range(0, len(grams), 255):  # so many that their sum is a byte
        x = grams[at : at + 255, None] * TURNS
        x = (x ^ (x >> np.uint64(32))) * MIX
        x ^= x >> np.uint64(29)
        counts += np.unpackbits(x.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(grams)).tobytes()


def indexed(width: int):
    """(id, th, text) -> (id, th, node, size, fp); texts of the same words are one node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch.column(2).to_pylist()]
            node = np.fromiter((n for n, _ in sets), np.uint64, len(sets)).view(np.int64)
            fps = pa.array([wide_fingerprint(g) for _, g in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(node), pa.array([len(g) for _, g in sets], pa.int64()), fps], names=["id", "th", "node", "size", "fp"])

    return run


def postings(places: range):
    """(node, size, fp) -> (key, node, size, w0, w1) for each place: its number and two bytes, and the window behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                node, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                fps = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, WIDE)
                fps = np.ascontiguousarray(np.column_stack([fps, fps[:, : WINDOW + 2]]))
                out = []
                for p in places:
                    key = p << 16 | fps[:, 2 * p].astype(np.int64) << 8 | fps[:, 2 * p + 1]
                    window = np.ascontiguousarray(fps[:, 2 * p + 2 : 2 * p + 2 + WINDOW]).view(np.int64)
                    out.append((key, node, size, window[:, 0], window[:, 1]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["key", "node", "size", "w0", "w1"])

    return run


def wide_tallied(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which pairs of one posting share enough positional bytes, the key's two included, and differ in few enough bits of the window."""
    low, shared, apart = np.uint64(0x7F7F7F7F7F7F7F7F), 2, 0
    for u, v in zip(a, b):
        x = u ^ v
        shared = shared + np.bitwise_count(~((((x & low) + low) | x) | low))
        apart = apart + np.bitwise_count(x)
    return (shared >= WIDE_BYTES) & (apart <= WIDE_BITS)


def posting_groups(most: int = 1024):
    """Stream of (key, node, size, w0, w1) rows sorted by key -> (key, hub, node, size): the groups that tallied pairs connect within a posting.

    A group's hub is its least node; each of its other nodes is a row, and `key` tells groups apart.
    Pairs of a posting of up to `most` are taken for all postings at once; longer ones, as near copies make, are
    searched from a member at a time, each reached member leaving what is still to be compared.
    """

    def solve(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, w0: np.ndarray, w1: np.ndarray) -> pa.RecordBatch | None:
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(edge, len(keys)))
        links, at = [], np.flatnonzero(np.repeat((size > 1) & (size <= most), size))
        for d in range(1, int(size[size <= most].max(initial=1))):
            at = at[at < len(keys) - d]
            at = at[keys[at] == keys[at + d]]
            hit = at[wide_tallied((w0[at], w1[at]), (w0[at + d], w1[at + d]))]
            links.append((hit, hit + d))
        for k in np.flatnonzero(size > most):
            rest, front = np.arange(edge[k], edge[k] + size[k]), []
            while len(rest):
                if not front:
                    front, rest = [rest[0]], rest[1:]
                one = front.pop()
                hit = wide_tallied((w0[one], w1[one]), (w0[rest], w1[rest]))
                if hit.any():
                    links.append((np.full(int(hit.sum()), one), rest[hit]))
                    front += rest[hit].tolist()
                    rest = rest[~hit]
        u, v = (np.concatenate(c) for c in zip(*links)) if links else (at[:0], at[:0])
        if not len(u):
            return None
        label, old = np.arange(len(keys)), None
        while old is None or (label != old).any():
            old = label.copy()
            least = np.minimum(label[u], label[v])
            np.minimum.at(label, u, least)
            np.minimum.at(label, v, least)
            label = label[label]
        rows = np.unique(np.concatenate([u, v]))
        rows = rows[np.lexsort((nodes[rows], label[rows]))]
        first = np.flatnonzero(np.diff(label[rows], prepend=-1))
        hub = np.repeat(nodes[rows[first]], np.diff(np.append(first, len(rows))))
        group = (keys[rows].view(np.uint64) * MIX ^ hub.view(np.uint64)) * MIX
        others = np.ones(len(rows), bool)
        others[first] = False
        return pa.RecordBatch.from_arrays([pa.array(c[others]) for c in (group.view(np.int64), hub, nodes[rows], sizes[rows])], names=["key", "hub", "node", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, enough = [], 200_000
        for batch in batches:
            if batch.num_rows:
                key, node, size, w0, w1 = (c.to_numpy() for c in batch.columns)
                held.append((key, node, size, w0.view(np.uint64), w1.view(np.uint64)))
            if sum(len(h[0]) for h in held) >= enough:
                whole = [np.concatenate(c) for c in zip(*held)]
                cut = int(np.searchsorted(whole[0], whole[0][-1]))  # the last posting may go on
                held, enough = [tuple(c[cut:] for c in whole)], max(200_000, 2 * (len(whole[0]) - cut))
                if cut and (out := solve(*(c[:cut] for c in whole))) is not None:
                    yield out
        if held and (out := solve(*(np.concatenate(c) for c in zip(*held)))) is not None:
            yield out

    return run


def groups_of(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, size, fp) -> (key, hub, node, size): what meets in the inverted index and passes the count filter, key by key, in passes that free their shuffles."""
    parts, step = [], PLACES // PASSES
    for p in range(PASSES):
        posted = nodes.where("length(fp) > 0").select("node", "size", "fp").mapInArrow(postings(range(p * step, (p + 1) * step)), "key long, node long, size long, w0 long, w1 long")
        sorted_ = posted.repartition("key").sortWithinPartitions("key")
        parts.append(scratch.write(sorted_.mapInArrow(posting_groups(), "key long, hub long, node long, size long"), f"groups{p}"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def alike(both, one, other):
    """Whether sets of these sizes with `both` shared are at least 0.8 alike by Jaccard: both / (one + other - both) >= 0.8."""
    return 9 * both >= 4 * (one + other)


def similar_spanning(names: list[int], sets: list[np.ndarray], pivots: int) -> list[tuple[int, int]]:
    """Links that connect what similarities with one of the first `pivots` sets connect; the others count as connected."""
    size = np.asarray([len(s) for s in sets], np.int64)
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    own = np.split(ids, np.cumsum(size)[:-1])
    mark, out = np.zeros(int(ids.max()) + 1, np.int8), []
    rest = np.arange(len(sets))
    flat, starts = ids, np.cumsum(size) - size
    while len(rest) and rest[0] < pivots:
        front, rest, flat, starts = [int(rest[0])], rest[1:], flat[size[rest[0]] :], starts[1:] - size[rest[0]]
        while front and len(rest):
            one = front.pop()
            mark[own[one]] = 1
            both = np.add.reduceat(mark[flat], starts, dtype=np.int64)
            mark[own[one]] = 0
            hit = alike(both, size[one], size[rest])
            if hit.any():
                new = rest[hit].tolist()
                out += [(names[one], names[x]) for x in new]
                front += new
                flat, rest = flat[np.repeat(~hit, size[rest])], rest[~hit]
                starts = np.cumsum(size[rest]) - size[rest]
    return out


def against_hub(width: int):
    """Stream of (hub, salt, first, node, text) sorted so that each group opens with the hub -> links (u, v) with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.empty(0, np.uint64)
        for batch in batches:
            found = []
            for hub, _, first, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                mine = shingle_set(text, width)[1]
                if first:
                    own = mine
                elif alike(len(np.intersect1d(own, mine, assume_unique=True)), len(own), len(mine)):
                    found.append((hub, node))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["u", "v"])

    return run


def verified(width: int):
    """Stream of (key, i, j, pivot, node, text) rows, grouped by key, i, j with pivots first -> links (u, v) of true similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, pivots = None, {}, 0

        def links() -> Iterator[pa.RecordBatch]:
            if len(held) > 1 and (found := similar_spanning(list(held), list(held.values()), pivots)):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["u", "v"])

        for batch in batches:
            for key, i, j, pivot, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != now:
                    yield from links()
                    now, held, pivots = (key, i, j), {}, 0
                held[node] = shingle_set(text, width)[1]
                pivots += pivot
        yield from links()

    return run


def hub_links(met: DataFrame, texts: DataFrame, width: int, spread: int) -> DataFrame:
    """Links of each key's hub, its least node, with the nodes that meet it and are similar; linear in what meets."""
    star = met.groupBy("hub", "node").agg(F.first("size").alias("size"))
    salts = star.groupBy("hub").agg(F.ceil(F.sum("size") / F.lit(spread)).cast("int").alias("salts"))
    members = star.join(salts, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("first"), "node")
    heads = salts.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("first"), F.col("hub").alias("node"))
    rows = members.unionByName(heads).join(texts, "node").select("hub", "salt", "first", "node", "text")
    return rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.desc("first")).mapInArrow(against_hub(width), "u long, v long")


def unsettled(met: DataFrame, roots: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """(key, i, j, pivot, node): what of a key's nodes has to be compared yet.

    Nodes that the hubs' links connect with their key's hub need no links among themselves. The others, the pivots,
    are compared with each other and with these, in blocks of at most `most` shingles. Keys with the same nodes are
    compared once.
    """
    root = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    judged = met.join(root("node"), "node", "left").join(root("hub"), "hub", "left")
    judged = judged.select("key", "hub", "node", "size", F.coalesce("node_root", "node").alias("root"), F.coalesce("hub_root", "hub").alias("hub_root"))
    judged = scratch.write(judged.withColumn("pivot", F.col("root") != F.col("hub_root")), "judged")
    blocks = lambda mine: F.ceil(F.coalesce(F.sum(F.when(mine, F.col("size"))), F.lit(0)) / F.lit(most)).cast("int")
    pivot = F.col("pivot")
    stats = judged.groupBy("key").agg(F.first("hub").alias("hub"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "pivot")).alias("sign"), blocks(pivot).alias("p"), blocks(~pivot).alias("q"), F.min(F.when(pivot, F.col("root"))).alias("lo"), F.max(F.when(pivot, F.col("root"))).alias("hi"))
    once = stats.where("p > 0 and (q > 0 or lo <> hi)").groupBy("hub", "n", "sign").agg(F.min(F.struct("key", "p", "q")).alias("k")).select("k.*")
    dealt = judged.select("key", "node", "pivot").join(once, "key").withColumn("b", F.pmod(F.xxhash64("node"), F.when(pivot, F.col("p")).otherwise(F.col("q"))).cast("int"))
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    b, p, q = F.col("b"), F.col("p"), F.col("q")
    with_pivots = F.transform(F.filter(upto("p"), lambda o: (o != b) | (q == 0)), lambda o: pair(F.least(b, o), F.greatest(b, o)))
    with_rest = F.when(q > 0, F.transform(upto("q"), lambda s: pair(b, p + s))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    places = F.when(pivot, F.concat(with_pivots, with_rest)).otherwise(F.transform(upto("p"), lambda o: pair(o, p + b)))
    return dealt.select("key", "pivot", "node", F.explode(places).alias("at")).select("key", "at.i", "at.j", "pivot", "node")


def similar_roots(keyed: DataFrame, nodes: DataFrame, width: int, scratch: Scratch, most: int, spread: int) -> DataFrame:
    """(node, root) of the components that similarities of nodes meeting in a group of the index make; only linked nodes appear.

    First every node is compared with the hubs of its groups (keys here), which settles near copies in linear time.
    Only nodes that this leaves apart from their hub are compared further, within each key.
    """
    spark = keyed.sparkSession
    met = groups_of(nodes, scratch)
    asked = met.select("node").unionByName(met.select(F.col("hub").alias("node"))).distinct()
    places = nodes.select("node", "k.id", "k.th").join(asked, "node")
    texts = keyed.select("id", "th", "text").join(places.hint("merge"), ["id", "th"]).groupBy("node").agg(F.first("text").alias("text"))
    texts = scratch.write(texts, "texts")
    links = scratch.write(hub_links(met, texts, width, spread), "hub_links")
    roots = connected_components(links, Scratch(spark, "neardup_hubs"))
    rest = scratch.write(unsettled(met, roots, scratch, most), "unsettled")
    if rest.isEmpty():
        return roots
    rows = rest.join(texts, "node").select("key", "i", "j", "pivot", "node", "text")
    more = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", F.desc("pivot")).mapInArrow(verified(width), "u long, v long")
    return connected_components(links.unionByName(scratch.write(more, "more_links")), Scratch(spark, "neardup_links"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text", most: int = 8_000_000, spread: int = 250_000) -> DataFrame:
    """`docs` with one row of each component of shingle Jaccard >= 0.8: that of the least id (null last), ties by a hash of the text."""
    scratch, last = Scratch(docs.sparkSession, "neardup"), 2**63 - 1
    # the row travels packed, so its columns may have any names
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    each = scratch.write(keyed.select("id", "th", "text").mapInArrow(indexed(width), "id long, th long, node long, size long, fp binary"), "indexed")
    nodes = scratch.write(each.groupBy("node").agg(F.min(F.struct("id", "th")).alias("k"), F.first("size").alias("size"), F.first("fp").alias("fp")), "nodes")
    roots = similar_roots(keyed, nodes, width, scratch, most, spread)
    found = each.select("id", "th", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_doc = found.groupBy("root", "id", "th").agg(F.count("*").alias("n"))
    best = per_doc.groupBy("root").agg(F.min(F.struct("id", "th", "n")).alias("k"))
    keep = scratch.write(best.select("k.id", "k.th", "k.n"), "keep")
    rows = keyed.drop("text")
    kept = rows.join(keep.where("n = 1").hint("merge"), ["id", "th"], "left_semi")  # what stays grows with the corpus: never broadcast it
    repeated = keep.where("n > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(rows.join(repeated, ["id", "th"], "left_semi").groupBy("id", "th").agg(F.first("row").alias("row")))
    return kept.select("row.*")

"""Best-fit packing by minimum bin slack (MBS).

Every document becomes token ids and an end id; only documents longer than the capacity are cut, the short
piece first. A bin is filled by a bitset subset-sum dynamic programme over the lengths still available: the
largest length left seeds the bin, the fullest reachable sum completes it, and that combination is removed.

Items of equal length are interchangeable, so the programme runs over the length histogram (at most
`capacity` rows, whatever the corpus size) and removes a combination as often as its scarcest length allows.
Documents then find their bin by (length, rank): ranks come from counters kept while tokenising plus offsets
per task, so no task or driver ever sees more than the histogram, and a hot length costs nothing special.

Edge cases: null or empty text is the end id alone; repeated rows and repeated ids are packed once per row;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import Scratch

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, local_rank long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

_MEMO: dict[str, "Encoder"] = {}
_SAFE_SPLIT = re.compile(r"(?<=\S) (?=\S)")


class Unsafe(Exception):
    """A space stands beside other white space, so chunks between spaces are not independent."""


class Memo(dict):
    """Chunk -> little-endian ids; two generations bound it, and what is still in use moves to the new one."""

    def __init__(self, encode, prefix: str, limit: int):
        self.encode, self.prefix, self.limit, self.old = encode, prefix, limit, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if self.prefix and (not chunk or chunk[0].isspace() or chunk[-1].isspace()):
                raise Unsafe
            ids = array("I", self.encode(self.prefix + chunk)).tobytes()
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


def engine(path: str):
    """text -> ids of a byte-level BPE file. If its merges stand in the order of their ids, as ranks do, a rank
    engine gives the same ids several times faster; any other file is left to its own library."""
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"].get("merges", [])
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    letters = sorted(pre_tokenizers.ByteLevel.alphabet())
    plain = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not spec["pre_tokenizer"].get("add_prefix_space")
    if plain and all(vocab.get(x) == len(letters) + k for k, x in enumerate(joined)):
        shown = [k for k in range(256) if chr(k) in letters]
        byte = {chr(k): k for k in shown} | {chr(256 + n): k for n, k in enumerate(k for k in range(256) if k not in shown)}
        ranks = {bytes(byte[c] for c in x): vocab[x] for x in [*letters, *joined]}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True  # texts come here without added tokens
    return lambda text: tok.encode(text, add_special_tokens=False).ids


def added_tokens(path: str) -> tuple[dict[str, int], bool]:
    """The file's added tokens with their ids, and whether any of them takes more than its own characters."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    rows = spec.get("added_tokens") or []
    return {r["content"]: r["id"] for r in rows}, any(r.get("lstrip") or r.get("rstrip") or r.get("single_word") or r.get("normalized") and spec.get("normalizer") for r in rows)


class Encoder:
    """The tokenizers library's exact ids of a byte-level BPE file, memoised per space-separated chunk.

    Added tokens that stand in a text are found first, as the library does, and each is its own id. A single space
    between two visible characters always starts a new pre-token, so what lies between them may be cut there and
    each chunk encoded alone. The memo lives as long as the Python worker and is bounded.
    """

    def __init__(self, path: str, limit: int = 300_000):
        self.exact = encode = engine(path)
        self.first, self.rest = Memo(encode, "", limit // 10), Memo(encode, " ", limit)
        self.added, self.greedy = added_tokens(path)
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        if self.greedy:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.special or not self.special.search(text):
            return self.plain(text)
        if self.greedy:  # tokens that take white space or look at their neighbours are left to the library
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        out, at = [], 0
        for hit in self.special.finditer(text):
            out += [self.plain(text[at : hit.start()]), array("I", [self.added[hit[0]]]).tobytes()]
            at = hit.end()
        return b"".join([*out, self.plain(text[at:])])

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if not text:
            return b""
        parts = text.split(" ")
        try:
            if not parts[0] or parts[0][-1].isspace():
                raise Unsafe
            return self.first[parts[0]] + b"".join(map(self.rest.__getitem__, parts[1:]))
        except Unsafe:
            head, *tail = _SAFE_SPLIT.split(text)
            return b"".join([array("I", self.exact(head)).tobytes(), *[array("I", self.exact(f" {x}")).tobytes() for x in tail]])


def encoder(path: str) -> Encoder:
    if path not in _MEMO:
        _MEMO[path] = Encoder(path)
    return _MEMO[path]


def tokenise_pieces(path: str, capacity: int, end_id: int):
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, seen = encoder(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = enc.encode(text or "") + end
                n, start, piece = len(ids) // 4, 0, 0
                while start < n:
                    size = (n - start) % capacity or capacity
                    rows.append((doc_id, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), task, seen[size]))
                    seen[size] += 1
                    start, piece = start + size, piece + 1
            columns = list(zip(*rows)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"])

    return run


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum within `room`, larger lengths preferred.

    `lengths` descend. Bit s of the running integer says that sum s is reachable; the snapshots before each
    length (multiplicities split in powers of two) let the chosen sum be traced back.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for size in lengths:
        if size > room:
            continue
        left, power = min(counts[size], room // size), 1
        while left:
            take = min(power, left)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & mask
            left, power = left - take, power * 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, defaultdict(int)
    for size, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[size] += take
            at -= size * take
    return dict(chosen)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations (length -> multiplicity) and how many bins take each."""
    counts, plan = {k: v for k, v in histogram.items() if v}, []
    lengths = sorted(counts, reverse=True)
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        combo = fullest(lengths, counts, capacity - seed)
        counts[seed] += 1
        combo[seed] = combo.get(seed, 0) + 1
        times = min(counts[k] // m for k, m in combo.items())
        plan.append((combo, times))
        for k, m in combo.items():
            counts[k] -= m * times
        lengths = [k for k in lengths if counts[k]]
    return plan


def intervals(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, multiplicity, first sequence, offset of its first copy in the bin)."""
    used, out, sequence = defaultdict(int), defaultdict(list), 0
    for combo, times in plan:
        offset = 0
        for size in sorted(combo, reverse=True):
            out[size].append((used[size], combo[size], sequence, offset))
            used[size] += combo[size] * times
            offset += combo[size] * size
        sequence += times
    return {k: np.asarray(v, np.int64) for k, v in out.items()}


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every row of `docs`; one result row per piece, with its sequence and its place there."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "packing")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = scratch.write(slim.mapInArrow(tokenise_pieces(tokenizer_path, capacity, end_id), PIECES), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # At most `capacity` rows reach the driver, however many documents there are.
    histogram = {int(r.length): int(r.n) for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = intervals(plan_bins(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    ranked = pieces.join(shift, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("local_rank") + F.col("shift")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                mine, rows = length == size, places[int(size)]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                nth = rank[mine] - row[:, 0]
                sequence[mine], offset[mine] = row[:, 2] + nth // row[:, 1], row[:, 3] + nth % row[:, 1] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PACKED)

"""Katz backoff language model: Good-Turing discounts, exactly normalised backoff weights, recursive scoring.

Model. For a history h seen in training and a word w,
    p(w | h) = d(c) c(h w) / c(h)                     if h w was seen,
               alpha(h) p(w | h without its first word)   otherwise,
down to p(w) = d(c) c(w) / N, the mass that discounting frees there going to one unknown word. d is Katz's
Good-Turing discount for counts up to `most` (1 above it, and where the counts of counts do not allow it);
alpha(h) = (1 - sum of seen p(w | h)) / (1 - sum of the same words' lower-order p), so each p(. | h) sums to 1.
Where discounting frees nothing after a history (all its counts are large), one more token stands in its
denominator, so that no text has probability 0. If a history's seen words leave no lower-order mass, its seen part is rescaled to 1 and alpha is 0.

Distribution. Documents are read once and packed into chunks (at most `chunk_tokens` tokens, or one longer
document): local word numbers and each chunk's own dictionary. Every later pass works on chunks, and a chunk
meets the model the same way for each order: it sends its distinct n-grams, with their counts in its training
documents and their lower-order probabilities, to buckets by history; buckets add the counts up, write the
model tables (partitioned by order), give each n-gram a number that is small if it is frequent, and answer
each chunk with its n-grams' counts and numbers and its histories' weights. So a frequent n-gram costs an
entry per chunk, not per token. Histories that stand for over an eighth of a bucket's n-grams (or 1/`HOT` of all training
tokens, if that is more: so they are at most `HOT`, and the start mark) are spread over all buckets by their words; only
their sums, at most `HOT` rows a bucket, are added up once more. The driver sees counts of counts and those sums,
nothing else. Buckets and chunks grow in number with the corpus and each shuffle has a partition for each, so a
task's memory does not grow until 1/`HOT` of all tokens fills a bucket.

The text starts with a start mark, which is a history but no token, and ends with an end token.

Edge cases: null or empty text is its end token alone; repeated rows each count and each get their row; a null
id hashes as empty text; with no training tokens every probability falls to the unknown word; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import Scratch

HOT = 65_536
END = np.uint64(0x9E3779B97F4A7C15)  # the end token's hash in round 1
START = np.uint64(0)  # the number of the history before a text's first token; n-grams are numbered from 1
CHUNK_NAMES = ["chunk", "docs", "words", "toks", "grams"]
CHUNK = "chunk long, docs binary, words binary, toks binary, grams binary"
MESSAGE = "bucket int, chunk long, hot boolean, body binary"
MESSAGE_NAMES = ["bucket", "chunk", "hot", "body"]


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays -> one compressed blob; byte planes of wide integers lie together, which suits the compressor."""
    head, parts = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if a.dtype.itemsize > 1 else a.tobytes()
        head.append(f"{a.dtype.str}:{len(a)}")
        parts.append(raw)
    return zstandard.ZstdCompressor(level=1).compress((",".join(head) + "\n").encode() + b"".join(parts))


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    cut = raw.index(b"\n")
    at, out = cut + 1, []
    for item in raw[:cut].decode().split(","):
        kind, n = item.split(":")
        kind, n = np.dtype(kind), int(n)
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def scatter(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number of two, to deal n-grams to buckets."""
    with np.errstate(over="ignore"):
        x = (history ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0x9FB21C651E98DF25)
        x = (x ^ (x >> np.uint64(29))) + word * np.uint64(0xE7037ED1A0B428DB)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
        return x ^ (x >> np.uint64(28))


def least_kind(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 2**32 else np.uint64)


def chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 4))], names=CHUNK_NAMES)


def chunks(folds: int, chunk_tokens: int):
    """(doc_id, text) rows -> chunks. Word 0 of a chunk is the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        local: dict[bytes, int] = {}
        ids, held, sizes, toks, n = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal local, ids, held, sizes, toks, n, nth
            digest = xxhash.xxh3_64_intdigest
            words = np.fromiter((digest(w) for w in local), np.uint64, len(local))
            known = np.fromiter((i is not None for i in ids), np.uint8, len(ids))
            number = np.fromiter((i or 0 for i in ids), np.int64, len(ids))
            docs = squeeze(number, known, np.asarray(sizes, np.uint32), np.asarray(held, np.uint8))
            row = ((task << 32) | nth, docs, squeeze(np.append(END, words)), squeeze(np.concatenate(toks)), None)
            local, ids, held, sizes, toks, n, nth = {}, [], [], [], [], 0, nth + 1
            return chunk_batch([row])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or "").encode().lower().split()
                if n and n + len(words) + 1 > chunk_tokens:
                    yield flush()
                try:
                    tok = np.fromiter(map(local.__getitem__, words), np.uint32, len(words))
                except KeyError:
                    for w in words:
                        local.setdefault(w, len(local) + 1)
                    tok = np.fromiter(map(local.__getitem__, words), np.uint32, len(words))
                ids.append(i)
                held.append(zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0)
                sizes.append(len(words) + 1)
                toks.append(np.append(tok, np.uint32(0)))
                n += len(words) + 1
        if ids:
            yield flush()

    return run


class Chunk:
    """A decoded chunk after some orders: hashes of its words before the first, numbers and counts after it, and
    each token's n-gram of the last order with that n-gram's number and probability."""

    def __init__(self, row: dict, plan: "Plan"):
        self.chunk, self.docs = row["chunk"], row["docs"]
        self.ids, self.known_id, sizes, self.held = unsqueeze(row["docs"])
        self.sizes = sizes.astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.key, *count = unsqueeze(row["words"])
        (self.toks,) = unsqueeze(row["toks"])
        self.key = self.key.astype(np.uint64)
        self.train = np.repeat(self.held == 0, self.sizes)
        self.count = count[0].astype(np.int64) if count else None
        if row["grams"]:
            self.gram, number, self.gram_p = unsqueeze(row["grams"])
            self.gram_number = number.astype(np.uint64)
        elif count:
            self.gram, self.gram_number, self.gram_p = self.toks, self.key, plan.unigram(self.count)

    def packed(self, order: int) -> tuple:
        grams = squeeze(self.gram, least_kind(self.gram_number), self.gram_p) if order > 1 else None
        return self.chunk, self.docs, squeeze(least_kind(self.key), least_kind(self.count)), squeeze(self.toks), grams

    def distinct(self, order: int):
        """Distinct (history, word), their lower-order p, each token's index, training counts."""
        if order == 1:
            n = np.bincount(self.toks[self.train], minlength=len(self.key))
            return np.zeros(len(self.key), np.uint64), self.key, np.zeros(len(self.key)), self.toks, n
        word, history = self.key[self.toks], np.empty(len(self.toks), np.uint64)
        history[1:] = self.gram_number[self.gram[:-1]]
        history[self.first] = START
        by = np.lexsort((word, history))
        h, w = history[by], word[by]
        new = np.concatenate([np.ones(min(1, len(by)), bool), (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
        where = np.empty(len(by), np.uint32)
        where[by] = np.cumsum(new) - 1
        at = by[new]
        return h[new], w[new], self.gram_p[self.gram[at]], where, np.bincount(where[self.train], minlength=len(at))

    def take(self, order: int, answers: list[dict], plan: "Plan") -> None:
        """Go one order up with the buckets' answers."""
        h, w, lower, where, _ = self.distinct(order)
        count, number, weight, ratio = np.zeros(len(h), np.int64), np.zeros(len(h), np.uint64), np.zeros(len(h)), np.ones(len(h))
        told = {(a["bucket"], a["hot"]): a["body"] for a in answers}
        for bucket, is_hot, mine in slices(*plan.deal(order, h, w)):
            c, *rest = unsqueeze(told[bucket, is_hot])
            count[mine] = c
            if order < plan.order:
                number[mine] = rest.pop(0)
            if order > 1:
                # the history's alpha, and what a seen count is divided by
                _, size = runs(h[mine])
                weight[mine], ratio[mine] = np.repeat(rest[0], size), np.repeat(rest[1], size)
        if order == 1:
            self.key, self.count = number, count
            self.gram_p = plan.unigram(count)
        else:
            d = plan.discount(order)
            self.gram_p = np.where(count > 0, d[np.minimum(count, len(d) - 1)] * count * ratio, weight * lower)
        self.gram, self.gram_number = where, number


class Plan:
    """What is the same for all chunks: bucket numbers, hot histories and discounts per order, unigram facts."""

    def __init__(self, order: int, buckets: int, train: int):
        self.order, self.buckets, self.train, self.types, self.unknown, self.scale = order, buckets, train, 0, 1.0, 1.0
        self.hot: dict[int, np.ndarray] = {}
        self.d: dict[int, np.ndarray] = {}

    def unigram(self, count: np.ndarray) -> np.ndarray:
        d = self.discount(1)
        return np.where(count > 0, d[np.minimum(count, len(d) - 1)] * count * self.scale / max(self.train, 1), self.unknown)

    def discount(self, order: int) -> np.ndarray:
        return np.append(self.d[order], 1.0)  # counts beyond the table are not discounted

    def deal(self, order: int, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hot = self.hot.get(order, np.zeros(0, np.uint64))
        is_hot = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
        key = scatter(h, np.where(is_hot | (order == 1), w, np.uint64(0)))
        return (key % np.uint64(self.buckets)).astype(np.int32), is_hot


def slices(bucket: np.ndarray, is_hot: np.ndarray):
    """(bucket, hot, indices) for each filled pair; indices ascend, so both sides can number them alike."""
    code = bucket.astype(np.int64) * 2 + is_hot
    by = np.argsort(code, kind="stable")
    edge = np.flatnonzero(np.diff(code[by], prepend=-1))
    for a, b in zip(edge, np.append(edge[1:], len(by))):
        yield int(code[by[a]] // 2), bool(code[by[a]] % 2), by[a:b]


def runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of equal neighbours."""
    start = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), h[1:] != h[:-1]]))
    return start, np.diff(np.append(start, len(h)))


def discounts(counts_of_counts: dict[int, int], most: int) -> np.ndarray:
    """d[c] for c up to `most` (index 0 unused); 1 where Good-Turing does not give a ratio within (0, 1]."""
    d, n = np.ones(most + 1), counts_of_counts
    if not n.get(1):
        return d
    tail = (most + 1) * n.get(most + 1, 0) / n[1]
    for c in range(1, most + 1):
        if n.get(c) and tail < 1:
            r = (c + 1) * n.get(c + 1, 0) / (n[c] * c)
            x = (r - tail) / (1 - tail)
            if 0 < x <= 1:
                d[c] = x
    return d


def batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.bool_(), pa.binary()))], names=MESSAGE_NAMES)


def send(order: int, plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for row in got.to_pylist():
                h, w, p, _, n = Chunk(row, plan).distinct(order)
                out = []
                for bucket, is_hot, mine in slices(*plan.deal(order, h, w)):
                    start, size = runs(h[mine])
                    lower, which = np.unique(p[mine], return_inverse=True)
                    out.append((bucket, row["chunk"], is_hot, squeeze(least_kind(h[mine][start]), least_kind(size), least_kind(w[mine]), least_kind(n[mine]), lower, least_kind(which))))
                yield batch(out)

    return run


def move_up(order: int, plan: Plan):
    """Chunks with their answers -> chunks after that order; what it no longer needs stays behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for row in got.to_pylist():
                chunk = Chunk(row, plan)
                chunk.take(order, row["answers"], plan)
                yield chunk_batch([chunk.packed(order)])

    return run


def gathered(group: pa.Table):
    """The messages of a bucket: distinct (history, word) with summed counts and lower-order p, and each message's indices."""
    rows, parts = group.to_pylist(), []
    for r in rows:
        h, size, w, n, lower, which = unsqueeze(r["body"])
        parts.append((np.repeat(h.astype(np.uint64), size.astype(np.int64)), w.astype(np.uint64), n.astype(np.int64), lower[which]))
    h, w, n, p = (np.concatenate(x) for x in zip(*parts))
    by = np.lexsort((w, h))
    new = np.concatenate([[True], (h[by][1:] != h[by][:-1]) | (w[by][1:] != w[by][:-1])])
    where = np.empty(len(by), np.int64)
    where[by] = np.cumsum(new) - 1
    at = by[new]
    # counts are whole numbers far below 2**53, so floating sums are exact
    total = np.bincount(where, weights=n, minlength=len(at)).astype(np.int64)
    return rows, [len(x[0]) for x in parts], h[at], w[at], total, p[at], where


MERGED = "bucket int, chunks binary, grams binary, places binary"


def merge():
    """The messages of a bucket -> one row: its n-grams added up, and each message's places among them."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows, sizes, h, w, n, p, where = gathered(group)
        start, size = runs(h)
        lower, which = np.unique(p, return_inverse=True)
        senders = squeeze(np.asarray([r["chunk"] for r in rows], np.int64), np.asarray([r["hot"] for r in rows], np.uint8), np.asarray(sizes, np.int64))
        grams = squeeze(least_kind(h[start]), least_kind(size), least_kind(w), least_kind(n), lower, least_kind(which))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "chunks": [senders], "grams": [grams], "places": [squeeze(least_kind(where))]})

    return run


class Bucket:
    """A merged bucket, decoded."""

    def __init__(self, row: dict):
        self.number = row["bucket"]
        h, size, w, n, lower, which = unsqueeze(row["grams"])
        self.h, self.w, self.n, self.p = np.repeat(h.astype(np.uint64), size.astype(np.int64)), w.astype(np.uint64), n.astype(np.int64), lower[which]
        self.row = row

    def messages(self) -> Iterator[tuple[int, bool, np.ndarray]]:
        chunk, hot, size = unsqueeze(self.row["chunks"])
        (where,) = unsqueeze(self.row["places"])
        at = 0
        for c, is_hot, m in zip(chunk.tolist(), hot.tolist(), size.tolist()):
            yield c, bool(is_hot), where[at : at + m]
            at += m


def each_bucket(make):
    """Map-only pass over merged buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for row in got.to_pylist():
                yield make(Bucket(row))

    return run


def count(b: Bucket) -> pa.RecordBatch:
    seen = b.n > 0
    columns = [np.full(int(seen.sum()), b.number, np.int32), b.h[seen].view(np.int64), b.w[seen].view(np.int64), b.n[seen]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "history", "word", "n"])


def by_history(h, n, p, d):
    """Starts of the histories and their sums: counts, discounted counts, lower-order probabilities of seen words."""
    start, size = runs(h)
    kept = d[np.minimum(n, len(d) - 1)] * n
    return start, size, *(np.add.reduceat(x, start) if len(start) else np.zeros(0) for x in (n.astype(float), kept, np.where(n > 0, p, 0.0)))


def hot_sums(d: np.ndarray, hot: np.ndarray):
    def make(b: Bucket) -> pa.RecordBatch:
        start, _, c, kept, low = by_history(b.h, b.n, b.p, d)
        mine = np.isin(b.h[start], hot)
        columns = [b.h[start][mine].view(np.int64), c[mine], kept[mine], low[mine]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["history", "c", "kept", "low"])

    return make


def weights(c: np.ndarray, kept: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """alpha of each history and the factor that turns a discounted count into a probability."""
    free = 1.0 - low
    c = np.where((c > 0) & (kept >= c * (1 - 1e-12)), c + 1, c)
    with np.errstate(divide="ignore", invalid="ignore"):
        back = (free > 1e-12) & (c > 0)
        ratio = np.where(c > 0, np.where(back, 1.0 / c, 1.0 / kept), 0.0)
        alpha = np.where(c > 0, np.where(back, (1.0 - kept / c) / free, 0.0), 1.0)
    return alpha, ratio


def numbers(n: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """A number for each n-gram of a bucket, other than any of another bucket's, the smaller the more frequent."""
    rank = np.empty(len(n), np.uint64)
    rank[np.argsort(-n, kind="stable")] = np.arange(len(n), dtype=np.uint64)
    return rank * np.uint64(buckets) + np.uint64(bucket) + np.uint64(1)


def frequent(buckets: int, least: int):
    def make(b: Bucket) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(numbers(b.n, b.number, buckets)[b.n > least].view(np.int64))], names=["number"])

    return make


def answer(order: int, d: np.ndarray, hot: dict[int, tuple], buckets: int, last: bool):
    def make(b: Bucket) -> pa.RecordBatch:
        start, size, c, kept, low = by_history(b.h, b.n, b.p, d)
        if order > 1 and hot:
            for k in np.flatnonzero(np.isin(b.h[start], np.asarray(list(hot), np.uint64))):
                c[k], kept[k], low[k] = hot[int(b.h[start[k]])]
        alpha, ratio = weights(c, kept, low)
        number = numbers(b.n, b.number, buckets)
        run_of = np.repeat(np.arange(len(start)), size)
        out = []
        for chunk, is_hot, mine in b.messages():
            arrays = [least_kind(b.n[mine])]
            if not last:  # nothing follows the highest order, so its n-grams need no numbers
                arrays.append(least_kind(number[mine]))
            if order > 1:
                heads = run_of[mine][runs(b.h[mine])[0]]
                arrays += [alpha[heads], ratio[heads]]
            out.append((b.number, chunk, is_hot, squeeze(*arrays)))
        return batch(out)

    return make


def chunk_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        parts = [unsqueeze(x) for x in got.column(0).to_pylist()]
        tokens, train = (sum(int(s[keep(held)].sum()) for _, _, s, held in parts) for keep in (lambda h: h >= 0, lambda h: h == 0))
        yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([train]), pa.array([len(parts)])], names=["tokens", "train", "chunks"])


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(order: int, plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for row in got.to_pylist():
                chunk = Chunk(row, plan)
                chunk.take(order, row["answers"], plan)
                add = lambda x, chunk=chunk: np.add.reduceat(x, chunk.first)
                base = np.log10((chunk.count + 0.1) / (plan.train + 0.1 * (plan.types + 1)))[chunk.toks]
                known = (chunk.count > 0).astype(np.int64)[chunk.toks]
                columns = [pa.array(chunk.ids, mask=chunk.known_id == 0), pa.array(chunk.held == 1), pa.array(chunk.sizes), pa.array(add(known)), pa.array(np.full(len(chunk.sizes), plan.train, np.int64)), pa.array(add(base)), pa.array(add(np.log10(chunk.gram_p)[chunk.gram]))]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCORES.split(", ")])

    return run


class Katz:
    """Trains on the documents whose crc32(id) is not divisible by `folds`, and scores all."""

    def __init__(self, docs: DataFrame, order: int = 3, folds: int = 10, most: int = 5, chunk_tokens: int = 2_000_000, bucket_grams: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text"):
        self.scratch, self.order, self.most = Scratch(docs.sparkSession, "katz"), order, most
        slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.chunks = self.scratch.write(slim.mapInArrow(chunks(folds, chunk_tokens), CHUNK), "chunks0")
        totals = self.chunks.select("docs").mapInArrow(chunk_sizes, "tokens long, train long, chunks long").agg(F.sum("tokens"), F.sum("train"), F.sum("chunks")).first()
        self.plan = Plan(order, max(1, -(-int(totals[0] or 0) // bucket_grams)), int(totals[1] or 0))
        # counted in training tokens: a colder history is at most a small part of a bucket, unless the driver would see over HOT
        self.hot_from, self.n_chunks = max(1, bucket_grams // 8, self.plan.train // HOT), max(1, int(totals[2] or 0))
        self.tables: dict[int, DataFrame] = {}
        for k in range(1, order + 1):
            self._round(k)

    def _answered(self, answers: DataFrame) -> DataFrame:
        """Chunks, each with what the buckets answered."""
        told = answers.repartition(self.n_chunks, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "hot", "body")).alias("answers"))
        return self.chunks.join(told, "chunk")

    def _round(self, k: int) -> None:
        plan, scratch, most = self.plan, self.scratch, self.most
        # the one shuffle of n-grams of this order
        merged = scratch.write(self.chunks.mapInArrow(send(k, plan), MESSAGE).repartition(plan.buckets, "bucket").groupBy("bucket").applyInArrow(merge(), MERGED), f"merged{k}")
        self.tables[k] = table = scratch.write(merged.mapInArrow(each_bucket(count), "bucket int, history long, word long, n long"), f"order={k}")
        coc = {int(r.n): int(r.k) for r in table.where(F.col("n") <= most + 1).groupBy("n").agg(F.count("*").alias("k")).collect()}
        plan.d[k] = discounts(coc, most)
        d, hot = plan.discount(k), {}
        if k == 1:
            plan.types = table.count()
            if plan.train:
                freed = sum((1 - plan.d[1][c]) * c * coc.get(c, 0) for c in range(1, most + 1)) / plan.train
                # if nothing was discounted, the unknown word gets the share of one more token
                plan.unknown, plan.scale = (freed, 1.0) if freed > 0 else (1 / (plan.train + 1), plan.train / (plan.train + 1))
        else:
            sums = merged.mapInArrow(each_bucket(hot_sums(d, plan.hot[k])), "history long, c double, kept double, low double")
            summed = sums.groupBy("history").agg(*[F.sum(c).alias(c) for c in ("c", "kept", "low")])
            hot = {int(np.int64(r.history).view(np.uint64)): (r.c, r.kept, r.low) for r in summed.collect()}  # at most HOT + 1 rows
        self.answers = scratch.write(merged.mapInArrow(each_bucket(answer(k, d, hot, plan.buckets, k == self.order)), MESSAGE), f"answers{k}")
        if k < self.order:
            # histories of the next order that are too frequent for one bucket, at most HOT, and the start mark
            found = merged.mapInArrow(each_bucket(frequent(plan.buckets, self.hot_from)), "number long")
            plan.hot[k + 1] = np.asarray([0, *(r.number for r in found.collect())], np.uint64)
        scratch.drop(f"merged{k}")
        if k < self.order:
            self.chunks = scratch.write(self._answered(self.answers).mapInArrow(move_up(k, plan), CHUNK), f"chunks{k}")
            scratch.drop(f"chunks{k - 1}", f"answers{k}")
    
    def scores(self) -> DataFrame:
        return self._answered(self.answers).mapInArrow(score(self.order, self.plan), SCORES)

"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Every whole text becomes a short vector of statistics. A seeded cosine map approximates a Gaussian kernel over
the standardised vectors; each partition of labelled rows sums its part of the normal equations, the parts are
added row by row of the matrix, and the driver solves one system of `features` unknowns (2 MB at 512), however
many rows were summed. A calibration fold apart from the ridge fold is counted into `BINS` score bins, and
pool-adjacent-violators turns them into a monotone map to [0, 1].

Labels come only from rows whose crc32(id as text) is not divisible by `folds`; language, source, id and labels
are never inputs. Of the training rows, remainder 1 calibrates and the others fit. All labelled rows are used.

Edge cases: null text counts as empty and gets a score like any vector; null labels are ignored, contrary labels
of one id average; repeated rows each count; without training labels every score is 0.5; a null id hashes as
empty text and is held out; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import Scratch

BINS, LOW, HIGH = 2000, -1.0, 2.0
#: Partial sums of a line on the way to its total.
BRANCHES = 64
STATS = ["log_chars", "log_words", "log_lines", "word_length", "word_spread", "distinct", "top_word", "repeated_pairs", "symbols", "punctuation", "digits", "upper", "shout", "bars", "high_bytes", "entropy", "squeeze", "line_repeats"]
_GROUPS = {"symbols": b"#*$%&<>^~@_=", "punctuation": b".,;:'\"()-", "digits": b"0123456789", "upper": bytes(range(65, 91)), "shout": b"!?", "bars": b"|/\\{}[]"}
_TABLE = np.zeros((256, len(_GROUPS) + 1))
for _k, _chars in enumerate(_GROUPS.values()):
    _TABLE[list(_chars), _k] = 1
_TABLE[128:, -1] = 1


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode()
    if not raw.strip():
        return [0.0] * len(STATS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = counts @ _TABLE / len(raw)
    p = counts[counts > 0] / len(raw)
    words = raw.split()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    return [
        np.log1p(len(raw)), np.log1p(n), np.log1p(len(lines)), sizes.mean(), sizes.std(), len(seen) / n, max(seen.values()) / n, 1 - pairs / max(n - 1, 1) if n > 1 else 0.0,
        *shares, float(-(p * np.log2(p)).sum()), len(zlib.compress(raw, 1)) / len(raw), 1 - len(set(lines)) / len(lines),
    ]


def describe(folds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            fold = [zlib.crc32(("" if i is None else str(i)).encode()) % folds for i in ids]
            x = np.asarray([statistics(t) for t in batch.column(1).to_pylist()], np.float64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fold, pa.int32()), *[pa.array(c) for c in x.T]], names=["doc_id", "fold", *STATS])

    return run


class Model:
    """What scoring needs; a few MB at most."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, np.where(scale > 1e-9, scale, 1.0)
        self.w = rng.normal(0.0, 1.0 / width, (len(mean), features))
        self.b = rng.uniform(0.0, 2 * np.pi, features)
        self.theta = np.zeros(features + 1)
        self.at, self.level = np.asarray([LOW, HIGH]), np.asarray([0.5, 0.5])

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b
        return np.hstack([np.sqrt(2.0 / len(self.b)) * np.cos(z), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.theta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.at, self.level)


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(s).to_numpy() for s in STATS]) if batch.num_rows else np.zeros((0, len(STATS)))


def partial_sums(model: Model):
    """A partition's share of the normal equations, as rows (line of the matrix, its numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(model.theta)
        total = np.zeros((n, n + 1))
        for batch in batches:
            z = model.lift(matrix(batch))
            total += z.T @ np.column_stack([z, batch.column("y").to_numpy()])
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array([r.tobytes() for r in total])], names=["line", "sums"])

    return run


def add_lines(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.float64) for x in group.column("sums").to_pylist())
    return pa.table({"line": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()])})


def summed(lines: DataFrame) -> DataFrame:
    """The lines of all partitions added up as a tree: first `BRANCHES` sums of each line, then those."""
    kind = "line int, sums binary"
    some = lines.withColumn("branch", F.spark_partition_id() % BRANCHES).groupBy("line", "branch").applyInArrow(add_lines, kind)
    return some.groupBy("line").applyInArrow(add_lines, kind)


def isotonic(hits: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins in order; bins without rows are left out by the caller."""
    pools: list[list[float]] = []
    for h, n in zip(hits, total):
        pools.append([float(h), float(n), 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            h2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + h2, pools[-1][1] + n2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), h / n) for h, n, k in pools]) if pools else np.zeros(0)


def bin_scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip((model.raw(matrix(batch)) - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])

    return run


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def apply_model(model: Model, cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.clip(model.score(matrix(batch)), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(batch.column("fold").to_numpy() == 0), pa.array(s), pa.array((s >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, features: int = 384, width: float = 4.0, ridge: float = 1e-3, seed: int = 11, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted."""
    scratch = Scratch(docs.sparkSession, "classifier")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = scratch.write(slim.mapInArrow(describe(folds), ", ".join(["doc_id long", "fold int", *[f"{s} double" for s in STATS]])), "statistics")
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).where("y is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("y").alias("y"))
    train = scratch.write(rows.where("fold <> 0").join(marks, "doc_id"), "train")
    facts = train.agg(F.count("*"), *[F.avg(s) for s in STATS], *[F.stddev_pop(s) for s in STATS]).first()
    k = len(STATS)
    n = int(facts[0])
    model = Model(np.asarray([v or 0.0 for v in facts[1 : k + 1]]), np.asarray([v or 0.0 for v in facts[k + 1 :]]), features, width, seed)
    if n:
        fit = train.where("fold <> 1")
        lines = summed(fit.mapInArrow(partial_sums(model), "line int, sums binary")).collect()  # `features` + 1 rows
        if lines:
            total = np.vstack([np.frombuffer(r.sums, np.float64) for r in sorted(lines, key=lambda r: r.line)])
            a = total[:, :-1].copy()
            size = a[-1, -1]
            a[np.diag_indices(features)] += ridge * size
            a[-1, -1] += 1e-9
            model.theta = np.linalg.solve(a, total[:, -1])
        held = train.where("fold = 1") if train.where("fold = 1").limit(1).count() else train
        bins = held.mapInArrow(bin_scores(model), "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()  # at most BINS rows
        level = isotonic(np.asarray([r.y for r in bins]), np.asarray([r.n for r in bins]))
        model.at, model.level = np.asarray([LOW + (r.bin + 0.5) * (HIGH - LOW) / BINS for r in bins]), level
    return rows.mapInArrow(apply_model(model, cut), SCORED)

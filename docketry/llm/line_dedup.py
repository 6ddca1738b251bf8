"""Line dedup by pairwise alignment: shared rare line hashes find the pairs, patience diff aligns them.

Lines are compared with their white space collapsed; blank lines neither break a block nor go with it. What pairs
documents are hashes of short runs of lines: from every line the shortest run of following lines that has
`min_words` words, and the shortest such run of lines that ends there. They are rarer than the lines they hold, and a
line that is long enough alone is a run by itself. Every later document is paired with the first holder of each of its
runs, so a run that a third of the corpus holds costs one row per document, never a row per pair, and no run is too
frequent to count.

A later document is aligned with each of its partners by patience diff: shared runs are the anchors, patience sorting
keeps a longest series of them that stands in the same order in both, and neighbouring anchors grow together into
blocks. What moved (anchors that cross the series) is aligned again, until nothing shared is left; all passes come from
one patience sort. The aligned blocks are deleted from the later document.

So it does not matter which of several earlier holders is the partner: deleted are exactly the lines in common blocks
of at least `min_words` words with any earlier document, wherever they stand. (A block holds the run from its first
line and, for each line beyond that run, the run that ends there; each has a first holder.) Texts are aligned as they
came, so the result does not depend on an order of deletions.

Order: doc_id, null ids last, then a hash of the text. Rows with equal id and text are one document that is
repeated: they fare alike and do not delete each other's lines. Null text stays null, empty text stays empty;
a document whose every line goes keeps its row with an empty text; empty tables give empty results; all other
columns pass through, and n_chars, if there, follows the text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import Scratch, let

LAST = 2**63 - 1
RUNS = "id long, th long, step int, lines array<int>, key long"


def runs_of(sizes: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest runs with enough words from each line on and up to each line, in order."""
    found, first, words = set(), 0, 0
    for last, n in enumerate(sizes):
        words += n
        while words >= min_words:  # `first` is the last line from which a run up to here has enough words
            found.add((first, last))
            words -= sizes[first]
            first += 1
        if first:  # the shortest run that ends here
            k, have = last, n
            while have < min_words:
                k -= 1
                have += sizes[k]
            found.add((k, last))
    return sorted(found)


def split_runs(min_words: int):
    """(id, th, text) -> a row per run of lines: where its lines stand in the text, and its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, hashes, texts = (c.to_pylist() for c in batch.columns)
            out = ([], [], [], [], [])
            for i, th, text in zip(ids, hashes, texts):
                rows = [(pos, words) for pos, line in enumerate(text.split("\n")) if (words := line.split())]
                flat = [" ".join(words) for _, words in rows]
                for a, b in runs_of([len(words) for _, words in rows], min_words):
                    key = hashed("\n".join(flat[a : b + 1]).encode()) - 2**63
                    for column, value in zip(out, (i, th, a, [pos for pos, _ in rows[a : b + 1]], key)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["id", "th", "step", "lines", "key"])

    return run


def passes(pairs: list[tuple[int, int]]) -> list[list[int]]:
    """Patience sort of (step, partner's step) pairs, sorted by step: the fewest series, as indices, in each of which the
    partner's steps do not decrease."""
    tops: list[int] = []  # minus the last partner's step of each series, ascending
    out: list[list[int]] = []
    for k, (_, other) in enumerate(pairs):
        at = bisect_left(tops, -other)
        if at == len(out):
            out.append([])
            tops.append(0)
        tops[at] = -other
        out[at].append(k)
    return out


def blocks(matches: list[dict]) -> list[int]:
    """Lines to delete from one later document, given the runs that it shares with earlier ones."""
    by_partner: dict = defaultdict(list)
    for m in matches:
        by_partner[m["oid"], m["oth"]].append((m["step"], m["ostep"], m["lines"]))
    gone: set[int] = set()
    for rows in by_partner.values():
        rows.sort()
        for series in passes([r[:2] for r in rows]):
            for k in series:
                gone.update(rows[k][2])
    return sorted(gone)


def deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = [blocks(m) for m in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(gone, pa.list_(pa.int32()))], names=["id", "th", "gone"])


def dedup_lines(docs: DataFrame, min_words: int = 3, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_deleted") -> DataFrame:
    """`docs` with the aligned common blocks removed; `count_col`, if any, gets the number of lines removed."""
    scratch = Scratch(docs.sparkSession, "lines")
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    raw = keyed.where("text is not null and text <> ''").mapInArrow(split_runs(min_words), RUNS)
    runs = scratch.write(raw, "runs")
    owners = runs.groupBy("key").agg(F.min(F.struct("id", "th", "step")).alias("o"), F.max(F.struct("id", "th")).alias("last")).where("o.id <> last.id or o.th <> last.th")
    owners = scratch.write(owners, "owners")  # a table of its own, so that the join below may split a hot key
    shared = runs.join(owners.select("key", F.col("o.id").alias("oid"), F.col("o.th").alias("oth"), F.col("o.step").alias("ostep")), "key")
    later = shared.where("id <> oid or th <> oth").groupBy("id", "th", "step", "lines", "oid", "oth", "ostep").agg(F.lit(1).alias("one"))
    per_doc = later.groupBy("id", "th").agg(F.collect_list(F.struct("step", "lines", "oid", "oth", "ostep")).alias("matches"))
    gone = scratch.write(per_doc.mapInArrow(deletions, "id long, th long, gone array<int>"), "gone")
    scratch.drop("runs")
    # the row travels packed, so its columns may have any names
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("th"))
    joined = packed.join(gone.hint("merge"), ["id", "th"], "left")  # what goes grows with the corpus: never broadcast it
    old, gone_lines = F.col("row")[text_col].cast("string"), F.col("gone")
    rebuilt = let(F.split(old, "\n", -1), lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone_lines), lambda k: F.get(ls, k)), "\n"))
    cleaned = F.when(gone_lines.isNull(), old).otherwise(rebuilt)

    def out(c: str) -> Column:
        if c == text_col:
            return cleaned.alias(c)
        kept = F.col("row")[c]
        if c == "n_chars" and c != id_col:
            kept = F.when(gone_lines.isNull(), kept).otherwise(F.length(cleaned).cast(docs.schema[c].dataType))
        return kept.alias(c)

    extra = [F.when(gone_lines.isNull(), 0).otherwise(F.size(gone_lines)).alias(count_col)] if count_col else []
    return joined.select(*[out(c) for c in docs.columns if c != count_col], *extra)

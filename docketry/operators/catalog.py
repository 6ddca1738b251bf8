"""Catalog queries and changes (CAT, DML, AGG): DataFrame in, DataFrame out; `Catalog` keeps two append-only logs.

A catalog row is the latest log entry of its id joined with the latest status of that id. Nothing is updated in
place, so a change costs its own size; `compact` folds the logs into a new folder.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions import header as H


def filing_id(ticker: Column, file_path: Column) -> Column:
    return F.xxhash64(ticker, file_path)


# --- queries ------------------------------------------------------------------------------------------------


def get_filings(catalog: DataFrame, ticker: str | None = None, filing_type: str | None = None, start: dt.date | None = None, end: dt.date | None = None, parsed: bool | None = None, limit: int | None = None, listing: DataFrame | None = None, limit_after_exists: bool = False) -> DataFrame:
    """CAT-1: filters, newest first (ties by id), limit, then only rows whose file is in `listing`.

    The limit comes before the existence check unless `limit_after_exists`.
    """
    checks = ((ticker, str), (filing_type, str), (start, dt.date), (end, dt.date), (parsed, bool), (limit, int))
    for value, kind in checks:
        if value is not None and (not isinstance(value, kind) or kind is int and isinstance(value, bool)):
            raise TypeError(f"{value!r} is no {kind.__name__}")
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    out = catalog
    for column, value in (("ticker", ticker), ("filing_type", filing_type), ("parsed", parsed)):
        out = out.where(F.col(column) == value) if value is not None else out
    out = out.where(F.col("filing_date") >= F.lit(start)) if start else out
    out = out.where(F.col("filing_date") <= F.lit(end)) if end else out
    newest = [F.desc_nulls_last("filing_date"), F.asc("id")]
    if listing is not None and limit_after_exists:
        out = existing_only(out, listing)
    out = out.orderBy(*newest).limit(limit) if limit else out
    if listing is not None and not limit_after_exists:
        out = existing_only(out, listing)
    return out.orderBy(*newest)


def unparsed(catalog: DataFrame, **filters) -> DataFrame:
    """CAT-2."""
    return get_filings(catalog, parsed=False, **filters)


def existing_only(catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """CAT-3."""
    return catalog.join(listing.select("file_path"), "file_path", "left_semi").select(*catalog.columns)


def top_tickers(catalog: DataFrame, n: int = 10) -> DataFrame:
    """CAT-4."""
    return catalog.groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(n)


def counts(catalog: DataFrame) -> DataFrame:
    """AGG-1..3 and 5 in one pass: (measure, value, n)."""
    status = F.when(F.col("parsed"), F.coalesce(F.nullif("parse_status", F.lit("")), F.lit("unknown")))
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("value")) for m, v in (("total", F.lit("")), ("ticker", F.col("ticker")), ("filing_type", F.col("filing_type")), ("parse_status", status))])
    each = catalog.select(F.explode(cells).alias("c")).select("c.*").where("measure <> 'parse_status' or value is not null")
    return each.groupBy("measure", "value").agg(F.count("*").alias("n"))


def summary(catalog: DataFrame) -> DataFrame:
    """AGG-1, 4 and 6 as one row."""
    return catalog.agg(F.count("*").alias("total"), F.count_if("parsed").alias("parsed"), F.count_if(~F.coalesce("parsed", F.lit(False))).alias("unparsed"), F.min("filing_date").alias("first_date"), F.max("filing_date").alias("last_date"))


def batch_summary(results: DataFrame) -> DataFrame:
    """AGG-8: anything but success failed."""
    good = F.coalesce(F.col("status") == "success", F.lit(False))
    return results.agg(F.count("*").alias("total"), F.count_if(good).alias("successful"), F.count_if(~good).alias("failed"))


# --- changes as set transforms ------------------------------------------------------------------------------


def described(files: DataFrame, as_of: dt.date) -> DataFrame:
    """(ticker, filing_type, file_path, content_text) -> log rows; files without a filing date give none."""
    rows = files.select(filing_id(F.col("ticker"), F.col("file_path")).alias("id"), "ticker", "filing_type", H.filing_date(F.col("content_text")).alias("filing_date"), "file_path", H.accession(F.col("content_text"), F.col("file_path")).alias("accession_number"), F.lit(as_of).alias("download_date"))
    return rows.where("filing_date is not null")


def new_rows(found: DataFrame, catalog: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Found rows whose keys the catalog lacks: (ticker, file_path) to add, file_path alone to catalog, three to scan a folder."""
    return found.join(catalog.select(*keys).distinct(), list(keys), "left_anti").select(*found.columns)


def upsert(catalog: DataFrame, found: DataFrame, update: bool = True) -> DataFrame:
    """DML-1: insert new (ticker, file_path), update the metadata of known ones, leave parse state alone."""
    fresh = found.dropDuplicates(["ticker", "file_path"])
    blank = {"parsed": F.lit(False), "parse_date": F.lit(None).cast("date"), "parse_status": F.lit(None).cast("string")}
    added = new_rows(fresh, catalog, ("ticker", "file_path")).withColumns(blank).select(*catalog.columns)
    if not update:
        return catalog.unionByName(added)
    changed = ["filing_type", "filing_date", "accession_number", "download_date"]
    newer = fresh.select("ticker", "file_path", *[F.col(c).alias(f"_{c}") for c in changed], F.lit(True).alias("_hit"))
    kept = catalog.join(newer, ["ticker", "file_path"], "left")
    kept = kept.select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in catalog.columns])
    return kept.unionByName(added)


def sync_counts(discovered: DataFrame, added: DataFrame) -> DataFrame:
    """DML-4: new rows per discovered (ticker, filing_type), zeros included."""
    n = added.groupBy("ticker", "filing_type").agg(F.count("*").alias("n"))
    return discovered.select("ticker", "filing_type").distinct().join(n, ["ticker", "filing_type"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def sync_summary(counts: DataFrame) -> DataFrame:
    """AGG-7: what a sync added in all, and for how many tickers it looked."""
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("added"), F.countDistinct("ticker").alias("tickers"))


def selected(filing_id: int | None = None, ticker: str | None = None, accession_number: str | None = None, file_path: str | None = None) -> Column:
    """Which rows a mark hits: the id, else ticker and accession number, else the path."""
    if filing_id is not None:
        return F.col("id") == filing_id
    if ticker and accession_number:
        return (F.col("ticker") == ticker) & (F.col("accession_number") == accession_number)
    if file_path:
        return F.col("file_path") == file_path
    raise ValueError("name an id, a ticker with an accession number, or a file path")


def mark(catalog: DataFrame, hit: Column, parsed: bool, status: str | None = "success", as_of: dt.date | None = None) -> DataFrame:
    """DML-5 and 6."""
    hit = F.coalesce(hit, F.lit(False))
    after = {"parsed": F.lit(parsed), "parse_date": F.lit(as_of if parsed else None).cast("date"), "parse_status": F.lit(status if parsed else None).cast("string")}
    return catalog.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in after.items()})


# --- the stored catalog -------------------------------------------------------------------------------------


def _batched(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield some


class Catalog:
    """A catalog in a folder."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def _log(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.location}/{name}")

    def filings(self) -> DataFrame:
        """The current rows; older logs may lack columns, which read as NULL."""

        def latest(log: DataFrame) -> DataFrame:
            """The last entry of each id (of entries of one moment the greatest), combined before the shuffle."""
            last = log.groupBy("id").agg(F.max(F.struct("op_ts", *[c for c in log.columns if c not in ("id", "op_ts")])).alias("last"))
            return last.select("id", "last.*").drop("op_ts")

        status = latest(self._log("status_log", schemas.STATUS_LOG))
        rows = latest(self._log("filings_log", schemas.FILINGS_LOG)).join(status, "id", "left")
        return rows.withColumn("parsed", F.coalesce("parsed", F.lit(False))).select(*[c.split()[0] for c in schemas.CATALOG.split(", ")])

    def append(self, rows: DataFrame) -> None:
        rows.withColumn("op_ts", F.current_timestamp()).select(*[c.split()[0] for c in schemas.FILINGS_LOG.split(", ")]).write.mode("append").parquet(f"{self.location}/filings_log")

    def add(self, files: DataFrame, as_of: dt.date, update: bool = False, keys: tuple[str, ...] = ("ticker", "file_path")) -> int:
        """DML-1..3 over files with their text; returns how many rows were written."""
        found = described(files, as_of).dropDuplicates(["ticker", "file_path"])
        rows = found if update else new_rows(found, self.filings(), keys)
        rows = rows.cache()
        n = rows.count()
        if n:
            self.append(rows)
        rows.unpersist()
        return n

    def sync(self, root: str, as_of: dt.date, tickers: list[str] | None = None, batch: int = 10_000) -> DataFrame:
        """DML-4: one listing, paths the catalog lacks (R2), and only then their content: fresh paths go to the reader in
        batches, so a sync reads what is new and no more; the first sync of a tree, which reads most of it, reads it at once."""
        from docketry.sources.filings import read_text, tree

        listed = tree(self.spark, root)
        listed = listed.where(F.col("ticker").isin(*tickers)) if tickers else listed
        fresh = new_rows(listed, self.filings(), ("ticker", "filing_type", "file_path"))
        paths = fresh.select("ticker", "filing_type", "file_path").cache()
        if 2 * paths.count() > listed.count():
            parts = [read_text(self.spark, root + "/*/*/*")]
        else:
            rows = iter([r.file_path for r in some] for some in _batched(paths.select("file_path").toLocalIterator(), batch))
            parts = [read_text(self.spark, names) for names in rows]
        found = [described(text.join(paths, "file_path"), as_of) for text in parts] or [described(paths.withColumn("content_text", F.lit("")), as_of)]
        # staged first: the log may then grow without changing what was found, even if executors are lost
        staged = f"{self.location}/staged/{uuid.uuid4().hex}"
        for part in found:
            part.write.mode("append").parquet(staged)
        paths.unpersist()
        found = self.spark.read.schema(found[0].schema).parquet(staged)
        self.append(found)
        return sync_counts(listed, found)

    def set_status(self, hit: Column, parsed: bool, status: str | None = "success", as_of: dt.date | None = None) -> bool:
        """DML-5 and 6; False if no row is hit."""
        rows = mark(self.filings().where(F.coalesce(hit, F.lit(False))), F.lit(True), parsed, status, as_of)
        rows = rows.select("id", "parsed", "parse_date", "parse_status").cache()
        if rows.isEmpty():
            return False
        rows.withColumn("op_ts", F.current_timestamp()).write.mode("append").parquet(f"{self.location}/status_log")
        return True

    def compact(self, location: str) -> "Catalog":
        """Fold the logs into a new folder, never the one being read."""
        now = self.filings()
        other = Catalog(self.spark, location)
        other.append(now)
        now.select("id", "parsed", "parse_date", "parse_status", F.current_timestamp().alias("op_ts")).write.mode("append").parquet(f"{other.location}/status_log")
        return other

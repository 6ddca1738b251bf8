"""Coverage gaps (COV): which periods lack a filing. All keys at once; a key is a (ticker, filing_type) or any columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Filing types by name.
FILING_TYPES = ("FILING_10K", "FILING_10Q", "FILING_4", "FILING_8K")
PREFIX = "FilingType."


def resolve_type(name: str) -> str | None:
    """COV-6: an exact name, its prefix stripped; anything else is unknown."""
    bare = name.removeprefix(PREFIX)
    return bare if bare in FILING_TYPES else None


def parse_date(value: str) -> dt.date:
    """DATE-1: strict ISO."""
    try:
        if len(value) != 10:
            raise ValueError
        return dt.date.fromisoformat(value)
    except (TypeError, ValueError):
        raise ValueError(f"{value!r} is no date of the form YYYY-MM-DD") from None


def _checked(start: dt.date, end: dt.date) -> None:
    if start > end:
        raise ValueError("the range starts after its end")


def _dates(dates: DataFrame, keys: list[str], wanted: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row per wanted key: its distinct dates in range, sorted, as array `d`.

    The only shuffle of filings in this module. It combines on the map side, and an array is no longer than the
    range has days, so neither a busy key nor a long history makes a large group.
    """
    _checked(start, end)
    inside = dates.where(F.col("filing_date").between(F.lit(start), F.lit(end)))
    found = inside.groupBy(*keys).agg(F.array_sort(F.collect_set("filing_date")).alias("d"))
    return wanted.select(*keys).distinct().join(found, keys, "left").withColumn("d", F.coalesce("d", F.array().cast("array<date>")))


def _span(first: Column, last: Column) -> Column:
    return F.struct(first.alias("range_start"), last.alias("range_end"))


def _periods(d: Column, start: dt.date, end: dt.date, months: int) -> Column:
    unit = "QUARTER" if months == 3 else "YEAR"
    opening = lambda x: F.to_date(F.date_trunc(unit, x))
    calendar = F.sequence(opening(F.lit(start)), F.lit(end), F.expr(f"interval {months} months"))
    missing = F.array_except(calendar, F.transform(d, opening))
    return F.transform(missing, lambda p: _span(p, F.date_sub(F.add_months(p, months), 1)))


def _gaps(d: Column, start: dt.date, end: dt.date, gap_days: int) -> Column:
    """Around the dates: the day before the range stands first, the day after it last; edges have no threshold."""
    before = F.concat(F.array(F.date_sub(F.lit(start), 1)), d)
    after = F.concat(d, F.array(F.date_add(F.lit(end), 1)))
    pairs = F.zip_with(before, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    least = lambda k: F.when((k == 0) | (k == F.size(d)), F.lit(1)).otherwise(F.lit(gap_days))
    open_ = F.filter(pairs, lambda p, k: F.datediff(p["b"], p["a"]) > least(k))
    return F.transform(open_, lambda p: _span(F.date_add(p["a"], 1), F.date_sub(p["b"], 1)))


def _exploded(rows: DataFrame, keys: list[str], ranges: Column) -> DataFrame:
    return rows.select(*keys, F.explode(ranges).alias("r")).select(*keys, "r.range_start", "r.range_end")


def missing_periods(dates: DataFrame, keys: list[str], wanted: DataFrame, start: dt.date, end: dt.date, months: int) -> DataFrame:
    """COV-2 (3 months) and COV-3 (12): whole calendar periods touched by the range without a date.

    `wanted` has the keys to report on, so that a key without any date lacks every period.
    """
    return _exploded(_dates(dates, keys, wanted, start, end), keys, _periods(F.col("d"), start, end, months))


def day_gaps(dates: DataFrame, keys: list[str], wanted: DataFrame, start: dt.date, end: dt.date, gap_days: int = 30) -> DataFrame:
    """COV-4: before the first date, between dates over `gap_days` apart, and after the last."""
    if gap_days < 1:
        raise ValueError("gap_days must be at least 1")
    return _exploded(_dates(dates, keys, wanted, start, end), keys, _gaps(F.col("d"), start, end, gap_days))


def missing_ranges(catalog: DataFrame, wanted: DataFrame, start: dt.date, end: dt.date, listing: DataFrame | None = None) -> DataFrame:
    """COV-1 for every wanted (ticker, filing_type): quarters for 10-Q, years for 10-K, 30-day gaps for others.

    A key without any filing in range misses the whole range, whatever its type.
    """
    from docketry.operators.catalog import existing_only

    keys, d, kind = ["ticker", "filing_type"], F.col("d"), F.col("filing_type")
    known = existing_only(catalog, listing) if listing is not None else catalog
    whole = F.array(_span(F.lit(start), F.lit(end)))
    ranges = F.when(F.size(d) == 0, whole).when(kind == "FILING_10Q", _periods(d, start, end, 3)).when(kind == "FILING_10K", _periods(d, start, end, 12)).otherwise(_gaps(d, start, end, 30))
    return _exploded(_dates(known, keys, wanted, start, end), keys, ranges)


def fetch(catalog, root: str, ticker: str, filing_type: str, start: dt.date, end: dt.date, as_of: dt.date, fetcher=None) -> tuple[DataFrame, DataFrame]:
    """COV-5: (filings in range, fetch plan). A fetcher(ticker, type, start, end) fills gaps on the driver."""
    if not ticker:
        raise ValueError("a ticker is needed")
    from docketry.operators.catalog import get_filings
    from docketry.sources.filings import tree

    _checked(start, end)
    spark, kind = catalog.spark, resolve_type(filing_type)
    key = kind or filing_type
    catalog.sync(root, as_of, [ticker])
    listing = tree(spark, root)
    wanted = spark.createDataFrame([(ticker, key)], "ticker string, filing_type string")
    plan = missing_ranges(catalog.filings(), wanted, start, end, listing) if kind else wanted.limit(0).selectExpr("*", "date'1970-01-01' range_start", "date'1970-01-01' range_end")
    if fetcher is not None and kind:
        for gap in plan.collect():  # the gaps of one key
            fetcher(ticker, kind, gap.range_start, gap.range_end)
        catalog.sync(root, as_of, [ticker])
        listing = tree(spark, root)
    return get_filings(catalog.filings(), ticker, key, start, end, listing=listing), plan

"""Fixtures B7, B8: catalog queries, changes, coverage, and the stored catalog."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketry import schemas
from docketry.operators import catalog as C
from docketry.operators import coverage as V
from docketry.streaming.incremental import catalog_stream

D = dt.date
ROWS = [
    (1, "AAA", "FILING_10K", D(2021, 2, 10), "/1", "1-1-1", D(2022, 1, 1), True, D(2022, 1, 2), "success"),
    (2, "AAA", "FILING_10Q", D(2021, 5, 5), "/2", "1-1-2", D(2022, 1, 1), True, D(2022, 1, 2), "failed"),
    (3, "AAA", "FILING_10Q", D(2021, 11, 4), "/3", "1-1-3", D(2022, 1, 1), False, None, None),
    (4, "BBB", "FILING_8K", D(2021, 3, 1), "/4", "1-1-4", D(2022, 1, 1), True, D(2022, 1, 2), None),
    (5, "BBB", "FILING_10Q", D(2021, 8, 1), "/5", "1-1-5", D(2022, 1, 1), False, None, None),
]


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(ROWS, schemas.CATALOG)


@pytest.fixture
def listing(spark):
    return spark.createDataFrame([(f"/{k}",) for k in range(1, 5)], "file_path string")


def ids(df):
    return [r.id for r in df.collect()]


def test_queries(catalog, listing):
    assert ids(C.get_filings(catalog, "AAA", listing=listing)) == [3, 2, 1]
    assert ids(C.get_filings(catalog, limit=2, listing=listing)) == [3]
    assert ids(C.get_filings(catalog, limit=2, listing=listing, limit_after_exists=True)) == [3, 2]
    assert ids(C.unparsed(catalog, listing=listing)) == [3]
    assert ids(C.get_filings(catalog, start=D(2021, 3, 1), end=D(2021, 5, 5))) == [2, 4]
    with pytest.raises(TypeError):
        C.get_filings(catalog, ticker=1)
    with pytest.raises(ValueError, match="positive"):
        C.get_filings(catalog, limit=0)


def test_statistics(catalog):
    n = {(r.measure, r.value): r.n for r in C.counts(catalog).collect()}
    assert n == {("total", ""): 5, ("ticker", "AAA"): 3, ("ticker", "BBB"): 2, ("filing_type", "FILING_10K"): 1, ("filing_type", "FILING_10Q"): 3, ("filing_type", "FILING_8K"): 1, ("parse_status", "success"): 1, ("parse_status", "failed"): 1, ("parse_status", "unknown"): 1}
    assert tuple(C.summary(catalog).first()) == (5, 3, 2, D(2021, 2, 10), D(2021, 11, 4))
    assert [r.ticker for r in C.top_tickers(catalog).collect()] == ["AAA", "BBB"]


def gaps(df):
    return sorted((r.range_start, r.range_end) for r in df.collect())


def ranges(spark, catalog, listing, ticker, kind, start, end):
    wanted = spark.createDataFrame([(ticker, kind)], "ticker string, filing_type string")
    return gaps(V.missing_ranges(catalog, wanted, start, end, listing))


def test_coverage(spark, catalog, listing):
    year = (D(2021, 1, 1), D(2021, 12, 31))
    assert ranges(spark, catalog, listing, "AAA", "FILING_10Q", *year) == [(D(2021, 1, 1), D(2021, 3, 31)), (D(2021, 7, 1), D(2021, 9, 30))]
    assert ranges(spark, catalog, listing, "AAA", "FILING_10K", D(2020, 6, 1), D(2022, 3, 1)) == [(D(2020, 1, 1), D(2020, 12, 31)), (D(2022, 1, 1), D(2022, 12, 31))]
    assert ranges(spark, catalog, listing, "BBB", "FILING_10Q", *year) == [year]
    assert ranges(spark, catalog, listing, "BBB", "FILING_8K", *year) == [(D(2021, 1, 1), D(2021, 2, 28)), (D(2021, 3, 2), D(2021, 12, 31))]
    with pytest.raises(ValueError, match="after its end"):
        V.missing_ranges(catalog, catalog, year[1], year[0])


def dated(spark, dates):
    return spark.createDataFrame([("k", d) for d in dates], "k string, filing_date date")


def test_goldens(spark):
    wanted = spark.createDataFrame([("k",)], "k string")
    q = dated(spark, [D(2020, 3, 31), D(2020, 9, 30)])
    assert gaps(V.missing_periods(q, ["k"], wanted, D(2020, 1, 1), D(2020, 12, 31), 3)) == [(D(2020, 4, 1), D(2020, 6, 30)), (D(2020, 10, 1), D(2020, 12, 31))]
    y = dated(spark, [D(2020, 12, 31), D(2022, 12, 31)])
    assert [a.year for a, _ in gaps(V.missing_periods(y, ["k"], wanted, D(2020, 1, 1), D(2023, 12, 31), 12))] == [2021, 2023]
    g = dated(spark, [D(2020, 1, 15), D(2020, 3, 1), D(2020, 6, 1)])
    assert gaps(V.day_gaps(g, ["k"], wanted, D(2020, 1, 1), D(2020, 12, 31), 45)) == [(D(2020, 1, 1), D(2020, 1, 14)), (D(2020, 1, 16), D(2020, 2, 29)), (D(2020, 3, 2), D(2020, 5, 31)), (D(2020, 6, 2), D(2020, 12, 31))]
    edge = dated(spark, [D(2020, 1, 1), D(2020, 1, 31)])
    assert gaps(V.day_gaps(edge, ["k"], wanted, D(2020, 1, 1), D(2020, 1, 31), 30)) == []


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 120), max_size=8), st.integers(1, 40))
def test_gap_properties(spark, days, width):
    start, end = D(2020, 1, 1), D(2020, 4, 30)
    dates = {start + dt.timedelta(d) for d in days}
    wanted = spark.createDataFrame([("k",)], "k string")
    found = gaps(V.day_gaps(dated(spark, sorted(dates)), ["k"], wanted, start, end, width))
    for (a, b), (c, _) in zip(found, found[1:]):
        assert a <= b < c
    assert not any(a <= d <= b for a, b in found for d in dates)
    day = start
    while day <= end:
        inside = any(a <= day <= b for a, b in found)
        assert inside or any(abs((day - d).days) <= width for d in dates)
        day += dt.timedelta(1)


HEAD = "FILED AS OF DATE: 202101{:02d}\nACCESSION NUMBER: 1-2-{}\n"


def tree(root, n=3):
    for t, k in (("AAA", "FILING_10K"), ("BBB", "FILING_8K")):
        (root / t / k).mkdir(parents=True, exist_ok=True)
        for i in range(n):
            (root / t / k / f"{i}.txt").write_text(HEAD.format(i + 1, i))
    (root / "BBB" / "FILING_8K" / "undated.txt").write_text("no date")


def test_stored_catalog(spark, tmp_path):
    tree(tmp_path / "in")
    cat = C.Catalog(spark, f"{tmp_path}/cat")
    day = D(2022, 1, 1)
    first = {(r.ticker, r.filing_type): r.n for r in cat.sync(f"{tmp_path}/in", day).collect()}
    assert first == {("AAA", "FILING_10K"): 3, ("BBB", "FILING_8K"): 3}
    assert {r.n for r in cat.sync(f"{tmp_path}/in", day).collect()} == {0}
    assert cat.filings().count() == 6
    path = cat.filings().where("ticker = 'AAA'").first().file_path
    assert cat.set_status(C.selected(file_path=path), True, "failed", day)
    assert not cat.set_status(C.selected(file_path="/none"), True)
    row = cat.filings().where("parsed").first()
    assert (row.file_path, row.parse_status, row.parse_date) == (path, "failed", day)
    from docketry.sources.filings import read_text
    from pyspark.sql import functions as F

    again = read_text(spark, path).select(F.lit("AAA").alias("ticker"), F.lit("FILING_NEW").alias("filing_type"), "file_path", "content_text")
    assert cat.add(again, day) == 0 and cat.add(again, day, update=True) == 1
    row = cat.filings().where("parsed").first()
    assert (row.filing_type, row.parse_status) == ("FILING_NEW", "failed")
    assert cat.set_status(C.selected(ticker="AAA", accession_number=row.accession_number), False)
    small = cat.compact(f"{tmp_path}/cat2")
    assert small.filings().count() == 6 and small.filings().where("parsed").count() == 0
    with pytest.raises(ValueError, match="name an id"):
        C.selected()


def test_fetch_and_stream(spark, tmp_path):
    root = tmp_path / "in"
    tree(root, 1)
    cat = C.Catalog(spark, f"{tmp_path}/cat")
    asked = []

    def fetcher(ticker, kind, start, end):
        asked.append((ticker, kind, start, end))
        (root / ticker / kind / "new.txt").write_text(HEAD.format(9, 77).replace("2021", "2022"))

    found, plan = V.fetch(cat, str(root), "AAA", "FilingType.FILING_10K", D(2021, 1, 1), D(2022, 12, 31), D(2023, 1, 1), fetcher)
    assert asked == [("AAA", "FILING_10K", D(2022, 1, 1), D(2022, 12, 31))]
    assert [r.filing_date.year for r in found.collect()] == [2022, 2021]
    catalog_stream(spark, str(root), cat, f"{tmp_path}/ck", D(2023, 1, 1)).awaitTermination()
    n = cat.filings().count()
    assert n == 3
    (root / "BBB" / "FILING_8K" / "later.txt").write_text(HEAD.format(20, 5))
    catalog_stream(spark, str(root), cat, f"{tmp_path}/ck", D(2023, 1, 1)).awaitTermination()
    assert cat.filings().count() == n + 1


def test_sync_reads_only_fresh_paths(spark, tmp_path, monkeypatch):
    from docketry.sources import filings as S

    root = tmp_path / "tree"
    text = "FILED AS OF DATE: 20210102\nACCESSION NUMBER: 0-21-{}\n"
    for k in range(6):
        at = root / f"T{k % 2}" / "FILING_8K"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"{k}.txt").write_text(text.format(k))
    store = C.Catalog(spark, str(tmp_path / "store"))
    day = dt.date(2021, 2, 1)
    assert C.sync_summary(store.sync(str(root), day)).first().asDict() == {"added": 6, "tickers": 2}
    for k in (7, 9, 11):
        (root / "T1" / "FILING_8K" / f"{k}.txt").write_text(text.format(k))
    asked, read = [], S.read_text
    monkeypatch.setattr(S, "read_text", lambda session, path: asked.append(path) or read(session, path))
    assert {(r.ticker, r.n) for r in store.sync(str(root), day, batch=2).collect()} == {("T0", 0), ("T1", 3)}
    assert sorted(p.rsplit("/", 1)[1] for some in asked for p in some) == ["11.txt", "7.txt", "9.txt"] and [len(some) for some in asked] == [2, 1]
    assert C.sync_summary(store.sync(str(root), day)).first().asDict() == {"added": 0, "tickers": 2}
    assert store.filings().count() == 9
    # entries of one moment: the same row is read each time, and the latest wins
    row = store.filings().where("accession_number = '0-21-7'")
    store.append(row.withColumn("filing_type", F.lit("FILING_4")))
    assert store.filings().where("accession_number = '0-21-7'").first().filing_type == "FILING_4" and store.filings().count() == 9

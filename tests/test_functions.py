"""Fixtures B1, B2, B5, B8-B10: header, block and text functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docketry.config import Settings
from docketry.functions import header as H
from docketry.functions import text as T
from docketry.operators import coverage as V
from docketry.operators.extract import split_cells
from docketry.sources.filings import decoded, to_blocks

HEADER = "<SEC-HEADER>0000123456-23-000789.hdr.sgml : 20230131\nACCESSION NUMBER:\t\t0000123456-23-000789\nCONFORMED PERIOD OF REPORT:\t20221231\nFILED AS OF DATE:\t\t20230130\n\tCOMPANY CONFORMED NAME:\t\tSample Widgets Inc.\n\tCENTRAL INDEX KEY:\t\t0000123456\n\tIRS NUMBER:\n\tFISCAL YEAR END:\t\t1231\n\tFORM TYPE:\t\t10-K\n\tSEC ACT:\t\t1934 Act\n\tSEC FILE NUMBER:\t001-00001\n"


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("x")).first().x


def test_header(spark):
    fields = H.header_fields(F.col("t"))
    r = spark.createDataFrame([(HEADER,)], "t string").select(*[c.alias(n) for n, c in fields.items()]).first()
    assert (r.accession_number, r.conformed_period_of_report, r.filed_as_of_date, r.form_type, r.cik) == ("0000123456-23-000789", "2022-12-31", "2023-01-30", "10-K", "0000123456")
    assert (r.filer.company_data.company_conformed_name, r.filer.company_data.irs_number, r.filer.company_data.fiscal_year_end) == ("Sample Widgets Inc.", "FISCAL", "1231")
    assert (r.filer.filing_values.act, r.filer.filing_values.file_number) == ("1934 Act", "001-00001")
    assert r.date_as_of_change is r.effectiveness_date is r.filer.filing_values.film_number is r.filer.company_data.standard_industrial_classification is None


def test_dates(spark):
    assert one(spark, HEADER, H.filing_date(F.col("v"))) == dt.date(2023, 1, 30)
    assert one(spark, HEADER, H.scanned_date(F.col("v"))) == dt.date(2023, 1, 31)
    bad = HEADER.replace("20230130", "20231345")
    assert one(spark, bad, H.filing_date(F.col("v"))) is None
    assert one(spark, bad, H.header_fields(F.col("v"))["filed_as_of_date"]) == "2023-13-45"
    assert one(spark, "x" * 2000 + HEADER, H.header_fields(F.col("v"))["accession_number"]) is None
    assert one(spark, "Filing-Date: 20200102", H.filing_date(F.col("v"))) == dt.date(2020, 1, 2)
    assert one(spark, "nothing", H.filing_date(F.col("v"))) is None


def test_accession_and_ticker(spark):
    assert one(spark, "", H.accession(F.col("v"), F.lit("/a/0001-23-000001.txt"))) == "0001-23-000001"
    assert one(spark, "/d/AAA/FILING_10K/x.txt", H.ticker(F.col("v"))) == "AAA"
    assert one(spark, "/d/.cache/FILING_10K/x.txt", H.ticker(F.col("v"))) == "UNKNOWN"
    assert one(spark, "/d/AAA/F/x.txt", H.ticker(F.col("v"), "ZZZ")) == "ZZZ"


def blocks(spark, text, **settings):
    rows = to_blocks(spark.createDataFrame([(1, text)], "id int, content_text string"), Settings(**settings), ["id"])
    return [(r.doc_ordinal, r.type_tag, r.text_content, r.doc_cik) for r in rows.orderBy("doc_ordinal").collect()]


def test_blocks(spark):
    two = "<DOCUMENT><TYPE>10-K\n<TEXT>a</TEXT></DOCUMENT><DOCUMENT><TYPE>EX-99.1\n<TEXT>b</TEXT></DOCUMENT>"
    assert blocks(spark, two) == [(0, "10-K", "a", None)]
    assert [b[1] for b in blocks(spark, two, process_all_documents=True)] == ["10-K", "EX-99.1"]
    assert blocks(spark, "plain") == [(0, "UNKNOWN", "plain", None)]
    assert blocks(spark, "<TEXT>abc\n")[0][2] == "abc"
    assert blocks(spark, "<DOCUMENT><TYPE>10-K/A\nx</DOCUMENT>") == []
    assert blocks(spark, "CIK: 42 <CIK>7</CIK>")[0][3] == "7"


LINES = {"| a || b |": ["a", "b"], "||": [], "Assets   100  200": ["Assets", "100", "200"], "a, b,,c": ["a", "b", "", "c"], "a, b": [], "plain words": [], "  x  y ": ["x", "y"]}


def test_split_rows(spark):
    rows = spark.createDataFrame([(x,) for x in LINES], "line string").select("line", T.split_row(F.col("line")).alias("c")).collect()
    assert {r.line: r.c for r in rows} == LINES == {x: split_cells(x) for x in LINES}


@pytest.mark.parametrize(("value", "want"), [("Balance Sheet (é) №5 ²", "Balance_Sheet__é___5_²"), ("a" * 60, "a" * 50)])
def test_safe_name(spark, value, want):
    assert one(spark, value, T.safe_name(F.col("v"))) == want


def test_clean_section(spark):
    assert one(spark, "A [Table of Contents] B", T.clean_section(F.col("v"))) == "A  B"
    assert one(spark, " a\n b [x Top][Data_Table_start]zz[Data_Table_end] Click here to view", T.clean_section(F.col("v"))) == "a b  "


@pytest.mark.parametrize(("rows", "want"), [([["Item", "2023"], ["a", "1"]], True), ([["1", "2"], ["3", "4"]], False), ([["", "2"], ["3", "4"]], True), ([["1,000", "2"], ["3", "4"]], True), ([["a"]], False), ([["1e3", "-.5"], ["x", "y"]], False), ([["1d", "NaN"], ["x", "y"]], True)])
def test_header_row(spark, rows, want):
    assert one(spark, rows, T.has_header_row(F.col("v")), "array<array<string>>") is want


def test_decoding(spark):
    for raw, want in ((b"\xc3\xa9", "é"), (b"\xe9", "é"), (b"a\r\nb\rc", "a\nb\nc"), (b"", "")):
        assert one(spark, raw, decoded(F.col("v")), "binary") == want


def test_types_and_dates():
    assert V.resolve_type("FILING_10K") == V.resolve_type("FilingType.FILING_10K") == "FILING_10K" and V.resolve_type("10-K") is None
    assert V.parse_date("2020-02-29") == dt.date(2020, 2, 29)
    for bad in ("2020-02-30", "20200101", "x", None):
        with pytest.raises(ValueError, match="no date"):
            V.parse_date(bad)

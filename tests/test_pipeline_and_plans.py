"""End-to-end parsing of files, sinks, CLI, settings, plan rules, and the driver's entry points."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from docketry import cli
from docketry.config import Settings, load_settings, profile_rows
from docketry.operators import catalog as C
from docketry.operators.extract import extracted
from docketry.plans import catalogue_queries as Q
from docketry.sources.filings import dated_files, files, parse_filings, tree
from docketry.sources.sinks import table_file, write_parsed

DUMP = "<SEC-HEADER>a.hdr.sgml : 20230131\nACCESSION NUMBER:\t1-2-3\nFILED AS OF DATE: 20230130\nFORM TYPE: 10-K\n<DOCUMENT><TYPE>10-K\n<TEXT><CIK>7</CIK><h1>Head</h1><p>Body</p><table><tr><td>a,b</td><td>\"q\"</td></tr><tr><td>1</td><td>2</td></tr></table></TEXT></DOCUMENT><DOCUMENT><TYPE>EX-1\n<TEXT>skip</TEXT></DOCUMENT>"


@pytest.fixture
def root(tmp_path):
    for t in ("AAA", "BBB"):
        (tmp_path / "in" / t / "FILING_10K").mkdir(parents=True)
        (tmp_path / "in" / t / "FILING_10K" / "a.txt").write_text(DUMP)
    (tmp_path / "in" / "AAA" / "FILING_10K" / "b.TXT").write_text("ignored")
    return tmp_path


def test_parse_and_sinks(spark, root):
    p = parse_filings(spark, f"{root}/in", ticker_map={"BBB": "mapped"})
    meta = {r.ticker: r for r in p.metadata.collect()}
    assert set(meta) == {"AAA", "mapped"}
    m = meta["AAA"]
    assert (m.form_type, m.cik, m.tables_count, m.sections_count, m.document_types, m.detected_encoding) == ("10-K", "7", 1, 1, ["10-K"], "utf-8")
    assert sorted((r.ticker or "", r.status) for r in p.results.collect()) == [("", "success"), ("mapped", "success")]
    s = p.sections.where("ticker = 'AAA'").first()
    assert (s.title, s.section_number, s.cik, len(s.section_id)) == ("Head", 1, "7", 64)
    csv = table_file(p.html_tables).first()
    assert csv.csv == '"a,b","""q"""\n1,2' and csv.file_name.startswith("0_")
    write_parsed(p, f"{root}/out")
    done = json.loads(spark.read.text(f"{root}/out/processing_summary").first()[0])
    assert done == {"total": 2, "successful": 2, "failed": 0}
    assert json.loads(spark.read.json(f"{root}/out/metadata_json").first()["json"]).get("date_as_of_change", "absent") == "absent"
    assert spark.read.parquet(f"{root}/out/html_cells").count() == 8


def test_sources(spark, root):
    assert files(spark, f"{root}/in").count() == 2
    assert "content" not in tree(spark, f"{root}/in").columns
    assert dated_files(spark, f"{root}/in", "AAA", "FILING_10K", "2023-01-01", "2023-02-01").count() == 1
    with pytest.raises(FileNotFoundError):
        files(spark, f"{root}/none")
    (root / "empty").mkdir()
    with pytest.raises(ValueError, match="no .*txt"):
        parse_filings(spark, f"{root}/empty")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan_below_extraction(spark, tmp_path):
    spark.createDataFrame([("10-K", "x"), ("EX", "y")], "type_tag string, text_content string").write.parquet(f"{tmp_path}/b")
    df = spark.read.parquet(f"{tmp_path}/b").select("type_tag", extracted(F.col("text_content"), F.col("type_tag"), Settings()).alias("x"))
    text = plan(df.where("type_tag = '10-K'").select("type_tag", F.posexplode_outer("x.sections")))
    assert text.count("ArrowEvalPython") == 1 and "EqualTo(type_tag,10-K)" in text


def test_catalog_plans(spark):
    sf = E.SMOKE
    assert "TakeOrderedAndProject" in plan(Q.QUERIES["catalog_topn"](spark, sf))
    text = plan(C.get_filings(Q.filings_v(spark, sf), filing_type="FILING_10Q"))
    assert "o_totalprice" not in text


def test_coverage_shuffles_filings_once(spark):
    text = plan(Q.QUERIES["gaps_days"](spark, E.SMOKE))
    assert "Window" not in text and text.count("Scan parquet") == 2 and text.count("Exchange hashpartitioning") <= 3


def test_settings(tmp_path):
    (tmp_path / "c.toml").write_text('[docketry]\nprocess_all_documents = true\ndefault_ticker = "ZZZ"\n[docketry.profiles."10-K"]\na = ["x", "y"]\n')
    s = load_settings(f"{tmp_path}/c.toml", default_ticker=None, process_all_documents=False)
    assert (s.process_all_documents, s.default_ticker, s.table_ids("10-K"), s.table_ids("none")) == (False, "ZZZ", ("x", "y"), ())
    assert [len(v) for v in Settings().profiles.values()] == [40, 22, 7, 16]
    assert len(profile_rows(Settings())) == 85


def test_cli(spark, root, capsys):
    base = ["--catalog", f"{root}/cat", "--download-folder", f"{root}/in"]
    keep = spark.stop
    assert cli.main(["coverage", "--show-filing-types"]) == 0
    assert cli.main([*base, "sync"]) == 0
    assert cli.main([*base, "list", "--json", "--ticker", "AAA"]) == 0
    assert cli.main([*base, "mark", "--parsed"]) == 2
    assert cli.main([*base, "mark", "--parsed", "--ticker", "AAA", "--accession", "1-2-3"]) == 0
    assert cli.main([*base, "mark", "--parsed", "--path", "/none"]) == 1
    assert cli.main([*base, "stats"]) == 0
    assert cli.main([*base, "coverage", "--start-date", "2023-01-01", "--end-date", "2024-12-31"]) == 0
    assert cli.main([*base, "parse", "--dir", f"{root}/in", "--output", f"{root}/o", "--no-process-all"]) == 0
    out = capsys.readouterr().out
    assert '"ticker": "AAA"' in out and '"range_start": "2024-01-01"' in out and keep


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["page_id", "section_number", "title", "level", "parent_title", "content_length"] and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_a_file_that_cannot_be_read_fails_alone(spark, tmp_path):
    """One row per listed file; a bad one is told and the others are parsed. Errors within blocks fail no file."""
    import os

    folder = tmp_path / "AAA" / "FILING_10K"
    folder.mkdir(parents=True)
    (folder / "good.txt").write_text("ACCESSION NUMBER: 1-2-3\n<DOCUMENT>\n<TYPE>10-K\n<TEXT><h1>Title</h1><p>Body</p></TEXT></DOCUMENT>")
    (folder / "bad +%20é.txt").write_text("ACCESSION NUMBER: 3-4-5\n")
    parsed = parse_filings(spark, str(tmp_path))
    os.remove(folder / "bad +%20é.txt")  # listed, and gone when it is read
    rows = {r.file_path.rsplit("/", 1)[1]: (r.status, r.error) for r in parsed.results.collect()}
    assert rows == {"good.txt": ("success", None), "bad +%20é.txt": ("failed", "empty or cannot be read")}
    assert C.batch_summary(parsed.results).first().asDict() == {"total": 2, "successful": 1, "failed": 1}
    assert [r.accession_number for r in parsed.metadata.collect()] == ["1-2-3"]

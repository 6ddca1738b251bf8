"""Sinks (SNK): Parquet tables, with JSON and CSV exports for those who read the files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import safe_name
from docketry.operators.catalog import batch_summary
from docketry.operators.extract import cells_of
from docketry.sources.filings import ParsedFilings


def metadata_json(metadata: DataFrame) -> DataFrame:
    """SNK-1: one JSON text per filing; absent fields stay absent."""
    return metadata.select("file_path", F.to_json(F.struct("*"), {"ignoreNullFields": "true"}).alias("json"))


def table_file(tables: DataFrame) -> DataFrame:
    """SNK-2 and 3: a name per table that no other table of the filing has, and CSV text."""
    base = F.when(F.coalesce("table_name", F.lit("")) == "", F.concat(F.lit("table_"), F.col("table_ordinal"))).otherwise(F.concat(safe_name(F.col("table_name")), F.lit("_"), F.col("table_ordinal")))
    quoted = lambda c: F.when(c.rlike('[",\n\r]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    line = lambda cells: F.array_join(F.transform(cells, quoted), ",")
    numbered = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n_cols") - 1, F.lit(0))), lambda k: k.cast("string"))
    lines = F.transform("rows", line)
    text = F.when(F.col("has_header"), F.array_join(lines, "\n")).otherwise(F.array_join(F.concat(F.array(line(numbered)), lines), "\n"))
    return tables.select("file_path", "doc_ordinal", "table_ordinal", F.concat_ws("_", F.col("doc_ordinal").cast("string"), base).alias("file_name"), text.alias("csv"))


def write_parsed(parsed: ParsedFilings, out: str) -> None:
    """SNK-1..6: everything, keyed by (file_path, doc_ordinal, ordinal), so nothing overwrites another."""
    parsed.metadata.write.mode("overwrite").partitionBy("ticker", "form_type").parquet(f"{out}/filing_metadata")
    metadata_json(parsed.metadata).write.mode("overwrite").json(f"{out}/metadata_json")
    for kind, tables in (("html", parsed.html_tables), ("text", parsed.text_tables)):
        tables.write.mode("overwrite").parquet(f"{out}/{kind}_tables")
        table_file(tables).write.mode("overwrite").parquet(f"{out}/{kind}_table_files")
        cells_of(tables, ["file_path", "doc_ordinal"]).write.mode("overwrite").parquet(f"{out}/{kind}_cells")
    parsed.sections.write.mode("overwrite").parquet(f"{out}/sections")
    parsed.sections.write.mode("overwrite").json(f"{out}/sections_json")
    parsed.results.write.mode("overwrite").json(f"{out}/results")
    batch_summary(parsed.results).write.mode("overwrite").json(f"{out}/processing_summary")

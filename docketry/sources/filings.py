"""Sources (SRC): listing, reading and decoding filing files, and the parse pipeline over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import __version__
from docketry.config import Settings
from docketry.functions import header as H
from docketry.operators import extract as X


def decoded(content: Column) -> Column:
    """SRC-3: UTF-8 if valid, else Latin-1; line ends become \\n. (No statistical guess of other encodings.)"""
    text = F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "\r\n?", "\n")


def encoding(content: Column) -> Column:
    return F.when(F.is_valid_utf8(content.cast("string")), F.lit("utf-8")).otherwise(F.lit("latin1"))


def files(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1 and 2: one file, or every *.txt below a directory; content is read only if selected."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if "*" not in path and not fs.exists(hadoop):
        raise FileNotFoundError(path)
    reader = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    if "*" not in path and fs.getFileStatus(hadoop).isDirectory():
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
    return reader.load(path).withColumnRenamed("path", "file_path")


def tree(spark: SparkSession, root: str) -> DataFrame:
    """SRC-6: root/ticker/type/file, any extension; content stays unread."""
    listed = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*/*").withColumnRenamed("path", "file_path")
    return listed.select(H.path_part(F.col("file_path"), 2).alias("ticker"), H.path_part(F.col("file_path"), 1).alias("filing_type"), "file_path", "length")


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, content_text) of a path, a pattern or a list of paths."""
    listed = spark.read.format("binaryFile").load(path).withColumnRenamed("path", "file_path")
    return listed.select("file_path", decoded(F.col("content")).alias("content_text"))


def dated_files(spark: SparkSession, root: str, ticker: str, filing_type: str, start, end) -> DataFrame:
    """SRC-9: files of one folder whose scanned date lies in the range."""
    read = read_text(spark, f"{root}/{ticker}/{filing_type}/*").withColumn("filing_date", H.scanned_date(F.col("content_text")))
    return read.where(F.col("filing_date").between(F.lit(start), F.lit(end))).select("file_path", "filing_date")


def to_blocks(filings: DataFrame, settings: Settings, keys: list[str]) -> DataFrame:
    """DOC-1, DOC-2 and FLT-1: kept blocks, filtered before any extraction (R1)."""
    each = filings.select(*keys, F.posexplode(H.blocks(F.col("content_text"))).alias("doc_ordinal", "block"))
    each = each.select(*keys, "doc_ordinal", H.type_tag(F.col("block")).alias("type_tag"), H.text_content(F.col("block")).alias("text_content"), H.block_cik(F.col("block")).alias("doc_cik"))
    return each.where(H.kept_block(F.col("type_tag"), tuple(settings.profiles), settings.process_all_documents))


@dataclass
class ParsedFilings:
    """Lazy results of a parse; `extracted` was written or cached once, the rest derives from it (R4)."""

    metadata: DataFrame
    extracted: DataFrame
    html_tables: DataFrame
    text_tables: DataFrame
    sections: DataFrame
    results: DataFrame


def parse_filings(spark: SparkSession, path: str, settings: Settings | None = None, ticker: str | None = None, ticker_map: dict[str, str] | None = None, partitions: int | None = None) -> ParsedFilings:
    """Parse one file or a directory of files. Blocks are dealt anew before extraction, as files cannot be split."""
    settings = settings or Settings()
    source = files(spark, path)
    # the file index, which the driver has anyway: a file that is empty or cannot be read gives no row when read
    listed = spark.createDataFrame([(f,) for f in source.inputFiles()], "uri string")
    every = listed.select(F.regexp_replace(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))), "^file:///", "file:/").alias("file_path"))
    if not source.select("file_path").head(1):
        raise ValueError(f"no *.txt files in {path}")
    above = H.path_part(F.col("file_path"), 2)
    mapped = F.create_map(*[F.lit(x) for kv in ticker_map.items() for x in kv])[above] if ticker_map else F.lit(None).cast("string")
    filings = source.select("file_path", F.col("length").alias("file_size"), encoding(F.col("content")).alias("detected_encoding"), decoded(F.col("content")).alias("content_text"), mapped.alias("mapped_ticker"), H.ticker(F.col("file_path"), ticker, settings.default_ticker, mapped if ticker_map else None).alias("ticker"))
    fields = H.header_fields(F.col("content_text"))
    header = filings.select("file_path", "file_size", "detected_encoding", "ticker", "mapped_ticker", F.lit(__version__).alias("parser_version"), *[c.alias(n) for n, c in fields.items()])
    blocks = to_blocks(filings, settings, ["file_path", "ticker"])
    blocks = blocks.repartition(partitions or spark.sparkContext.defaultParallelism * 4, "file_path", "doc_ordinal")
    extracted = blocks.select("file_path", "ticker", "doc_ordinal", "type_tag", "doc_cik", X.extracted(F.col("text_content"), F.col("type_tag"), settings).alias("x")).persist()
    keys = ["file_path", "doc_ordinal"]
    per_file = extracted.groupBy("file_path").agg(
        F.sum(F.size("x.html_tables") + F.size("x.text_tables")).cast("int").alias("tables_count"), F.sum(F.size("x.sections")).cast("int").alias("sections_count"),
        F.transform(F.sort_array(F.collect_list(F.struct("doc_ordinal", "type_tag"))), lambda s: s["type_tag"]).alias("document_types"), F.concat_ws("; ", F.collect_list("x.error")).alias("errors"),
        F.min_by("doc_cik", F.when(F.col("doc_cik").isNotNull(), F.col("doc_ordinal"))).alias("_cik"),
    )
    metadata = header.join(per_file, "file_path", "left").withColumn("cik", F.coalesce("cik", "_cik"))
    metadata = metadata.withColumns({"tables_count": F.coalesce("tables_count", F.lit(0)), "sections_count": F.coalesce("sections_count", F.lit(0)), "document_types": F.coalesce("document_types", F.array().cast("array<string>"))}).drop("_cik")
    # a file that was listed and not read failed; errors within blocks are told and do not fail a file
    done = metadata.select("file_path", F.col("mapped_ticker").alias("ticker"), F.nullif("errors", F.lit("")).alias("errors"), F.lit(True).alias("done"))
    status = F.when(F.col("done"), "success").otherwise("failed")
    results = every.join(done, "file_path", "left").select("file_path", "ticker", status.alias("status"), F.when(F.col("done"), F.col("errors")).otherwise("empty or cannot be read").alias("error"))
    metadata = metadata.drop("errors")
    sections = X.sections_of(extracted, [*keys, "ticker", "doc_cik"]).withColumnRenamed("doc_cik", "cik")
    return ParsedFilings(metadata.drop("mapped_ticker"), extracted, X.tables_of(extracted, keys, "html"), X.tables_of(extracted, keys, "text"), sections, results)

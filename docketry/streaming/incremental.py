"""Incremental cataloging: a file-source stream that catalogs files it has not seen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketry.functions import header as H
from docketry.operators.catalog import Catalog
from docketry.sources.filings import decoded

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def catalog_stream(spark: SparkSession, root: str, catalog: Catalog, checkpoint: str, as_of: dt.date) -> StreamingQuery:
    """Catalog what arrived under root/ticker/type/ since the last run, then stop.

    The checkpoint remembers files; the anti-join in `add` covers rows cataloged by other means, so a batch
    that is repeated after a failure adds nothing twice.
    """

    def one(batch: DataFrame, _: int) -> None:
        rows = batch.select(H.path_part(F.col("path"), 2).alias("ticker"), H.path_part(F.col("path"), 1).alias("filing_type"), F.col("path").alias("file_path"), decoded(F.col("content")).alias("content_text"))
        catalog.add(rows, as_of, keys=("ticker", "filing_type", "file_path"))

    stream = spark.readStream.format("binaryFile").schema(BINARY_FILE).load(f"{root}/*/*")
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

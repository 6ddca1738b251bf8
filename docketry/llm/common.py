"""Shared pieces: scratch tables in the cluster's shared folder, table reads, partition sizing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words in every operator of this package.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Shuffle files go when the query that made them ends: each stage's result is a written table, nothing reads them again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where the session names none, one is made in local mode; a cluster must name its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


class Scratch:
    """Written tables that cut lineage: lost executors re-read files instead of recomputing whole stages."""

    #: Folders of this process's tables, oldest first. Results read them lazily, so only callers know when to release them.
    opened: list[str] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        Scratch.opened.append(self.root)
        spark.conf.set(CLEANUP, "true")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write once and read back with the schema known, so no listing job infers it."""
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Free a table that nothing reads any more."""
        for name in names:
            _delete(self.spark, self.path(name))

    @staticmethod
    def release(spark: SparkSession, since: int = 0) -> None:
        """Free the tables opened since then; for callers whose results are written."""
        for root in Scratch.opened[since:]:
            _delete(spark, root)
        del Scratch.opened[since:]


def _delete(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text (null: none); all-JVM."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Bind `value` to a lambda variable, so that an expression used inside loops is evaluated once."""
    return F.transform(F.array(value), body)[0]


def held_out(id_col: Column, folds: int) -> Column:
    """True where crc32 of the id as text is divisible by `folds` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == 0

"""What several operators of this subpackage use: the shared folder, written tables, words."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The same split for Spark's own functions (Java's \s is ASCII white space).
JAVA_SPLIT = "[\\x20\\x09-\\x0D]+"
#: Rows of an Arrow batch.
BATCH_ROWS = 1000
#: A-Z to lower case; other letters keep their case.
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where a session names none (tests on one machine) is a temporary folder set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def bounded(df: DataFrame) -> DataFrame:
    """df, with its session's Arrow batches kept small: whole texts are long rows, and a batch stands
    in memory several times on both sides of the boundary."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


class Written:
    """Tables written to the shared folder; drop() removes those no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.tables = spark, shared_dir(spark), []

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        """Write df, cut its lineage, and return the table as read again."""
        path = f"{self.base}/tessera/{name}-{uuid.uuid4().hex[:12]}"
        schema = df.schema
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out.written_at = path
        self.tables.append(out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing will read again."""
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gone = {df.written_at for df in tables}
        self.tables = [df for df in self.tables if df.written_at not in gone]

    def keep(self, since: list[DataFrame], *kept: DataFrame) -> None:
        """Remove what was written since a copy of self.tables was taken, but for the kept."""
        stay = {df.written_at for df in [*since, *kept]}
        self.drop(*[df for df in self.tables if df.written_at not in stay])


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], n: str, how: str = "inner") -> DataFrame:
    """rows joined with table, which holds each key once and tells in column n how many rows have it.

    Keys that more than 1 / (4 * partitions) of the counted rows have are at most 4 * partitions, so
    their part of the table is broadcast; the rows of all others are joined by a shuffle in which no key is
    large. how is inner or left.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(100, (table.agg(F.sum(n)).first()[0] or 0) // (4 * parts))
    hot, cold = (table.filter(c).drop(n) for c in (F.col(n) > most, F.col(n) <= most))
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys, how))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def words(text: str) -> list[str]:
    return WORD.findall(text)

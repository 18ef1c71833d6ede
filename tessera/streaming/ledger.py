"""The ledger as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import model_family
from tessera.sources.schemas import LEDGER


def ledger_stream(spark: SparkSession, path: str) -> DataFrame:
    """Entries as files arrive."""
    return spark.readStream.schema(LEDGER).json(path)


def appended(rows: DataFrame, table: str, checkpoint: str) -> None:
    """Append what a stream has to add to a table (a folder of parquet files), once each, and end.

    A run goes on where the last one with the same checkpoint stopped, whatever happened to it.
    """
    query = rows.writeStream.format("parquet").outputMode("append").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def cost_by_window(entries: DataFrame, prices: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Calls and cost of each part and window; entries later than `late` are left out of closed windows."""
    family = prices.select(F.col("model").alias("family"), "input", "output")
    priced = entries.withWatermark("ts", late).withColumn("family", model_family(F.col("model"))).join(family, "family", "left")
    billed = ~F.coalesce("cached", F.lit(False))
    cost = F.when(billed, (F.col("input_tokens") * F.coalesce("input", F.lit(0.0)) + F.col("output_tokens") * F.coalesce("output", F.lit(0.0))) / 1e6).otherwise(0.0)
    return priced.groupBy(F.window("ts", window), "part").agg(F.count_if(billed).alias("calls"), F.round(F.sum(cost), 4).alias("cost")).select("window.start", "window.end", "part", "calls", "cost")

"""Usage ledger: calls, tokens and cost by part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import model_family
from tessera.operators.relational import small


def cost_by_part(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """part, calls, cached_calls, input_tokens, output_tokens, cost, models.

    ledger: part, model, input_tokens, output_tokens, cached. prices: model, input, output for a
    million tokens. Cached rows only count as such (and name their model); a family without a
    price costs nothing.
    """
    priced = ledger.withColumn("family", model_family(F.col("model"))).join(small(prices.select(F.col("model").alias("family"), F.col("input").alias("p_in"), F.col("output").alias("p_out"))), "family", "left")
    billed = ~F.coalesce("cached", F.lit(False))
    tokens = lambda c: F.when(billed, F.coalesce(c, F.lit(0))).otherwise(0)
    cost = (tokens("input_tokens") * F.coalesce("p_in", F.lit(0.0)) + tokens("output_tokens") * F.coalesce("p_out", F.lit(0.0))) / 1e6
    return priced.groupBy(F.coalesce("part", F.lit("unknown")).alias("part")).agg(
        F.count_if(billed).alias("calls"),
        F.count_if(~billed).alias("cached_calls"),
        F.sum(tokens("input_tokens")).alias("input_tokens"),
        F.sum(tokens("output_tokens")).alias("output_tokens"),
        F.round(F.sum(cost), 4).alias("cost"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("model", F.lit("")))), "/").alias("models"),
    )


def cost_total(parts: DataFrame) -> DataFrame:
    """The sum over parts; cost adds the parts' rounded costs, as a reader of the report would."""
    sums = ["calls", "cached_calls", "input_tokens", "output_tokens"]
    return parts.agg(*[F.sum(c).alias(c) for c in sums], F.round(F.sum("cost"), 4).alias("cost"))


def usage_by_item(records: DataFrame, item: str, user: str, done: str) -> DataFrame:
    """records, users and finishes of each item."""
    return records.groupBy(item).agg(F.count("*").alias("records"), F.count_distinct(user).alias("users"), F.sum(F.when(F.col(done), 1).otherwise(0)).alias("finishes"))

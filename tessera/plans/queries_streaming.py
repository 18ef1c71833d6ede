"""Queries: streams and stages that are stopped and taken up again, against SQL over the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cards import drop_contained
from tessera.operators.relational import shared_dir
from tessera.plans.cache import refreshed
from tessera.plans.catalogue import ORACLE_SQL, query
from tessera.session import table
from tessera.streaming import alerts as A
from tessera.streaming import ledger as L

#: Parts in which the events arrive; the stream is started anew for each.
SLICES = 3


def in_slices(rows: DataFrame, make) -> DataFrame:
    """What a stream over rows (with ts) has appended after all slices of their time have come, one run for each.

    make(stream) is the stream's plan. Rows are written to a folder that the stream reads, slice by slice.
    """
    spark, base = rows.sparkSession, f"{shared_dir(rows.sparkSession)}/streams/{uuid.uuid4().hex}"
    ends = rows.agg(F.min("ts").cast("long").alias("a"), F.max("ts").cast("long").alias("b")).first()
    place = F.lit(0) if ends.a is None or ends.a == ends.b else F.least(F.floor((F.col("ts").cast("long") - ends.a) * SLICES / (ends.b - ends.a)), F.lit(SLICES - 1))
    out = None
    for k in range(SLICES):
        rows.filter(place == k).write.mode("append").parquet(f"{base}/in")
        plan = make(spark.readStream.schema(rows.schema).parquet(f"{base}/in"))
        L.appended(plan, f"{base}/out", f"{base}/checkpoint")
        out = spark.read.schema(plan.schema).parquet(f"{base}/out")
    return out


def event_times(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("""WITH a AS (SELECT user_id AS source, event_id AS id, ts, event_type || ':' || CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) AS s FROM events), l AS (SELECT *, lag(s) OVER (PARTITION BY source ORDER BY ts, id) AS p FROM a) SELECT source, id FROM l WHERE p IS DISTINCT FROM s""")
def alerts_once(spark, sf_dir):
    """Events as notifications of their users, without those that say what the user's last one said; the stream is restarted twice."""
    said = F.concat_ws(":", "event_type", F.floor(F.col("value") / 50).cast("long").cast("string"))
    rows = event_times(spark, sf_dir).select(F.col("user_id").alias("source"), F.col("event_id").alias("id"), "ts", A.signature(said).alias("signature"))
    return in_slices(rows, A.changed).select("source", "id")


@query("""WITH e AS (SELECT ts, event_type AS part, event_id % 7 = 0 AS cached, event_id % 1000 AS i, event_id % 300 AS o, CASE event_id % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'large' ELSE 'other' END AS family FROM events),
    p AS (SELECT *, CASE family WHEN 'small' THEN 0.5 WHEN 'large' THEN 1.0 ELSE 0 END AS pi, CASE family WHEN 'small' THEN 0.0 WHEN 'large' THEN 2.0 ELSE 0 END AS po, time_bucket(INTERVAL '1 day', ts) AS b FROM e)
    SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS began, part, count(*) FILTER (NOT cached) AS calls, round(sum(CASE WHEN cached THEN 0.0 ELSE (i * pi + o * po) / 1e6 END)::DOUBLE, 4) AS cost
    FROM p WHERE b + INTERVAL '1 day' <= (SELECT max(ts) FROM events) - INTERVAL '2 hours' GROUP BY b, part""")
def ledger_stream_cost(spark, sf_dir):
    """Calls and cost of the days that a ledger stream has closed; entries come in three runs of the stream."""
    k = F.col("event_id")
    model = F.when(k % 3 == 0, "small[a]").when(k % 3 == 1, "large").otherwise("other[b]")
    rows = event_times(spark, sf_dir).select("ts", F.col("event_type").alias("part"), model.alias("model"), (k % 1000).alias("input_tokens"), (k % 300).alias("output_tokens"), (k % 7 == 0).alias("cached"))
    prices = spark.createDataFrame([("small", 0.5, 0.0), ("large", 1.0, 2.0)], "model string, input double, output double")
    out = in_slices(rows, lambda stream: L.cost_by_window(stream, prices, "1 day"))
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("began"), "part", "calls", "cost")


@query(ORACLE_SQL["contained_cards"])
def incremental_cards(spark, sf_dir):
    """contained_cards after two runs: the second computes only the tenth of the conversations that has changed in between."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("quote"))
    earlier = rows.withColumn("quote", F.when(F.col("conv_id") % 10 == 3, F.upper("quote")).otherwise(F.col("quote")))
    folder = f"{shared_dir(spark)}/stages/{uuid.uuid4().hex}"
    build = lambda own: drop_contained(own, "conv_id", "turn", "quote")
    refreshed(earlier, "conv_id", build, folder)
    return refreshed(rows, "conv_id", build, folder)[0]

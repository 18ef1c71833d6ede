"""Results that only larger tables show."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from tessera.operators import quotes as Q
from tessera.operators import relational as R
from tessera.operators import retrieval as T
from tessera.plans import catalogue


def test_dense_ids_beyond_five_digits(spark, tmp_path):
    """As the SQL's lpad: numbers of six digits lose their last one."""
    spark.range(100_003).select(F.col("id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus")).write.parquet(str(tmp_path / "orders.parquet"))
    got = {r.o_orderkey: r.code for r in catalogue.QUERIES["dense_ids"](spark, str(tmp_path)).filter("o_orderkey < 2 or o_orderkey > 99998").collect()}
    assert got == {0: "O-00000", 1: "O-00001", 99_999: "O-99999", 100_000: "O-10000", 100_001: "O-10000", 100_002: "O-10000"}


def test_numbered_digits(spark):
    rows = spark.createDataFrame([("k", i) for i in range(3)], "k string, i long")
    assert [r.n for r in R.numbered(rows, ["k"], [F.col("i")], "%s/%s", "n", 9, digits=2).orderBy("i").collect()] == ["k/09", "k/10", "k/11"]


def test_windows_of_long_texts(spark):
    """Windows are cut from stretches; none is lost or moved at their edges."""
    texts = [("äbcdefghij" * 7)[:n] for n in range(70)] + [" " * n for n in range(12)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("w", T.fixed_windows(F.col("t"), 6, 2, 3))
    for r in rows.collect():
        n, want, k = len(r.t), [], 0
        while n - 4 * k >= 6:
            want.append((k, 4 * k, r.t[4 * k : 4 * k + 6]))
            k += 1
        if r.t[4 * k :].strip():
            want.append((k, 4 * k, r.t[4 * k :]))
        assert [tuple(w) for w in r.w] == want
    plan = rows.select("w")._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten" in plan  # two levels: no window is looked for from the text's beginning


def test_bm25_top(spark):
    """The k best as all scores give them, copies and empty texts among them, few rows of a slice at a time."""
    r = random.Random(5)
    texts = ["".join(r.choice("ab cd") for _ in range(r.randint(0, 12))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:60])] + [(900, None)], "i long, t string").repartition(5)
    asked = spark.createDataFrame([(q, texts[q]) for q in range(0, 150, 7)] + [(998, "zz"), (999, None)], "q long, a string")
    got = T.bm25_top(docs, asked, "i", "t", "q", "a", 4)
    want = T.top_k(T.bm25_scores(T.postings(docs, "i", "t"), asked, "i", "q", "a"), "q", "i", 4)
    near = lambda d: sorted((x.q, x["rank"], x.i, round(x.score, 5)) for x in d.collect())
    assert near(got) == near(want)


def test_slices_of_batches():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 9, "", "ddd"])], names=["t"])
    assert [s.column(0).to_pylist() for s in Q.slices(batch, "t", 4)] == [["ab", None], ["c" * 9], ["", "ddd"]]


def test_hybrid_top(spark):
    """As all scores give it; one query's cosines are all negative, labels may be null."""
    r = random.Random(3)
    vectors = [(i, [float(r.randint(-2, 2)) for _ in range(3)], r.choice(["a", "b", None])) for i in range(80)] + [(80, [1.0, 1.0], "a"), (81, [2.0, 1.0], "b"), (82, [1.0, 3.0], None)]
    queries = [(i, v, x) for i, v, x in vectors if i % 5 == 0] + [(900, [-1.0, -1.0], "b"), (901, [0.0] * 3, "a")]
    df, qs = spark.createDataFrame(vectors, "i long, v array<float>, l string"), spark.createDataFrame(queries, "q long, v array<float>, l string")
    same = qs.select("q", "l").join(df.select("i", "l"), "l").select("q", "i", F.lit(1.0).alias("score"))
    every = T.hybrid_scores(T.cosine_scores(df, qs, "i", "q", "v"), same, "q", "i")
    # vectors of other lengths meet a query by their label alone there
    want = T.top_k(every.join(T.cosine_scores(df, qs, "i", "q", "v").select("q", "i"), ["q", "i"], "left_semi"), "q", "i", 3)
    got = T.hybrid_top(df, qs, "i", "q", "v", "l", 3)
    rows = lambda d: sorted((x.q, x["rank"], x.i, x.score) for x in d.collect() if x.q != 900)
    assert rows(got) == rows(want) and got.filter("q = 900").count() == 3
    assert [x.score for x in got.filter("q = 900").orderBy("rank").collect()] == [x.score for x in want.filter("q = 900").orderBy("rank").collect()]


def test_postings_are_counted_once(spark):
    """Scores read a table of postings: no text is cut into pairs again for lengths, frequencies and hits."""
    docs, asked = (spark.createDataFrame([(i, t) for i, t in enumerate(["abc", "bcd", ""])], f"{c} long, t string") for c in "iq")
    scores = T.bm25_scores(T.postings(docs, "i", "t"), asked, "i", "q", "t")
    assert "Generate" not in scores._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.q, r.i) for r in scores.collect()} == {(0, 0), (0, 1), (1, 0), (1, 1), (2, 2)}

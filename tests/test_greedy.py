"""Greedy passes, ranks and what is built on them, against loops in order."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import cards, frames, greedy, relational


def loop(conflicts):
    before = defaultdict(set)
    for k, a, b in conflicts:
        before[k, b].add(a)
    gone = set()
    for k, b in sorted(before):
        if any((k, a) not in gone for a in before[k, b]):
            gone.add((k, b))
    return gone


@pytest.mark.parametrize("stretch", [60, 10_000])
def test_greedy_like_a_loop(spark, stretch):
    r = random.Random(stretch)
    rows = set()
    for k in "abc":
        n = r.choice([10, 30])
        for _ in range(3 * n):
            a, b = sorted(r.sample(range(n), 2))
            rows.add((k, a, b))
    rows |= {("chain", i, i + 1) for i in range(120)}
    got = greedy.dropped(spark.createDataFrame(sorted(rows), "key string, earlier long, later long"), stretch)
    assert {tuple(x) for x in got.collect()} == loop(rows)
    assert greedy.dropped(spark.createDataFrame([], "key string, earlier long, later long")).collect() == []


def test_ranked_splits_hot_keys(spark):
    r = random.Random(1)
    rows = [(None if r.random() < 0.1 else "hot" if r.random() < 0.8 else f"k{r.randrange(5)}", r.randrange(10_000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, i long")
    got = relational.ranked(df, ["k"], [F.desc("v"), F.col("i")])
    assert got.columns == ["k", "v", "i", "place"]
    want = defaultdict(list)
    for k, v, i in sorted(rows, key=lambda x: (-x[1], x[2])):
        want[k].append(i)
    found = defaultdict(dict)
    for x in got.collect():
        found[x.k][x.place] = x.i
    assert {k: [found[k][p] for p in range(1, len(v) + 1)] for k, v in want.items()} == dict(want)
    sizes = relational.ranked(df, ["k"], [F.col("i")]).count()
    assert sizes == 3000
    whole = relational.ranked(df, [], [F.col("i")]).collect()
    assert all(x.place == x.i + 1 for x in whole)
    ranges = df.repartitionByRange(4, "k", "v").groupBy(F.spark_partition_id()).count().collect()
    assert max(x["count"] for x in ranges) <= 2 * sorted(x["count"] for x in ranges)[len(ranges) // 2]


def kept_frames(rows, distance):
    out, kept = set(), defaultdict(list)
    for c, i, h in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        if h is None:
            out.add((c, i))
        elif all((int(h, 16) ^ k).bit_count() > distance for k in kept[c]):
            kept[c].append(int(h, 16))
            out.add((c, i))
    return out


@pytest.mark.parametrize("distance", [0, 6, 15, 24])
def test_distinct_frames(spark, distance):
    r = random.Random(distance)
    rows, i = [], 0
    for c in ("a", "b", None):
        scene = r.getrandbits(64)
        for _ in range(70):
            if r.random() < 0.1:
                scene = r.getrandbits(64)
            h = scene
            for _ in range(r.choice([0, 0, 1, 2, 4, 6, 9])):
                h ^= 1 << r.randrange(64)
            if r.random() < 0.3:
                scene = h  # a slow pan: each frame is near the one before
            rows.append((c, i, None if r.random() < 0.02 else f"{h:016x}".upper() if r.random() < 0.2 else f"{h:016x}"))
            i += 1
    df = spark.createDataFrame(rows, "c string, i long, h string")
    got = frames.distinct_frames(df, "c", "i", "h", distance)
    assert got.schema == df.schema and {(x.c, x.i) for x in got.collect()} == kept_frames(rows, distance)


def test_slots_meet_within_the_distance(spark):
    r = random.Random(3)
    rows = []
    for d in range(7):
        for _ in range(60):
            a = b = r.getrandbits(64)
            for bit in r.sample(range(64), d):
                b ^= 1 << bit
            rows.append((f"{a:016x}", f"{b:016x}"))
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.filter(~F.arrays_overlap(frames.hash_slots(F.col("a"), 6), frames.hash_slots(F.col("b"), 6))).isEmpty()


def test_a_hot_course_of_frames(spark):
    """20,000 frames of one course in scenes of near copies: no group is one frame of a task."""
    rows = spark.range(20_000).select(F.lit("hot").alias("c"), F.col("id").alias("i"), F.concat(F.substring(F.md5((F.col("id") / 50).cast("long").cast("string").cast("binary")), 1, 15), F.lower(F.hex(F.col("id") % 16))).alias("h"))
    got = frames.distinct_frames(rows, "c", "i", "h")
    assert got.count() == 400 and got.filter("i % 50 <> 0").isEmpty()
    plan = got._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan


def test_frames_of_large_courses_meet_in_slots(spark, monkeypatch):
    """Slots find what all pairs find, and no table that grows with the input is built on the driver, however small its file is."""
    monkeypatch.setattr(frames, "SMALL_COURSE", 20)
    r = random.Random(11)
    rows = []
    for c, n in (("a", 200), ("b", 15), (None, 60)):
        scene = r.getrandbits(64)
        for i in range(n):
            scene = r.getrandbits(64) if r.random() < 0.2 else scene ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
            rows.append((c, i, f"{scene:016x}"))
    got = frames.distinct_frames(spark.createDataFrame(rows, "c string, i long, h string"), "c", "i", "h", 6)
    assert {(x.c, x.i) for x in got.collect()} == kept_frames(rows, 6)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_contained_cards(spark):
    r = random.Random(6)
    rows = []
    for c in ("a", "b", None):
        for i in range(80):
            t = "".join(r.choice("ab ") for _ in range(r.choice([1, 3, 6, 12, 30])))
            rows.append((c, i, r.choice([t, t, t + "xyz", None if r.random() < 0.1 else t])))
    rows += [("e", 1, ""), ("e", 2, "abc"), ("e", 3, None), ("f", 1, "abc"), ("f", 2, " "), ("f", 3, "a b")]
    want, kept = set(), defaultdict(list)
    for c, i, q in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        q = "".join((q or "").split())
        if not any(q in k or k in q for k in kept[c]):
            kept[c].append(q)
            want.add((c, i))
    df = spark.createDataFrame(rows, "c string, i long, q string")
    got = cards.drop_contained(df, "c", "i", "q")
    assert got.schema == df.schema and {(x.c, x.i) for x in got.collect()} == want


def test_contained_cards_of_large_groups(spark, monkeypatch):
    """Groups that are too large for a task, by cards or by characters, keep what a pass in order keeps, and small ones beside them do too."""
    r = random.Random(16)
    rows = []
    for c, n in (("many", 90), ("long", 20), ("few", 8), (None, 90), ("", 3)):
        for i in range(n):
            t = "".join(r.choice("ab ") for _ in range(r.choice([1, 4, 9, 15, 40]) + (c == "long") * 60))
            rows.append((c, i, r.choice([t, t, t[5:25], None if r.random() < 0.1 else t])))
    want, kept = set(), defaultdict(list)
    for c, i, q in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        q = "".join((q or "").split())
        if not any(q in k or k in q for k in kept[c]):
            kept[c].append(q)
            want.add((c, i))
    monkeypatch.setattr(cards, "GROUP_CARDS", 50)
    monkeypatch.setattr(cards, "GROUP_CHARS", 1200)
    df = spark.createDataFrame(rows, "c string, i long, q string")
    got = cards.drop_contained(df, "c", "i", "q")
    assert got.schema == df.schema and sorted((str(x.c), x.i) for x in got.collect()) == sorted((str(c), i) for c, i in want)


def test_contained_cards_deal_out_texts_once(spark, shuffled):
    """What is shuffled and stored is about the texts themselves, not all places of their grams."""
    r = random.Random(17)
    rows = [(i // 5, i, "".join(r.choice("abcdefghijklmnop ") for _ in range(400))) for i in range(1000)]
    df = spark.createDataFrame(rows, "c long, i long, q string")
    assert shuffled(lambda: cards.drop_contained(df, "c", "i", "q").count()) < 2 * 400 * len(rows)


def test_types_in_turn(spark):
    r = random.Random(4)
    types = ["x", "y", "z", "w"]
    rows = [(c, i, r.choice(types[: r.choice([1, 2, 4])] + ["other"])) for c in range(12) for i in range(r.choice([1, 5, 30]))]
    want = set()
    for c in range(12):
        queues = {t: [i for d, i, k in sorted(rows) if d == c and k == t] for t in types}
        left, turn, n = [t for t in types if queues[t]], 0, 0
        taken = Counter()
        while left and n < 7:
            t = left[turn % len(left)]
            if taken[t] < len(queues[t]):
                n += 1
                want.add((c, queues[t][taken[t]], n))
                taken[t] += 1
                turn += 1
            else:
                left.remove(t)
    got = cards.round_robin(spark.createDataFrame(rows, "c long, i long, k string"), "c", "i", "k", 7, types)
    assert {(x.c, x.i, x.pick_no) for x in got.collect()} == want

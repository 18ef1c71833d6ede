"""Reconciling a roster with a platform's goods and lives and with the files at hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions import vocabulary as V
from tessera.functions.numbers import half_even
from tessera.operators.relational import greedy_pairs, small, stored


def in_window(day: Column, low: Column, high: Column) -> Column:
    """Is a time's date within both dates? Missing times are not."""
    date = F.try_to_date(F.substring(day.cast("string"), 1, 10))
    return F.coalesce(date.between(low, high), F.lit(False))


def title_pairs(roster: DataFrame, goods: DataFrame, least: float) -> DataFrame:
    """(left, right, score) of roster (left, left_title, win_start, win_end) and goods (right, right_title, day)
    whose day is in the window and whose titles are at least so alike.

    Equal titles are one: distinct titles meet by their character pairs and are scored once. Titles of n
    pairs that are so alike share at least o = least * n / (2 - least) pairs, so they share one
    of the n - o + 1 rarest of each and are filed under these alone. Rows are joined to scored
    titles at the end.
    """
    sides = [d.withColumn("key", X.normal_title(F.col(f"{k}_title"))).filter("key <> ''") for d, k in ((roster, "left"), (goods, "right"))]
    titles = stored(sides[0].select("key").unionAll(sides[1].select("key")).distinct().withColumn("s", F.array_distinct(X.gram_list(F.col("key")))))
    grams = titles.select("key", F.size("s").alias("n"), F.explode("s").alias("gram"))
    grams = grams.join(grams.groupBy("gram").agg(F.count("*").alias("df")), "gram")
    shown = F.col("n") - F.greatest(F.lit(1), F.ceil(F.col("n") * (least - 1e-6) / (2 - least))) + 1
    rank = F.row_number().over(Window.partitionBy("key").orderBy("df", "gram"))
    grams = stored(grams.withColumn("rank", rank).filter(F.col("rank") <= shown).select("gram", "key"))
    met = grams.withColumnRenamed("key", "l_key").join(grams.withColumnRenamed("key", "r_key"), "gram").select("l_key", "r_key").distinct()
    sets = [titles.select(F.col("key").alias(f"{k}_key"), F.col("s").alias(f"{k}_s")) for k in "lr"]
    score = F.round(F.try_divide(2.0 * F.size(F.array_intersect("l_s", "r_s")), F.size("l_s") + F.size("r_s")), 6)
    alike = met.join(sets[0], "l_key").join(sets[1], "r_key").select("l_key", "r_key", score.alias("score")).filter(F.col("score") >= least)
    l, r = (d.withColumnRenamed("key", f"{k}_key") for d, k in zip(sides, "lr", strict=True))  # noqa: E741
    rows = l.select("left", "win_start", "win_end", "l_key").join(alike, "l_key").join(r.select("right", "day", "r_key"), "r_key")
    return rows.filter(in_window(F.col("day"), F.col("win_start"), F.col("win_end"))).select("left", "right", "score")


def assign(roster: DataFrame, goods: DataFrame, least: float = 0.3, threshold: float = V.TITLE_MATCH) -> DataFrame:
    """One-to-one (left, right, score) between roster and goods."""
    return greedy_pairs(title_pairs(roster, goods, least), "left", "right", "score", threshold)


def deviation(video: Column, meta: Column) -> Column:
    """Relative difference of two durations to 4 places; null unless both are known and not 0."""
    return F.when((video != 0) & (meta != 0), half_even(F.abs(video - meta) / meta, 4))


def status(has_text: Column, has_video: Column, video: Column, meta: Column, matched: Column, score: Column, ok: str = "OK") -> Column:
    """The flags of a roster row, joined by semicolons."""
    off = F.abs(video - meta) / meta
    flags = [
        F.when(~has_text, "no transcript"),
        F.when(~has_video, "no video"),
        F.when((video != 0) & (meta != 0) & (off > V.DURATION), "duration differs"),
        F.when(matched & (score < 0.99), "title differs"),
        F.when(~matched, "no match"),
    ]
    return F.coalesce(F.nullif(F.concat_ws(";", *flags), F.lit("")), F.lit(ok))


def gaps(master: DataFrame) -> DataFrame:
    """(level, canonical_id, title, camp, detail): A no transcript, B no video, C duration or title differs.

    master: canonical_id, title, camp, has_text, has_video, video_secs, meta_secs, goods_name, match_score.
    """
    off = F.abs(F.col("video_secs") - F.col("meta_secs")) / F.col("meta_secs")
    row = lambda level, detail: F.struct(F.lit(level).alias("level"), detail.alias("detail"))
    found = F.array_compact(
        F.array(
            F.when(~F.col("has_text"), row("A", F.lit("no transcript file"))),
            F.when(~F.col("has_video"), row("B", F.lit("no video file"))),
            F.when((F.col("video_secs") != 0) & (F.col("meta_secs") != 0) & (off > V.DURATION), row("C", F.format_string("stated %s s, video %s s", F.col("meta_secs").cast("string"), F.col("video_secs").cast("string")))),
            F.when(F.col("goods_name").isNotNull() & (F.col("match_score") < 0.99), row("C", F.concat(F.lit("listed as "), F.col("goods_name")))),
        )
    )
    return master.select("canonical_id", "title", "camp", F.explode(found).alias("g")).select("g.level", "canonical_id", "title", "camp", "g.detail")


def unmatched_goods(goods: DataFrame, matched: DataFrame, roster: DataFrame, least: float = V.TOPICAL, ordinal: bool = True) -> DataFrame:
    """Goods (id, name, day, ord) with no match that resemble some roster title; equal titles are one row.

    The row keeps its first goods' name and day (by ord) and lists all ids.
    """
    left = goods.join(matched.select("id"), "id", "left_anti")
    if ordinal:
        left = left.filter(X.ordinal_title(F.col("name")))
    near = title_pairs(
        left.select(F.col("id").alias("left"), F.col("name").alias("left_title"), F.lit("0001-01-01").cast("date").alias("win_start"), F.lit("9999-12-31").cast("date").alias("win_end")),
        roster.select(F.col("title").alias("right"), F.col("title").alias("right_title"), F.lit("2000-01-01").alias("day")).distinct(),
        least,
    ).groupBy(F.col("left").alias("id")).agg(F.max("score").alias("topical"))
    rows = left.join(near, "id")
    first = lambda c: F.min_by(c, F.struct("ord", "id"))
    return rows.groupBy(X.normal_title(F.col("name")).alias("key")).agg(
        first("name").alias("title"), first("day").alias("day"), F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"), F.round(first("topical"), 2).alias("topical")
    )


def instructor(intro: Column, patterns: list[str], stop: list[str], blocked_before: str) -> Column:
    """The name that the first pattern with an accepted hit gives; patterns have one group.

    Only a pattern's first hit counts: its name must be no stop word and not follow a blocked character.
    """
    found = []
    for p in patterns:
        hit = F.regexp_extract(intro, f"(?s)^.*?({p})", 1)
        at = F.instr(intro, hit)
        before = F.when(at > 1, F.substr(intro, at - 1, F.lit(1))).otherwise("")
        name = F.regexp_extract(intro, p, 1)
        fine = (hit != "") & ~name.isin(stop) & ~((before != "") & F.lit(blocked_before).contains(before))
        found.append(F.when(fine, name))
    return F.coalesce(*found)


def with_instructor(rows: DataFrame, names: DataFrame, patterns: list[str], stop: list[str], blocked_before: str) -> DataFrame:
    """rows (instructor, intro, ...) with missing instructors filled from the intro, in their canonical form.

    names: variant, canonical. Only listed names are accepted. Each pattern is tried on its own, so a
    hit that is not listed leaves the next pattern its turn.
    """
    known = names.agg(F.map_from_entries(F.collect_list(F.struct("variant", "canonical"))).alias("_names"))
    tried = [instructor(F.col("intro"), [p], stop, blocked_before) for p in patterns]
    picked = F.coalesce(*[F.try_element_at("_names", F.coalesce(t, F.lit(""))) for t in tried])
    out = rows.join(F.broadcast(known), F.lit(True)).withColumn("_found", picked).drop("_names")
    missing = F.coalesce(F.col("instructor"), F.lit("")) == ""
    return out.withColumn("instructor_source", F.when(missing & F.col("_found").isNotNull(), "intro")).withColumn("instructor", F.when(missing, F.coalesce("_found", "instructor")).otherwise(F.col("instructor"))).drop("_found")


def coverage(master: DataFrame, usage: DataFrame) -> DataFrame:
    """Each roster row with the records and users of its goods, 0 where there are none."""
    joined = master.join(small(usage.withColumnRenamed("goods_id", "_g")), F.col("goods_id") == F.col("_g"), "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "users", "finishes")]
    return joined.select("canonical_id", "goods_id", *zero, (F.coalesce("records", F.lit(0)) > 0).alias("covered"))


def lessons(goods: DataFrame, kinds: list[int] = V.LESSON_KINDS) -> DataFrame:
    """Goods of the kinds that are lessons."""
    return goods.filter(F.col("resource_type").isin(kinds))


def containers(goods: DataFrame, part: str, kind: int = V.CONTAINER_KIND) -> DataFrame:
    """Goods that hold a whole cohort's lessons: of one kind, their name has the cohort's part."""
    return goods.filter(F.contains(F.coalesce("goods_name", F.lit("")), F.lit(part)) & (F.col("resource_type") == kind))


def with_camp(roster: DataFrame, camps: DataFrame) -> DataFrame:
    """Roster rows with their cohort's label and window."""
    return roster.join(small(camps.select("camp", F.col("label").alias("camp_label"), "win_start", "win_end")), "camp")


def master_rows(roster: DataFrame, matched: DataFrame, goods: DataFrame, live_matched: DataFrame, lives: DataFrame) -> DataFrame:
    """Roster rows with the goods and the live matched to each, empty where there is none, sorted by id when written.

    matched and live_matched: left (canonical_id), right (goods_id, live_id), score.
    """
    g = matched.select(F.col("left").alias("canonical_id"), F.col("right").alias("goods_id"), F.round("score", 3).alias("match_score")).join(goods.select("goods_id", "goods_name", F.col("created_at").alias("listed_at")), "goods_id")
    v = live_matched.select(F.col("left").alias("canonical_id"), F.col("right").alias("live_id"), F.round("score", 3).alias("live_match_score")).join(lives.select("live_id", F.col("zb_start_at").alias("live_at")), "live_id")
    zero = {"match_score": 0.0, "live_match_score": 0.0}
    return roster.join(g, "canonical_id", "left").join(v, "canonical_id", "left").na.fill(zero)

"""Quizzes and handouts: validating against their cards, selecting, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions import vocabulary as V
from tessera.operators.relational import top_per_group

BLANKS = " \n\t\r"


def unknown_ids(rows: DataFrame, key: str, ids: str, cards: DataFrame, card_key: str, card_id: str) -> DataFrame:
    """(key, id) of listed ids that no card of the course has."""
    return rows.select(card_key, key, F.explode(ids).alias("id")).join(cards.select(card_key, F.col(card_id).alias("id")), [card_key, "id"], "left_anti").select(key, "id").distinct()


def question_error(known: Column, no_source: str = V.NO_SOURCE) -> Column:
    """The first rule that a question breaks, in order; null for a good one.

    Columns: stem, options (map), answer, explanation, source_card_ids, distractor_source,
    distractor_note. known: the course's card ids (array). Options are compared as they are written.
    """
    trim = lambda c: F.btrim(F.coalesce(F.col(c), F.lit("")), F.lit(BLANKS))
    values = F.map_values("options")
    source, other = F.col("source_card_ids"), F.col("distractor_source")
    return (
        F.when(F.length(trim("stem")) < V.STEM, "short_stem")
        .when(~F.coalesce(F.array_sort(F.map_keys("options")) == F.array(*map(F.lit, "ABCD")), F.lit(False)), "bad_options")
        .when(F.exists(values, lambda v: F.btrim(F.coalesce(v, F.lit("")), F.lit(BLANKS)) == ""), "empty_option")
        .when(F.size(F.array_distinct(values)) < 4, "equal_options")
        .when(~F.upper(trim("answer")).isin(*"ABCD"), "bad_answer")
        .when(F.length(trim("explanation")) < V.EXPLANATION, "short_explanation")
        .when(F.coalesce(F.size(source), F.lit(0)) < 1, "unknown_source")
        .when(F.size(F.array_except(source, known)) > 0, "unknown_source")
        .when(F.coalesce(F.size(other), F.lit(0)) < 1, "no_distractor_source")
        .when((other != F.array(F.lit(no_source))) & (F.size(F.array_except(other, known)) > 0), "unknown_distractor")
        .when(trim("distractor_note") == "", "empty_note")
    )


def validated(questions: DataFrame, cards: DataFrame, key: str = "course_id", order: str = "pos", no_source: str = V.NO_SOURCE) -> DataFrame:
    """questions with error (null for accepted ones); of accepted equal stems of a course only the first is."""
    known = cards.groupBy(key).agg(F.collect_set("card_id").alias("_known"))
    rows = questions.join(known, key, "left").withColumn("_known", F.coalesce("_known", F.array().cast("array<string>")))
    rows = rows.withColumn("error", question_error(F.col("_known"), no_source)).drop("_known")
    stem = F.btrim("stem", F.lit(BLANKS))
    again = F.row_number().over(Window.partitionBy(key, stem, F.col("error").isNull()).orderBy(order)) > 1
    return rows.withColumn("error", F.when(F.col("error").isNull() & again, "equal_stem").otherwise(F.col("error")))


def noted(note: Column, source: Column, no_source: str = V.NO_SOURCE, mark: str = V.NO_SOURCE_MARK, full: str = V.NO_SOURCE_NOTE) -> Column:
    """A distractor note that says so where no card stands behind the distractors."""
    return F.when((source == F.array(F.lit(no_source))) & ~F.contains(note, F.lit(mark)), F.concat(note, F.lit(";" + full))).otherwise(note)


def real_distractor(source: Column, no_source: str = V.NO_SOURCE) -> Column:
    return source != F.array(F.lit(no_source))


def selected(questions: DataFrame, key: str, order: str, most: int = 5, no_source: str = V.NO_SOURCE) -> DataFrame:
    """Up to `most` questions of a course, those with real distractors first, else in order; numbered q_no."""
    return top_per_group(questions, [key], [F.when(real_distractor(F.col("distractor_source"), no_source), 0).otherwise(1), F.col(order)], most, "q_no")


def course_gate(questions: DataFrame, key: str, least: int = 3, no_source: str = V.NO_SOURCE) -> DataFrame:
    """Courses with too few questions, or none with a real distractor."""
    counts = questions.groupBy(key).agg(F.count("*").alias("questions"), F.count_if(real_distractor(F.col("distractor_source"), no_source)).alias("real"))
    return counts.filter((F.col("questions") < least) | (F.col("real") < 1))


def used_cards(questions: DataFrame, cards: DataFrame, key: str, no_source: str = V.NO_SOURCE) -> DataFrame:
    """course, used, cards, coverage: the share of a course's cards that its questions draw on."""
    ids = questions.select(key, F.explode(F.array_union("source_card_ids", "distractor_source")).alias("card_id")).filter(F.col("card_id") != no_source).distinct()
    used = ids.join(cards.select(key, "card_id").distinct(), [key, "card_id"], "left_semi").groupBy(key).agg(F.count("*").alias("used"))
    total = cards.groupBy(key).agg(F.count_distinct("card_id").alias("cards"))
    return total.join(used, key, "left").select(key, F.coalesce("used", F.lit(0)).alias("used"), "cards", F.round(F.coalesce("used", F.lit(0)) / F.col("cards"), 3).alias("coverage"))


def stray_marks(handouts: DataFrame, cards: DataFrame, key: str = "course_id", reach: float = V.MARK_REACH) -> DataFrame:
    """(course, mark) of time marks with no card within `reach` seconds.

    Marks and cards meet in cells of twice the reach: each card is filed under the cells it reaches.
    """
    width = 2 * reach
    marks = handouts.select(key, F.explode(X.time_marks(F.col("markdown"))).alias("mark")).withColumn("_cell", F.floor(F.col("mark") / width))
    filed = cards.select(key, "start_sec", F.explode(F.sequence(F.floor((F.col("start_sec") - reach) / width), F.floor((F.col("start_sec") + reach) / width))).alias("_cell"))
    near = (marks[key] == filed[key]) & (marks["_cell"] == filed["_cell"]) & (F.abs(marks["mark"] - filed["start_sec"]) <= reach)
    return marks.join(filed, near, "left_anti").select(key, "mark")


def handout_error(handouts: DataFrame, cards: DataFrame, key: str = "course_id", least: int = V.HANDOUT, marks: int = V.MARKS, reach: float = V.MARK_REACH) -> DataFrame:
    """handouts with error: too_short, few_marks, stray_mark, or null."""
    stray = stray_marks(handouts, cards, key, reach).groupBy(key).agg(F.count("*").alias("_stray"))
    found = F.coalesce(F.size(X.time_marks(F.col("markdown"))), F.lit(0))
    short = F.coalesce(F.length("markdown"), F.lit(0)) < least
    return handouts.join(stray, key, "left").withColumn("error", F.when(short, "too_short").when(found < marks, "few_marks").when(F.col("_stray") > 0, "stray_mark")).drop("_stray")


def template_handout(cards: DataFrame, key: str = "course_id", types: list[str] = V.CARD_TYPES, headings: dict[str, str] | None = None, quoted: str = V.CARD_TYPES[3]) -> DataFrame:
    """A handout from a course's cards alone: a section per type in order, cards by time, one type quoted."""
    names = headings or {}
    place = F.array_position(F.array(*map(F.lit, types)), F.col("type"))
    line = F.concat(F.when(F.col("type") == quoted, "> ").otherwise("- "), F.lit("【"), X.hms(F.col("start_sec")), F.lit("】"), F.col("content"))
    lines = cards.filter(F.col("type").isin(types)).select(key, "type", place.alias("place"), "start_sec", "card_id", line.alias("line"))
    section = lines.groupBy(key, "type", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_sec", "card_id", "line"))), lambda x: x["line"]), "\n").alias("body"))
    title = F.lit(None).cast("string")
    for t in types:
        title = F.when(F.col("type") == t, names.get(t, t)).otherwise(title)
    block = F.concat(F.lit("## "), title, F.lit("\n\n"), F.col("body"))
    return section.groupBy(key).agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", block.alias("b")))), lambda x: x["b"]), "\n\n"), F.lit("\n")).alias("markdown"))


def merged_by_stem(first: DataFrame, repair: DataFrame, key: str = "course_id", order: str = "pos") -> DataFrame:
    """Both rounds' questions, of equal stems the first round's."""
    both = first.withColumn("_round", F.lit(1)).unionByName(repair.withColumn("_round", F.lit(2)))
    return top_per_group(both, [key, "stem"], [F.col("_round"), F.col(order)], 1).drop("_round")


def totals(per_course: DataFrame) -> DataFrame:
    """courses, questions, mean coverage over courses without an error."""
    fine = F.col("error").isNull()
    return per_course.agg(F.count("*").alias("courses"), F.sum(F.when(fine, F.col("questions")).otherwise(0)).alias("questions"), F.round(F.avg(F.when(fine, F.col("coverage"))), 3).alias("coverage"))


def generate(courses: DataFrame, cards: DataFrame, ask, key: str = "course_id", least: int = 3, no_source: str = V.NO_SOURCE, most: int = 5) -> DataFrame:
    """Ask once, validate, ask again for the courses that fall short, merge by stem, and select.

    ask(courses, round) gives question rows; only the second round depends on what the first gave.
    """
    first = validated(ask(courses, 1), cards, key, "pos", no_source).filter("error is null").drop("error")
    weak = course_gate(first, key, least, no_source).select(key)
    none = courses.select(key).join(first.select(key).distinct(), key, "left_anti")
    again = courses.join(weak.unionAll(none).distinct(), key, "left_semi")
    second = validated(ask(again, 2), cards, key, "pos", no_source).filter("error is null").drop("error")
    return selected(merged_by_stem(first, second, key), key, "pos", most, no_source)


def completion(rows: DataFrame, flag: str, done: str) -> DataFrame:
    """wanted, finished and their ratio among flagged rows."""
    fine = F.col(flag) & F.coalesce(F.col(done), F.lit(False))
    return rows.agg(F.count_if(flag).alias("wanted"), F.count_if(fine).alias("finished"), F.round(F.try_divide(F.count_if(fine), F.count_if(flag)), 4).alias("ratio"))

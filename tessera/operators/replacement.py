"""Dictionary work on whole texts by one automaton over all forms: guarded replacement, first contexts.

All canonicals and variants of a dictionary are the patterns of one Aho-Corasick automaton. It is built on the
driver, broadcast once as bytes, and read by each Python worker once; a text is then read once, whatever the
number of forms. At each place the longest form counts. A canonical stays as it is and so protects the variants
inside it; a variant whose guard forbids the characters beside it is skipped, and shorter forms at the same place
are tried; what a hit covers is not looked at again.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tessera.functions import vocabulary as V
from tessera.operators.relational import bounded, stored

#: Forms of one automaton when contexts are looked up; more forms take more readings of the texts.
LOT = 200_000


class Rule(NamedTuple):
    """What a form becomes (None: it is canonical and stays), and where it may stand."""

    size: int
    becomes: str | None
    before: frozenset[str]  # characters that must not stand before it
    after: frozenset[str]  # nor behind it
    classed: bool  # replaced only in the setting of the class rule


class ClassRule(NamedTuple):
    """Variants that match the pattern are replaced only after one of `before`, or before one of `heads`, with or without one particle between."""

    pattern: str
    before: str
    heads: str
    particles: str = "的之"


def automaton_of(rules: dict[str, Rule]) -> bytes:
    found = ahocorasick.Automaton()
    for form, rule in rules.items():
        found.add_word(form, rule)
    if rules:
        found.make_automaton()
    return pickle.dumps(found)


def rules_of(terms: list[tuple[str, list[str]]], guards: dict[str, tuple[str, str]] | None = None, class_rule: ClassRule | None = None) -> dict[str, Rule]:
    """Rules of a dictionary (canonical, variants): a form listed as a variant of another is replaced, the last listing counts."""
    guards, classes = guards or {}, re.compile(class_rule.pattern) if class_rule else None
    rules = {c: Rule(len(c), None, frozenset(), frozenset(), False) for c, _ in terms if c}
    for canonical, variants in terms:
        for v in variants:
            if v and v != canonical:
                before, after = guards.get(v, ("", ""))
                rules[v] = Rule(len(v), canonical, frozenset(before), frozenset(after), bool(classes and classes.fullmatch(v)))
    return rules


def hits(automaton, text: str, class_rule: ClassRule | None = None) -> tuple[list[tuple[int, Rule]], list[Rule]]:
    """(start, rule) of the replacements in a text, and the rules that were skipped."""
    if not len(automaton):
        return [], []
    found = [(end + 1 - rule.size, -rule.size, rule) for end, rule in automaton.iter(text)]
    found.sort(key=lambda x: x[:2])
    taken, skipped, free = [], [], 0
    for start, _, rule in found:
        if start < free:
            continue
        end = start + rule.size
        if rule.becomes is None:
            free = end
        elif text[start - 1 : start] in rule.before or text[end : end + 1] in rule.after:
            skipped.append(rule)
        elif rule.classed and not _in_setting(text, start, end, class_rule):
            skipped.append(rule)
            free = end
        else:
            taken.append((start, rule))
            free = end
    return taken, skipped


def _in_setting(text: str, start: int, end: int, rule: ClassRule) -> bool:
    head = end + 1 if text[end : end + 1] and text[end] in rule.particles else end
    before, follows = text[start - 1 : start] if start else "", text[head : head + 1]
    return bool(before and before in rule.before) or bool(follows and follows in rule.heads)


def tally(rules: list[Rule]) -> list[dict]:
    counts: dict[str, int] = {}
    for rule in rules:
        counts[rule.becomes] = counts.get(rule.becomes, 0) + 1
    return [{"canonical": c, "n": n} for c, n in sorted(counts.items())]


_COUNTS = ArrayType(StructType([StructField("canonical", StringType()), StructField("n", LongType())]))
REPLACED = StructType([StructField("text", StringType()), StructField("hits", _COUNTS), StructField("skipped", _COUNTS)])


def replacer(spark: SparkSession, terms: list[tuple[str, list[str]]], guards: dict[str, tuple[str, str]] | None = None, class_rule: ClassRule | None = None):
    """A pandas UDF: text -> (text with canonical forms, hits and guarded skips by canonical)."""
    shared = spark.sparkContext.broadcast(automaton_of(rules_of(terms, guards, class_rule)))

    @F.pandas_udf(REPLACED)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = pickle.loads(shared.value)
        for texts in parts:
            out = []
            for t in texts:
                taken, skipped = hits(automaton, t or "", class_rule)
                pieces, at = [], 0
                for start, rule in taken:
                    pieces += [t[at:start], rule.becomes]
                    at = start + rule.size
                out.append((None if t is None else "".join([*pieces, t[at:]]), tally([r for _, r in taken]), tally(skipped)))
            yield pd.DataFrame(out, columns=["text", "hits", "skipped"])

    return run


def cleaned(blocks: DataFrame, terms: list[tuple[str, list[str]]], guards: dict[str, tuple[str, str]] | None = None, text_col: str = "text", class_rule: ClassRule | None = None) -> DataFrame:
    """blocks with canonical forms in the text, and the hits and guarded skips of each canonical."""
    done = replacer(blocks.sparkSession, terms, guards, class_rule)(F.col(text_col))
    return bounded(blocks).withColumn("_r", done).withColumn(text_col, F.col("_r.text")).withColumns({"hits": F.col("_r.hits"), "skipped": F.col("_r.skipped")}).drop("_r")


def hit_counts(done: DataFrame, key: str) -> DataFrame:
    """(key, canonical, n, skipped): replacements and guarded skips of cleaned blocks, added up by key."""
    none = F.lit(0).cast("long")
    both = F.concat(
        F.transform("hits", lambda h: F.struct(h["canonical"].alias("canonical"), h["n"].alias("n"), none.alias("skipped"))),
        F.transform("skipped", lambda h: F.struct(h["canonical"].alias("canonical"), none.alias("n"), h["n"].alias("skipped"))),
    )
    return done.select(key, F.explode(both).alias("h")).groupBy(key, "h.canonical").agg(F.sum("h.n").alias("n"), F.sum("h.skipped").alias("skipped"))


def first_contexts(forms: DataFrame, texts: DataFrame, form_col: str, order_col: str, text_col: str, width: int = V.CONTEXT) -> DataFrame:
    """(form, order, context): each form with its surroundings in the first text, by order, that holds it.

    Forms are taken a lot at a time (the driver holds no more); each lot is one automaton and one reading of the
    texts, in which a task keeps each form's first text and its first place there. Forms that no text holds have no row.
    """
    spark, out = texts.sparkSession, None
    kind = texts.schema[order_col].dataType.simpleString()
    schema = f"{form_col} string, {order_col} {kind}, context string"
    kept = to_arrow_type(texts.schema[order_col].dataType)
    rows = bounded(texts.filter(F.col(text_col).isNotNull()).select(order_col, text_col))
    lot: list[str] = []

    def looked_up(lot: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast(automaton_of({f: Rule(len(f), None, frozenset(), frozenset(), False) for f in lot}))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton, first = pickle.loads(shared.value), {}
            for batch in batches:
                for at, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    text, seen, place = text.as_py(), {}, (at is not None, at)
                    for end, rule in automaton.iter(text):
                        seen.setdefault(text[end + 1 - rule.size : end + 1], end + 1 - rule.size)
                    for form, start in seen.items():
                        known = first.get(form)
                        if known is None or place <= known[0]:
                            piece = text[max(0, start - width) : start + len(form) + width].replace("\n", " ")
                            found = place, f"…{piece}…"
                            first[form] = found if known is None else min(known, found)
            columns = list(first), [p[1] for p, _ in first.values()], [c for _, c in first.values()]
            types = pa.string(), kept, pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[form_col, order_col, "context"])

        return rows.mapInArrow(look, schema)

    for row in forms.select(form_col).filter(F.col(form_col) != "").distinct().toLocalIterator():
        lot.append(row[0])
        if len(lot) == LOT:
            out = looked_up(lot) if out is None else out.unionAll(looked_up(lot))
            lot = []
    if lot:
        out = looked_up(lot) if out is None else out.unionAll(looked_up(lot))
    if out is None:
        return spark.createDataFrame([], schema)
    return out.groupBy(form_col).agg(F.min(F.struct(order_col, "context")).alias("m")).select(form_col, f"m.{order_col}", "m.context")


def enriched(candidates: DataFrame, texts: DataFrame, order_col: str, text_col: str, kind: str = "kind") -> DataFrame:
    """Candidate pairs (kind, a, b, na) with both forms' contexts and what is suggested.

    An anchored pair's a comes from the dictionary: its context says so, and its na is the number of texts.
    """
    is_anchor = F.col(kind) == V.ANCHORED
    asked = candidates.select(F.col("b").alias("form")).unionAll(candidates.filter(~is_anchor).select(F.col("a").alias("form")))
    found = stored(first_contexts(asked, texts, "form", order_col, text_col).select("form", "context"))
    out = candidates
    for side in "ab":
        out = out.join(found.select(F.col("form").alias(side), F.col("context").alias(f"ctx_{side}")), side, "left")
    own = F.concat(F.lit("(词典 canonical:"), F.col("a"), F.lit(")"))
    return out.withColumns({
        "na": F.when(is_anchor, F.lit(texts.count())).otherwise(F.col("na")).cast("long"),
        "ctx_a": F.when(is_anchor, own).otherwise(F.coalesce("ctx_a", F.lit(""))),
        "ctx_b": F.coalesce("ctx_b", F.lit("")),
        "suggest": F.when(is_anchor, V.SUGGEST[0]).otherwise(V.SUGGEST[1]),
    })

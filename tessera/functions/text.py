"""Text scalars: normalising, character grams, contexts, time marks, tolerant JSON.

Offsets are 0-based counts of code points throughout, as SQL's substr is 1-based only inside.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: Unicode white space in Java's regular expressions (plain \s is ASCII there).
SPACE = "(?U)\\s"
#: Fixed value: a run of unified ideographs.
CJK_RUN = "[\\u4e00-\\u9fff]{2,}"
#: Fixed value: a time mark as handouts write it.
TIME_MARK = "【(\\d{2}):(\\d{2}):(\\d{2})】"


def squeeze(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, f"{SPACE}+", "")


def blank(text: Column) -> Column:
    return squeeze(F.coalesce(text, F.lit(""))) == ""


def _longer(grams: Column, chars: Column, size: int) -> Column:
    """Grams of one character more: each with the character after it. Linear in the text, where
    cutting every gram out of the text by its place is not."""
    return F.array_compact(F.zip_with(grams, F.slice(chars, size, 1 << 30), lambda g, c: F.concat(g, c)))


def char_grams(text: Column, size: int) -> Column:
    """All grams of so many characters, with repeats; none if the text is shorter."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    out = chars
    for k in range(2, size + 1):
        out = _longer(out, chars, k)
    return out


def gram_list(text: Column, size: int = 2) -> Column:
    """All character grams of the squeezed text with repeats; a shorter text is its own gram."""
    t = squeeze(text)
    return F.when(F.length(t) < size, F.array(t)).otherwise(char_grams(t, size))


def gram_set(text: Column) -> Column:
    """Distinct character pairs whose second character is no white space; nothing is squeezed."""
    return F.array_distinct(F.filter(char_grams(text, 2), lambda p: ~F.substr(p, F.lit(2), F.lit(1)).rlike(SPACE)))


def word_grams(text: Column, low: int, high: int, run: str = CJK_RUN) -> Column:
    """All grams of low to high characters inside the runs that match the pattern, with repeats."""

    def of_run(r):
        chars = F.filter(F.split(r, ""), lambda c: c != "")
        out, sizes = chars, []
        for k in range(1, high + 1):
            out = out if k == 1 else _longer(out, chars, k)
            if k >= low:
                sizes.append(out)
        return F.concat(*sizes)

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(f"({run})"), 1), of_run))


def letter_key(text: Column, table: dict[str, str] | None = None) -> Column:
    """Key per character joined by spaces: equal keys sound alike.

    table maps characters to their sounds (others to nothing). Without one, Latin text gets its
    Soundex code, a stand-in for scripts without a table.
    """
    if table is None:
        return F.soundex(text)
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv]) if table else F.create_map().cast("map<string,string>")
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.element_at(pairs, c), F.lit(""))), " ")


def context(text: Column, needle: Column, width: int = 22) -> Column:
    """The first occurrence with `width` characters on both sides; empty where there is none."""
    at = F.instr(text, needle) - 1
    start = F.greatest(at - width, F.lit(0))
    piece = F.substr(text, start + 1, at - start + F.length(needle) + width)
    return F.when(at < 0, F.lit("")).otherwise(F.concat(F.lit("…"), F.translate(piece, "\n", " "), F.lit("…")))


def occurrences(text: Column, needle: str) -> Column:
    """Number of occurrences of a literal, not overlapping."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def overlapping(text: Column, needle: Column) -> Column:
    """Number of occurrences of a literal, overlaps counted: places that it can begin at."""
    literal = F.replace(needle, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))  # what would end the quotation is quoted by itself
    ahead = F.concat(F.lit("(?=\\Q"), literal, F.lit("\\E)"))
    return F.when(F.length(needle) == 0, F.lit(0)).otherwise(F.regexp_count(text, ahead))


def hms(seconds: Column) -> Column:
    """Seconds as HH:MM:SS, cut to whole seconds."""
    s = F.floor(seconds)
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def from_hms(text: Column) -> Column:
    part = F.split(text, ":")
    return F.element_at(part, 1).cast("long") * 3600 + F.element_at(part, 2).cast("long") * 60 + F.element_at(part, 3).cast("long")


def minutes(seconds: Column) -> Column:
    """Seconds as minutes and seconds, e.g. 3m05s; a dash where unknown."""
    s = F.floor(seconds)
    return F.coalesce(F.concat(F.floor(s / 60).cast("string"), F.lit("m"), F.format_string("%02d", s % 60), F.lit("s")), F.lit("-"))


def time_marks(text: Column) -> Column:
    """Seconds of all time marks of a text."""
    return F.transform(F.regexp_extract_all(text, F.lit(TIME_MARK), 0), lambda m: from_hms(F.translate(m, "【】", "")))


def plain_number(value: Column, digits: int = 1) -> Column:
    """A number with so many decimals at most and no trailing zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits}f", value), "0+$", ""), "\\.$", "")


def table_cell(text: Column) -> Column:
    """Safe inside a Markdown table."""
    return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def without_fence(text: Column) -> Column:
    """Without a code fence around it."""
    t = F.btrim(text, F.lit(" \n\t\r"))
    inner = F.regexp_replace(F.regexp_replace(t, "^```[A-Za-z]*\n?", ""), "\n?```$", "")
    return F.when(F.startswith(t, F.lit("```")), F.btrim(inner, F.lit(" \n\t\r"))).otherwise(t)


def model_family(model: Column) -> Column:
    """A model's name up to the first square bracket."""
    return F.substring_index(F.coalesce(model, F.lit("")), "[", 1)


def ordinal_title(text: Column) -> Column:
    """Does a title (in compatibility form) begin with an ordinal lesson number?"""
    return nfkc(text).rlike("^第[一二三四五六七八九十百0-9]+课")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no built-in for it."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


#: What matters to the scan for brackets: strings' ends and escapes, and the brackets themselves.
_MARKS = re.compile(r'\\.|["\[\]{}]', re.S)
_CLOSES = {"]": "[", "}": "{"}


def balanced(text: str) -> list[tuple[int, int]]:
    """(start, end) of every stretch from a bracket to the one that closes it, by their starts.

    Brackets in strings do not count, and strings only begin inside of brackets; a closing bracket takes
    the nearest open one of its kind, and what was opened in between stays open for good.
    """
    out, open_, quoted = [], [], False
    for m in _MARKS.finditer(text):
        mark = m.group()
        if mark == '"':
            quoted = bool(open_) and not quoted
        elif quoted or mark[0] == "\\":
            continue
        elif mark in "[{":
            open_.append((mark, m.start()))
        elif any(mark_ == _CLOSES[mark] for mark_, _ in open_):
            while open_[-1][0] != _CLOSES[mark]:
                open_.pop()
            out.append((open_.pop()[1], m.end()))
    return sorted(out)


def parsed(text: str | None) -> Iterator[tuple[int, int, object]]:
    """(start, end, value) of the balanced stretches of a reply that are JSON."""
    for start, end in balanced(text or ""):
        try:
            yield start, end, json.loads(text[start:end])
        except ValueError:
            pass


def parse_first(text: str | None):
    """The first JSON list or object of a reply, whatever stands around it; None if there is none."""
    return next((value for *_, value in parsed(text)), None)


def parse_every(text: str | None) -> list:
    """All JSON lists and objects of a reply, also those inside others; lists give their elements."""
    return [v for *_, value in parsed(text) for v in (value if isinstance(value, list) else [value])]


@F.pandas_udf(StringType())
def first_json(texts: pd.Series) -> pd.Series:
    """parse_first as canonical JSON text, null where nothing parses."""
    return texts.map(lambda t: None if (v := parse_first(t)) is None else json.dumps(v, ensure_ascii=False, sort_keys=True))


@F.pandas_udf(ArrayType(StringType()))
def every_json(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [json.dumps(v, ensure_ascii=False, sort_keys=True) for v in parse_every(t)])


HITS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("fragment", StringType())]))


def hits(pattern: str):
    """A pandas UDF that lists all matches of a pattern with their offsets."""
    found = re.compile(pattern)

    @F.pandas_udf(HITS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: [{"start": m.start(), "end": m.end(), "fragment": m.group(0)} for m in found.finditer(t or "")])

    return run


def normal_title(text: Column) -> Column:
    """Lower-cased letters, digits and ideographs alone: the key under which titles are one."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", "")


def similarity(a: Column, b: Column) -> Column:
    """Dice coefficient of two titles' distinct character pairs (0 to 1); equal titles are 1."""
    x, y = (F.array_distinct(gram_list(normal_title(t))) for t in (a, b))
    dice = F.try_divide(2.0 * F.size(F.array_intersect(x, y)), F.size(x) + F.size(y))
    empty = (normal_title(a) == "") | (normal_title(b) == "")
    return F.when(empty, F.lit(0.0)).otherwise(F.round(dice, 6))

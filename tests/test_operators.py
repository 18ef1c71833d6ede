"""Operators on small frames with results worked out by hand, and folds against brute force."""

import json
import random
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions import vectors
from tessera.functions import vocabulary as V
from tessera.operators import cards, frames, ledger, quiz, reconcile, relational, replacement, retrieval, terms
from tessera.plans import checks, providers, run
from tessera.sources import readers, schemas, sinks


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(("length", "want"), [(0, []), (499, [(0, 499)]), (500, [(0, 500), (400, 100)]), (900, [(0, 500), (400, 500), (800, 100)])])
def test_fixed_windows(spark, length, want):
    got = one(spark, retrieval.fixed_windows(F.col("t")), t="x" * length)
    assert [(p.start, len(p.piece)) for p in got] == want


def groups(spark, f, rows):
    df = spark.createDataFrame([("c", i, s, n) for i, (s, n) in enumerate(rows)], "k string, o long, speaker string, n long")
    return [r.group_no for r in f(df, "k", "o", "n").orderBy("o").collect()]


def test_block_folds(spark):
    assert groups(spark, retrieval.semantic_groups, [("1", 299), ("2", 10), ("1", 10)]) == [0, 0, 1]
    assert groups(spark, retrieval.semantic_groups, [("1", 699), ("1", 5), ("1", 5)]) == [0, 0, 1]
    assert groups(spark, retrieval.packed_segments, [("1", 3000), ("1", 1000), ("1", 1)]) == [0, 0, 1]


def test_round_robin_shifts_when_a_type_runs_dry(spark):
    rows = [("A", 1), ("B", 1), ("B", 2), ("B", 3), ("C", 1), ("C", 2), ("C", 3)]
    df = spark.createDataFrame([("c", i, t, f"{t}{n}") for i, (t, n) in enumerate(rows)], "k string, o long, type string, name string")
    got = cards.round_robin(df, "k", "o", "type", types=["A", "B", "C"]).orderBy("pick_no").collect()
    assert [r.name for r in got] == ["A1", "B1", "C1", "C2", "B2", "C3", "B3"]
    assert cards.round_robin(df, "k", "o", "type", most=2, types=["A", "B", "C"]).count() == 2


def test_containment_and_hash_dedup(spark):
    df = spark.createDataFrame([("c", i, q) for i, q in enumerate(["ab cd", "bc", "xabcdx", "yz"])], "k string, o long, q string")
    assert [r.q for r in cards.drop_contained(df, "k", "o", "q").orderBy("o").collect()] == ["ab cd", "yz"]
    hashes = [0, 0b111111, 0b1111111, (1 << 63)]
    df = spark.createDataFrame([("c", i, f"{h:016x}") for i, h in enumerate(hashes)], "k string, o long, h string")
    assert [r.o for r in frames.distinct_frames(df, "k", "o", "h").orderBy("o").collect()] == [0, 2]


def test_greedy_pairs_like_brute_force(spark):
    r = random.Random(1)
    rows = [(a, b, round(r.random(), 1)) for a in range(25) for b in range(20) if r.random() < 0.5]
    df = spark.createDataFrame(rows, "l long, r long, s double")
    taken, left, right = [], set(), set()
    for a, b, s in sorted(rows, key=lambda x: (-x[2], x[0], x[1])):
        if s >= 0.4 and a not in left and b not in right:
            taken.append((a, b, s))
            left.add(a)
            right.add(b)
    assert sorted(map(tuple, relational.greedy_pairs(df, "l", "r", "s", 0.4).collect())) == sorted(taken)
    assert relational.greedy_pairs(df.limit(0), "l", "r", "s", 0.4).count() == 0


def test_text_scalars(spark):
    t = lambda c, v: one(spark, c, t=v)
    c = F.col("t")
    assert t(X.gram_list(c), "a b") == ["ab"] and t(X.gram_list(c), "a") == ["a"] and t(X.gram_set(c), "a b") == [" b"]
    assert t(X.squeeze(c), "a　b\n c") == "abc"
    assert t(X.hms(F.lit(3725.9)), "") == "01:02:05" and t(X.minutes(F.lit(185)), "") == "3m05s" and t(X.plain_number(F.lit(22.50)), "") == "22.5"
    assert t(X.time_marks(c), "a【00:01:35】b【01:00:00】") == [95, 3600]
    assert t(X.without_fence(c), "```json\n{}\n```") == "{}" and t(X.model_family(c), "m[x]") == "m"
    assert t(X.overlapping(c, F.lit("aa")), "aaaa") == 3 and t(X.occurrences(c, "aa"), "aaaa") == 2
    assert t(X.context(c, F.lit("x"), 2), "abc\nxdef") == "…c xde…" and t(X.context(c, F.lit("q")), "abc") == ""
    assert t(X.ordinal_title(c), "第１２课 x") is True and t(X.ordinal_title(c), "关于第一课") is False
    assert t(X.word_grams(c, 2, 3), "一二三x四五") == ["一二", "二三", "一二三", "四五"]
    assert t(X.letter_key(c, {"一": "yi", "二": "er"}), "一二x") == "yi er "
    assert t(X.similarity(c, F.lit("Red ring")), "red RING") == 1.0 and t(X.similarity(c, F.lit("")), "x") == 0.0
    assert t(X.table_cell(c), "a|b\nc") == "a\\|b c"
    assert json.loads(t(X.first_json(c), 'ok: [{"a": 1}] }')) == [{"a": 1}]
    assert X.parse_every('x {"a": [1]} y') == [{"a": [1]}, 1]
    assert [h.start for h in t(X.hits(r"\d+")(c), "a1b22")] == [1, 3]


def test_vectors(spark):
    assert one(spark, vectors.hamming(F.lit("8000000000000001"), F.lit("0000000000000000"))) == 2
    pixels = list(range(9)) * 8
    assert one(spark, vectors.difference_hash(F.array(*map(F.lit, pixels)))) == "0" * 16
    assert one(spark, vectors.difference_hash(F.array(*map(F.lit, [9 - p for p in pixels])))) == "f" * 16
    assert abs(one(spark, vectors.dot(vectors.unit(F.array(F.lit(3.0), F.lit(4.0))), F.array(F.lit(3.0), F.lit(4.0)))) - 5) < 1e-6


def test_card_rules(spark):
    text, quote = "Speaker one said: the quick  brown fox jumps over the lazy dog today", "thequick brown fox jumps over thelazy dog"
    at = one(spark, cards.located(F.col("t"), F.col("q")), t=text, q=quote)
    assert text[at.start : at.end] == "the quick  brown fox jumps over the lazy dog"
    assert one(spark, cards.located(F.col("t"), F.col("q")), t=text, q="cat") is None and one(spark, cards.located(F.col("t"), F.col("q")), t=text, q=" ") is None
    reason = lambda **v: one(spark, cards.reject_reason(F.col("k"), F.col("c"), F.col("s"), F.lit(v.pop("b", True))), **v)
    good = {"k": "事实", "c": "long enough", "s": "x" * 30}
    assert reason(**good) is None and reason(**{**good, "k": "?"}) == "bad_type" and reason(**{**good, "c": "short"}) == "bad_content"
    assert reason(**{**good, "s": None}) == "quote_not_found" and reason(**{**good, "s": "Speaker" * 9}) == "quote_has_header"
    assert reason(**{**good, "s": "x" * 29}) == "quote_length" and reason(b=False, **good) == "block_not_found"
    blocks = spark.createDataFrame([("c", 0, 0.0, 4), ("c", 1, 10.0, 10), ("c", 2, 20.0, 100)], "course_id string, block_idx long, start_sec double, n_chars long")
    assert [(r.text_start, r.text_end, r.end_sec) for r in cards.block_spans(blocks).orderBy("block_idx").collect()] == [(0, 4, 10.0), (4, 14, 20.0), (14, 114, 40.0)]


def test_similar_pairs_like_brute_force(spark):
    r = random.Random(2)
    rows = [(i, i % 3, "".join(r.choice("abcd ") for _ in range(r.randint(0, 25)))) for i in range(60)]
    grams = {i: {t[k : k + 2] for k in range(len(t) - 1) if not t[k + 1].isspace()} for i, _, t in rows}
    want = sorted((a, b, len(grams[a] & grams[b])) for a, ga, _ in rows for b, gb, _ in rows if a < b and ga != gb and len(grams[a] & grams[b]) >= 6 and len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.5)
    got = cards.similar_pairs(spark.createDataFrame(rows, "i long, g long, t string"), "i", "g", "t", least=0.5)
    assert sorted((r.a, r.b, r.inter) for r in got.collect()) == want


def test_similar_pairs_in_stripes_and_tiles(spark, monkeypatch):
    """Pairs are the same however cards are cut: several stripes, tiles and lots of grams; nulls and an empty table."""
    r = random.Random(5)
    rows = [(f"i{i:03d}", None if i % 40 == 7 else f"g{i % 3}", None if i % 40 == 9 else "".join(r.choice("abcdé𝄞 ") for _ in range(r.randint(0, 40)))) for i in range(150)]
    rows.append((None, "g1", "abcabcabcabcabcd"))
    grams = {i: {t[k : k + 2] for k in range(len(t or "") - 1) if not t[k + 1].isspace()} for i, _, t in rows}
    kept = [(i, g) for i, g, _ in rows if i is not None and g is not None]
    want = sorted((a, b, len(grams[a] & grams[b])) for a, ga in kept for b, gb in kept if a < b and ga != gb and len(grams[a] & grams[b]) >= 6 and len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.5)
    df = spark.createDataFrame(rows, "i string, g string, t string")
    assert len(want) > 20 and sorted((x.a, x.b, x.inter) for x in cards.similar_pairs(df, "i", "g", "t", least=0.5, stripe=40).collect()) == want
    assert cards.similar_pairs(df.limit(0), "i", "g", "t").collect() == []
    monkeypatch.setattr(cards, "PAIR_TILE", 16)
    monkeypatch.setattr(cards, "PAIR_GRAMS", 5)
    number = {g: k for k, g in enumerate(sorted(set().union(*grams.values())))}
    sets = [sorted(number[x] for x in grams[i]) for i, _ in kept]
    one = pa.RecordBatch.from_arrays([pa.array([0] * len(kept)), pa.array([0] * len(kept)), pa.array(["a"] * len(kept)), pa.array([i for i, _ in kept]), pa.array([g for _, g in kept]), pa.array(sets, pa.list_(pa.int64()))], names=["stripe_a", "stripe_b", "side", "id", "g", "s"])
    got = [x for batch in cards._like(6, 0.5)([one.slice(0, 50), one.slice(50)]) for x in batch.to_pylist()]
    assert sorted((*sorted((x["x"], x["y"])), x["inter"]) for x in got) == want


def test_similar_pairs_deal_out_cards_once(spark, shuffled):
    """What is dealt out does not grow with the number of stripes, and pairs are the same: with small and large tiles, and cards of the same text."""
    r = random.Random(8)
    rows = [(i, i % 50, "".join(r.choice("abcdefghij ") for _ in range(r.randint(20, 90)))) for i in range(390)] + [(i, i, "the same words for all of these") for i in range(390, 400)]
    df, got = spark.createDataFrame(rows, "i long, g long, t string"), {}
    pairs = lambda stripe: sorted(map(tuple, cards.similar_pairs(df, "i", "g", "t", 6, 0.25, stripe=stripe).collect()))
    one, many = (shuffled(lambda s=s: got.update({s: pairs(s)})) for s in (400, 50))
    assert len(got[400]) > 45 and got[400] == got[50] and many < 3 * one


def test_tiles_hold_their_cards_in_order(monkeypatch):
    """Tiles are full or end with their grams; cards without grams are left out, and what is packed comes back."""
    cut = cards._packed(3)
    n = [0, 1, 1, 1, 1, 2, 2]
    rows = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["g"] * 7), pa.array([list(range(k)) for k in n], pa.list_(pa.int64())), pa.array(n, pa.int32())], names=["id", "g", "s", "n"])
    monkeypatch.setattr(cards, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 1)))
    tiles = [x for batch in cut([rows.slice(0, 3), rows.slice(3)]) for x in batch.to_pylist()]
    assert [(x["tile"] - (1 << 32), x["low"], x["high"]) for x in tiles] == [(0, 1, 1), (1, 1, 2)]
    pair = pa.RecordBatch.from_arrays([pa.array([x[k] for x in (tiles[0], tiles[0])]) for k in ("tile", "cards")] + [pa.array([x[k] for x in tiles]) for k in ("tile", "cards")], names=["tile_a", "cards_a", "tile_b", "cards_b"])
    assert [(x["side"], x["id"], len(x["s"])) for b in cards._unpacked([pair]) for x in b.to_pylist()] == [("a", 1, 1), ("a", 2, 1), ("a", 3, 1)] * 2 + [("b", 4, 1), ("b", 5, 2), ("b", 6, 2)]


def test_guarded_replacement(spark):
    rules = [("合学", ["和学", "核学"]), ("咬合平面", []), ("颌平面", ["合平面"]), ("Ⅱ类", ["二类"])]
    f = replacement.replacer(spark, rules, {"和学": ("究", "")}, replacement.ClassRule("^[一二三]类$", "偏氏", "骨高"))
    got = lambda t: one(spark, f(F.col("t")), t=t)
    r = got("和学研究和学,咬合平面与合平面")
    assert r.text == "合学研究和学,咬合平面与颌平面" and {h.canonical: h.n for h in r.hits} == {"合学": 1, "颌平面": 1}
    assert [(h.canonical, h.n) for h in r.skipped] == [("合学", 1)] and [(h.canonical, h.n) for h in got("第二类问题").skipped] == [("Ⅱ类", 1)]
    assert got("第二类问题").text == "第二类问题" and got("安氏二类").text == "安氏Ⅱ类" and got("二类的骨型").text == "Ⅱ类的骨型"
    again = got(r.text)
    assert again.text == r.text and not again.hits


def test_fixes(spark):
    text = "疗程 3个月,距离 13个月,牙弓宽度3个月"
    at = lambda t, f, x: one(spark, terms.best_place(F.col("t"), F.col("f"), F.col("x")), t=t, f=f, x=x)
    assert at(text, "3个月", "…牙弓宽度3个月…") == text.rindex("3个月")
    assert at("共13个月", "3个月", "") is None and at("无", "3个月", "") is None and at("abc", "", "") is None
    assert at("3个月,3个月", "3个月", "") == 0 and at("a\\Eb a\\Eb", "\\Eb", "zz") == 1
    df = spark.createDataFrame([(text, "3个月", "3毫米", "…牙弓宽度3个月…")], "t string, f string, c string, x string")
    r = terms.fragment_fixes(df, "t", "f", "c", "x").first()
    assert r.fixed and r.t.endswith("牙弓宽度3毫米")
    spans = F.array(F.struct(F.lit(0).alias("start"), F.lit(1).alias("end"), F.lit("XX").alias("new")), F.struct(F.lit(3).alias("start"), F.lit(4).alias("end"), F.lit("").alias("new")))
    assert one(spark, terms.placed(F.col("t"), spans), t="abcdef") == "XXbcef"
    assert one(spark, terms.migrated(F.col("t"), {"ab": "x", "abc": "y"}, ("q", "z")), t="abcabq") == "yxz"


def test_cross_check(spark):
    pairs = spark.createDataFrame([("a", "b", 0.9)], "a string, b string, score double")
    grams = spark.createDataFrame([("a", "aa", "k", 2), ("b", "ab", "k", 2), ("b", "ac", "k", 2), ("b", "zz", "q", 2)], "id string, gram string, key string, n long")
    texts = spark.createDataFrame([("a", "aa"), ("b", "ab ac zz")], "id string, text string")
    known = spark.createDataFrame([("aa", "ac")], "canonical string, variant string")
    assert [(r.form_a, r.form_b) for r in terms.cross_check(pairs, grams, texts, known).collect()] == [("aa", "ab")]
    courses = spark.createDataFrame([("a", 1, "x", "red ring one"), ("b", 2, "y", "red ring two"), ("c", 3, "x", "red ring one")], "id string, ord long, camp string, title string")
    assert {(r.a, r.b) for r in terms.unlike_pairs(courses).collect()} == {("a", "b"), ("b", "c")}


def test_handouts_and_merging(spark):
    known = spark.createDataFrame([("c", 100.0)], "course_id string, start_sec double")
    pages = [("c", "x" * 500 + "【00:01:35】【00:01:45】【00:01:40】", None), ("c", "x" * 500 + "【00:01:34】【00:01:45】【00:01:40】", "stray_mark"), ("c", "short", "too_short"), ("c", "x" * 500 + "【00:01:40】", "few_marks"), ("c", None, "too_short")]
    for course, text, want in pages:
        df = spark.createDataFrame([(course, text)], "course_id string, markdown string")
        assert quiz.handout_error(df, known).first().error == want
    q = "course_id string, pos long, stem string"
    first, second = spark.createDataFrame([("c", 1, "a")], q), spark.createDataFrame([("c", 1, "b"), ("c", 2, "a")], q)
    assert sorted((r.stem, r.pos) for r in quiz.merged_by_stem(first, second).collect()) == [("a", 1), ("b", 1)]
    assert one(spark, quiz.noted(F.col("n"), F.array(F.lit(V.NO_SOURCE))), n="n") == "n;" + V.NO_SOURCE_NOTE
    t = quiz.totals(spark.createDataFrame([("a", 3, 0.5, None), ("b", 2, 0.9, "x")], "course_id string, questions long, coverage double, error string")).first()
    assert (t.courses, t.questions, t.coverage) == (2, 3, 0.5)


def test_as_of_like_brute_force(spark):
    r = random.Random(3)
    left = [(r.randint(0, 2), i, r.randint(0, 20)) for i in range(40)]
    right = [(r.randint(0, 2), r.randint(0, 20), i) for i in range(15)]
    got = relational.as_of(spark.createDataFrame(left, "k long, i long, t long"), spark.createDataFrame(right, "k long, s long, v long"), ["k"], "t", "s", ["v"])
    for row in got.collect():
        fits = [(s, v) for k, s, v in right if k == row.k and s <= row.t]
        assert (row.s, row.v) == (max(fits) if fits else (None, None))
    assert got.count() == 40


def test_transcripts_and_sources(spark, tmp_path):
    raw = "Keywords: a\nSpeaker 1 00:00:01.500 \nHello\nthere\n\nSpeaker 2 00:01:00.000\nBye\n"
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "c1.txt").write_text(raw)
    (tmp_path / "t" / "c2.txt").write_text("nothing")
    blocks, bad = readers.transcripts(spark, str(tmp_path / "t"))
    assert [(r.course_id, r.block_idx, r.speaker, r.start_sec, r.text) for r in blocks.orderBy("block_idx").collect()] == [("c1", 0, "1", 1.5, "Hello\nthere"), ("c1", 1, "2", 60.0, "Bye")]
    assert [r.course_id for r in bad.collect()] == ["c2"]
    assert one(spark, readers.intro(F.col("t")), t=raw) == "Hello。there。Bye"
    roster = spark.createDataFrame([("c1",), ("c3",)], "id string")
    probe = readers.probed(roster, readers.files(spark, str(tmp_path)), F.concat(F.lit("t/"), "id", F.lit(".txt")), "text")
    assert {r.id: r.text_bytes for r in probe.collect()} == {"c1": len(raw), "c3": None}
    (tmp_path / "c.json").write_text(json.dumps({"terms": [{"canonical": "x", "variants": ["y"]}]}))
    assert readers.config(spark, str(tmp_path / "c.json"), "terms", schemas.TERMS).first().variants == ["y"]
    (tmp_path / "l.jsonl").write_text('{"part": "p", "input_tokens": 3}\n\n')
    assert [r.input_tokens for r in readers.jsonl(spark, str(tmp_path / "l.jsonl"), schemas.LEDGER).collect()] == [3]
    made = []
    for _ in range(2):
        readers.once(spark, str(tmp_path / "snap"), lambda: (made.append(1), roster)[1])
    assert made == [1]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "x|y"), ("a", None)], "id string, note string")
    sinks.report_csv(df, str(tmp_path / "csv"), {"id": "Id", "note": "Note"}, ["id"])
    raw = next((tmp_path / "csv").glob("part-*")).read_bytes().decode()
    assert raw.startswith("﻿Id,Note") and raw.splitlines()[1].startswith("a,")
    lines = [r.line for r in sinks.markdown_table(df, ["id", "note"], ["id"]).orderBy("n").collect()]
    assert lines == ["| id | note |", "|---|---|", "| a |  |", "| b | x\\|y |"]
    text = one(spark, sinks.replace_section(F.col("t"), "## H", F.lit("new")), t="top\n\n## H\n\nold")
    assert text == "top\n\n## H\n\nnew" == one(spark, sinks.replace_section(F.col("t"), "## H", F.lit("new")), t=text)
    sinks.write_text(spark, f"file://{tmp_path}/r.md", "é")
    assert (tmp_path / "r.md").read_text() == "é"
    sinks.json_lines(df, str(tmp_path / "j"), "id")
    sinks.append(df, str(tmp_path / "led"))
    sinks.append(df, str(tmp_path / "led"))
    assert spark.read.json(str(tmp_path / "led")).count() == 4 and spark.read.json(str(tmp_path / "j")).count() == 2
    assert json.loads(df.filter("id = 'a'").select(sinks.compact_json(["id", "note"]).alias("v")).first().v) == {"id": "a"}
    sinks.blocked(spark, str(tmp_path / "blocked"), "s", "no key")
    assert spark.read.json(str(tmp_path / "blocked")).first().status == "BLOCKED"


def test_runs_publish_only_when_checked(spark, tmp_path):
    base = f"file://{tmp_path}"
    steps = [run.Step("a", lambda r: spark.range(3)), run.Step("b", lambda r: r.table("a").filter("id > 0"), ("a",)), run.Step("c", lambda r: r.table("missing"), ()), run.Step("d", lambda r: r.table("c"), ("c",))]
    assert run.listing(steps, "b") == ["b", "c", "d"]
    good = run.execute(run.Run(spark, base, "r1"), steps[:2])
    assert not good.failed and run.publish(good, lambda r: {"empty": checks.at_least(r.table("b"), 2, "rows")}) and run.latest(spark, base) == "r1"
    bad = run.execute(run.Run(spark, base, "r2"), steps)
    assert set(bad.failed) == {"c", "d"} and not run.publish(bad, lambda r: {}) and run.latest(spark, base) == "r1"
    other = run.execute(run.Run(spark, base, "r3"), steps[:2])
    assert not run.publish(other, lambda r: {"empty": checks.at_least(r.table("b"), 5, "rows")}) and run.latest(spark, base) == "r1"


def test_providers(spark):
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise providers.ProviderError(500)
        return 7

    assert providers.with_retry(flaky, wait=0.0) == 7 and len(calls) == 3
    with pytest.raises(providers.ProviderError):
        providers.with_retry(lambda: (_ for _ in ()).throw(providers.ProviderError(404)), wait=0.0)
    assert providers.full_reply(lambda m, p, b: ("r", 1, 1, b < 10000), "m", "p")[0] == "r"
    assert providers.full_reply(lambda m, p, b: ("r", 1, 1, True), "m", "p")[0] == ""
    rows = spark.createDataFrame([("p", "m", "x"), ("p", "m", "y")], "part string, model string, payload string")
    first = providers.ask(rows, providers.Echo())
    again = providers.ask(rows, providers.Echo(), providers.to_file(first.filter("payload = 'x'")))
    assert {r.payload: r.from_cache for r in again.collect()} == {"x": True, "y": False}
    assert providers.ledger_rows(again).filter("cached").count() == 1


def test_streams(spark, tmp_path):
    from tessera.streaming import ledger as stream

    for k, rows in enumerate([[("2024-01-01T00:10:00", 5)], [("2024-01-01T05:00:00", 7)]]):
        (tmp_path / f"{k}.json").write_text("".join(json.dumps({"ts": t, "part": "p", "model": "m[x]", "input_tokens": n, "output_tokens": 0, "cached": False}) + "\n" for t, n in rows))
    prices = spark.createDataFrame([("m", 1e6, 0.0)], "model string, input double, output double")
    out = stream.cost_by_window(stream.ledger_stream(spark, str(tmp_path)), prices)
    q = out.writeStream.outputMode("complete").format("memory").queryName("costs").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.calls, r.cost) for r in spark.table("costs").collect()) == [(1, 5.0), (1, 7.0)]


def test_reconcile_rules(spark):
    status = lambda *v: spark.createDataFrame([v], "ht boolean, hv boolean, v double, m double, ok boolean, s double").select(reconcile.status(*map(F.col, ["ht", "hv", "v", "m", "ok", "s"])).alias("x")).first().x
    assert status(True, True, 95.0, 100.0, True, 1.0) == "OK" and status(True, True, 94.0, 100.0, True, 1.0) == "duration differs"
    assert status(False, False, None, 0.0, False, None) == "no transcript;no video;no match"
    assert one(spark, reconcile.deviation(F.lit(94.0), F.lit(100.0))) == 0.06 and one(spark, reconcile.deviation(F.lit(0.0), F.lit(100.0))) is None
    prices = spark.createDataFrame([("m", 1.0, 2.0)], "model string, input double, output double")
    led = spark.createDataFrame([("p", "m[1]", 1_000_000, 1_000_000, False), ("p", "other", 5, 5, False), ("p", "m[1]", 9, 9, True)], "part string, model string, input_tokens long, output_tokens long, cached boolean")
    r = ledger.cost_by_part(led, prices).first()
    assert (r.calls, r.cached_calls, r.input_tokens, r.cost, r.models) == (2, 1, 1_000_005, 3.0, "m[1]/other")


def test_generate_asks_again_where_it_falls_short(spark):
    schema = "course_id string, pos long, stem string, options map<string,string>, answer string, explanation string, source_card_ids array<string>, distractor_source array<string>, distractor_note string"
    options = {k: f"option {k}" for k in "ABCD"}
    row = lambda c, i, stem, other: (c, i, stem, options, "a", "explained at length", ["k"], other, "note")
    asked = []

    def ask(courses, n):
        asked.append(sorted(r.course_id for r in courses.collect()))
        rows = {1: [row("x", i, f"question {i}", ["k"]) for i in range(3)] + [row("y", 1, "question 1", [V.NO_SOURCE])], 2: [row("y", i, f"question {i}", ["k"]) for i in range(1, 4)]}[n]
        return spark.createDataFrame(rows, schema).filter(F.col("course_id").isin(asked[-1]))

    courses = spark.createDataFrame([("x",), ("y",), ("z",)], "course_id string")
    cards = spark.createDataFrame([(c, "k") for c in "xyz"], "course_id string, card_id string")
    got = sorted((r.course_id, r.pos, r.q_no) for r in quiz.generate(courses, cards, ask).collect())
    assert asked == [["x", "y", "z"], ["y", "z"]]
    assert got == [("x", 0, 1), ("x", 1, 2), ("x", 2, 3), ("y", 1, 3), ("y", 2, 1), ("y", 3, 2)]


def test_mining_stops_and_does_not_ask_twice(spark):
    stats = spark.createDataFrame([("aa", 9, 2), ("ab", 8, 2), ("ac", 3, 1), ("zz", 9, 1)], "gram string, n long, courses long")
    dictionary = spark.createDataFrame([("aa", [], "c", "seed", 0)], "canonical string, variants array<string>, category string, source string, ord long")
    table, asked = {"a": "v", "b": "v", "c": "v", "z": "z"}, []

    def judge(found):
        asked.append(sorted((r.a, r.b) for r in found.collect()))
        return found.select("a", "b", F.when(F.col("b") == "ab", "adopt").otherwise("reject").alias("decision"), F.col("a").alias("canonical"), F.col("b").alias("variant"), F.lit("c").alias("category"))

    out = terms.mined(stats, dictionary, judge, table, ((5, 5, 10), (2, 2, 10)), 100)
    assert {r.canonical: r.variants for r in out.collect()} == {"aa": ["ab"]}
    assert asked[0] == [("aa", "ab")] and ("aa", "ab") not in asked[1] and ("aa", "ac") in asked[1]
    assert terms.mined(stats, dictionary, judge, table, ((5, 5, 10),), 1).count() == 1
    assert terms.term_of(out, "ab") == "aa"
    with pytest.raises(LookupError):
        terms.term_of(out, "none")


def test_master_rows(spark):
    roster = spark.createDataFrame([("c1", "x"), ("c2", "y")], "canonical_id string, camp string")
    camps = spark.createDataFrame([("x", "X", None, None), ("y", "Y", None, None)], schemas.CAMPS)
    goods = spark.createDataFrame([("g1", "49 days", 7, 1.0, 1, 1, "2024-01-01"), ("g2", "lesson", 3, 1.0, 1, 1, "2024-01-02"), ("g3", None, 9, 1.0, 1, 1, None)], schemas.GOODS)
    lives = spark.createDataFrame([("l1", "t", "2024-02-01", None, 1)], schemas.LIVES)
    assert [r.goods_id for r in reconcile.lessons(goods).collect()] == ["g2"] and [r.goods_id for r in reconcile.containers(goods, "49").collect()] == ["g1"]
    pairs = "left string, right string, score double"
    out = reconcile.master_rows(reconcile.with_camp(roster, camps), spark.createDataFrame([("c1", "g2", 0.71234)], pairs), goods, spark.createDataFrame([("c2", "l1", 0.8)], pairs), lives)
    assert sorted((r.canonical_id, r.camp_label, r.goods_name, r.match_score, r.live_at, r.live_match_score) for r in out.collect()) == [("c1", "X", "lesson", 0.712, None, 0.0), ("c2", "Y", None, 0.0, "2024-02-01", 0.8)]

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def want_ids(text):
    return [*LIB.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("text", ["", None, "Hello  world\n\n x", " a", "it's 12 34", "<|endoftext|>x<|endoftext|>", "é日本 　  z\x1c\x1d ", "  ", "a\t\tb", "!!! ??\n", "x" * 3000 + " y", " " * 3000 + "z", "\u1680a \u2009\u202fb\u0085c", "naïve ﬁ 𝔘nicode ½ ²"])
def test_ids_like_the_library(text):
    got = np.frombuffer(packing.loaded(PATH).ids([text])[0], "<u2").tolist()
    assert got == LIB.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abc '.,1\n\t"), st.characters(max_codepoint=0x24FF, exclude_categories=["Cs", "Cn"])), max_size=50))
def test_random_ids_like_the_library(text):
    got = np.frombuffer(packing.loaded(PATH).ids([text])[0], "<u2").tolist()
    assert got == LIB.encode(text, add_special_tokens=False).ids


def whole(rows, docs, sequence):
    """Brute-force check that the pieces hold each id once, and sequences have no gap."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for i, t, *_ in docs:
        want[i].append(want_ids(t))
    for i, texts in want.items():
        if len(texts) > 1:
            assert sum(r["length"] for r in pieces[i]) == sum(map(len, texts))
            continue
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(texts[0])
            assert r["ids_crc32"] == zlib.crc32(np.array(texts[0][at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(texts[0])
    last = max(places, default=-1)
    for s, found in places.items():
        at = 0
        for o, n in sorted(found):
            assert o == at
            at += n
        assert at == sequence or s == last
    assert sorted(places) == list(range(last + 1))


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = packing.op7_packing(spark, sf).collect()
    whole(rows, docs, 2048)


def test_mixture_of_every_window(spark):
    docs = [(i, "word and more " * (5 + i % 7), "a" if i % 3 else "b") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    rows = packing.pack(df, PATH, sequence=64, window=256).collect()
    whole(rows, docs, 64)
    source = {d[0]: d[2] for d in docs}
    share = sum(len(want_ids(t)) for _, t, s in docs if s == "a") / sum(len(want_ids(t)) for _, t, _ in docs)
    by = defaultdict(int)
    for r in rows:
        by[r["sequence_id"] // 4] += r["length"] * (source[r["doc_id"]] == "a")
    for w in range(max(by)):
        assert abs(by[w] - 256 * share) <= 3


def test_targets_hold_until_a_queue_is_dry(spark):
    docs = [(i, "word and more", "a" if i < 300 else "b") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = packing.pack(df, PATH, sequence=32, window=64, targets={"a": 1.0, "b": 1.0}).collect()
    whole(rows, docs, 32)
    by = defaultdict(int)
    for r in rows:
        by[r["sequence_id"] // 2] += r["length"] * (r["doc_id"] >= 300)
    ends = 2 * sum(len(want_ids(t)) for i, t, _ in docs if i >= 300) // 64
    assert all(abs(by[w] - 32) <= 2 for w in range(ends - 1))


def test_a_rare_source_has_its_target_from_the_first_window(spark):
    docs = [(i, "word and more " * 400, "big") for i in range(20)] + [(20, "tiny text", "rare")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = packing.pack(df, PATH, sequence=4, window=8, targets={"rare": 0.5, "big": 0.5}).collect()
    whole(rows, docs, 4)
    tokens = len(want_ids("tiny text"))
    assert tokens * 8 < sum(len(want_ids(t)) for _, t, _ in docs)  # less than a token a window by its share
    by = defaultdict(int)
    for r in rows:
        by[r.sequence_id // 2] += r.length * (r.doc_id == 20)
    assert [by[w] for w in range(-(-tokens // 4))] == [min(4, tokens - 4 * w) for w in range(-(-tokens // 4))]


def test_small_sources_share_a_queue(spark):
    docs = [(i, "word and more " * 100, "big") for i in range(60)] + [(100 + i, "few", f"s{i:02d}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = packing.pack(df, PATH, sequence=64, window=256).collect()
    whole(rows, docs, 64)
    total, small = sum(r.length for r in rows), sum(r.length for r in rows if r.doc_id >= 100)
    assert small // 40 * 256 < total < small * 256
    by = defaultdict(int)
    for r in rows:
        by[r.sequence_id // 4] += r.length * (r.doc_id >= 100)
    assert all(abs(by[w] - 256 * small / total) <= 2 for w in range(max(by)))


def test_targets_of_the_query_hold_while_all_sources_last(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()}
    rows = packing.op7_packing(spark, sf).collect()
    n = defaultdict(int)
    for r in docs.values():
        n[r.source] += len(want_ids(r.text))
    total = sum(n.values())
    share = {s: packing.TARGETS.get(s, n[s] / total) for s in n}
    scale = sum(share.values())
    lasts = int(min(n[s] / share[s] * scale for s in n)) // packing.WINDOW
    by = defaultdict(lambda: defaultdict(int))
    for r in rows:
        by[r.sequence_id // 16][docs[r.doc_id].source] += r.length
    assert lasts > 1
    for w in range(lasts):
        for s in n:
            # each queue may be a token behind, so a window begins up to as many tokens early
            assert abs(by[w][s] - packing.WINDOW * share[s] / scale) <= len(n) + 1


def test_special_inputs(spark, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    docs = [(1, None, None, "x"), (2, "", "s", "x"), (3, "long text " * 30000, "s", "x"), (4, "tie", "t", "x"), (4, "tie", "t", "x"), (5, "tie", "t", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, start string")
    whole(packing.pack(df, PATH, sequence=512, window=1024).collect(), docs, 512)
    assert packing.pack(df.limit(0), PATH).count() == 0
    got = packing.pack(df, PATH, keep_ids=True).filter("doc_id = 2").collect()
    assert [bytes(r.ids) for r in got] == [b"\x01\0\0\0"]

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def check(text):
    own = bpe.loaded(PATH)
    want = LIB.encode(text or "", add_special_tokens=False).ids
    assert own.encode(text) == want
    assert own.encode_texts([text])[0][1] == LIB.decode(want, skip_special_tokens=False)
    assert own.decode(want) == LIB.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", None, " \n\t ", "a", "aaaaaaa", "It's we'll I'D 123 x9", "Été ÉLÈVE naïve ñandú ß", "ΣΑΣ ΟΔΟΣ", "İstanbul",
    "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "<| end |>", "日本語テキスト", "😀😀 fin", "école", "\x1ca\x85b c​d", "mississippi banana " * 200,
    "x" * 5000, "�\u0000z",
])
def test_like_the_library(text):
    check(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdehinorst '.,1"), st.characters(max_codepoint=0x2FF, exclude_categories=["Cs", "Cn"])), max_size=60))
def test_random_texts(text):
    check(text)


def test_every_code_point_is_split_and_lowered_as_by_the_library():
    own, stands = bpe.loaded(PATH), bpe.byte_alphabet()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 10_000):
        text = " ".join(f"a{c}b {c}1 {c}{c}" for c in points[lo : lo + 10_000])
        want = [p for p, _ in LIB.pre_tokenizer.pre_tokenize_str(LIB.normalizer.normalize_str(text))]
        assert ["".join(stands[b] for b in w.encode()) for w in own.words(text)] == want


@pytest.mark.parametrize("c", ["\u0558", "\U00010940", "\u1c89", "\ua7cb", "\U00016ea0", "\U00011de0", "\U00012550"])
def test_code_points_of_newer_tables(c):
    check(f"a{c}b {c}1 {c}{c}")


def test_special_tokens_of_any_spelling(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    for t in spec["added_tokens"]:
        if t["id"] == 49407:
            t["content"] = "[end]"
    for old in [t for t, i in spec["model"]["vocab"].items() if i == 49407]:
        spec["model"]["vocab"]["[end]"] = spec["model"]["vocab"].pop(old)
    (tmp_path / "v.json").write_text(json.dumps(spec))
    own, lib = bpe.PairIndexBPE(str(tmp_path / "v.json")), Tokenizer.from_file(str(tmp_path / "v.json"))
    for text in ("a[end]b <|endoftext|> [END]", "[end]", "<|startoftext|>x"):
        assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_many_words_at_once_and_forgetting(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50)
    own, r = bpe.PairIndexBPE(PATH), random.Random(3)
    texts = [" ".join("".join(r.choice("aeinorst") for _ in range(r.randint(1, 9))) for _ in range(40)) for _ in range(20)]
    for text, (ids, decoded) in zip(texts, own.encode_texts(texts), strict=True):
        want = LIB.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == LIB.decode(want, skip_special_tokens=False)


def test_dataframe(spark):
    rows = [(1, "Hello world", "x"), (2, None, "y"), (2, None, "y"), (3, "", None), (4, "lo " * 9000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, bpe.encode_documents(docs, PATH).collect()))
    want = []
    for i, t, _ in rows:
        e = LIB.encode(t or "", add_special_tokens=False)
        want.append((i, len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIB.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = bpe.op1_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = LIB.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()

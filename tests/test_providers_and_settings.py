import json

import pytest

from tessera.functions import text as X
from tessera.operators import retrieval as T
from tessera.plans import providers as P
from tessera.sources import readers


def test_json_values_of_replies():
    assert X.parse_first('Sure:\n```json\n{"a": [1, "}"]}\n```\nanything else?') == {"a": [1, "}"]}
    assert X.parse_first('see [note] then {"a": "x\\"]"} ]') == {"a": 'x"]'}
    assert X.parse_first("[1, 2") is None and X.parse_first(None) is None and X.parse_first('{"a": }') is None
    assert X.parse_first('{"broken": [1} {"b": 2}') == {"b": 2}
    assert X.parse_every('[{"a": 1}, {"b": [2]}] and {"c": 3}') == [{"a": 1}, {"b": [2]}, {"a": 1}, {"b": [2]}, 2, {"c": 3}]


def test_every_json_column(spark):
    df = spark.createDataFrame([('x {"a": 1} [2]',), (None,)], "t string")
    assert [r[0] for r in df.select(X.every_json("t")).collect()] == [['{"a": 1}', "2"], []]


def test_embeddings_by_index(spark):
    class Flaky(P.HashEmbedder):
        def __call__(self, model, texts):
            if "bad" in texts:
                raise P.ProviderError(400)
            return super().__call__(model, texts)

    rows = [(i, f"text {i}" if i != 13 else "bad") for i in range(23)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    out = {r.id: r for r in P.embed(df, Flaky(), "m", "id", "text").collect()}
    lost = [i for i, r in out.items() if r.embedding is None]
    assert 13 in lost and 0 < len(lost) <= 10 and len(out) == 24
    for i, t in rows:
        if i not in lost:
            assert list(out[i].embedding) == P.HashEmbedder()("m", [t or ""])[0][1] and not out[i].from_cache
    filed = P.embed(df.filter("id < 5"), P.HashEmbedder(), "m", "id", "text")
    again = {r.id: r.from_cache for r in P.embed(df, P.HashEmbedder(), "m", "id", "text", cache=filed).collect()}
    assert {i for i, hit in again.items() if hit} == set(range(5))
    assert P.embed(df.limit(0), P.HashEmbedder(), "m", "id", "text").count() == 0


def test_image_requests_are_asked(spark):
    images = spark.createDataFrame([("a", bytearray(b"\xff\xd8x"))], "frame_id string, content binary")
    rows = P.image_request(images, "m", "what is it?", "content", "label")
    assert json.loads(rows.first().payload) == {"prompt": "what is it?", "image": "data:image/jpeg;base64,/9h4"}
    assert len(P.ask(rows.drop("content"), P.Echo()).first().reply) == 64


def test_outside_programs(spark):
    files = spark.createDataFrame([("1.5",), ("broken",), (None,)], "path string")
    assert sorted((r.path or "", r.secs) for r in P.probed(files, "path", float, "secs").collect()) == [("", None), ("1.5", 1.5), ("broken", None)]
    videos = spark.createDataFrame([("v", "ab"), ("w", "")], "key string, path string")
    out = P.frames_of(videos, "key", "path", lambda p: (c.encode() for c in p)).collect()
    assert sorted((r.key, r.seq, bytes(r.content)) for r in out) == [("v", 1, b"a"), ("v", 2, b"b")]


def test_settings():
    text = "# keys\nA=1\nexport B = 'two'\n\nC\nA=3"
    assert readers.settings(text, {"B": "env", "D": ""}, ["A", "B", "C", "D"]) == {"A": "3", "B": "env", "C": None, "D": None}
    with pytest.raises(LookupError):
        readers.settings(None, {}, ["A"], ("A",))


def test_quotes_of_any_length_have_a_chunk(spark):
    chunks = spark.createDataFrame([(1, "abc def"), (2, "xyz long enough text"), (3, "xyz")], "id long, text string")
    asked = spark.createDataFrame([(1, "xyz"), (2, "f"), (3, ""), (4, "long enough"), (5, "no such text"), (6, None)], "q long, quote string")
    assert sorted((r.q, r.id) for r in T.truth(chunks, asked, "id", "text", "q", "quote").collect()) == [(1, 2), (2, 1), (3, 1), (4, 2)]

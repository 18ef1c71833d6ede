"""Model calls as data: a provider turns request rows into reply rows, and replies are filed.

Real providers are outside of this library; Echo is a deterministic one for tests.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.readers import cache_key, cached

#: Statuses that another attempt does not mend.
FINAL = (400, 401, 403, 404, 422)
BUDGET = (4096, 65536)


class Provider(Protocol):
    def __call__(self, model: str, payload: str, budget: int) -> tuple[str, int, int, bool]:
        """(reply, input tokens, output tokens, cut short)."""


class ProviderError(Exception):
    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


class Echo:
    """Replies with the hash of what it is asked."""

    def __call__(self, model: str, payload: str, budget: int) -> tuple[str, int, int, bool]:
        return hashlib.sha256(f"{model}\n{payload}".encode()).hexdigest(), len(payload), 64, False


def with_retry(call: Callable, tries: int = 4, wait: float = 1.0):
    """Call until it answers; final statuses and the last try raise."""
    for k in range(tries):
        try:
            return call()
        except ProviderError as e:
            if e.status in FINAL or k == tries - 1:
                raise
            time.sleep(wait * 2**k)
    raise AssertionError("unreachable")


def full_reply(provider: Provider, model: str, payload: str, budget: int = BUDGET[0], most: int = BUDGET[1]):
    """A reply that is not cut short: the budget doubles until it suffices."""
    while True:
        reply, used, made, short = with_retry(lambda b=budget: provider(model, payload, b), wait=0.0)
        if not short or budget >= most:
            return ("" if short else reply), used, made
        budget = min(most, budget * 2)


def ask(requests: DataFrame, provider: Provider, cache: DataFrame | None = None) -> DataFrame:
    """requests (part, model, payload, ...) with key, reply, input_tokens, output_tokens, from_cache, failed.

    Filed replies are joined; only the rest is asked, partition by partition. A failed or empty reply is
    not worth filing (failed).
    """
    keyed = requests.withColumn("key", cache_key(F.col("model"), F.col("payload")))
    rows = cached(keyed, cache) if cache is not None else keyed.withColumn("reply", F.lit(None).cast("string")).withColumn("from_cache", F.lit(False))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            out = []
            for hit, reply, model, payload in zip(rows["from_cache"], rows["reply"], rows["model"], rows["payload"], strict=True):
                if hit:
                    out.append((reply, 0, 0, False))
                    continue
                try:
                    text, used, made = full_reply(provider, model, payload)
                    out.append((text, used, made, not text))
                except ProviderError:
                    out.append((None, 0, 0, True))
            yield rows.assign(**dict(zip(("reply", "input_tokens", "output_tokens", "failed"), map(list, zip(*out, strict=True)) if out else [[]] * 4, strict=True)))

    schema = rows.withColumns({"input_tokens": F.lit(0).cast("long"), "output_tokens": F.lit(0).cast("long"), "failed": F.lit(False)}).schema
    return rows.mapInPandas(run, schema)


def to_file(answered: DataFrame) -> DataFrame:
    """(key, reply) of new good replies, for the cache."""
    return answered.filter("not from_cache and not failed").select("key", "reply").dropDuplicates(["key"])


def ledger_rows(answered: DataFrame) -> DataFrame:
    """Ledger entries of answered requests."""
    return answered.select(F.current_timestamp().alias("ts"), "part", "model", "input_tokens", "output_tokens", F.col("from_cache").alias("cached"))


def numbered_prompt(lines: DataFrame, keys: list[str], order: str, line: Column, head: str) -> DataFrame:
    """One request per batch: the head, then its numbered lines in order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.concat(F.col(order).cast("string"), F.lit(". "), line).alias("l"))))
    return lines.groupBy(*keys).agg(F.concat(F.lit(head + "\n"), F.array_join(F.transform(parts, lambda p: p["l"]), "\n")).alias("payload"))


class Embedder(Protocol):
    def __call__(self, model: str, texts: list[str]) -> list[tuple[int, list[float]]]:
        """(index in the batch, vector), in any order."""


class HashEmbedder:
    """Vectors of a text's hash: a deterministic stand-in."""

    def __init__(self, size: int = 8):
        self.size = size

    def __call__(self, model: str, texts: list[str]) -> list[tuple[int, list[float]]]:
        raw = [hashlib.sha256(f"{model}\n{t}".encode()).digest() for t in texts]
        return [(i, [b / 255 for b in r[: self.size]]) for i, r in reversed(list(enumerate(raw)))]


def embed(texts: DataFrame, provider: Embedder, model: str, id_col: str, text_col: str, size: int = 10, cache: DataFrame | None = None) -> DataFrame:
    """id_col, key, embedding, from_cache of texts: filed vectors are joined, the rest is asked in batches of `size`.

    Vectors are put to their texts by the index they come with. A batch that fails, or lacks a text,
    leaves null.
    """
    keyed = texts.select(id_col, F.col(text_col).alias("_text"), cache_key(F.lit(model), F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    filed = cache.select("key", F.col("embedding").alias("_filed")).dropDuplicates(["key"]) if cache is not None else keyed.select("key").limit(0).withColumn("_filed", F.lit(None).cast("array<double>"))
    rows = keyed.join(filed, "key", "left").select(id_col, "key", "_text", "_filed")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            found = [None if v is None else list(v) for v in rows["_filed"]]
            hit = [v is not None for v in found]
            ask_for = [i for i, h in enumerate(hit) if not h]
            for lo in range(0, len(ask_for), size):
                batch = ask_for[lo : lo + size]
                try:
                    got = with_retry(lambda b=batch: provider(model, [rows["_text"].iloc[i] or "" for i in b]), wait=0.0)
                except ProviderError:
                    continue
                for k, vector in got:
                    found[batch[k]] = vector
            yield pd.DataFrame({id_col: rows[id_col], "key": rows["key"], "embedding": found, "from_cache": hit})

    kind = texts.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(run, f"`{id_col}` {kind}, key string, embedding array<double>, from_cache boolean")


def image_request(images: DataFrame, model: str, prompt: str, content: str, part: str) -> DataFrame:
    """images with (part, model, payload): a request that holds the prompt and the image in base64, for ask()."""
    payload = F.to_json(F.struct(F.lit(prompt).alias("prompt"), F.concat(F.lit("data:image/jpeg;base64,"), F.base64(content)).alias("image")))
    return images.withColumns({"part": F.lit(part), "model": F.lit(model), "payload": payload})


def probed(files: DataFrame, path: str, probe: Callable[[str], float | None], name: str) -> DataFrame:
    """files with what an outside program tells of each path (a duration), null where it fails."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            out = []
            for p in rows[path]:
                try:
                    out.append(None if p is None else probe(p))
                except (OSError, ValueError):
                    out.append(None)
            yield rows.assign(**{name: pd.Series(out, dtype="float64", index=rows.index)})

    return files.mapInPandas(run, files.withColumn(name, F.lit(None).cast("double")).schema)


def frames_of(videos: DataFrame, key: str, path: str, extract: Callable[[str], Iterator[bytes]]) -> DataFrame:
    """(key, seq, content): the pictures that an outside program takes from each video, numbered from 1."""
    kind = videos.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            for k, p in zip(rows[key], rows[path], strict=True):
                for seq, content in enumerate(extract(p), 1):  # a picture at a time
                    yield pd.DataFrame({key: [k], "seq": [seq], "content": [content]})

    return videos.select(key, path).mapInPandas(run, f"`{key}` {kind}, seq int, content binary")

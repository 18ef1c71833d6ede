"""Byte-pair encoding and decoding with a pair occurrence index.

Words that a worker has not met before are encoded together. Their symbols form
linked lists in one flat array; an index maps the rank of each mergeable pair to
all positions where it stands. Active ranks leave a heap in ascending order, every
position of a rank is merged, and only the lists of the neighbouring pairs change.
Words are independent, so this gives what merging each word alone gives.

Results for special inputs: a null text counts as empty; empty text has no ids, the
digests of nothing, and decodes to an empty string. A special token's string inside a
text becomes that token's id. Texts of any length are whole; repeated rows give
repeated results. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import bounded


#: White space and word pattern of the vocabulary's normaliser and splitter.
SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Code points that newer Unicode tables call letters or numbers and the tokenizers library does not.
NO_LETTERS = (
    r"\u0558\u058B\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DF1"
    r"\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2\U00016FF3\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
    r"\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24"
    r"\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4\U0001E6E5"
    r"\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
    r"\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
NO_NUMBERS = r"\U00011DE0-\U00011DE9\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016FF4-\U00016FF6"
LETTER, NUMBER = rf"(?:(?![{NO_LETTERS}])\p{{L}})", rf"(?:(?![{NO_NUMBERS}])\p{{N}})"
OTHER = rf"(?:[{NO_LETTERS}{NO_NUMBERS}]|[^{SPACE}\p{{L}}\p{{N}}])"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|{LETTER}+|{NUMBER}|{OTHER}+"
#: The same for texts without the code points that the tables disagree on.
QUICK = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
#: Fixed values: (first, last, distance) of code points that the library lower-cases beyond Python's tables; 0x3C3 for sigma in any place.
LOWER = [
    (0x3A3, 0x3A3, 32), (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27),
]
LOWERED = {c: c + by for a, b, by in LOWER for c in range(a, b + 1)}

#: Words a worker remembers; beyond it the memory starts anew, which changes no result.
MEMORY = 400_000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as itself, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class PairIndexBPE:
    """A vocabulary of words with ends, read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.by_rank = {rank: (a, b, new) for (a, b), (rank, new) in self.merges.items()}
        alphabet = byte_alphabet()
        self.first = [self.vocab.get(c) for c in alphabet]
        self.last = [self.vocab.get(c + self.suffix) for c in alphabet]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern, self.quick = regex.compile(PATTERN), regex.compile(QUICK)
        self.odd = regex.compile(f"[{NO_LETTERS}{NO_NUMBERS}]")
        self.memory: dict[str, tuple[bytes, str]] = {}

    def words(self, text: str) -> list[str]:
        """Normalise and split one text without special tokens."""
        if text.isascii():
            return self.quick.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # capital sigma goes first, so that a final one is no special case
            text = text.translate(LOWERED)
            return (self.pattern if self.odd.search(text) else self.quick).findall(text.lower())
        return self.quick.findall(text.lower())

    def merge_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, by the pair occurrence index over all of them."""
        first, last, merges = self.first, self.last, self.merges
        sym: list[int] = []
        start: list[int] = []
        for w in words:
            start.append(len(sym))
            raw = w.encode("utf-8")
            ids = [first[b] for b in raw[:-1]] + [last[raw[-1]]]
            sym += [i for i in ids if i is not None]
            sym.append(-1)  # ends the word
        n = len(sym)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        occurs: dict[int, list[int]] = {}
        get = merges.get
        a = -1
        for i, b in enumerate(sym):
            if (found := get((a, b))) is not None:
                occurs.setdefault(found[0], []).append(i - 1)
            a = b
        heap = list(occurs)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            positions = occurs.pop(rank, None)
            if positions is None:
                continue
            a, b, new = self.by_rank[rank]
            positions.sort()
            for at, i in enumerate(positions):
                j = nxt[i]
                if sym[i] != a or j >= n or sym[j] != b:
                    continue  # an earlier merge took one of the two
                k = nxt[j]
                sym[i], sym[j] = new, -2
                nxt[i] = k
                if k < n:
                    prv[k] = i
                lower = False
                p = prv[i]
                for left, pair in ((p, (sym[p] if p >= 0 else -1, new)), (i, (new, sym[k] if k < n else -1))):
                    if (found := get(pair)) is not None:
                        r = found[0]
                        lower |= r < rank
                        if r in occurs:
                            occurs[r].append(left)
                        else:
                            occurs[r] = [left]
                            heapq.heappush(heap, r)
                if lower and at + 1 < len(positions):  # a lower rank became active: it goes first
                    if rank in occurs:
                        occurs[rank] += positions[at + 1 :]
                    else:
                        occurs[rank] = positions[at + 1 :]
                        heapq.heappush(heap, rank)
                    break
        out = []
        for s in start:
            ids = []
            i = s
            while sym[i] != -1:
                ids.append(sym[i])
                i = nxt[i]
            out.append(ids)
        return out

    def learn(self, new: list[str]) -> None:
        tokens = self.tokens
        for lo in range(0, len(new), 50_000):
            part = new[lo : lo + 50_000]
            for w, ids in zip(part, self.merge_words(part), strict=True):
                self.memory[w] = (b"".join([i.to_bytes(4, "little") for i in ids]), " ".join([tokens[i] for i in ids]))

    def encode_texts(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """Ids (little-endian unsigned 32-bit) and decoded text of each."""
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif any(x in t for x in self.special):
                found: list = []
                for k, part in enumerate(self.split_special.split(t)):
                    found += [self.special[part]] if k % 2 else self.words(part)
                split.append(found)
            else:
                split.append(self.words(t))
        seen: set = set()
        for s in split:
            seen.update(s)
        if len(self.memory) + len(seen) > MEMORY:
            self.memory.clear()
        self.learn([w for w in seen if w.__class__ is str and w not in self.memory])
        memory = self.memory
        out = []
        for s in split:
            got = [memory[w] if w.__class__ is str else (w.to_bytes(4, "little"), self.tokens[w]) for w in s]
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[1]])))
        return out

    def encode(self, text: str | None) -> list[int]:
        raw = self.encode_texts([text])[0][0]
        return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings joined by a space, as the vocabulary file names no decoder."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@lru_cache(maxsize=2)
def loaded(path: str) -> PairIndexBPE:
    return PairIndexBPE(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode every text of docs.

    Returns id_col, n_tokens, ids_sha256, decoded_sha256 and, if keep_ids, ids
    (binary, little-endian unsigned 32-bit) and decoded.
    """
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields += [("ids", pa.binary()), ("decoded", pa.string())]
        ddl += ", ids binary, decoded string"

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows = bpe.encode_texts(part.column(1).to_pylist())
                cols = [
                    [len(i) // 4 for i, _ in rows],
                    [hashlib.sha256(i).hexdigest() for i, _ in rows],
                    [hashlib.sha256(d.encode()).hexdigest() for _, d in rows],
                ]
                if keep_ids:
                    cols += [[i for i, _ in rows], [d for _, d in rows]]
                arrays = [part.column(0), *(pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, *(n for n, _ in fields)])

    return bounded(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(run, ddl)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the vocabulary of words with ends."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import scan

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abAB é日\t\n\x0b\x85 ", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_and_shingles_like_brute_force(texts, slice_bytes):
    scan.SLICE, old = slice_bytes, scan.SLICE
    try:
        known, seen = {}, {}
        rows = 0
        for w in scan.words(pa.array(texts, pa.string()), lower=True):
            assert w.row == rows
            rows += w.n
            h, at = scan.shingles(w, 3)
            for k in range(w.n):
                want = re.findall(r"[^\x20\x09-\x0D]+", (texts[w.row + k] or "").translate({c: c + 32 for c in range(65, 91)}))
                got = w.hash[w.first[k] : w.first[k + 1]]
                assert len(got) == len(want)
                for x, y in zip(want, got, strict=True):
                    assert known.setdefault(x, y) == y
                s, e = w.start[w.first[k] : w.first[k + 1]], w.end[w.first[k] : w.first[k + 1]]
                assert [bytes(w.data[a:b]).decode().translate({c: c + 32 for c in range(65, 91)}) for a, b in zip(s, e, strict=True)] == want
                runs = [tuple(want[i : i + 3]) for i in range(len(want) - 2)] or ([tuple(want)] if want else [])
                own = h[at[k] : at[k + 1]]
                assert len(own) == len(runs)
                for x, y in zip(runs, own, strict=True):
                    assert seen.setdefault(x, y) == y
        assert rows == len(texts)
        assert len(set(map(int, known.values()))) == len(known) and len(set(map(int, seen.values()))) == len(seen)
    finally:
        scan.SLICE = old


def test_long_text():
    w = next(iter(scan.words(pa.array(["ab " * 700_000]))))
    assert len(w.hash) == 700_000 and len(np.unique(w.hash)) == 1


def test_thue_morse_words_differ():
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    w = next(iter(scan.words(pa.array([f"{a} {b} {' '.join(a)} {' '.join(b)}"]))))
    assert len(np.unique(w.hash)) == 4
    for size in (2, 8, 50, 1024, 2048):
        h = scan.runs(w.hash[2:], size)
        assert len(h) == len(w.hash) - 2 - size + 1
        seen = {}
        for i, x in enumerate(h.tolist()):
            assert seen.setdefault(w.hash[2 + i : 2 + i + size].tobytes(), x) == x
        assert len(set(seen.values())) == len(seen)


def test_lines_by_any_length_like_brute_force():
    r = np.random.default_rng(3)
    parts = [bytes(r.integers(97, 99, n).astype(np.uint8)) for n in [*range(40), 511, 512, 513, 513, 600] for _ in range(4)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    end = np.cumsum([len(p) for p in parts])
    h = scan.hashes(data, end - [len(p) for p in parts], end)
    assert len(set(h.tolist())) == len(set(parts)) and len(set(zip(h.tolist(), parts, strict=True))) == len(set(parts))

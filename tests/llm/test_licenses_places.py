import random

from tessera.llm import licenses

T = licenses.TEMPLATES


def test_copies_side_by_side_are_places_of_their_own(spark):
    r = random.Random(5)
    rows, want = [], set()
    for i in range(120):
        name = list(T)[i % len(T)]
        text = ""
        for _ in range(r.randint(1, 4)):
            text += "".join(r.choice(["lorem ", "ipsum ", "dolor\n"]) for _ in range(r.choice([0, 0, 1, 3, 40])))
            for _ in range(r.randint(1, 5)):
                bare = T[name].rstrip(".")
                want.add((i, name, len(text), len(text) + len(bare)))
                text += bare + r.choice([". ", "\n"])
        rows.append((i, text))
    names = {i: list(T)[i % len(T)] for i, _ in rows}
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.license, x.start, x.end) for x in out if x.license == names[x.doc_id]) == sorted(want)


def test_changed_copies_side_by_side(spark):
    words = T["bsd"].split(" ")
    first, second = " ".join(words[:-2] + ["x", "y"]), " ".join(["x", "y"] + words[2:])
    text = first + " " + second
    out = sorted((x.start, x.end) for x in licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect())
    assert out == [(0, len(first) - 4), (len(first) + 5, len(text))]


def test_parts_in_another_order_are_a_place():
    h = {x: [x] for x in range(10)}
    assert licenses.places(list(range(10)), [5, 6, 7, 8, 9, 0, 1, 2, 3, 4], h, 14, 5) == [(1.0, 0, 14)]

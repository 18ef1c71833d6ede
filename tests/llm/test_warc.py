import hashlib
import random

from tessera.llm import warc


def frames(spark, a, b):
    schema = "key long, record binary"
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


def run(spark, a, b):
    return sorted((r.key, r.offset, r.length, r.fault) for r in warc.audit(*frames(spark, a, b)).collect())


def brute(a, b):
    """Faults by comparing all records; offsets by file and key in the replica that has it."""
    out = []
    of = lambda rows, k: sorted(bytes(v) for x, v in rows if x == k)
    for k in {x for x, _ in a} | {x for x, _ in b}:
        x, y = of(a, k), of(b, k)
        if x != y:
            rows = a if x else b
            offset = sum(len(v) for j, v in rows if j // warc.FILE == k // warc.FILE and j < k)
            out.append((k, offset, sum(map(len, x or y)), "missing" if not y else "added" if not x else "changed"))
    return sorted(out)


def test_faults_like_brute_force(spark):
    r = random.Random(1)
    a = [(k, bytes(r.randbytes(r.randint(1, 30)))) for k in range(0, 6000, 3)]
    b = [(k, v) for k, v in a if r.random() > 0.005]
    b = [(k, v[::-1]) if r.random() < 0.005 else (k, v) for k, v in b] + [(7, b"new"), (90000, b"far")]
    assert run(spark, a, b) == brute(a, b)
    assert run(spark, b, a) == brute(b, a)
    assert run(spark, a, a) == []


def test_special_inputs(spark):
    a = [(1, b"x"), (1, b"x"), (2, b""), (-5, b"n")]
    for b in ([(1, b"x"), (2, b""), (-5, b"n")], [], [(1, b"x"), (1, b"y"), (2, b""), (-5, b"n")], a[::-1]):
        assert run(spark, a, b) == brute(a, b)
        assert run(spark, b, a) == brute(b, a)
    pages = spark.createDataFrame([(None, None, None, "z"), (3, "u", "é" * 50000, "z"), (None, "v", "", "z")], "page_id long, url string, html string, key string")
    rows = warc.records(pages)
    assert rows.count() == 3 and warc.audit(rows, rows).count() == 0
    assert warc.audit(rows, rows.limit(0)).count() == 3


def test_layout_alone(spark):
    """The same records; in the replica one lies three bytes later in its file, and another in another file."""
    rows = [(k, bytes([k]) * (5 + k % 3), "f", 0) for k in range(40)]
    laid, at = [], 0
    for k, v, f, _ in rows:
        laid.append((k, v, f, at))
        at += len(v)
    schema = "key long, record binary, file string, offset long"
    a = spark.createDataFrame(laid, schema)
    later = spark.createDataFrame([(k, v, f, o + 3 * (k >= 20)) for k, v, f, o in laid], schema)
    assert warc.audit(a, a).count() == 0
    assert [(r.key, r.fault, r.offset) for r in warc.audit(a, later).collect()] == [(20, "moved", laid[20][3])]
    first, second = (warc.tree(warc.leaves(x), 0, 39, warc.Written(spark)) for x in (a, later))
    roots = [t[-1].collect() for t in (first, second)]
    assert len(first) == 3 and roots[0][0].hash != roots[1][0].hash and roots[1][0].size == roots[0][0].size + 3
    last = spark.createDataFrame([(k, v, f if k < 39 else "g", o if k < 39 else 1) for k, v, f, o in laid], schema)
    assert [(r.key, r.fault) for r in warc.audit(a, last).collect()] == [(39, "moved")]


def test_archives_read_from_files(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [bytes(r.record) for r in warc.records(pages).orderBy("key").collect()]
    for name, faulty in (("a", False), ("b", True)):
        (tmp_path / name).mkdir()
        for f in range(2):
            part = rows[f::2]
            if faulty and f:
                part = [*part[:3], part[3][:-6] + b"!" + part[3][-5:], *part[5:]]  # one changed, one lost
            (tmp_path / name / f"{f}.warc").write_bytes(b"".join(part))

    def keyed(name):
        found = warc.read_archive(spark, str(tmp_path / name)).collect()
        place = {bytes(v): k for k, v in enumerate(rows)} | {rows[7][:-6] + b"!" + rows[7][-5:]: 7}
        return spark.createDataFrame([(place[bytes(r.record)], bytearray(r.record), r.file[-6:], r.offset) for r in found], "key long, record binary, file string, offset long")

    got = sorted((r.key, r.fault) for r in warc.audit(keyed("a"), keyed("b")).collect())
    assert got == [(7, "changed"), (9, "missing")]


def test_archive_files(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(50)
    rows = [bytes(r.record) for r in warc.records(pages).orderBy("key").collect()]
    (tmp_path / "a.warc").write_bytes(b"".join(rows[:20]))
    (tmp_path / "b.warc").write_bytes(b"".join(rows[20:]))
    back = [bytes(r.record) for r in warc.read_archive(spark, str(tmp_path)).orderBy("file", "offset").collect()]
    assert back == rows


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.key, r.fault) for r in warc.op9_warc(spark, sf).collect()}
    kinds = {0: "missing", 1: "changed", 2: "changed"}
    keys = [r.page_id for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert got == {(k, kinds[c]) for k in keys if (c := int(hashlib.md5(str(k).encode()).hexdigest()[:6], 16) % 100) in kinds}


def test_query_like_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    duckdb.sql(f"create or replace view pages as select * from '{sf}/pages.parquet'")
    out = warc.op9_warc(spark, sf)
    want = duckdb.sql(warc.ORACLE_SQL).fetchall()
    assert sorted(tuple(r[c] for c in ("key", "file", "offset", "length", "fault")) for r in out.collect()) == sorted(want)

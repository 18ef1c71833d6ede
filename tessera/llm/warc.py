"""Merkle fixity audit of WARC archives.

Every record of an archive is hashed over its bytes. A leaf tells a key's file, its offset range
[start, end) there, and hashes the records' hash, the range's length and the gap between it and the
range before; so a record that lies elsewhere is told from one that only follows a lost one.
Nodes over ``FANOUT`` consecutive keys hash their children, each with its offset range counted
from the node's own start, level by level up to one root. To compare two replicas their roots are
compared, and only the children of nodes that differ are compared further, down to the
records. A key's place in the tree does not depend on other records, so a lost or an added
record changes its own branch alone.

Records of archives that were read (read_archive) have the file and offset they were read from;
others are laid out in the order of their keys, ``FILE`` keys to a file, without gaps.

Results for special inputs: a null URL or body counts as empty; records with a null key get a key
of their content below 0; records that repeat a key form one leaf, in the order of their hashes;
an empty archive has an empty tree, and all records of the other are reported as missing or
added. Other columns of the input are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.shared import Written

FANOUT = 16
#: Keys of a file.
FILE = 256


def record_bytes(url, body):
    """The bytes of a WARC resource record."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """(key, record) of pages."""
    record = record_bytes(F.col(url_col), F.col(body_col))
    key = F.coalesce(F.col(id_col).cast("long"), -1 - F.pmod(F.xxhash64(record), F.lit(1 << 40)))
    return pages.select(key.alias("key"), record.alias("record"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, record) of WARC files under a path; a file's records are cut at their lengths."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, offsets, found = 0, [], []
                while at < len(data):
                    head = data.find(b"\r\n\r\n", at)
                    size = 0
                    for line in data[at:head].split(b"\r\n") if head >= 0 else []:
                        if line.lower().startswith(b"content-length:"):
                            size = int(line.split(b":")[1])
                    end = min(len(data), head + 8 + size) if head >= 0 else len(data)
                    offsets.append(at)
                    found.append(data[at:end])
                    at = end
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array(offsets, pa.int64()), pa.array(found, pa.binary())], names=["file", "offset", "record"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, offset long, record binary")


def leaves(rows: DataFrame) -> DataFrame:
    """(key, file, start, end, gap, records, hash) of (key, record), or (key, record, file, offset): one leaf for each key."""
    laid = "offset" in rows.columns
    file = F.col("file").cast("string") if laid else F.floor(F.col("key") / FILE).cast("string")
    offset = F.col("offset").cast("long") if laid else F.lit(None).cast("long")
    one = rows.select("key", file.alias("file"), offset.alias("offset"), F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("hash"))
    # keys repeat rarely; a leaf of repeats hashes their count and the sums of their hashes' parts
    parts = [F.sum(F.conv(F.substring("hash", 1 + 8 * k, 8), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"h{k}") for k in range(8)]
    grouped = one.groupBy("key").agg(F.min(F.struct("file", "offset")).alias("at"), F.sum("length").alias("length"), F.count("*").alias("n"), F.min("hash").alias("hash"), *parts)
    many = F.sha2(F.concat_ws(" ", F.col("n").cast("string"), *[f"h{k}" for k in range(8)]), 256)
    grouped = grouped.select("key", F.col("at.file").alias("file"), F.col("at.offset").alias("offset"), "length", F.when(F.col("n") == 1, F.col("hash")).otherwise(many).alias("records"))
    if laid:
        order = Window.partitionBy("file").orderBy("start", "key")  # the records of a file
        grouped = grouped.withColumnRenamed("offset", "start")
    else:
        order = Window.partitionBy("file").orderBy("key")  # FILE keys at most
        grouped = grouped.withColumn("start", F.sum("length").over(order) - F.col("length")).drop("offset")
    grouped = grouped.withColumn("end", F.col("start") + F.col("length"))
    grouped = grouped.withColumn("gap", F.col("start") - F.coalesce(F.lag("end").over(order), F.lit(0)))
    text = F.concat_ws(":", "records", F.col("length").cast("string"), F.col("gap").cast("string"))
    return grouped.select("key", "file", "start", "end", "gap", "records", F.sha2(text, 256).alias("hash"))


def above(node, root: bool):
    """The node over a node; the root is over all."""
    return F.lit(0).cast("long") if root else F.floor(node / FANOUT)


def parents(level: DataFrame, root: bool) -> DataFrame:
    """(node, size, hash) of the nodes over (node, size, hash): children are hashed with their ranges in the node."""
    child = F.struct("node", "size", "hash")
    kids = level.groupBy(above(F.col("node"), root).alias("node")).agg(F.array_sort(F.collect_list(child)).alias("kids"))  # FANOUT at most
    start = lambda i: F.aggregate(F.slice("kids", 1, i), F.lit(0).cast("long"), lambda total, k: total + k["size"])
    told = F.transform("kids", lambda k, i: F.concat_ws(":", k["node"].cast("string"), start(i).cast("string"), (start(i) + k["size"]).cast("string"), k["hash"]))
    return kids.select("node", start(F.size("kids")).alias("size"), F.sha2(F.array_join(told, "|"), 256).alias("hash"))


def tree(leaf: DataFrame, low: int, high: int, written: Written) -> list[DataFrame]:
    """Levels of the tree from the leaves to the root, over keys from low to high: above the leaves (node, size, hash).

    size: bytes that a node's records and the gaps before them take.
    """
    level = leaf.select(F.col("key").alias("node"), (F.col("end") - F.col("start") + F.col("gap")).alias("size"), "hash")
    levels = [leaf]
    while not levels[1:] or low != high:
        root = high - low < FANOUT
        level = written.save(parents(level, root), "warc-level")
        levels.append(level)
        low, high = (0, 0) if root else (low // FANOUT, high // FANOUT)
    return levels


def audit(primary: DataFrame, replica: DataFrame, written: Written | None = None) -> DataFrame:
    """Records (key, record[, file, offset]) that differ between two replicas.

    Returns key, file, offset, length (in the replica that has it, the primary first), and fault:
    changed, missing (in the replica), added, or moved (the same record elsewhere in its file).
    """
    written = written or Written(primary.sparkSession)
    told = [written.save(leaves(rows), "warc-leaves") for rows in (primary, replica)]
    low, high = told[0].select("key").unionAll(told[1].select("key")).agg(F.min("key"), F.max("key")).first()
    one, two = (tree(leaf, low or 0, high or 0, written) for leaf in told)
    wrong: DataFrame | None = None
    for k in range(len(one) - 1, 0, -1):
        pair = [t[k].select("node", F.col("hash").alias(f"h{i}")) for i, t in enumerate((one, two))]
        if wrong is not None:
            over, root = wrong.select(F.col("node").alias("parent")), k == len(one) - 2
            pair = [p.withColumn("parent", above(F.col("node"), root)).join(over, "parent", "left_semi").drop("parent") for p in pair]
        wrong = pair[0].join(pair[1], "node", "full_outer").filter(~F.col("h0").eqNullSafe(F.col("h1"))).select("node")
        wrong = written.save(wrong, "warc-wrong")
    over = wrong.select(F.col("node").alias("parent"))
    sides = []
    for i, t in enumerate((one, two)):
        leaf = t[0].select("key", *[F.col(c).alias(f"{c}{i}") for c in ("file", "start", "end", "records", "hash")])
        leaf = leaf.withColumn("parent", above(F.col("key"), len(one) == 2)).join(over, "parent", "left_semi").drop("parent")
        sides.append(leaf)
    found = sides[0].join(sides[1], "key", "full_outer").filter(~F.col("hash0").eqNullSafe(F.col("hash1")))
    fault = F.when(F.col("hash1").isNull(), "missing").when(F.col("hash0").isNull(), "added").when(F.col("records0") == F.col("records1"), "moved").otherwise("changed")
    start, end = F.coalesce("start0", "start1"), F.coalesce("end0", "end1")
    return found.select("key", F.coalesce("file0", "file1").alias("file"), start.alias("offset"), (end - start).alias("length"), fault.alias("fault"))


def damaged(rows: DataFrame) -> DataFrame:
    """A replica with known faults, for the query: of a hundred keys (by md5) one record is lost,
    one has its first letters in the other case, and one is cut by its last byte."""
    part = F.conv(F.substring(F.md5(F.col("key").cast("string").cast("binary")), 1, 6), 16, 10).cast("long") % 100
    n = F.octet_length("record")
    changed = F.concat(F.encode(F.lower(F.decode(F.substring("record", 1, 4), "UTF-8")), "UTF-8"), F.substring("record", F.lit(5), n))
    record = F.when(part == 1, changed).when(part == 2, F.substring("record", F.lit(1), n - 1)).otherwise(F.col("record"))
    return rows.filter(part != 0).select("key", record.alias("record"))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """An archive of all pages against a replica with known faults."""
    rows = records(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return audit(rows, damaged(rows))


ORACLE_SQL = r"""
WITH r AS (
  SELECT page_id AS key, page_id // 256 AS file,
         strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
           || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR)
           || chr(13) || chr(10) || chr(13) || chr(10)) + strlen(coalesce(html, '')) + 4 AS length,
         CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6) AS BIGINT) % 100 AS part
  FROM pages),
o AS (
  SELECT *, sum(length) OVER (PARTITION BY file ORDER BY key) - length AS before FROM r)
SELECT CAST(key AS BIGINT) AS key, CAST(file AS VARCHAR) AS file, CAST(before AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
       CASE WHEN part = 0 THEN 'missing' ELSE 'changed' END AS fault
FROM o WHERE part IN (0, 1, 2)
"""

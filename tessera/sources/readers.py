"""Readers. Paths may belong to any store that Spark reads."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Fixed value: the line that begins a block of a transcript.
HEADER = r"(?m)^Speaker\s+(\d+)\s+(\d{2}):(\d{2}):(\d{2}\.\d{3})\s*$"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def once(spark: SparkSession, path: str, build) -> DataFrame:
    """The table at path; built and written there if it is not."""
    if not exists(spark, path):
        build().write.parquet(path)
    return spark.read.parquet(path)


def config(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """A list in a configuration file (JSON, or YAML where its library is installed) as rows in file order."""
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one small file
    if path.endswith((".yaml", ".yml")):
        import yaml

        items = yaml.safe_load(text)[key]
    else:
        items = json.loads(text)[key]
    empty = spark.createDataFrame([], schema)
    rows = [tuple(item.get(f.name) for f in empty.schema) for item in items]
    return spark.createDataFrame(rows, empty.schema)


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path).dropna(how="all")


def files(spark: SparkSession, path: str, suffix: str = "*", recursive: bool = True) -> DataFrame:
    """path, bytes, modified of the files below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", suffix).load(path)
    return found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def probed(roster: DataFrame, listing: DataFrame, place: Column, name: str) -> DataFrame:
    """roster with name_path and name_bytes of the file at `place` (a path's end), null where there is none."""
    ends = listing.select(F.col("path").alias(f"{name}_path"), F.col("bytes").alias(f"{name}_bytes"), F.substring_index("path", "/", -2).alias("_end"))
    return roster.withColumn("_end", place).join(ends, "_end", "left").drop("_end")


def parsed_transcripts(texts: DataFrame, id_col: str = "course_id", text_col: str = "text") -> DataFrame:
    """Blocks (id_col, block_idx, speaker, start_sec, text) of transcripts: a header line begins each."""
    heads = F.regexp_extract_all(text_col, F.lit(f"({HEADER})"), 1)
    bodies = F.split(text_col, HEADER)
    rows = texts.select(id_col, heads.alias("h"), F.slice(bodies, 2, 1 << 30).alias("b")).select(id_col, F.posexplode(F.arrays_zip("h", "b")).alias("i", "z"))
    part = lambda k: F.regexp_extract("z.h", HEADER, k)
    start = part(2).cast("int") * 3600 + part(3).cast("int") * 60 + part(4).cast("double")
    return rows.select(id_col, F.col("i").cast("long").alias("block_idx"), part(1).alias("speaker"), F.round(start, 3).alias("start_sec"), F.btrim("z.b", F.lit(" \n\t\r")).alias("text"))


def transcripts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, rejected ids) of the transcript files at a path; a file without a block is rejected."""
    texts = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^./]+$", 1).alias("course_id"), F.col("value").alias("text"))
    blocks = parsed_transcripts(texts)
    return blocks, texts.select("course_id").join(blocks.select("course_id").distinct(), "course_id", "left_anti")


def intro(text: Column, first: int = 4000, most: int = 1200) -> Column:
    """The beginning of a transcript's speech: its lines without headers, keywords and dates."""
    lines = F.filter(F.transform(F.split(F.substr(text, F.lit(1), F.lit(first)), "\n"), lambda s: F.btrim(s)), lambda s: (s != "") & ~s.rlike(HEADER) & ~F.startswith(s, F.lit("Keywords:")) & ~F.startswith(s, F.lit("20")))
    return F.substr(F.array_join(lines, "。"), F.lit(1), F.lit(most))


def with_fallback(wanted: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """wanted with the value of first, else of second, and where it is from (null: missing)."""
    a, b = (d.select(key, F.col(value).alias(f"_{k}")) for k, d in enumerate((first, second)))
    source = F.when(F.col("_0").isNotNull(), "first").when(F.col("_1").isNotNull(), "second")
    return wanted.join(a, key, "left").join(b, key, "left").withColumn(value, F.coalesce("_0", "_1")).withColumn("source", source).drop("_0", "_1")


def cache_key(model: Column, payload: Column) -> Column:
    """What a reply is filed under: the model and the request, not the budget of the reply."""
    return F.sha2(F.concat_ws("\n", model, payload), 256)


def cached(requests: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """requests with their filed reply and from_cache; empty replies are as good as none."""
    good = cache.filter(F.coalesce(F.btrim("reply"), F.lit("")) != "").select(key, "reply").dropDuplicates([key])
    return requests.join(good, key, "left").withColumn("from_cache", F.col("reply").isNotNull())


def fingerprint(*parts: str) -> Column:
    """Hash of all inputs of a stage; another hash means that it must run again."""
    return F.sha2(F.concat_ws("\x00", *map(F.lit, parts)), 256)


def settings(text: str | None, environment: dict[str, str], names: list[str], required: tuple[str, ...] = ()) -> dict[str, str | None]:
    """Named settings: the environment's value, else that of the last NAME=value line of a text; quotes around values go.

    Blank lines and those that begin with # say nothing. A required name without a value is an error.
    """
    lines = [x.strip().removeprefix("export ") for x in (text or "").splitlines()]
    filed = {k.strip(): v.strip().strip("\"'") for k, eq, v in (x.partition("=") for x in lines if x and not x.startswith("#")) if eq}
    out = {n: environment.get(n) or filed.get(n) for n in names}
    if missing := [n for n in required if not out.get(n)]:
        raise LookupError(f"not set: {', '.join(missing)}")
    return out

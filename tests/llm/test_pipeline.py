import corpus_pipeline
from tessera.llm import jaccard_join, packing, quality, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_do_their_work(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        before = {r.doc_id: r.text for r in docs.collect()}
        out.write.parquet(path := str(tmp_path / name))
        after = spark.read.parquet(path)
        if k < 4:
            kept = {r.doc_id: r.text for r in after.collect()}
            assert after.count() == len(kept) and kept.keys() <= before.keys()
        if k == 0:
            machine = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {i: t for i, t in before.items() if machine.scores([toxicity.slots(t)])[0] < 0.7}
        elif k == 1:
            want = {r.doc_id: before[r.doc_id] for r in quality.assess(docs).collect() if r.kept}
        elif k == 2:
            want = {r.doc_id: before[r.doc_id] for r in jaccard_join.near_duplicates(docs).collect() if r.component_id == r.doc_id}
        elif k == 3:
            want = dict(before)
            for r in sorted(suffix_dedup.spans(docs).filter("not is_first").collect(), key=lambda r: -r.start):
                want[r.doc_id] = want[r.doc_id][: r.start] + want[r.doc_id][r.end :]
            assert {r.doc_id: r.n_chars for r in after.collect()} == {i: len(t) for i, t in kept.items()}
        else:
            got = {}
            for r in after.collect():
                got.setdefault(r.doc_id, [r.doc_tokens, 0])[1] += r.length
            assert got.keys() == before.keys() and all(a == b for a, b in got.values())
            want = kept
        assert kept == want
        docs = after


def test_run_is_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {len(r) for r in rows} == {7}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sum(r.length for r in rows) == sum(r.length for r in docs.collect())


def test_special_inputs(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b " * 40000, "en", None, 7)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.count()
    assert packing.SEQUENCE == 2048


def test_clashing_columns_and_repeated_ids(spark):
    """Extra columns of any name stay; rows with one id and different texts are documents of their own."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, text(1), "en", "s", 5, "a", 1), (1, text(2), "en", "s", 5, "b", 2), (1, text(2), "en", "s", 5, "b", 2), (2, text(2), "en", "s", 5, "c", 3), (3, text(3), "en", "s", 5, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k_id string, row int")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.k_id) for r in kept.collect()) == [(1, "a"), (1, "b"), (3, "d")]
    plain = docs.filter("row <> 2")
    assert sorted((r.doc_id, r.k_id) for r in corpus_pipeline.near_duplicate_stage(spark, plain, SF).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == plain.columns


def test_repeated_ids_with_maps(spark):
    """Columns that hold maps, also inside arrays, do not keep rows with one id from being told apart."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, text(1), {"a": 1}, [{"x": None}]), (1, text(2), {"a": 2}, None), (1, text(2), {"a": 2}, None), (2, text(2), None, []), (3, text(3), {}, [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, l array<map<string,string>>")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id, (r.m or {}).get("a")) for r in kept.collect()) == [(1, 1), (1, 2), (3, None)]


def test_texts_are_not_dealt_out_to_drop_duplicates(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
        assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
        want = sorted(kept.collect())
        monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
        assert sorted(corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.doc_id for r in want} == {r.doc_id for r in jaccard_join.near_duplicates(docs).collect() if r.component_id == r.doc_id}

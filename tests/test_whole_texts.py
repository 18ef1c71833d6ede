from tessera.plans import catalogue


def test_contained_cards_compares_whole_texts(spark, tmp_path):
    rows = [
        (1, 0, "user", "the same beginning, then one thing"),
        (1, 1, "user", "the same beginning, then another"),
        (1, 2, "user", "then another"),
        (1, 3, "user", "before it: the same beginning, then one thing, and more"),
        (1, 4, "user", "the same"),
        (2, 0, "user", "then another"),
        (2, 1, "user", None),
    ]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    out = {(r.conv_id, r.turn): r.quote for r in catalogue.QUERIES["contained_cards"](spark, str(tmp_path)).collect()}
    squeezed = lambda t: "".join((t or "").split())
    want, kept = {}, {}
    for c, t, _, text in rows:
        q = squeezed(text)
        if not any(q in k or k in q for k in kept.setdefault(c, [])):
            kept[c].append(q)
            want[c, t] = text
    assert out == want and set(out) == {(1, 0), (1, 1), (2, 0)}

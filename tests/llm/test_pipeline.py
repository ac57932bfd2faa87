"""The pipeline on a small folder of tables: each stage's decisions take effect."""

import corpus_pipeline


def test_stages(spark, folder):
    item = " ".join(f"bench{i}" for i in range(20))
    body = {i: " ".join(f"d{i}w{k}" for k in range(80)) for i in range(60)}
    rows = [(i, body[i] + (" nasty vile" if i < 30 else "")) for i in range(60)]
    rows += [(100, body[40]), (101, body[41] + " " + item), (102, None), (103, "")]
    rows += [(i, f"a line that three documents hold\nunique {i}") for i in (200, 201, 202)]
    full = [(i, t, "en", "s", len(t or ""), "extra") for i, t in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, print string"
    spark.createDataFrame(full, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i < 30)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(out) == {*range(30, 60), 102, 103, 200, 201, 202}
    assert all(r.round_trip for r in out.values())
    assert out[200].n_tokens < out[202].n_tokens
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe",
    ]

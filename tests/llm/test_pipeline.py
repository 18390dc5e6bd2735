import numpy as np
from fixtures import DOCS

import corpus_pipeline
from tidemart.llm import queries


def tables(spark, folder, n=240):
    rng = np.random.default_rng(9)
    stems = [a + b for a in ("ka", "lo", "mi", "tun", "ver") for b in ("sch", "re", "na", "ti", "os")]
    rows = []
    for i in range(n):
        words = [str(w) for w in rng.choice(stems, 40)]
        text = " ".join(words) if i % 6 else " ".join(w + "%%%" for w in words)
        rows.append([i, text, "en", "s", len(text)])
    for i in range(20, 40):  # copies
        rows[i][1] = rows[19][1]
    spark.createDataFrame([tuple(r) for r in rows], DOCS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 0 if i % 6 == 0 else 1, 0) for i in range(0, n, 2)],
                          "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return rows


def test_stages_keep_what_they_should(spark, tmp_dir):
    rows = tables(spark, tmp_dir)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    kept = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, tmp_dir)
        assert after.columns == docs.columns
        path = f"{tmp_dir}/{name}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
        kept = {r.doc_id for r in docs.collect()}
        if name == "quality_classifier":
            assert kept == {r[0] for r in rows if "%" not in r[1]}
        assert kept, name
    copies = {i for i in range(19, 40) if "%" not in rows[i][1]}
    assert copies & kept == {19}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, tmp_dir).collect()
    assert {p.doc_id for p in pieces} == kept
    whole = corpus_pipeline.run(spark, tmp_dir)
    assert {r.doc_id for r in whole.select("doc_id").distinct().collect()} == kept


def test_empty_tables_pass_through_all_stages(spark, tmp_dir):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "simhash_near_dedup", "packing"]

import numpy as np
import pyarrow as pa
from fixtures import documents, empty

from tidemart.llm import resampling as R


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(spark, n=400):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        words = rng.choice([f"w{j}" for j in range(200)], 60)
        rows.append((i, " ".join(words) if i % 4 else " ".join(w + "%%%$$$" for w in words)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_good_documents_stay_and_bad_go(spark):
    docs = corpus(spark)
    marks = labels(spark, [(i, 0 if i % 4 == 0 else 1, 0) for i in range(0, 200)])
    rows = R.resample(docs, marks).collect()
    assert len(rows) == 400
    assert {r.doc_id for r in rows if r.kept} == {i for i in range(400) if i % 4}
    kept = R.keep_sampled(docs, marks)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 4}


def test_counts_cover_all_documents(spark):
    docs = documents(spark)
    total = np.zeros(R.BUCKETS, np.int64)
    for r in docs.collect():
        raw = (r.text or "").encode()
        np.add.at(total, R.ngrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[1], 1)
    found = {r.bucket: r.n for r in R.bucket_counts(docs.repartition(5)).collect()}
    assert found == {int(b): int(total[b]) for b in np.flatnonzero(total)}


def test_ngrams_stay_within_a_text():
    both = np.frombuffer(b"ab cdef gh", np.uint8)
    rows, buckets = R.ngrams(both, np.array([0, 5, 10]))
    one = R.ngrams(both[:5], np.array([0, 5]))[1]
    two = R.ngrams(both[5:], np.array([0, 5]))[1]
    assert buckets[rows == 0].tolist() == one.tolist() and buckets[rows == 1].tolist() == two.tolist()


def test_gumbel_top_k_draws_in_proportion():
    weights = np.log(np.array([8.0, 4.0, 2.0, 1.0, 1.0]))
    first = np.zeros(5)
    for seed in range(4000):
        first[np.argmax(weights + R.gumbel(np.arange(5), seed))] += 1
    assert np.abs(first / 4000 - np.array([8, 4, 2, 1, 1]) / 16).max() < 0.03


def test_inclusion_rates_are_those_of_successive_draws():
    """Top 2 of weight plus noise: the chance of being drawn first or second, by formula."""
    weights = np.array([8.0, 4.0, 2.0, 1.0, 1.0])
    p = weights / weights.sum()
    want = p + np.array([sum(p[j] * p[i] / (1 - p[j]) for j in range(5) if j != i) for i in range(5)])
    drawn, ids = np.zeros(5), pa.array(range(5))
    for seed in range(6000):
        model = R.Resampler(np.zeros(R.BUCKETS, np.int64), 10.0, seed, 0.0)
        drawn[np.argsort(-model.keys(ids, np.log(weights) / 10.0))[:2]] += 1
    assert np.abs(drawn / 6000 - want).max() < 0.03


def test_effective_size(spark):
    rows = spark.createDataFrame([(np.log(x).item(),) for x in (4.0, 2.0, 1.0, 1.0)], "log_weight double")
    assert abs(R.effective_size(rows) - 64 / 22) < 1e-9
    assert R.effective_size(rows.where("log_weight > 9")) == 0


def test_the_registered_query_against_brute_force(spark):
    """Both models, weights, k and the draw, from plain counts of n-grams."""
    sf = "/root/testdata/sf0.001"
    df = R.op3_importance_resampling(spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("doc_id", "bigint"), ("log_weight", "double"), ("gumbel_key", "bigint"), ("kept", "boolean")]
    got = {r.doc_id: r for r in df.collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    half = "pmod(xxhash64(doc_id, 12), 2) = 0 AS fits"
    marks = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "quality", half).collect()
             if r.quality is not None and r.doc_id in docs}
    assert got.keys() == docs.keys()

    def grams(text):
        raw = (text or "").encode()
        return R.ngrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[1]

    of = {i: grams(t) for i, t in docs.items()}
    raw, target = np.zeros(R.BUCKETS), np.zeros(R.BUCKETS)
    for i, g in of.items():
        np.add.at(raw, g, 1)
        if i in marks and marks[i].quality == 1 and marks[i].fits:
            np.add.at(target, g, 1)
    ratio = [np.log((c + 1) / (c.sum() + R.BUCKETS)) for c in (target, raw)]
    fixed = np.rint((ratio[0] - ratio[1]) * R.FIXED)
    mean = {i: fixed[g].sum() / R.FIXED / max(len(g), 1) for i, g in of.items()}
    held = [(mean[i], m.quality) for i, m in marks.items() if not m.fits]
    cut = R.best_cut(np.array([m for m, _ in held]), np.array([q for _, q in held]), 20.0)
    ids = np.array(sorted(docs))
    keys = np.array([mean[i] for i in ids]) * 10.0 + R.gumbel(ids, 11)
    k = sum(m >= cut for m in mean.values())
    want = set(ids[np.argsort(-keys)[:k]].tolist())
    assert {i for i, r in got.items() if r.kept} == want
    assert all(abs(got[i].log_weight - 10.0 * mean[i]) < 1e-6 for i in docs)
    good = [i for i, m in marks.items() if m.quality == 1]
    assert sum(i in want for i in good) >= 0.97 * len(good)


def test_kth_largest_against_sorting(spark):
    rng = np.random.default_rng(2)
    keys = [int(x) for x in np.concatenate([rng.integers(0, 1 << 32, 500), np.full(40, 77)])]
    df = spark.createDataFrame([(k,) for k in keys], "gumbel_key long")
    for k in (1, 2, 250, 500, 501, 540):
        assert R.kth_largest(df, k) == sorted(keys, reverse=True)[k - 1]


def test_batches_and_slabs_do_not_change_a_score():
    texts = pa.array(["ab cd ef", None, "", "x" * 5000, "q% r% s%"] * 3)
    ratios = np.random.default_rng(3).integers(-99999, 99999, R.BUCKETS)
    model = R.Resampler(ratios, 50.0, 1, 0.0)
    one = [model.means(texts.slice(i, 1))[0] for i in range(len(texts))]
    assert model.means(texts).tolist() == one


def test_awkward_rows_and_missing_labels(spark):
    docs = documents(spark)
    rows = R.resample(docs, labels(spark, [(0, 1, 0), (1, 0, 0), (None, 1, 1), (3, None, None)])).collect()
    assert len(rows) == docs.count()
    assert all(r.log_weight == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert len({r.kept for r in rows if r.doc_id == 0}) == 1
    assert R.keep_sampled(docs, labels(spark, [])).count() == docs.count()  # nothing is known: all stay
    assert R.keep_sampled(empty(spark), labels(spark, [])).count() == 0
    kept = R.keep_sampled(docs, labels(spark, [(0, 1, 0)]))
    assert kept.schema.names == docs.schema.names


def test_best_cut():
    m, g = np.array([-3.0, -2.0, 0.5, 1.0]), np.array([0, 0, 1, 1])
    assert -2 < R.best_cut(m, g, 20) < 0.5
    assert R.best_cut(m, np.zeros(4, int), 20) == -np.inf
    assert R.best_cut(m, np.ones(4, int), 20) < -3


def test_labels_sample_is_bounded(spark):
    docs = corpus(spark, 300)
    marks = labels(spark, [(i, i % 2, 0) for i in range(300)])
    model = R.fit(docs, marks, sample_rows=10)
    assert np.isfinite(model.cut) or model.cut == -np.inf

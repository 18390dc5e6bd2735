import numpy as np
import pyarrow as pa
from fixtures import documents, empty

from tidemart.llm import toxicity


def corpus(n=900, seed=6):
    """Toxic: an insult together with a group; each alone is harmless."""
    rng = np.random.default_rng(seed)
    texts, toxic = [], []
    for _ in range(n):
        words = [f"w{j}" for j in rng.integers(0, 60, 12)]
        insult, group = (int(x) for x in rng.random(2) < 0.5)
        words += ["dolt"] * insult + ["martians"] * group
        texts.append(" ".join(rng.permutation(words)))
        toxic.append(int(insult and group))
    return texts, np.array(toxic)


def test_pairs_are_learned_that_single_weights_miss():
    texts, toxic = corpus()
    machine = toxicity.train(pa.array(texts), toxic)
    fresh, truth = corpus(300, 7)
    score = machine.scores(pa.array(fresh))
    assert ((score >= 0.7) == (truth == 1)).mean() > 0.98


def test_scores_against_brute_force():
    texts = ["Dolt you martians", "", None, "dolt", "w1 w2 " * 5000 + "dolt"]
    rng = np.random.default_rng(8)
    data = " ".join(t for t in texts if t).encode()
    buckets = np.unique(toxicity.terms(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[1])
    machine = toxicity.Machine(buckets, -1.0, rng.normal(0, 1, len(buckets)), rng.normal(0, 1, (len(buckets), 3)))
    for text, score in zip(texts, machine.scores(pa.array(texts, pa.string()))):
        raw = (text or "").encode()
        at = np.searchsorted(buckets, np.unique(toxicity.terms(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[1]))
        z = machine.bias + machine.weights[at].sum()
        z += sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(at) for j in at[:n])
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-9


def test_a_slab_without_a_known_term():
    machine = toxicity.Machine(np.array([1, 2]), -1.0, np.ones(2), np.ones((2, 3)))
    score = machine.scores(pa.array(["something else", "", None], pa.string()))
    assert np.allclose(score, 1 / (1 + np.exp(1)))


def test_g_statistic():
    g = toxicity.g_statistic(np.array([10, 5, 0]), np.array([0, 45, 90]), 10, 90)
    assert g[0] > 30 and abs(g[1]) < 1e-9 and g[2] > 30


def test_rows_labels_and_empty_tables(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (5, 0, 0), (None, 0, 1), (9, None, None)],
                                   "doc_id long, quality int, toxic int")
    machine = toxicity.fit(docs, labels)
    out = toxicity.scored(docs, machine)
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (1 if r.score >= 0.7 else 0) for r in rows)
    blank = [r.score for r in rows if r.text is None or r.text == ""]
    assert len(set(blank)) == 1
    none = toxicity.fit(docs, labels.filter("false"))
    assert {r.predicted for r in toxicity.scored(docs, none).collect()} == {0}
    assert toxicity.scored(empty(spark), machine).count() == 0


def labelled(spark, texts, toxic):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(x)) for i, x in enumerate(toxic)], "doc_id long, toxic int")


def test_long_texts_are_learned_from(spark):
    """What only texts far over 20,000 bytes say is learned, too."""
    texts, toxic = corpus(240)
    pad = " ".join(f"w{j % 60}" for j in range(8000))
    texts += [f"{pad} rotter{' dolt' if i % 2 else ''}" for i in range(60)] + [f"{pad} kindly" for _ in range(60)]
    toxic = np.concatenate([toxic, np.ones(60, int), np.zeros(60, int)])
    assert all(len(t) > 20_000 for t in texts[240:])
    machine = toxicity.fit(*labelled(spark, texts, toxic))
    score = machine.scores(pa.array(["rotter", "kindly", f"{pad} rotter"]))
    assert score[0] >= 0.7 > 0.3 > score[1] and score[2] >= 0.7


def test_terms_from_tasks_train_the_same_machine(spark):
    texts, toxic = corpus()
    docs, labels = labelled(spark, texts, toxic)
    got = toxicity.fit(docs.repartition(5), labels)
    want = toxicity.train(pa.array(texts), toxic)
    assert (got.buckets == want.buckets).all() and np.allclose(got.weights, want.weights)
    assert np.allclose(got.factors, want.factors) and np.isclose(got.bias, want.bias)

import re

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import toxicity as tx


def test_pairs_beyond_weights():
    """Neither term alone tells the class, both together do."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array([*([0] if a else []), *([1] if b else []), 2 + rng.integers(8)]))
        y.append(float(a == b))  # exclusive or: no weights can
    m = tx.fit(rows, np.array(y), 10)
    flat = np.array([0, 1, 5, 0, 5, 1, 5])
    both, first, second = m.scores(flat, np.array([0, 3, 5]))
    assert both > 0.7 and first < 0.3 and second < 0.3


def test_formula():
    rng = np.random.default_rng(2)
    m = tx.Machine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    rows = [[0, 2, 5], [], [1], []]
    want = [0.3 + sum(m.weights[r]) + sum(m.factors[r[i]] @ m.factors[r[j]] for i in range(len(r)) for j in range(i)) for r in rows]
    sizes = np.array([len(r) for r in rows])
    assert np.allclose(m.raw(np.concatenate([np.array(r, int) for r in rows]), np.cumsum(sizes) - sizes), want)


def test_held_out_accuracy_and_edges(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chosen, machine = tx.train(docs, labels)
    got = tx.score(docs.join(labels, "doc_id"), chosen, machine).join(labels, "doc_id").withColumn("h", tx.is_held_out(F.col("doc_id"))).where("h").collect()
    toxic = [r.score for r in got if r.toxic == 1 and r.quality == 1]  # poor rows are marked toxic at random
    clean = [r.score for r in got if r.toxic == 0]
    assert len(toxic) > 50 and np.mean(np.array(toxic) >= tx.THRESHOLD) > 0.9
    assert np.mean([r.score >= tx.THRESHOLD for r in got if r.toxic == 1]) > 0.84
    assert np.mean(np.array(clean) >= tx.THRESHOLD) < 0.01
    texts = {r.doc_id: r.text for r in docs.where("doc_id < 400 and length(text) < 3000").collect()}
    scores = {r.doc_id: r.score for r in tx.score(docs.where("doc_id < 400"), chosen, machine).collect()}
    for i in list(texts)[:12]:  # from the text to the score, term by term and pair by pair
        own = sorted({chosen[t] for w in re.findall(r"\w+", texts[i].lower()) for t in tx.terms_of(w) if t in chosen})
        raw = float(machine.bias) + sum(float(machine.weights[k]) for k in own) + sum(float(machine.factors[a] @ machine.factors[b]) for n, a in enumerate(own) for b in own[:n])
        assert abs(scores[i] - 1 / (1 + np.exp(-raw))) < 1e-3
    odd = spark.createDataFrame([(1, None, 3), (1, "", 3), (None, "x" * 300_000, 3), (2, "idiot loser scum " * 4, 3)], "doc_id long, text string, score int")
    rows = tx.score(odd, chosen, machine).collect()
    assert len(rows) == 4 and rows[0].score == rows[1].score < 0.5 and rows[3].score > 0.7


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in tx.classify(docs, none).collect()] == [0.5]
    odd = spark.createDataFrame([(1, None), (None, 1), (3, 7)], "doc_id long, toxic int")
    assert tx.classify(docs, odd).collect()[0].score == 0.5
    assert tx.classify(docs.limit(0), none).count() == 0


def test_toxic_only_as_a_pair(spark):
    """Two words, each as common in toxic as in clean texts: both or neither is toxic, one alone is clean."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(5000):
        toxic, first = rng.random() < 0.3, rng.random() < 0.5
        second = first if toxic else not first
        own = [f"w{k}" for k in rng.integers(0, 200, 10)] + ["marigold"] * first + ["thunder"] * second
        rows.append((i, " ".join(own), int(toxic), second and first))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = tx.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows[:4000]], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in tx.score(docs, *model).collect()}
    pairs, single = ([got[i] for i, _, toxic, both in rows[4000:] if toxic == k and both == k] for k in (1, 0))
    assert len(pairs) > 100 and len(single) > 500
    assert np.mean(np.array(pairs) >= tx.THRESHOLD) > 0.9 and np.mean(np.array(single) >= tx.THRESHOLD) < 0.02
    chosen, machine = model  # with factors set to zero nothing is left
    weights_only = tx.Machine(machine.bias, machine.weights, machine.factors * 0)
    got = {r.doc_id: r.score for r in tx.score(docs, chosen, weights_only).collect()}
    assert np.mean([got[i] >= tx.THRESHOLD for i, _, toxic, both in rows[4000:] if toxic and both]) < 0.2

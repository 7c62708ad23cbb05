import numpy as np
from pyspark.sql import functions as F

from millrace.llm import quality as q


def test_views_teach_each_other():
    """With few labels, the pool's agreement between views lifts the weak one."""
    rng = np.random.default_rng(1)

    def draw(n):
        y = (rng.random(n) < 0.7).astype(float)
        a = rng.normal(size=(n, q.N_CONTENT)) + y[:, None] * 2.0
        b = np.hstack([rng.normal(size=(n, q.N_META)) + y[:, None] * 1.2, rng.integers(0, 64, (n, 2))])
        none = [b""] * n
        return q.Rows(a.astype(np.float32), none), q.Rows(b.astype(np.float32)), y

    a, b, y = draw(60)
    pa_, pb, _ = draw(2000)
    ta, tb, ty = draw(2000)
    fold = np.arange(60) % 4 == 0
    both = q.co_train(a, b, y, fold, pa_, pb)
    none = np.zeros(0, int)
    alone = q.co_train(a, b, y, fold, pa_.of(none), pb.of(none))
    right = lambda z: ((z >= 0.5) == ty).mean()
    assert right(both.scores(ta, tb)[0]) > 0.95
    assert right(both.scores(ta, tb)[2]) >= right(alone.scores(ta, tb)[2]) - 0.01


def test_held_out_accuracy_and_edges(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judge = q.train(docs, labels)
    got = q.score(docs.join(labels, "doc_id"), judge).join(labels, "doc_id").withColumn("h", q.is_held_out(F.col("doc_id"))).where("h").collect()
    good, poor = ([r.score for r in got if r.quality == k] for k in (1, 0))
    assert len(poor) > 50 and np.mean(np.array(poor) < q.THRESHOLD) > 0.95 and np.mean(np.array(good) >= q.THRESHOLD) > 0.99
    odd = spark.createDataFrame([(1, None, None, None, 0), (1, "", "en", "s", 0), (None, "x" * 300_000, "", "", 0), (2, "\n\n \n", "en", "s", 0)], "doc_id long, text string, lang string, source string, score int")
    rows = q.score(odd, judge).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in q.classify(odd, none).collect()] == [0.5] * 4
    assert q.classify(odd.limit(0), none).count() == 0


def test_capped_classes_keep_their_shares(spark, monkeypatch):
    """A sample with as many poor as good rows must not move the scores of a table that is mostly good."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    whole = q.train(docs, labels)
    monkeypatch.setattr(q, "LABELLED", 600)
    capped = q.train(docs, labels)
    assert whole.prior > 1.5 and abs(capped.prior - whole.prior) < 0.05


def test_weights_restore_log_odds():
    """Measures that tell little: scores of a capped and weighted sample are those of all rows."""
    rng = np.random.default_rng(3)
    y = (rng.random(12_000) < 0.86).astype(float)
    a = (rng.normal(size=(len(y), q.N_CONTENT)) + y[:, None] * 0.2).astype(np.float32)
    b = np.hstack([rng.normal(size=(len(y), q.N_META)) + y[:, None] * 0.2, rng.integers(0, 64, (len(y), 2))]).astype(np.float32)
    fold, none = np.arange(len(y)) % 4 == 0, np.zeros(0, int)
    a, b = q.Rows(a, [b""] * len(y)), q.Rows(b)
    every = q.co_train(a, b, y, fold, a.of(none), b.of(none))
    n = int((y == 0).sum())
    pick = np.concatenate([np.flatnonzero(y == 0), np.flatnonzero(y == 1)[:n]])
    capped = q.co_train(a.of(pick), b.of(pick), y[pick], fold[pick], a.of(none), b.of(none), (1.0, float((y == 1).sum()) / n))
    kept = [(j.scores(a, b)[0] >= q.THRESHOLD).mean() for j in (every, capped)]
    assert abs(kept[0] - kept[1]) < 0.04


def test_the_content_view_reads_words(spark):
    """Good and poor texts that differ in their words alone, not in any count or layout."""
    rng = np.random.default_rng(7)
    words = [f"{c}{n:03d}" for c in "ab" for n in range(150)]
    rows = []
    for i in range(1500):
        good = rng.random() < 0.7
        own = rng.integers(0, 150, 60) + (150 if good else 0)
        own = np.where(rng.random(60) < 0.45, own, rng.integers(0, 300, 60))
        rows.append((i, " ".join(words[k] for k in own), "en", "s", int(good)))
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    judge = q.train(docs, spark.createDataFrame([(r[0], r[4]) for r in rows[:1200]], "doc_id long, quality int"))
    got = {r.doc_id: r.content_score >= 0.5 for r in q.score(docs, judge).collect()}
    assert np.mean([got[i] == bool(y) for i, *_, y in rows[1200:]]) > 0.9


def test_scores_by_hand():
    """Scores against the formula worked out row by row."""
    rng = np.random.default_rng(9)
    n = 400
    y = (rng.random(n) < 0.6).astype(float)
    found = [np.unique(rng.integers(0, 50, 12) + int(30 * v)) if i % 50 else np.arange(q.GRAMS // 2) + i for i, v in enumerate(y)]
    assert all((q.unpacked(q.packed(f)) == f).all() for f in found) and max(len(q.packed(f)) for f in found) == q.GRAMS // 8
    a = q.Rows((rng.normal(size=(n, q.N_CONTENT)) + y[:, None]).astype(np.float32), [q.packed(f) for f in found])
    b = q.Rows(np.hstack([rng.normal(size=(n, q.N_META)) + y[:, None], rng.integers(0, 64, (n, 2))]).astype(np.float32))
    judge = q.co_train(a, b, y, np.arange(n) % 4 == 0, a.of(np.arange(50)), b.of(np.arange(50)))
    got = judge.scores(a, b)[0]
    for i in range(0, n, 37):
        logits = []
        for view, rows in zip(judge.views, (a, b)):
            codes = [int((c <= rows.x[i, k]).sum()) for k, c in enumerate(view.cuts)]
            if view.lexicon:
                codes.append(int((view.lexical_cuts <= np.mean([view.lexicon.weights[g] for g in found[i]])).sum()))
            codes += [int(rows.x[i, k]) for k in range(view.n, rows.x.shape[1])]
            raw = sum(view.weights[view.ends[k] + c] for k, c in enumerate(codes)) + view.weights[-1]
            logits.append(min(12, max(-12, view.slope * raw + view.shift)))
        assert abs(got[i] - 1 / (1 + np.exp(-(sum(logits) - judge.prior)))) < 1e-6

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import chat, topk


def expected_chat(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        turns = "".join(f"{r}\n{x}\n" for *_, r, x in ts)
        loss = "".join(x for *_, r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rng = random.Random(1)
    odd = ["<|im_end|>", "<|im_start|>assistant ok", "\\", "\\l|", "\\b", "<", "|", "<|", "\n", "é🙂", " word", ""]
    for c in range(1000, 1030):
        rows += [(c, t, rng.choice(["system", "user", "assistant", "to\nol", "<|x|>", None]), "".join(rng.choices(odd, k=rng.randrange(12)))) for t in range(rng.randrange(1, 14))]
    rows += [(2000, t, "assistant" if t % 2 else "user" if t else "system", f"turn {t} " * 40) for t in range(300)]
    rows += [(2001, 0, "user", "word " * 30_000), (2001, 1, "assistant", None), (2001, 1, "assistant", "tie"), (2001, 1, "assistant", "tie")]
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    df = spark.createDataFrame([(*r, 1, "g") for r in rows], "conv_id long, turn long, role string, text string, window int, group string").repartition(5)
    got = chat.format_conversations(df, budget=100, history=2).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected_chat(rows)
    out = chat.windows(df.where("conv_id = 2000"), budget=200, history=2).orderBy("window").collect()
    assert len(out) > 50 and out[0].n_context == 0 and all(w.tokens <= 200 for w in out)
    assert all(w.formatted.startswith("<|im_start|>system\nturn 0 ") == (w.tokens > 84) for w in out[1:])
    for w in out:
        assert all(w.formatted[s.start - len("<|im_start|>assistant\n") : s.start] == "<|im_start|>assistant\n" for s in w.loss)
    assert sum(r.formatted_chars for r in got if r.conv_id == 2000) > sum(len(r[3]) for r in rows if r[0] == 2000)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_windows_keep_the_budget(spark):
    """Each window fits, context included; only one turn that is larger by itself does not."""
    rng = random.Random(2)
    rows = []
    for c in range(60):
        rows.append((c, 0, rng.choice(["system", "user"]), "s " * rng.choice((0, 3, 40, 49, 80, 120))))
        rows += [(c, t, "assistant" if t % 2 == 0 else "user", "w " * rng.choice((0, 1, 5, 10, 20, 40, 60, 90, 97, 150))) for t in range(1, rng.randrange(2, 60))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    size = {c: {} for c in range(60)}
    for c, t, r, x in rows:
        size[c][t] = len(x.split()) + chat.TURN_TOKENS
    systems = {c for c, t, r, x in rows if t == 0 and r == "system" and 2 * size[c][0] <= 100}
    out = chat.windows(df, budget=100, history=2).collect()
    assert len(out) > 300 and len(systems) > 10
    for w in out:
        turns = w.formatted.count("<|im_start|>")
        assert w.tokens <= 100 or turns == 1
    for c in systems:  # the system turn goes wherever there is room for it
        own = [w for w in out if w.conv_id == c]
        assert all(w.formatted.startswith("<|im_start|>system") for w in own if w.tokens + size[c][0] <= 100)
    assert sum(w.n_context for w in out) > len(out) / 3
    got = chat.format_conversations(df, budget=100, history=2).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected_chat(rows)


def brute(rows, k, every):
    ok = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            ok[i] = [math.floor(1024 * float(np.float32(x))) for x in e]
    out = set()
    for q, a in ok.items():
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok.items() if i != q)[:k]
            out |= {(q, n, i, max(-(2**63), min(2**63 - 1, -v))) for n, (v, i) in enumerate(s, 1)}
    return out


def test_top_k(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    dims = len(rows[0][1])
    rng = np.random.default_rng(3)
    clusters = rng.normal(size=(12, dims))
    rows += [(10_000 + i, (clusters[i % 12] + rng.normal(size=dims) * 0.05).tolist()) for i in range(1500)]
    rows += [(20_000 + i, clusters[3].tolist()) for i in range(400)]
    rows += [(30_000, None), (30_100, [None] * dims), (30_200, [float("nan")] * dims), (30_300, [float("inf")] * dims), (None, clusters[1].tolist()), (40_000, [0.5, -0.5]), (40_100, [])]
    monkeypatch.setattr(topk, "ANNULUS", 64)
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int").repartition(4)
    got = topk.top_k(df).collect()
    assert {tuple(r) for r in got} == brute(rows, 10, 100) and len(got) == len(brute(rows, 10, 100))
    few = df.where("vec_id in (100, 200, 201)")
    assert {tuple(r) for r in topk.top_k(few.unionAll(few)).collect()} == brute([r for r in rows if r[0] in (100, 200, 201)], 10, 100)
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e3, 3e4, 1e6, 3e9, 3.4e38])
def test_top_k_of_large_components(spark, size):
    """Every finite vector takes part; scores are exact where doubles and longs are too small for them."""
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, size=(300, 64)).astype(np.float32) * np.float32(size)
    x[200:220] = x[5] + np.float32(size) * np.float32(1e-7) * rng.integers(-3, 4, (20, 64)).astype(np.float32)
    x[220:230] *= np.float32(1e-6)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, [0.0] * 64), (401, [-0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute(rows, 10, 20)
    assert {tuple(r) for r in topk.top_k(df, every=20).collect()} == want and len(want) == 160


def test_top_k_of_doubles(spark):
    rows = [(i, [s * 1.7e308, 0.25 * i, 5e-324]) for i, s in enumerate((1.0, -1.0, 0.5, 0.0, 1.0))]
    got = {tuple(r)[:3] for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2, every=1).collect()}
    assert got == {(0, 1, 4), (0, 2, 2), (1, 1, 3), (1, 2, 2), (2, 1, 4), (2, 2, 0), (3, 1, 4), (3, 2, 2), (4, 1, 0), (4, 2, 2)}


def test_annuli_are_left_out():
    """On clustered vectors the bounds spare most cells."""
    rng = np.random.default_rng(0)
    x = np.rint(np.concatenate([rng.normal(size=(200, 8)) * 20 + c for c in rng.normal(size=(16, 8)) * 1000]))
    index = topk.Index(8, float(np.abs(x).max()) / 1024)
    assert index.exact
    index.top = float((x * x).sum(1).max())
    index.fit(x)
    far = index.distances(index.lifted(x))
    near = far.argmin(1)
    d = far[np.arange(len(x)), near]
    bins = defaultdict(list)
    for p, v in zip(near.tolist(), d.tolist()):
        bins[p, int(v / index.width)].append(v)
    index.cells, where = topk._cells([(p, b, len(v), min(v), max(v)) for (p, b), v in bins.items()])
    bound = index.best_scores(x[:50])
    tenth = np.sort(x[:50] @ x.T, 1)[:, -10]
    cell = np.array([where[p, int(v / index.width)] for p, v in zip(near.tolist(), d.tolist())])
    scores = x[:50] @ x.T
    assert (scores <= bound[:, cell] + 1e-3).all()
    assert (bound >= tenth[:, None]).mean() < 0.5

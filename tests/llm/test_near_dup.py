import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import near_dup as nd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def true_set(text, words):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, words, percent=80):
    """Components by comparing every pair."""
    sets = [(i, frozenset(true_set(t, words))) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1 :]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                lo, hi = sorted((root(i), root(j)))
                up[hi] = lo
    return {i: (len(s), root(i)) for i, s in sets}


def test_sets_and_estimate():
    texts = ["Aa  b\tC aa b", "", None, "one", "É x\x0by  z", "w " * 70_000 + "x" * 70_000 + " y" + "Q" * 66_000, "a b c", " lead trail "]
    got = nd.shingle_sets(pa.array(texts), 2)
    assert [len(g) for g in got] == [len(true_set(t, 2)) for t in texts]
    assert nd.shingle_sets(pa.array(["zz", *texts])[1:], 2)[0].tolist() == got[0].tolist()
    assert nd.shingle_sets(pa.array(["aA b c AA B"]), 2)[0].tolist() == got[0].tolist()
    rng = np.random.default_rng(0)
    for n in (5, 40, 300, 5000):
        base = nd.mix64(rng.integers(0, 1 << 62, n * 2).astype(np.uint64))
        a, b = np.unique(base[: int(n * 1.0)]), np.unique(base[int(n * 0.1) : int(n * 1.1)])
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        est = float(nd.estimated(nd.sketch(a), nd.sketch(b), np.int64(len(a)), np.int64(len(b))))
        assert abs(est - j) < 0.12


def test_no_link_at_the_threshold_is_lost_by_banding():
    rng = np.random.default_rng(1)
    for n in (9, 36, 90, 900):
        missed = 0
        for _ in range(150):
            base = nd.mix64(rng.integers(0, 1 << 62, n).astype(np.uint64))
            k = n // 9
            a, b = np.unique(base[: n - k]), np.unique(base[k:] if k else base)
            sa, sb = nd.sketch(a), nd.sketch(b)
            ka, kb = nd.band_keys(np.stack([sa, sb]))
            missed += not (ka == kb).any() or nd.estimated(sa, sb, np.int64(len(a)), np.int64(len(b))) < nd.floor_of_estimate(0.75)
        assert missed == 0


@pytest.mark.parametrize("words", [2, 5])
def test_documents(spark, sf, words):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows, words)
    got = nd.near_duplicates(df, words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert sum(not r.kept for r in got) > 3


def test_chains_hubs_and_edges(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(9999)}" for _ in range(60)]
    rows = []
    for i in range(120):  # a drifting chain: neighbours are alike, ends are not
        base = list(base)
        base[rng.randrange(60)] = f"v{rng.randrange(9999)}"
        rows.append((1000 - i, " ".join(base)))
    passage = " ".join(f"p{k}" for k in range(45))
    rows += [(2000 + i, passage + " " + " ".join(f"q{rng.randrange(99999)}" for _ in range(9 + i % 6))) for i in range(80)]
    rows += [(5, None), (6, ""), (7, " \n"), (8, "one"), (9, "ONE "), (10, "one two"), (10, "one two"), (None, "one")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, node string, bucket string")
    got = nd.near_duplicates(df, 2).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(rows, 2)
    none = [r for r in got if r.doc_id is None]
    assert len(none) == 1 and none[0].component_id is None and none[0].kept
    assert nd.near_duplicates(df.limit(0), 2).count() == 0


@pytest.mark.parametrize("words", [2, 5])
def test_a_family_around_the_threshold(spark, words):
    """Copies changed by little and by much: some link, many lie just below, all pairs are settled without listing them."""
    rng = random.Random(words)
    base = [f"w{rng.randrange(9999)}" for _ in range(120)]
    rows = []
    for i in range(300):
        own = list(base)
        for k in rng.sample(range(120), rng.choice((1, 2, 3, 5, 6, 7, 8, 9, 12, 20))):
            own[k] = rng.choice((f"v{rng.randrange(99999)}", base[k - 1]))
        rows.append((i, " ".join(own)))
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words).collect()
    want = brute(rows, words)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 20 < len({c for _, c in want.values()}) < 280


def test_rows_without_shingles_only(spark):
    got = nd.near_duplicates(spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True)]

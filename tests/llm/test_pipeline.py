"""The pipeline's stages, each on its predecessor's rows, against plainer versions."""

from collections import Counter

import public_tokenizers as P
import tiktoken

from pyspark.sql import functions as F

import corpus_pipeline as cp
from millrace.llm import bpe, mixing, near_dup, quality, toxicity
from tests.llm.test_near_dup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality", "near_dup", "mixing", "byte_bpe"]

    clean = cp.drop_toxic(spark, docs, sf).persist()
    assert clean.columns == COLUMNS
    want = {r.doc_id for r in toxicity.classify(docs, labels).where("predicted = 0").collect()}
    assert {r.doc_id for r in clean.collect()} == want

    good = cp.drop_poor(spark, clean, sf).persist()
    want = {r.doc_id for r in quality.classify(clean, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == want and good.columns == COLUMNS

    single = cp.drop_copies(spark, good, sf).persist()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in brute(rows, 5).items() if i == c} and single.columns == COLUMNS

    mixed = cp.mix_sources(spark, single, sf).persist()
    plan = {r.doc_id: (r.taken, r.size) for r in mixing.mix(single).collect()}
    got, words = Counter(), Counter()
    for r in mixed.collect():
        got[r.doc_id] += 1
        words[r.doc_id] += len(r.text.split())
    assert mixed.columns == COLUMNS
    assert {i: n for i, n in got.items()} == {i: -(-t // s) for i, (t, s) in plan.items() if t}
    assert all(words[i] == t for i, (t, _) in plan.items())

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(P.path(bpe.VOCABULARY)), special_tokens={})
    want = Counter((r.doc_id, len(lib.encode_ordinary(r.text))) for r in mixed.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in cp.tokens(spark, mixed, sf).collect()) == want


def test_odd_rows_pass_every_stage(spark, sf):
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (None, "d e", "en", None, 3), (None, "d e", "en", None, 3), (3, "w " * 20_000, "de", "t", 40_000)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, kind)
    assert Counter(map(tuple, cp.drop_toxic(spark, docs, sf).collect())) == Counter(rows)
    scores = quality.classify(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = Counter(r.doc_id for r in scores.where("predicted = 1").collect())
    assert Counter(r.doc_id for r in cp.drop_poor(spark, docs, sf).collect()) == good
    single = cp.drop_copies(spark, docs, sf).persist()
    assert Counter(r.doc_id for r in single.collect()) == {1: 1, 2: 1, 3: 1, None: 2}
    plan = mixing.mix(single).agg({"taken": "sum"}).first()[0]
    mixed = cp.mix_sources(spark, single, sf).persist()
    assert sum(len(r.text.split()) for r in mixed.collect()) == plan > 0
    got = cp.tokens(spark, mixed, sf).collect()
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(P.path(bpe.VOCABULARY)), special_tokens={})
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((r.doc_id, len(lib.encode_ordinary(r.text))) for r in mixed.collect())
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_repeated_rows_and_columns_of_any_name(spark):
    """Rows alike share what the mix takes of them; further columns come along whatever they are called."""
    names = ["_id", "_same", "_taken", "_size", "_md5", "_copy", "_gone", "row", "n", "number", "tie", "all", "a.b"]
    kind = "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(1, "a b c d e", "s", *range(len(names)))] * 7 + [(2, "x y", "t", *range(len(names)))] * 3 + [(k, f"w{k} " * 50, "t", *range(len(names))) for k in range(3, 9)]
    rows += [(None, "n n n", "u", *range(len(names)))] * 2 + [(9, None, "s", *range(len(names)))]
    docs = spark.createDataFrame(rows, kind).repartition(4)
    taken = {(r.doc_id): r.t for r in mixing.mix(docs).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()}
    out = mixing.mixed(docs).collect()
    words = Counter()
    for r in out:
        words[r.doc_id] += len(r.text.split())
        assert tuple(r)[3:] == tuple(range(len(names)))
    assert dict(words) == {i: t for i, t in taken.items() if t}
    left = near_dup.without_copies(docs).collect()
    assert Counter(r.doc_id for r in left) == {**{k: 1 for k in range(1, 10)}, None: 2} and left[0].asDict().keys() == docs.first().asDict().keys()

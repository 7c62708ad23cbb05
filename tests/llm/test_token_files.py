import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from millrace.llm import token_files as tf

LIB = Tokenizer.from_file(P.path(tf.VOCABULARY))


def expected(t):
    return LIB.encode(t or "", add_special_tokens=False).ids + [1]


def test_chunks_equal_whole_texts(spark, sf):
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    docs += ["", " ", "á b c\x1cd\x85e F", "don't  I'LL 1234 ΣΑΣ Σ", '"quote" ́x', "x" * 5000, "<|endoftext|> a<|startoftext|>"]
    docs += ["İİ ﬁ", "e.́ x.", "word. word, Word! ٣. aͅ.", "a b　c. Σ.", "A.\x1fB. c\x1d."]
    got = tf.Encoder(P.path(tf.VOCABULARY))(docs)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [expected(t) for t in docs]


def test_files(spark, tmp_path):
    rows = [(5, "five"), (1, None), (3, ""), (9, "long words " * 30_000), (3, "same id"), (None, "none"), (7, "seven"), (7, "seven")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int").repartition(3)
    folder = f"file://{tmp_path}/tokens"
    files = tf.write_files(df, folder, length=64)
    got = sorted(tf.read_documents(files, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 3, 3, 5, 7, 7, 9]
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    texts = {k: expected(v) for k, v in rows if k not in (3,)}
    for r in got:
        if r.doc_id != 3:
            ids = texts[r.doc_id]
            assert r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    first = tf.TokenFile(folder, files.orderBy("part").first().part)
    ids, mask = first.sequence(0)
    assert len(ids) == 64 and mask[0] and ids[: len(expected("none"))].tolist() == expected("none")
    assert tf.read_documents(tf.write_files(df.limit(0), folder + "0"), folder + "0").count() == 0


def test_letters_that_end_in_a_combining_mark():
    """Words whose normal form ends in a combining mark join the punctuation after it; every letter before every mark."""
    odd = ["GELD\u0130.", "\u092a\u095d,", "\u09b9\u09df,", "\ufb2a.", "a\u0130! \u0130? \u0130b; x\ufb2a:"]
    odd += ["a" + chr(k) + m for k in range(0x80, 0x32400) if chr(k).isalpha() for m in ".,"]
    got = tf.Encoder(P.path(tf.VOCABULARY))(odd)
    want = [e.ids + [1] for e in LIB.encode_batch_fast(odd, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == want


def test_another_vocabulary_gets_whole_texts(tmp_path):
    """A split that looks across blanks: ids are the library's own, chunks are not used."""
    import json

    spec = json.load(open(P.path(tf.VOCABULARY)))
    spec["normalizer"] = {"type": "Lowercase"}
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": "[a-z]+ [a-z]+|[a-z]+|[^a-z]+"}
    path = str(tmp_path / "own.json")
    json.dump(spec, open(path, "w"))
    docs = ["two words and three", "", "A b, c", "x" * 500]
    got = tf.Encoder(path)(docs)
    lib = Tokenizer.from_file(path)
    assert tf.splits_at_blanks(P.path(tf.VOCABULARY)) and not tf.splits_at_blanks(path)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [lib.encode(t, add_special_tokens=False).ids + [1] for t in docs]

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe

PATH = P.path(bpe.VOCABULARY)
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeiouthern sd'l \n\t\x1cé漢字🙂012!?") | st.characters(exclude_categories=["Cs"])), max_size=6))
def test_as_the_library_does(batch):
    got = list(bpe.Encoder(PATH, P.PATTERN).encode_batch(batch))
    assert [g.tolist() for g in got] == [LIB.encode_ordinary(t) for t in batch]
    assert [bpe.decode(g, PATH).decode() for g in got] == batch


def test_merges_of_equal_and_lower_rank():
    table = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 260, b"aa": 256, b"aaa": 301, b"cab": 258}
    lib = tiktoken.Encoding("t", pat_str=r"(?s).+", mergeable_ranks=table, special_tokens={})
    words = ["".join(w) for n in range(1, 8) for w in __import__("itertools").product("abc", repeat=n)]
    assert bpe.replay([w.encode() for w in words], bpe.Merges(table)) == [lib.encode_ordinary(w) for w in words]


def test_long_word_and_rows(spark):
    long = "ab" * 40_000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "tie")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int")
    got = sorted(bpe.encode_documents(df).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3]
    assert got[1].n_tokens == got[2].n_tokens == 0 and got[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert np.frombuffer(got[3].ids, "<u4").tolist() == LIB.encode_ordinary(long)
    assert got[3].decoded_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0)).count() == 0

"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Every distinct pre-token of a batch is split into bytes once. An inverted index maps
each adjacent token pair to the places (word, position) where it stands; merges are
replayed over the whole batch in rank order, and a merge touches only the neighbours
of the places that it joins. Documents then look their pre-tokens up.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_limits, only, take_over, texts

VOCABULARY = "byte_bpe_50k.tiktoken"

#: Encoded pre-tokens that a worker keeps between batches; beyond it only those that come again are carried on.
KEPT_WORDS = 200_000
#: Longer pre-tokens are encoded but not kept.
KEPT_BYTES = 64


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@cache
def tokens(path: str) -> list[bytes]:
    """Token bytes by id."""
    table = ranks(path)
    out = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        out[rank] = token
    return out


#: Stands after each word; no pair has it.
_END = 0xFFFF


class Merges:
    """A vocabulary's ranks, and what each pair of tokens makes."""

    def __init__(self, table: dict[bytes, int]):
        self.table = table
        #: left id << 16 | right id -> id of the token that both make together, for every such pair
        self.pairs: dict[int, int] = {}
        for token, rank in table.items():
            for cut in range(1, len(token)):
                left, right = table.get(token[:cut]), table.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 16 | right] = rank
        self.byte_ids = np.array([table.get(bytes([i]), _END) for i in range(256)], np.int64)
        #: the same for pairs of bytes, -1 for none
        self.of_bytes = np.array([[self.pairs.get(a << 16 | b, -1) for b in self.byte_ids.tolist()] for a in self.byte_ids.tolist()], np.int64)


@cache
def merges(path: str) -> Merges:
    return Merges(ranks(path))


def replay(words: list[bytes], known: Merges) -> list[list[int]]:
    """The token ids of each word, all words merged together in rank order.

    A word that is itself a token becomes that token. The bytes of all others lie in
    one row of places, linked to their neighbours; the index has, for each rank, the
    places where a pair makes that token. Ranks are taken from a queue, lowest first,
    a word's leftmost place first, as when each word is encoded alone: a merge that
    makes a pair of lower rank hands the rest of its word back to the queue.
    """
    table, pairs = known.table, known.pairs
    out: list[list[int] | None] = [None if (whole := table.get(w)) is None else [whole] for w in words]
    split = [w for w, own in zip(words, out) if own is None]
    if not split:
        return out
    data = np.frombuffer(b"\0".join(split) + b"\0", np.uint8)
    sizes = np.array([len(w) for w in split], np.int64) + 1
    ends = np.cumsum(sizes) - 1
    ids = known.byte_ids[data]
    ids[ends] = _END
    made = np.append(known.of_bytes[data[:-1], data[1:]], -1)
    made[ends] = made[np.maximum(ends - 1, 0)] = -1
    made[ends[sizes == 1]] = -1
    token, rank_at = ids.tolist(), made.tolist()
    after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
    token.append(_END)
    before.append(len(token) - 2)
    word_of = np.repeat(np.arange(len(split)), sizes).tolist()
    order = np.argsort(made, kind="stable")
    order = order[np.searchsorted(made[order], 0) :]
    heads = np.flatnonzero(np.diff(made[order], prepend=-1))
    index = dict(zip(made[order[heads]].tolist(), (x.tolist() for x in np.split(order, heads[1:])))) if len(order) else {}
    queue = list(index)  # ascending, so already a heap
    get = pairs.get
    while queue:
        rank = heapq.heappop(queue)
        places = index.pop(rank)
        places.sort()
        back, waiting = [], -1
        for i in places:
            if rank_at[i] != rank:
                continue  # since then one of its parts was joined elsewhere
            if word_of[i] == waiting:
                back.append(i)
                continue
            j = after[i]
            k = after[j]
            p = before[i]
            token[i], after[i], before[k], rank_at[j] = rank, k, i, -1
            new = get(rank << 16 | token[k], -1)
            rank_at[i] = new
            if new >= 0:
                if new in index:
                    index[new].append(i)
                else:
                    index[new] = [i]
                    heapq.heappush(queue, new)
            if p >= 0:
                low, new = new, get(token[p] << 16 | rank, -1)
                rank_at[p] = new
                if new >= 0:
                    if new in index:
                        index[new].append(p)
                    else:
                        index[new] = [p]
                        heapq.heappush(queue, new)
                    if new < rank:
                        waiting = word_of[i]
                if 0 <= low < rank:
                    waiting = word_of[i]
            elif 0 <= new < rank:
                waiting = word_of[i]
        if back:
            index[rank] = back
            heapq.heappush(queue, rank)
    found = iter(np.concatenate([[0], ends[:-1] + 1]).tolist())
    for n, own in enumerate(out):
        if own is None:
            i, got = next(found), []
            while token[i] != _END:
                got.append(token[i])
                i = after[i]
            out[n] = got
    return out


class Encoder:
    """Encodes texts; keeps the ids of pre-tokens it has seen, as packed bytes."""

    def __init__(self, path: str, pattern: str):
        self.merges = merges(path)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode_batch(self, batch: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.known) > KEPT_WORDS:
            self.known, self.older = {}, self.known
        pieces = [self.split(t) for t in batch]
        known, older = self.known, self.older
        fresh = {p for own in pieces for p in own if p not in known}
        known.update((p, older[p]) for p in fresh if p in older)
        names = [p for p in fresh if p not in older]
        found = replay([p.encode() for p in names], self.merges)
        known.update(zip(names, (np.array(ids, "<u4").tobytes() for ids in found)))
        for own in pieces:
            yield np.frombuffer(b"".join(map(known.__getitem__, own)), "<u4")
        for p in names:
            if len(p) > KEPT_BYTES:
                del known[p]


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def forget() -> None:
    """Drops the vocabularies and pre-tokens that a worker keeps."""
    for kept in (encoder, merges, ranks, tokens):
        kept.cache_clear()


def decode(ids: np.ndarray, path: str) -> bytes:
    """The bytes that the ids stand for."""
    return b"".join(map(tokens(path).__getitem__, ids.tolist()))


SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, keep_ids: bool = True, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per row of docs(doc_id, text): its token ids and digests, whole texts only.

    Null and empty texts have no tokens. Repeated rows and null ids come back as they
    are. A text that is not valid Unicode cannot occur: Spark strings are UTF-8.
    path: a vocabulary of ranks that every worker can read; by default the installed one.
    """
    arrow_limits(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("bpe", forget)
        coder = encoder(path, pattern)
        for batch in batches:
            rows = []
            for ids in coder.encode_batch(texts(batch.column(1))):
                packed = ids.tobytes()
                rows.append((len(ids), packed if keep_ids else None, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decode(ids, path)).hexdigest()))
            n, packed, a, b = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.binary()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return only(docs, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, SCHEMA)

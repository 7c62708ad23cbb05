"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and the beginnings of its words, hashed. The
machine learns a weight for each term that has enough rows and, through short factor
vectors, one for each pair, so that two terms may weigh more (or less) together than
apart. Terms alike in both classes have factors like all others; only their own weights
are held back the more, the less their counts differ. Both classes weigh the same in
training, whatever their numbers.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, arrow_limits, is_held_out, only, take_over, texts

#: Hashed terms.
BUCKETS = 1 << 20
#: Beginnings of words that are terms too, by length.
PREFIXES = (4, 5, 6)
#: Most labelled rows that are learnt from, chosen by hash, and about as many terms in all of them as are learnt from at most.
SAMPLE, SAMPLE_TERMS = 20_000, 8_000_000
#: The least rows of a term, and the z-score, either way, from which its weight is learnt first and is not held back.
LEAST_ROWS, CLEAR_Z = 3, 4.0
#: How fast the pull on a weight grows as its z-score falls below that, and where the z-score stops to count.
PULL, LEAST_Z = 8, 0.5
#: Length of a factor vector; passes over the sample with clear terms' weights, with all weights, then with factors too.
FACTORS, CLEAR, ALONE, EPOCHS = 6, 20, 30, 50
#: Steps of weights and of factors, what their squared gradients start from; penalties; rows of a step.
STEP, FACTOR_STEP, FROM, FACTOR_FROM, L1, L2, ROWS = 0.3, 0.1, 1e-6, 1e-2, 2e-5, 1e-3, 256
#: A score from which on a document counts as toxic.
THRESHOLD = 0.7
#: Words whose terms a worker keeps; beyond it starts anew.
KEPT_WORDS = 200_000

_words = re.compile(r"\w+").findall


def terms_of(word: str) -> set[int]:
    """Hashed terms of a lower-case word: itself and its beginnings."""
    found = {"=" + word} | {word[:n] for n in PREFIXES if len(word) >= n}
    return {zlib.crc32(t.encode()) % BUCKETS for t in found}


class Terms:
    """Distinct terms of texts; keeps what it has found for each word."""

    def __init__(self, chosen: dict[int, int] | None = None):
        self.chosen = chosen  # term -> index; None: all terms as they are
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> list[int]:
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        known, out = self.known, set()
        for w in set(_words(text.lower())):
            own = known.get(w)
            if own is None:
                found = terms_of(w)
                own = tuple(found) if self.chosen is None else tuple(self.chosen[t] for t in found if t in self.chosen)
                if len(w) < 64:
                    known[w] = own
            if own:
                out.update(own)
        return sorted(out)


class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of <factor, factor>); each present term counts once."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def raw(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid; flat holds the rows' term indices, each row from its start on."""
        out = np.full(len(starts), float(self.bias))
        full = np.append(starts[1:], len(flat)) > starts
        if full.any():
            at = starts[full]
            squares = np.einsum("ij,ij->i", self.factors, self.factors, dtype=np.float64)
            out[full] += np.add.reduceat((self.weights - 0.5 * squares)[flat], at)
            for own in self.factors.T:
                out[full] += 0.5 * np.add.reduceat(own[flat].astype(np.float64), at) ** 2
        return out

    def scores(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(flat, starts), -30, 30)))


class _Step:
    """Rows of one training step; their terms are numbered anew, so that sums over rows and over terms are short runs."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, each: np.ndarray):
        self.labels, self.each, self.n = labels, each / len(rows), len(rows)
        sizes = np.array([len(r) for r in rows])
        self.full = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes) - sizes)[self.full]
        self.terms, where = np.unique(np.concatenate(rows), return_inverse=True)
        order = np.argsort(where, kind="stable")
        self.rows = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)[order]
        self.runs = np.searchsorted(where[order], np.arange(len(self.terms)))
        self.where = where.astype(np.int32)

    def by_row(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n, np.float32)
        if len(self.full):
            out[self.full] = np.add.reduceat(x[self.where], self.starts)
        return out

    def by_term(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x[self.rows], self.runs) if len(self.runs) else np.zeros(0, np.float32)


def _z_scores(rows: list[np.ndarray], labels: np.ndarray, n_terms: int) -> np.ndarray:
    """By how much each term is commoner in class 1 than in class 0, in standard errors."""
    none = np.zeros(0, np.int32)
    n0, n1 = (np.bincount(np.concatenate([none, *(rows[i] for i in np.flatnonzero(labels == k))]), minlength=n_terms) for k in (0, 1))
    all0, all1 = (labels == 0).sum(), (labels == 1).sum()
    p = (n0 + n1) / len(labels)
    return (n1 / all1 - n0 / all0) / np.sqrt(p * (1 - p) * (1 / all0 + 1 / all1) + 1e-12)


def fit(rows: list[np.ndarray], labels: np.ndarray, n_terms: int, seed: int = 7) -> Machine:
    """Learns by Adagrad on the log loss, with an L1 pull on weights and L2 on factors."""
    rng = np.random.default_rng(seed)
    share = labels.mean()
    each = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    z = np.abs(_z_scores(rows, labels, n_terms))
    pull = (L1 * np.maximum(1, CLEAR_Z / np.maximum(z, LEAST_Z)) ** PULL).astype(np.float32)
    order = rng.permutation(len(rows))
    steps = [_Step([rows[i] for i in pick], labels[pick].astype(np.float32), each[pick]) for pick in (order[at : at + ROWS] for at in range(0, len(order), ROWS))]
    w, v, b = np.zeros(n_terms, np.float32), np.zeros((FACTORS, n_terms), np.float32), 0.0
    gw, gv, gb = np.full(n_terms, FROM, np.float32), np.full((FACTORS, n_terms), FACTOR_FROM, np.float32), FROM
    for epoch in range(EPOCHS):
        if epoch == ALONE:  # single terms first, so that pairs hold only what is theirs
            v = rng.normal(0, 0.01, (FACTORS, n_terms)).astype(np.float32)
        for k in rng.permutation(len(steps)):
            s = steps[k]
            raw = b + s.by_row(w[s.terms])
            if epoch >= ALONE:
                own = v[:, s.terms]
                total = np.stack([s.by_row(x) for x in own])
                raw += 0.5 * ((total * total).sum(0) - s.by_row((own * own).sum(0)))
            err = ((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - s.labels) * s.each).astype(np.float32)
            db = float(err.sum())
            gb += db * db
            b -= STEP * db / gb**0.5
            each_term = s.by_term(err)
            dw = each_term if epoch >= CLEAR else each_term * (z[s.terms] >= CLEAR_Z)
            gw[s.terms] += dw * dw
            rate = STEP / np.sqrt(gw[s.terms])
            stepped = w[s.terms] - rate * dw
            w[s.terms] = np.sign(stepped) * np.maximum(0, np.abs(stepped) - np.minimum(rate, 1.0) * pull[s.terms])
            if epoch < ALONE:
                continue
            dv = np.stack([s.by_term(err * x) for x in total]) - own * each_term + L2 * own
            gv[:, s.terms] += dv * dv
            v[:, s.terms] -= FACTOR_STEP * dv / np.sqrt(gv[:, s.terms])
    return Machine(b, w, np.ascontiguousarray(v.T))


def _sample(docs: DataFrame, labels: DataFrame, space: Workspace) -> DataFrame:
    """label, text_hash, terms of at most SAMPLE labelled rows that are not held out."""
    spark = docs.sparkSession
    chosen = only(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max("toxic").cast("double").alias("label"))
    # Toxic rows are the fewer: each class may fill half of the bound.
    parts = [chosen.where(F.col("label") == k).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE // 2) for k in (0.0, 1.0)]
    chosen = space.save(parts[0].unionAll(parts[1]), "chosen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("toxicity")
        find = Terms()
        for batch in batches:
            found = [np.array(find(t), np.uint32).tobytes() for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([hashlib.blake2b(f, digest_size=16).digest() for f in found], pa.binary()), pa.array(found, pa.binary())], ["label", "same", "terms"])

    joined = docs.join(F.broadcast(chosen), docs.doc_id == chosen["_id"])  # SAMPLE rows at most
    return space.save(joined.select("label", "text").mapInArrow(run, "label double, same binary, terms binary"), "sample")


def _counts(sample: DataFrame) -> DataFrame:
    """term, n0, n1: rows of each class that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for label, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[int(label), np.frombuffer(packed, np.uint32)] += 1
        terms = np.flatnonzero(sums.any(0))
        for at in range(0, len(terms), 1 << 16):
            part = terms[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[0, part].astype(np.int64)), pa.array(sums[1, part].astype(np.int64))], ["term", "n0", "n1"])

    return sample.select("label", "terms").coalesce(8).mapInArrow(run, "term bigint, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, int], Machine]:
    """The chosen terms and the machine. Without rows of both classes every score is that of the only class seen (0.5 without any)."""
    arrow_limits(docs.sparkSession)
    space = Workspace(docs.sparkSession, "toxicity")
    docs = only(docs, "doc_id", "text").where("doc_id is not null")
    sample = _sample(docs, labels, space)
    sample = sample.dropDuplicates(["same", "label"])  # copies teach nothing new
    held = sample.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    if held > 4 * SAMPLE_TERMS:  # long texts: fewer of them, as their hashes have it
        sample = sample.where(F.pmod(F.xxhash64("same"), F.lit(1 << 20)) < int((1 << 20) * 4 * SAMPLE_TERMS / held))
    totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0.0, 0), totals.get(1.0, 0)
    if not n0 or not n1:
        return {}, Machine(3.0 if n1 else -3.0 if n0 else 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    common = _counts(sample).where(((F.col("n0") + F.col("n1")) >= LEAST_ROWS) & ((F.col("n0") + F.col("n1")) < n0 + n1)).select("term").toPandas()  # BUCKETS rows at most
    chosen = {t: k for k, t in enumerate(sorted(common["term"].tolist()))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.array([chosen[t] for t in np.frombuffer(x, np.uint32).tolist() if t in chosen], np.int32).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["label", "same", "terms"])

    rows = sample.mapInArrow(run, "label double, same binary, terms binary").toPandas()  # SAMPLE rows of chosen terms
    rows = rows.sort_values(["same", "label"])  # the same order in each run
    machine = fit([np.frombuffer(t, np.int32) for t in rows["terms"]], rows["label"].to_numpy(), len(chosen))
    space.drop("chosen", "sample")
    return chosen, machine


def score(docs: DataFrame, chosen: dict[int, int], machine: Machine) -> DataFrame:
    """doc_id, score of every row of docs(doc_id, text), by the whole text; null and empty texts score by the bias."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("toxicity")
        find = Terms(chosen)
        for batch in batches:
            rows = [find(t) for t in texts(batch.column(1))]
            sizes = np.array([len(r) for r in rows], np.int64)
            flat = np.array([t for r in rows for t in r], np.int64)
            got = machine.scores(flat, np.cumsum(sizes) - sizes) if len(rows) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    return only(docs, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, that the trained machine scores below the threshold."""
    chosen, machine = train(docs, labels)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("toxicity")
        find = Terms(chosen)
        for batch in batches:
            rows = [find(t) for t in texts(batch.column(place))]
            sizes = np.array([len(r) for r in rows], np.int64)
            if len(rows):
                got = machine.scores(np.array([t for r in rows for t in r], np.int64), np.cumsum(sizes) - sizes)
                yield batch.filter(pa.array(got < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from labels(doc_id, toxic) of rows that are not held out, and scores every document.

    Returns doc_id, held_out, score (0 to 1) and predicted (score >= 0.7) for every row,
    repeated rows and null ids included. Labels that are null or other than 0 and 1 are
    passed over; of contradicting ones the higher counts.
    """
    scored = score(docs, *train(docs, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Quality by co-training: a view of a document's content and a view of its metadata teach each other.

The content view sees the words: hashed words and word pairs weighed by how much
oftener good texts have them, and the words' variety, repetition and make-up. The
metadata view reads no word: source, language, size and the layout of the lines. Both
are logistic regressions over binned measures. In each round either view labels the
unlabelled rows that it is surest of for the other one; at the end both are calibrated
on rows that neither has learnt from, and combined.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, arrow_limits, is_held_out, mix64, only

#: Most labelled and most unlabelled rows that are learnt from, chosen by hash.
LABELLED, POOL = 16_000, 8_000
#: Rounds, and the share of the pool that a view labels in each; how sure it must be.
ROUNDS, GIVES, SURE = 5, 0.05, 0.95
#: Bins of a measure; hashed names of sources; penalty.
BINS, SOURCES, L2 = 8, 64, 1.0
#: Hashed words and word pairs; rows that each class is taken to have more of any of them; the weights' bound.
GRAMS, PRIOR_ROWS, MOST = 1 << 15, 10.0, 3.0
#: Rows whose grams are unpacked at once.
UNPACKED = 512
#: Below this score a document is rejected. Under one half: a clean document lost costs more than a poor one kept.
THRESHOLD = 0.4

_SYMBOLS = [b for b in range(33, 127) if not chr(b).isalnum()]
_STOPS = [ord(c) for c in ".,;:!?"]


def grams(words: list[str]) -> bytes:
    """Hashes of a text's distinct words and of its distinct pairs of neighbours, case apart; packed.

    Few are listed in 16 bits each, more than fit in GRAMS / 8 bytes are kept as one bit for each hash.
    """
    own = {w: zlib.crc32(w.encode()) for w in set(words)}
    codes = np.fromiter(map(own.__getitem__, words), np.uint64, len(words))
    pairs = mix64(codes[:-1] * np.uint64(0x9E3779B1) + codes[1:]) if len(codes) > 1 else codes[:0]
    return packed(np.unique(np.concatenate([codes % np.uint64(GRAMS), pairs % np.uint64(GRAMS)])))


def packed(found: np.ndarray) -> bytes:
    if 2 * len(found) < GRAMS // 8:
        return found.astype(np.uint16).tobytes()
    bits = np.zeros(GRAMS, bool)
    bits[found.astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def unpacked(own: bytes) -> np.ndarray:
    if len(own) < GRAMS // 8:
        return np.frombuffer(own, np.uint16).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(own, np.uint8)))


def content(text: str, words: list[str], hist: np.ndarray) -> list[float]:
    """Measures of the words."""
    n = len(words)
    counts = Counter(words)
    letters = max(1, len(text))
    upper, digits = int(hist[65:91].sum()), int(hist[48:58].sum())
    symbols, stops = int(hist[_SYMBOLS].sum()), int(hist[_STOPS].sum())
    top = counts.most_common(1)[0][1] if n else 0
    return [
        len(counts) / max(1, n) ** 0.8,  # variety falls with length
        top / max(1, n),
        sum(map(operator.eq, words, words[1:])) / max(1, n),
        sum(map(len, words)) / max(1, n),
        upper / letters,
        digits / letters,
        (symbols - stops) / letters,
        stops / letters,
        int(hist[33]) / letters,
    ]


def metadata(text: str, n_bytes: int) -> list[float]:
    """Measures of the page's size and lines, without its words."""
    lines = text.split("\n")
    sizes = np.fromiter(map(len, lines), np.float64, len(lines))
    full = max(1, int((sizes > 0).sum()))
    ends = sum(line[-1:] in (".", "!", "?") for line in lines)
    return [
        log1p(len(text)),
        n_bytes / max(1, len(text)),
        log1p(len(lines)),
        log1p(float(sizes.mean())),
        log1p(float(sizes.max())),
        float((sizes < 30).mean()),
        len(set(lines)) / len(lines),
        ends / full,
    ]


N_CONTENT, N_META = 9, 8


class Rows:
    """Rows of one view: measures, and for the content view their packed grams."""

    def __init__(self, x: np.ndarray, grams: list[bytes] | None = None):
        self.x, self.grams = x, grams

    def __len__(self) -> int:
        return len(self.x)

    def of(self, pick: np.ndarray) -> Rows:
        pick = np.flatnonzero(pick) if pick.dtype == bool else pick
        return Rows(self.x[pick], None if self.grams is None else [self.grams[i] for i in pick.tolist()])

    def __add__(self, more: Rows) -> Rows:
        return Rows(np.concatenate([self.x, more.x]), None if self.grams is None else self.grams + more.grams)

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Some rows at a time: which, their numbers of grams, and their grams one after the other."""
        for at in range(0, len(self), UNPACKED):
            own = [unpacked(g) for g in self.grams[at : at + UNPACKED]]
            yield slice(at, at + len(own)), np.array([len(g) for g in own]), np.concatenate(own)


def features(batch: pa.RecordBatch) -> tuple[Rows, Rows]:
    """Both views' rows of (text, source, lang); the metadata view ends with the codes of source and language."""
    a, g, b = [], [], []
    for text, source, lang in zip(*(batch.column(k).to_pylist() for k in range(3))):
        text = text or ""
        raw, words = text.encode(), text.split()
        hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        a.append(content(text, words, hist))
        g.append(grams(words))
        b.append(metadata(text, len(raw)) + [float(zlib.crc32((source or "").encode()) % SOURCES), float(zlib.crc32((lang or "").encode()) % SOURCES)])
    return Rows(np.array(a, np.float32).reshape(-1, N_CONTENT), g), Rows(np.array(b, np.float32).reshape(-1, N_META + 2))


class Lexicon:
    """For each gram, the log of how much likelier a good row has it than a poor one."""

    def __init__(self, rows: Rows, y: np.ndarray, weight: np.ndarray):
        n = np.zeros((2, GRAMS))
        for part, sizes, flat in rows.blocks():
            for k in (0, 1):
                n[k] += np.bincount(flat, np.repeat((y[part] == k) * weight[part], sizes), GRAMS)
        total = [((y == k) * weight).sum() for k in (0, 1)]
        share = (n[0] + n[1] + PRIOR_ROWS) / (sum(total) + 2 * PRIOR_ROWS)
        odds = [np.log((n[k] + PRIOR_ROWS * share) / (total[k] + PRIOR_ROWS)) for k in (0, 1)]
        self.weights = np.clip(odds[1] - odds[0], -MOST, MOST)

    def __call__(self, rows: Rows) -> np.ndarray:
        """The mean weight of each row's grams; none: 0."""
        out = np.zeros(len(rows))
        for part, sizes, flat in rows.blocks():
            full = sizes > 0
            if full.any():
                sums = np.zeros(len(sizes))
                sums[full] = np.add.reduceat(self.weights[flat], (np.cumsum(sizes) - sizes)[full])
                out[part] = sums / np.maximum(1, sizes)
        return out


class View:
    """Logistic regression on measures cut into bins by the sample's quantiles, and on coded names."""

    def __init__(self, sample: np.ndarray, names: int):
        self.n, self.names = sample.shape[1] - names, names
        self.cuts = [self._cuts(sample[:, k]) for k in range(self.n)]
        self.lexicon: Lexicon | None = None
        self.slope, self.shift = 1.0, 0.0

    @staticmethod
    def _cuts(x: np.ndarray) -> np.ndarray:
        # the tails matter most: cut them finely too
        return np.unique(np.quantile(x, [0.01, 0.03, *np.linspace(0, 1, BINS + 1)[1:-1], 0.97, 0.99])) if len(x) else np.zeros(0)

    def _codes(self, rows: Rows, lexical: np.ndarray | None) -> np.ndarray:
        own = [np.searchsorted(c, rows.x[:, k], "right") for k, c in enumerate(self.cuts)]
        sizes = [len(c) + 1 for c in self.cuts]
        if lexical is not None:
            own.append(np.searchsorted(self.lexical_cuts, lexical, "right"))
            sizes.append(len(self.lexical_cuts) + 1)
        own += [rows.x[:, k].astype(int) for k in range(self.n, rows.x.shape[1])]
        sizes += [SOURCES] * self.names
        self.ends = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        return np.stack(own, 1) + self.ends[:-1] if len(rows) else np.zeros((0, len(sizes)), int)

    def fit(self, rows: Rows, y: np.ndarray, weight: np.ndarray, rounds: int = 12) -> None:
        """Newton steps on the log loss; each row counts by its weight.

        A row's grams are weighed by the lexicon of the other half of the rows, so that
        the regression does not take what was learnt from a row for evidence on it.
        """
        lexical = None
        if rows.grams is not None:
            half, lexical = np.arange(len(rows)) % 2 == 0, np.zeros(len(rows))
            for part in (half, ~half):
                lexical[part] = Lexicon(rows.of(~part), y[~part], weight[~part])(rows.of(part))
            self.lexical_cuts, self.lexicon = self._cuts(lexical), Lexicon(rows, y, weight)
        codes = self._codes(rows, lexical)
        x = np.zeros((len(codes), self.ends[-1] + 1))
        np.put_along_axis(x, codes, 1.0, 1)
        x[:, -1] = 1
        w = np.zeros(x.shape[1])
        ridge = np.full(len(w), L2)
        ridge[-1] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
            step = np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge * w)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def raw(self, rows: Rows) -> np.ndarray:
        return self.weights[self._codes(rows, self.lexicon(rows) if self.lexicon else None)].sum(1) + self.weights[-1]

    def calibrate(self, rows: Rows, y: np.ndarray, weight: np.ndarray) -> None:
        """Slope and shift of the raw score that suit rows it has not learnt from."""
        z = self.raw(rows)
        x, w = np.stack([z, np.ones(len(z))], 1), np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag([1e-2, 1e-2])
            w -= np.linalg.solve(h, x.T @ (weight * (p - y)) + 1e-2 * (w - [1, 0]))
        self.slope, self.shift = max(0.0, float(w[0])), float(w[1])

    def logit(self, rows: Rows) -> np.ndarray:
        return np.clip(self.slope * self.raw(rows) + self.shift, -12, 12)


class Judge:
    """Both views and the share of good rows."""

    def __init__(self, content_view: View | None, meta_view: View | None, prior: float):
        self.views, self.prior = (content_view, meta_view), prior

    def scores(self, a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined score and each view's own: log odds add up, less the share that both count."""
        if self.views[0] is None:
            same = np.full(len(a), 1 / (1 + np.exp(-self.prior)))
            return same, same, same
        own = [v.logit(x) for v, x in zip(self.views, (a, b))]
        both = own[0] + own[1] - self.prior
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (both, *own))


def co_train(a: Rows, b: Rows, y: np.ndarray, fold: np.ndarray, pool_a: Rows, pool_b: Rows, counts: tuple[float, float] = (1.0, 1.0)) -> Judge:
    """y: 1, 0; fold: rows kept for calibration; counts: rows that one of class 0 and one of class 1 stand for."""
    if len(y) == 0 or y.min() == y.max():
        return Judge(None, None, 0.0 if not len(y) else 3.0 if y[0] else -3.0)
    weight = np.where(y == 1, counts[1], counts[0])
    weight = weight / weight.mean()  # as many rows as there are, in the classes' own shares
    share = float((weight * y).mean())
    views = [View(np.concatenate([a.x, pool_a.x]), 0), View(np.concatenate([b.x, pool_b.x]), 2)]
    learn = ~fold if len(set(y[~fold])) == 2 and len(set(y[fold])) == 2 else np.ones(len(y), bool)
    pool = [pool_a, pool_b]
    rows, marks, weights = [a.of(learn), b.of(learn)], [y[learn], y[learn]], [weight[learn], weight[learn]]
    free = [np.ones(len(pool_a), bool), np.ones(len(pool_a), bool)]
    for _ in range(ROUNDS):
        for v, r, m, u in zip(views, rows, marks, weights):
            v.fit(r, m, u)
        for k, other in ((0, 1), (1, 0)):  # k labels for the other
            p = 1 / (1 + np.exp(-views[k].raw(pool[k])))
            for sure, mark in ((p, 1.0), (1 - p, 0.0)):
                part = share if mark else 1 - share
                can = np.flatnonzero(free[other] & (sure >= SURE))
                take = can[np.argsort(-sure[can], kind="stable")[: int(GIVES * len(p) * part) + 1]]
                free[other][take] = False
                rows[other] = rows[other] + pool[other].of(take)
                marks[other] = np.concatenate([marks[other], np.full(len(take), mark)])
                weights[other] = np.concatenate([weights[other], np.ones(len(take))])
    rest = ~learn if not learn.all() else learn
    for v, r, m, u, own in zip(views, rows, marks, weights, (a, b)):
        v.fit(r, m, u)
        v.calibrate(own.of(rest), y[rest], weight[rest])
    return Judge(*views, float(np.log(share / (1 - share))))


def train(docs: DataFrame, labels: DataFrame) -> Judge:
    """Learns from labels(doc_id, quality) of rows that are not held out, and from unlabelled rows of docs.

    Each class may fill half of LABELLED; its rows then count for all of their class.
    """
    arrow_limits(docs.sparkSession)
    space = Workspace(docs.sparkSession, "quality")
    docs = only(docs, "doc_id", "text", "lang", "source").where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    marks = only(labels, "doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.min("quality").cast("double").alias("y"))
    order = [F.xxhash64("_id", F.lit(3)), F.col("_id")]
    own = marks.where(~is_held_out(F.col("_id")))
    totals = {r.y: r.n for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    counts = tuple(max(1.0, totals.get(k, 0) / (LABELLED // 2)) for k in (0.0, 1.0))
    parts = [own.where(F.col("y") == k).orderBy(*order).limit(LABELLED // 2) for k in (0.0, 1.0)]
    ids = docs.select(F.col("doc_id").alias("_id")).distinct()
    free = ids.join(marks.select("_id"), "_id", "left_anti").orderBy(*order).limit(POOL).withColumn("y", F.lit(-1.0))
    chosen = space.save(parts[0].unionAll(parts[1]).unionAll(free), "chosen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = features(batch)
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(4), *(pa.array([x.tobytes() for x in r.x], pa.binary()) for r in (a, b)), pa.array(a.grams, pa.binary())], ["id", "y", "a", "b", "g"])

    joined = docs.join(F.broadcast(chosen), docs.doc_id == chosen["_id"])  # LABELLED + POOL rows at most
    found = joined.select("text", "source", "lang", "_id", "y").mapInArrow(run, "id bigint, y double, a binary, b binary, g binary").dropDuplicates(["id"])
    rows = found.toPandas().sort_values("id")
    a = Rows(np.frombuffer(b"".join(rows["a"]), np.float32).reshape(-1, N_CONTENT), rows["g"].tolist())
    b = Rows(np.frombuffer(b"".join(rows["b"]), np.float32).reshape(-1, N_META + 2))
    y, fold = rows["y"].to_numpy(), np.array([zlib.crc32(b"%d" % i) // 3 % 4 == 0 for i in rows["id"]], bool)
    space.drop("chosen")
    know = y >= 0
    return co_train(a.of(know), b.of(know), y[know], fold[know], a.of(~know), b.of(~know), counts)


def score(docs: DataFrame, judge: Judge) -> DataFrame:
    """doc_id, score, content_score, meta_score of every row, by whole texts; null and empty texts are judged as empty."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = judge.scores(*features(batch))
            yield pa.RecordBatch.from_arrays([batch.column(3), *(pa.array(x, pa.float64()) for x in got)], ["doc_id", "score", "content_score", "meta_score"])

    return only(docs, "text", "source", "lang", "doc_id").selectExpr("text", "source", "lang", "cast(doc_id as bigint) doc_id").mapInArrow(run, "doc_id bigint, score double, content_score double, meta_score double")


def without_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, that score at least the threshold."""
    judge = train(docs, labels)
    places = [docs.columns.index(n) for n in ("text", "source", "lang")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = judge.scores(*features(pa.RecordBatch.from_arrays([batch.column(k) for k in places], ["text", "source", "lang"])))[0]
                yield batch.filter(pa.array(got >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better), content_score, meta_score, predicted (1: keep) of every row.

    docs: doc_id, text, lang, source. Repeated rows and null ids are scored like others;
    null names count as empty. Labels that are null or other than 0 and 1 are passed over;
    of contradicting ones the lower counts. Without rows of both classes all scores are
    those of the one class (0.5 without any).
    """
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "content_score", "meta_score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

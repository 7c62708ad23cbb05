"""Exact top-k search by inner product over a pivot-distance index.

One more coordinate makes all vectors equally long, so that the highest inner products
are the nearest neighbours. Each vector is keyed by its nearest pivot and its distance
from it; sorted by that key, a pivot's vectors fall into annuli. A query first visits
the annuli that lie nearest; the scores found bound its search: by the triangle
inequality an annulus whose distances from its pivot all differ from the query's by
more than the search radius holds no result and is left out.

Distances and bounds are rounded, and allowances for that are added; scores are whole
numbers. Where products of the data's components cannot be summed exactly as doubles,
the rounded scores only choose whose exact score is computed.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, arrow_limits, only

#: Pivots, and the sampled vectors that they are fitted on.
PIVOTS, FIT_ROWS = 64, 4096
#: Distance bins of a pivot, vectors of an annulus (about), and annuli that each query visits first.
BINS, ANNULUS, FIRST = 256, 1024, 2
#: Queries that are compared with an annulus at once.
QUERY_BLOCK = 256
#: Fixed value: components count in parts of this.
SCALE = 1024


#: From here on doubles have no fractions of 1 / SCALE left.
_WHOLE = float(1 << 43)


def quantised(rows: DataFrame) -> DataFrame:
    """vec_id, v: components as floor(1024 * x) / 1024, of the vectors that take part; doubles hold these exactly."""
    x = only(rows, "vec_id", "embedding").select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    bad = F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    cut = F.transform("e", lambda c: F.when(F.abs(c) >= _WHOLE, c).otherwise(F.floor(c * float(SCALE)).cast("double") / float(SCALE)))
    return x.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & ~F.coalesce(bad, F.lit(True))).select("vec_id", cut.alias("v"))


def whole(v: np.ndarray) -> list[int]:
    """The integers floor(1024 * x), of any size."""
    return [int(x) * SCALE if abs(x) >= _WHOLE else int(x * SCALE) for x in v.tolist()]


class Index:
    """Pivots and annuli; small, whatever the number of vectors."""

    def __init__(self, dims: int, largest: float):
        self.dims = dims
        #: the largest absolute integer, and whether sums of products are exact as doubles
        self.most = max(1, *map(abs, whole(np.array([largest]))))
        self.exact = dims * self.most**2 < 1 << 53
        #: doubles in use are integers if exact, else parts of the largest
        self.unit = 1 / SCALE if self.exact else max(largest, 1 / SCALE)
        #: bytes that order any score
        self.width_of_key = (dims * self.most**2).bit_length() // 8 + 1
        self.top = 0.0  # the largest squared length
        self.pivots = np.zeros((1, dims + 1))
        self.cells = np.zeros((0, 5))  # pivot, first bin, least and largest distance, parts
        self.width = 1.0

    def raw(self, packed: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), self.dims)

    def unpack(self, packed: list[bytes]) -> np.ndarray:
        return self.raw(packed) / self.unit

    def allowance(self) -> float:
        """What rounding may add to or take from a bound: roots of squared distances lose half their digits."""
        return 4e-7 * (self.dims + 3) ** 0.5 * self.top

    def key(self, score: int) -> bytes:
        return (score + (1 << (8 * self.width_of_key - 1))).to_bytes(self.width_of_key, "big")

    def of_key(self, key: bytes) -> float:
        """A key's score in the units of the doubles."""
        score = int.from_bytes(key, "big") - (1 << (8 * self.width_of_key - 1))
        return float(score) if self.exact else score / self.most**2

    def scores(self, query: bytes, held: list[bytes], rounded: np.ndarray) -> list[int]:
        """Exact integer inner products of the query with the held vectors; rounded: the same as doubles."""
        if self.exact:
            return [int(x) for x in rounded.tolist()]
        q = whole(self.raw([query])[0])
        return [sum(map(operator.mul, q, whole(v))) for v in self.raw(held)]

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """x with the coordinate that makes all lengths equal."""
        return np.hstack([x, np.sqrt(np.maximum(0, self.top - (x * x).sum(1)))[:, None]])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """From each (lifted) row to each pivot."""
        square = (x * x).sum(1)[:, None] - 2 * x @ self.pivots.T + (self.pivots**2).sum(1)
        return np.sqrt(np.maximum(0, square))

    def fit(self, x: np.ndarray) -> None:
        """Pivots: means of the sample's groups after a few rounds."""
        x = self.lifted(x)
        rng = np.random.default_rng(11)
        self.pivots = x[np.sort(rng.permutation(len(x))[:PIVOTS])]
        for _ in range(5):
            near = self.distances(x).argmin(1)
            self.pivots = np.stack([x[near == k].mean(0) if (near == k).any() else p for k, p in enumerate(self.pivots)])
        self.width = max(1e-9, 2.0 * (2 * self.top) ** 0.5 / BINS)  # no two points lie farther apart than twice their length

    def best_scores(self, q: np.ndarray) -> np.ndarray:
        """For each query and cell: no vector of the cell scores higher."""
        far = self.distances(np.hstack([q, np.zeros((len(q), 1))]))[:, self.cells[:, 0].astype(int)]
        gap = np.maximum(0, np.maximum(far - self.cells[:, 3], self.cells[:, 2] - far))
        return ((q * q).sum(1)[:, None] + self.top - gap * gap) / 2


def _cells(histogram: list) -> np.ndarray:
    """Neighbouring bins of a pivot, joined until they hold an annulus's vectors."""
    out, bins = [], {}
    now = None
    for pivot, b, n, lo, hi in sorted(histogram):
        if now is None or now[0] != pivot or now[4] >= ANNULUS:
            now = [pivot, b, lo, hi, 0]
            out.append(now)
        now[2], now[3], now[4] = min(now[2], lo), max(now[3], hi), now[4] + n
        bins[pivot, b] = len(out) - 1
    for c in out:
        c[4] = max(1, -(-c[4] // (2 * ANNULUS)))
    return np.array(out, float).reshape(-1, 5), bins


def _packing(v: DataFrame, dims: int) -> DataFrame:
    """v as bytes, filled up with zeros to dims."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for x in batch.column(1):
                full = np.zeros(dims)
                own = x.values.to_numpy()
                full[: len(own)] = own
                packed.append((full + 0.0).tobytes())  # no negative zeros
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["vec_id", "packed"])

    return v.mapInArrow(run, "vec_id bigint, packed binary")


def _visits(queries: DataFrame, index: Index, first: bool) -> DataFrame:
    """qid, packed, least (key of the lowest score that still counts), cell of each annulus to visit.

    first: the FIRST annuli of the best bounds; else all others that may hold a result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = index.best_scores(index.unpack(batch.column(1).to_pylist()))
            order = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
            pick = np.zeros(bound.shape, bool)
            np.put_along_axis(pick, order, True, 1)
            least = np.array([-np.inf if x is None else index.of_key(x) for x in batch.column(2).to_pylist()])
            if not first:
                pick = ~pick & (bound >= least[:, None] - index.allowance())
            row, cell = np.nonzero(pick)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns), pa.array(cell.astype(np.int32))], ["qid", "packed", "least", "cell"])

    return queries.select("qid", "packed", "least").mapInArrow(run, "qid bigint, packed binary, least binary, cell int")


def _best(found: DataFrame, keep: int) -> DataFrame:
    """Each query's `keep` best of found(qid, vec_id, key, score)."""
    ranked = Window.partitionBy("qid").orderBy(F.col("key").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= keep).drop("rank")


def _search(visits: DataFrame, items: DataFrame, index: Index, keep: int) -> DataFrame:
    """qid, vec_id, key, score of the best in each visited annulus, `keep` ids at most for each.

    key: bytes that order exact scores of any size; score: the score, or the end of the long range beyond which it lies.
    """
    blocks = visits.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))  # a row for each annulus
    left = items.join(F.broadcast(blocks), "cell").select("cell", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("bigint").alias("qid"), "packed", F.lit(None).cast("binary").alias("least"), "ids")
    parts = items.groupBy("cell").agg(F.max("parts").alias("parts"))
    right = visits.join(F.broadcast(blocks), "cell").join(F.broadcast(parts), "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.expr("cast(pmod(xxhash64(qid), blocks) as int) block"), "qid", "packed", "least", F.array().cast("array<bigint>").alias("ids"))
    dealt = left.unionAll(right).repartition("cell", "part", "block").sortWithinPartitions("cell", "part", "block", F.col("qid").asc_nulls_first())
    slack = 0.0 if index.exact else 1e-15 * (index.dims + 3) * index.top  # of a rounded score, either way

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, packed, ids, held = None, [], [], None

        for batch in batches:
            out = []
            cols = [c.to_pylist() for c in batch.columns]
            asked: list[int] = []

            def answer(asked=asked, cols=cols, out=out):
                if asked and len(held):
                    rounded = index.unpack([cols[4][r] for r in asked]) @ held.T
                    top = min(keep, held.shape[0])
                    for r, own in zip(asked, rounded):
                        floor = np.partition(own, -top)[-top]
                        if cols[5][r] is not None:
                            floor = max(floor, index.of_key(cols[5][r]))
                        near = np.flatnonzero(own >= floor - 2 * slack).tolist()
                        exact = index.scores(cols[4][r], [packed[k] for k in near], own[near])
                        best = sorted((-s, v) for k, s in zip(near, exact) for v in ids[k])[:keep]
                        out.extend((cols[3][r], v, index.key(-s), max(-(1 << 63), min((1 << 63) - 1, -s))) for s, v in best)
                asked.clear()

            for r in range(batch.num_rows):
                key = (cols[0][r], cols[1][r], cols[2][r])
                if key != unit:
                    answer()
                    unit, packed, ids, held = key, [], [], None
                if cols[3][r] is None:
                    packed.append(cols[4][r])
                    ids.append(cols[6][r])
                else:
                    if held is None:
                        held = index.unpack(packed) if packed else np.zeros((0, index.dims))
                    asked.append(r)
            answer()
            q, v, k, s = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(k, pa.binary()), pa.array(s, pa.int64())], ["qid", "vec_id", "key", "score"])

    return _best(dealt.mapInArrow(run, "qid bigint, vec_id bigint, key binary, score bigint"), keep)


def top_k(rows: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products, ties to the smaller vec_id.

    rows: vec_id, embedding. Queries are the rows whose vec_id is divisible by `every`;
    candidates all rows but the query's own. Rows whose id or vector is null, or whose
    components are null or not finite, take no part. Scores are exact whatever the
    components' size and rank as such; one outside the long range is returned as the
    end of that range. Shorter vectors count as filled up with zeros. Repeated rows
    count once; an id with several vectors is a query, and a candidate, with each.
    Among equal vectors only the k + 1 smallest ids can be results, so no more are
    kept. With fewer candidates all are returned.
    """
    spark = rows.sparkSession
    arrow_limits(spark, 1024)
    space = Workspace(spark, "top-k")
    v = space.save(quantised(rows), "vectors")
    shape = v.agg(F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    index = Index(max(1, shape.dims or 1), float(shape.most or 0))
    part = F.lit(index.unit)
    index.top = v.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + (c / part) * (c / part)))).first()[0] or 0.0
    packed = space.save(_packing(v, index.dims), "packed")
    same = Window.partitionBy("packed").orderBy("vec_id")
    few = packed.distinct().withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    items = space.save(few.groupBy("packed").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "items")  # k + 1 ids at most
    sample = items.select("packed").orderBy(F.xxhash64("packed")).limit(FIT_ROWS).collect()
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    index.fit(index.unpack([bytes(r.packed) for r in sample]))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = index.distances(index.lifted(index.unpack(batch.column(0).to_pylist())))
                near = far.argmin(1)
                d = far[np.arange(len(near)), near]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(d), pa.array((d / index.width).astype(np.int32))], ["packed", "ids", "pivot", "distance", "bin"])

    items = space.save(items.mapInArrow(keyed, "packed binary, ids array<bigint>, pivot int, distance double, bin int"), "keyed")
    counts = items.groupBy("pivot", "bin").agg(F.count("*").alias("n"), F.min("distance").alias("lo"), F.max("distance").alias("hi")).collect()  # PIVOTS * BINS rows at most
    index.cells, bins = _cells([tuple(r) for r in counts])
    table = spark.createDataFrame([(p, b, c, int(index.cells[c, 4])) for (p, b), c in bins.items()], "pivot int, bin int, cell int, parts int")
    items = items.join(F.broadcast(table), ["pivot", "bin"]).withColumn("part", F.expr("cast(pmod(xxhash64(packed), parts) as int)"))
    # A partition's rows lie sorted by pivot and distance.
    items = space.save(items.repartitionByRange("cell", "part", "distance").sortWithinPartitions("cell", "part", "distance").select("cell", "part", "parts", "packed", "ids"), "annuli")

    asked = packed.where(F.col("vec_id") % every == 0).distinct()
    queries = space.save(asked.groupBy("packed").agg(F.min("vec_id").alias("qid0")), "queries")
    # Equal query vectors are searched once, under a number of their own.
    queries = space.save(queries.select("packed", F.xxhash64("packed", "qid0").alias("qid")), "numbered")
    near = space.save(_search(_visits(queries.withColumn("least", F.lit(None).cast("binary")), index, True), items, index, k + 1), "near")
    kth = near.groupBy("qid").agg(F.count("*").alias("n"), F.min("key").alias("least")).where(F.col("n") >= k + 1).select("qid", "least")
    rest = _search(_visits(queries.join(kth, "qid", "left"), index, False), items, index, k + 1)
    # Written, so that a vector that very many ids ask for can be split in the join.
    best = space.save(_best(near.unionAll(rest), k + 1), "best")
    found = asked.join(queries, "packed").select(F.col("vec_id").alias("query_id"), "qid").join(best, "qid").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.col("key").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

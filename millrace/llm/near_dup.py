"""Near-duplicate documents by HyperMinHash sketches, banding and verification.

A document's distinct word shingles are hashed once. The hash's high bits choose one
of 288 registers; a register keeps, of the least second hash that it gets, the count
of leading zeros and ten mantissa bits. Empty registers borrow from full ones in a
fixed random order of their own. Bands of six compressed registers make the buckets.

Within a bucket documents are not paired all with all. Copies with equal shingle sets
are one node. Each bucket has a pivot; its members are compared with the pivot, first
by size and the collision-corrected estimate of the sketches, then on the full sets.
Members of buckets that still span several components go through an exact prefix
index: pairs of different components whose rarest shingles meet, and whose sizes and
positions allow the threshold, pass the same estimate and the same verification.
So each pair that meets in a bucket is verified or already connected: links of
different texts are lost only if no band of theirs agrees (below 1 in a million at
the threshold) or if the estimate is more than five deviations low.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Workspace, arrow_limits, mix64, only, take_over
from .components import components

#: Bands and registers of each: at similarity 0.8 no band agrees with probability 4e-7.
BANDS, ROWS = 48, 6
REGISTERS = BANDS * ROWS
#: Bits of a register's mantissa.
MANTISSA = 10
#: Deviations of the estimate that a pair may lie under the threshold and still be verified.
SLACK_DEVIATIONS = 5
#: Low bits of a bucket's key that hold its band.
BAND_BITS = 6
#: Members that are verified against one copy of their pivot's set.
PER_PIVOT_COPY = 64
#: Bytes that are hashed at once; longer words are hashed on their own.
SEGMENT, LONG_WORD = 1 << 20, 1 << 16

_ODD = 0x9E3779B97F4A7C15 | 1
_ALL = (1 << 64) - 1


def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = SEGMENT + LONG_WORD + 2
    up, down = np.full(n, _ODD, np.uint64), np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_tables: dict[str, object] = {}


def _table(name: str, make: Callable[[], object]):
    if name not in _tables:
        _tables[name] = make()
    return _tables[name]


# --- Shingles ---------------------------------------------------------------------


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]: a polynomial over its bytes, mixed with its length."""
    up, down = _table("powers", _powers)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        if ends[i] - starts[i] > LONG_WORD:
            out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        wide = np.flatnonzero(ends[i:j] - starts[i:j] > LONG_WORD)
        j = i + int(wide[0]) if len(wide) else j
        s, e, base = starts[i:j] - starts[i], ends[i:j] - starts[i], starts[i]
        part = data[base : base + e[-1]].astype(np.uint64)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * up[: len(part)], out=total[1:])
        out[i:j] = mix64((total[e] - total[s]) * down[s] ^ ((e - s).astype(np.uint64) << np.uint64(40)))
        i = j
    return out


def shingle_sets(text: pa.Array, words: int = 2) -> list[np.ndarray]:
    """For each text (null: empty) the sorted 64-bit hashes of its distinct word shingles.

    Words are runs of non-white-space, A-Z in lower case. Fewer words than a shingle
    holds make one shingle; no words, an empty set.
    """
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if text.null_count:
        text = text.fill_null("" if pa.types.is_string(text.type) else b"")
    width = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    bounds = np.frombuffer(text.buffers()[1], width)[text.offset : text.offset + len(text) + 1].astype(np.int64) if len(text) else np.zeros(1, np.int64)
    if bounds[-1] == bounds[0]:
        return [np.zeros(0, np.uint64)] * len(text)
    data = np.frombuffer(text.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(inside & (cut[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (cut[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    hashes = _word_hashes(data, starts, ends)
    first = np.searchsorted(starts, bounds)
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            n = min(words, b - a)
            if not n:
                out.append(np.zeros(0, np.uint64))
                continue
            mixed = np.full(b - a - n + 1, n, np.uint64)
            for k in range(n):
                mixed = mix64(mixed * np.uint64(_ODD) + hashes[a + k : b - n + 1 + k])
            out.append(np.unique(mixed))
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


# --- HyperMinHash -----------------------------------------------------------------


def _borrowing() -> np.ndarray:
    """Row j: the order in which register j, if empty, looks for a full one."""
    order = np.random.default_rng(20240229).permuted(np.tile(np.arange(REGISTERS, dtype=np.int32), (REGISTERS, 1)), axis=1)
    return np.argsort(order, axis=1).astype(np.uint16)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The compressed registers (leading zeros << 10 | mantissa) of a non-empty set of sorted hashes."""
    where = ((shingles >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)  # ascends with the hashes
    heads = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
    least = np.minimum.reduceat(mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11), heads)
    zeros = 53 - np.frexp(least.astype(np.float64))[1]
    mantissa = ((least << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    kept = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    full = where[heads].astype(np.int64)
    if len(full) == REGISTERS:
        return kept
    return kept[_table("borrowing", _borrowing)[:, full].argmin(axis=1)]


def band_keys(registers: np.ndarray) -> np.ndarray:
    """registers: n x 288 -> n x 48 bucket keys; the last bits hold the band."""
    grouped = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(BANDS, dtype=np.uint64) * np.uint64(_ODD), (len(registers), 1))
        for k in range(ROWS):
            key = mix64(key * np.uint64(_ODD) + grouped[:, :, k])
    return ((key & np.uint64(_ALL ^ ((1 << BAND_BITS) - 1))) | np.arange(BANDS, dtype=np.uint64)).astype(np.int64)


def estimated(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from agreeing registers, less the agreements expected by chance.

    The chance grows with the evenness of the sizes and halves with each mantissa bit.
    """
    ratio = np.maximum(n_a, n_b) / np.maximum(1, np.minimum(n_a, n_b))
    chance = 0.169919487159739093975315012348630288992889 * 4 * ratio / (1 + ratio) ** 2 / 2**MANTISSA
    return (a == b).mean(axis=-1) - chance


def floor_of_estimate(threshold: float) -> float:
    return threshold - SLACK_DEVIATIONS * (threshold * (1 - threshold) / REGISTERS) ** 0.5


# --- The operator -----------------------------------------------------------------


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest, sketch (null for an empty set) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("near-dup")
        for batch in batches:
            sets = shingle_sets(batch.column(1), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "n_shingles", "digest", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, sketch binary")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _bands(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_registers(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(pa.array(np.arange(batch.num_rows).repeat(BANDS)))], ["bucket", "node"])

    return nodes.select("node", "sketch").mapInArrow(run, "bucket bigint, node bigint")


def _likely(pairs: DataFrame, nodes: DataFrame, floor: float, percent: int) -> DataFrame:
    """Those of pairs(a, b) whose sizes allow the threshold and whose sketches come near it."""
    left = nodes.selectExpr("node a", "n_shingles n_a", "sketch s_a")
    right = nodes.selectExpr("node b", "n_shingles n_b", "sketch s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
                good = estimated(_registers(batch.column(3)), _registers(batch.column(5)), n_a, n_b) >= floor
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns[:2]], ["a", "b"])

    sized = pairs.join(left, "a").join(right, "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return sized.select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(run, "a bigint, b bigint")


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, words: int, space: Workspace, name: str) -> DataFrame:
    """node, shingles (packed) of the wanted nodes, from their texts."""
    ids = space.save(wanted.join(nodes.select("node", "digest"), "node"), f"{name}-ids")
    few = ids.count() <= BROADCAST_ROWS  # checked: ids and 16-byte digests; beyond it the texts are shuffled
    found = docs.join(F.broadcast(ids) if few else ids, docs.doc_id == ids.node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), words)
            same = pa.array([set_digest(s) == d for s, d in zip(sets, batch.column(2).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(same), pa.array([s.tobytes() for s in sets], pa.binary()).filter(same)], ["node", "shingles"])

    # a repeated row, or another text under a node's id, gives no second set
    return space.save(found.select("node", "text", "digest").mapInArrow(run, "node bigint, shingles binary").dropDuplicates(["node"]), name)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, space: Workspace, name: str) -> DataFrame:
    """Those of pairs(a, b) with 100 * intersection >= percent * union, on the full sets.

    Rows are dealt by pivot a and a copy number, each pivot's set ahead of its members',
    and compared as they stream by: one pivot's set is held at a time.
    """
    # Written first, so that a pivot's rows can be split in the joins.
    per = space.save(pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("copies", F.ceil(F.col("n") / PER_PIVOT_COPY).cast("int")), f"{name}-pivots")
    members = pairs.join(per.select("a", "copies"), "a").selectExpr("a", "cast(pmod(xxhash64(b), copies) as int) copy", "b")
    members = members.join(sets, members.b == sets.node).selectExpr("a", "copy", "b", "shingles")
    pivots = per.join(sets, per.a == sets.node).selectExpr("a", "explode(sequence(0, copies - 1)) copy", "cast(null as bigint) b", "shingles")
    dealt = pivots.unionAll(members).repartition("a", "copy").sortWithinPartitions("a", "copy", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, held = np.zeros(0, np.uint64), None
        for batch in batches:
            good = []
            for a, copy, b, packed in zip(*(batch.column(k).to_pylist() for k in range(4))):
                own = np.frombuffer(packed, np.uint64)
                if b is None:
                    pivot, held = own, (a, copy)
                    good.append(False)
                    continue
                if held != (a, copy):
                    raise RuntimeError("a pivot's set is missing")
                at = np.searchsorted(pivot, own)
                both = int((pivot[np.minimum(at, len(pivot) - 1)] == own).sum())
                good.append(100 * both >= percent * (len(pivot) + len(own) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(2).filter(keep)], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _tokens(sets: DataFrame) -> DataFrame:
    """A row for each shingle of sets(node, component, shingles): token, node, component, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(2).to_pylist()
            sizes = np.array([len(x) // 8 for x in packed], np.int64)
            at = pa.array(np.arange(len(packed)).repeat(sizes))
            token = pa.array(np.frombuffer(b"".join(packed), np.int64))
            yield pa.RecordBatch.from_arrays([token, batch.column(0).take(at), batch.column(1).take(at), pa.array(sizes.repeat(sizes))], ["token", "node", "component", "n"])

    return sets.select("node", "component", "shingles").mapInArrow(run, "token bigint, node bigint, component bigint, n bigint")


def _prefixes(sets: DataFrame, percent: int, space: Workspace) -> DataFrame:
    """token, node, component, n, pos of each shingle that a link to another component can begin with.

    Shingles rank by rarity: those of one component only come first, all others by the
    number of sets that hold them. Two sets of similarity percent / 100 share one of
    the first n - ceil(n * percent / 100) + 1 of either, so no others are kept.
    """
    tokens = space.save(_tokens(sets), "tokens")
    shared = space.save(tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token", "df"), "shared")
    ranked = tokens.join(shared, "token").groupBy("node").agg(F.first("component").alias("component"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ts"))  # a set's own shingles at most
    ranked = ranked.withColumn("own", F.expr("n - size(ts)")).withColumn("room", F.expr(f"cast(n - ceil(n * {percent} / 100) + 1 - own as int)")).where("room > 0")
    listed = ranked.select("node", "component", "n", "own", F.posexplode(F.expr("slice(ts, 1, room)")).alias("i", "t"))
    return listed.select("t.token", "node", "component", "n", F.expr("own + i").alias("pos"))


def _across(sets: DataFrame, percent: int, space: Workspace) -> DataFrame:
    """Pairs of different components that may be links, by an exact prefix index over sets(node, component, shingles).

    A pair is looked at where its prefixes share a shingle. What precedes it in either
    set is not in the other one, which bounds the intersection; sizes are bounded too.
    In a shingle's list the component with most members is only looked up by members
    of the others, so a large class costs nothing by itself.
    """
    rows = space.save(_prefixes(sets, percent, space), "prefixes")
    space.drop("tokens")
    each = rows.groupBy("token", "component").agg(F.count("*").alias("c"))
    # Written first, so that a common shingle's rows can be split in the join.
    lists = space.save(each.groupBy("token").agg(F.max_by("component", F.struct("c", "component")).alias("major"), F.count("*").alias("several")).where("several > 1").select("token", "major"), "majors")
    rows = space.save(rows.join(lists, "token").withColumn("is_major", F.expr("component = major")).drop("major"), "lists")
    left = rows.where("not is_major").select("token", *(F.col(n).alias(f"{n}_a") for n in ("node", "component", "n", "pos")))
    right = rows.select("token", "is_major", *(F.col(n).alias(f"{n}_b") for n in ("node", "component", "n", "pos")))
    near = f"component_a <> component_b and (is_major or node_a < node_b) and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    bound = f"{100 + percent} * least(n_a - pos_a, n_b - pos_b) >= {percent} * (n_a + n_b)"
    met = left.join(right, (left.token == right.token) & F.expr(near) & F.expr(bound))
    return met.selectExpr("least(node_a, node_b) a", "greatest(node_a, node_b) b").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents linked by the similarity of their word-shingle sets.

    docs: doc_id, text, and any others. Returns for each row: doc_id, n_shingles,
    component_id (the smallest doc_id reachable through links, itself included) and
    kept (it is that document). Null and empty texts have no shingles and no links.
    Equal sets are linked whatever their size. Repeated rows are one document. Of
    several texts under one doc_id that no smaller id has, one is compared with other
    documents. A row with a null doc_id takes no part: its component_id is null and it
    is kept.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    space, floor = Workspace(spark, "near-dup"), floor_of_estimate(percent / 100)
    docs = only(docs, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "text")
    rows = space.save(_sketches(docs, words), "rows")
    known = rows.where("doc_id is not null and n_shingles > 0")
    # Equal sets are one node, named by its smallest document.
    heads = known.groupBy("digest").agg(F.min_by(F.struct(F.col("doc_id").alias("node"), "n_shingles", "sketch"), "doc_id").alias("h")).select("digest", "h.*")
    nodes = space.save(heads.groupBy("node").agg(F.min_by(F.struct("digest", "n_shingles", "sketch"), "digest").alias("h")).select("node", "h.*"), "nodes")
    heads = known.groupBy("digest").agg(F.min("doc_id").alias("node"))
    bands = space.save(_bands(nodes), "bands")
    # Written first, so that a hot bucket's rows need not meet in the join and can be split.
    sizes = space.save(bands.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("least")).where("size > 1"), "sizes")
    buckets = space.save(bands.join(sizes, "bucket"), "buckets")
    space.drop("bands", "sizes")

    pairs = _likely(buckets.where("least <> node").selectExpr("least a", "node b").distinct(), nodes, floor, percent)
    pairs = space.save(pairs, "pairs")
    sets = _sets_of(docs, nodes, pairs.selectExpr("a node").unionAll(pairs.selectExpr("b node")).distinct(), words, space, "sets")
    links = space.save(_verified(pairs, sets, percent, space, "pairs"), "links")
    space.drop("sets")
    comp = components(links, space, "linked")
    # Buckets that span more than one component; in one of two members the only pair has been looked at.
    now = space.save(buckets.where("size > 2").join(comp, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")), "members")
    open_ = space.save(now.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket"), "open-buckets")
    left = space.save(now.join(open_, "bucket").select("node", "component").distinct(), "open")
    space.drop("buckets", "members", "open-buckets")
    if not left.isEmpty():
        sets = _sets_of(docs, nodes, left.select("node"), words, space, "open-sets").join(left, "node")
        pairs = space.save(_likely(_across(sets, percent, space), nodes, floor, percent), "open-pairs")
        more = space.save(_verified(pairs, sets.select("node", "shingles"), percent, space, "open"), "open-links")
        space.drop("open-sets", "shared", "prefixes", "majors", "lists")
        # What is connected already stands as one link from each node to its component.
        comp = components(more.unionAll(comp.selectExpr("node a", "component b")), space, "joined")

    names = heads.join(comp, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    out = known.join(names, "digest").select("doc_id", "n_shingles", "component_id", F.expr("doc_id = component_id").alias("kept"))
    alone = rows.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionAll(alone)


def without_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns as they are, of which one for each class stays.

    Of repeated doc_ids one row stays, whichever; rows with a null doc_id, and one row for
    each doc_id without words, all stay. Further columns of any name come along.
    Few rejected ids are broadcast, after a count; else the texts are joined by shuffle.
    """
    space = Workspace(docs.sparkSession, "near-dup-kept")
    found = space.save(near_duplicates(docs, words, percent).where("doc_id is not null").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")), "found")
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone"))
    if gone.count() <= BROADCAST_ROWS and found.where("n > 1").isEmpty():
        return docs.join(F.broadcast(gone), docs.doc_id == gone["_gone"], "left_anti")
    kept = docs.where("doc_id is not null").join(found.where("kept").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return only(kept, *docs.columns).unionAll(docs.where("doc_id is null"))

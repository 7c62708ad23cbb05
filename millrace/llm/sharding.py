"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced jointly.

Equal texts are a group. Groups that hold a fair part of a shard are units of their
own (cut into pieces where they would overfill one); all others are dealt by hash into
a fixed number of bundles. Units, largest first, go to the shard whose residual
capacity has the highest dot product with the unit's sizes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, only
from .mixing import size_of
from .ordering import prefix_sums, range_parts

SHARDS = 40
#: Bundles for each shard; units over 1 / HEAVY of a shard's share stand alone, pieces stay under 1 / PIECE of it.
BUNDLES, HEAVY, PIECE = 100, 100, 4
#: Bytes that each document costs beside its text.
OVERHEAD = 16


def place(units: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit (a row of sizes in several measures).

    Sizes count in shares of a shard's mean load. Residual capacity may fall below
    zero; among equal products the least loaded shard, then the first, is taken.
    """
    mean = np.maximum(units.sum(0), 1e-9) / shards
    share = units / mean
    room = np.ones((shards, units.shape[1]))
    out = np.zeros(len(units), np.int64)
    for k in np.lexsort((np.arange(len(units)), -share.sum(1), -share.max(1))):
        product = np.round(room @ share[k], 12)
        best = np.flatnonzero(product == product.max())
        out[k] = best[np.argmax(room[best].min(1))]
        room[out[k]] -= share[k]
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Each row's shard and its slot there, under the law `bytes`.

    docs: doc_id, text. Returns doc_id, size (UTF-8 bytes and 16), text_crc32, law,
    shard, slot (gapless from 0, by doc_id) and grown_shard (null: only a law of keys
    has one). Null texts are empty. Equal texts share a shard unless they hold over a
    quarter of one; then the group is cut by the hash of doc_id. Repeated rows and null
    ids are rows like others. The driver holds units only: at most 3 * HEAVY + BUNDLES
    for each shard, and a few pieces of the largest.
    """
    space = Workspace(docs.sparkSession, "sharding")
    raw = F.coalesce(F.col("text"), F.lit(""))
    narrow = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(raw) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.xxhash64(raw).alias("same"),
        size_of(F.col("text")).alias("tokens"),
    )
    narrow = space.save(narrow, "narrow")
    measures = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    names = ["bytes", "tokens", "rows"]
    total = narrow.agg(*measures).first()
    if not total.rows:
        return narrow.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    part = F.greatest(*(F.col(n) * shards / max(1, total[n]) for n in names), F.lit(0.0))  # of a shard's share
    key = ["same", "text_crc32", "size"]
    heavy = narrow.groupBy(*key).agg(*measures).where(part >= 1 / HEAVY).withColumn("pieces", F.when(part > 1 / PIECE, F.ceil(part * PIECE)).otherwise(1).cast("int"))
    heavy = space.save(heavy.select(*key, "pieces"), "heavy")  # 3 * HEAVY * shards rows at most, by their share
    marked = narrow.join(F.broadcast(heavy), key, "left")
    piece = F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("doc_id", F.lit(7)), "pieces")).otherwise(0)
    bundles = BUNDLES * shards
    unit = F.when(F.col("pieces").isNull(), F.struct(F.lit(None).cast("bigint").alias("g"), F.lit(None).cast("bigint").alias("c"), F.lit(None).cast("bigint").alias("s"), F.pmod("same", F.lit(bundles)).cast("int").alias("p"))).otherwise(
        F.struct(F.col("same").alias("g"), F.col("text_crc32").alias("c"), F.col("size").alias("s"), piece.cast("int").alias("p"))
    )
    marked = marked.select("doc_id", "size", "text_crc32", "same", "tokens", unit.alias("unit"))
    units = sorted(marked.groupBy("unit").agg(*measures).collect(), key=lambda r: tuple(-1 if x is None else x for x in r.unit))
    homes = place(np.array([[r.bytes, r.tokens, r.rows] for r in units], float), shards)
    rows = [(r.unit.g, r.unit.c, r.unit.s, r.unit.p, int(h)) for r, h in zip(units, homes)]
    table = docs.sparkSession.createDataFrame(rows, "g bigint, c bigint, s bigint, p int, shard int")
    same = [F.col(f"unit.{n}").eqNullSafe(F.col(n)) for n in "gcsp"]
    homed = marked.join(F.broadcast(table), same).select("doc_id", "size", "text_crc32", "same", "shard")  # as many rows as units
    order = [F.col("shard"), F.col("doc_id"), F.col("same")]
    parted = range_parts(homed, order, space, "parted")
    slotted = prefix_sums(parted, "shard", order[1:], {"slot": F.lit(1).cast("bigint")})
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

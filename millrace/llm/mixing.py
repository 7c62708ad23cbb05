"""Mixing sources to target weights, in DataFrame operations only.

Each document gets a hash-random key. A range sort by source and key and distributed
prefix sums of sizes give each document its place in its source's random order; the
source's budget cuts that order exactly, after as many whole passes as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Workspace, only
from .ordering import prefix_sums, range_parts

#: Weights of the sources in order, repeating, and the most passes over a source.
WEIGHTS, MOST_PASSES = (5, 2, 1), 3
#: Part of the key; another seed gives another order.
SEED = 1


def size_of(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, share: float = 1.0) -> DataFrame:
    """sizes(source, source_size) -> source, source_size, target, rank; a row for each source.

    Sources by code point, null last, weigh 5, 2, 1, repeating, and share the sum of
    all sizes times share. A target stops at three times its source's size; the excess
    goes to the others by weight. Raising the level `target / weight` for all, sources
    stop in the order of their stops' levels, so one sorted pass finds the final level.
    The table has a row for each source, not for each document, and is sorted whole.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("rank", F.row_number().over(order)).withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("stop", F.col("source_size") * float(MOST_PASSES)).withColumn("level", F.col("stop") / F.col("weight"))
    up = Window.orderBy("level", "rank")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    ranked = ranked.select(
        "*",
        F.sum("source_size").over(every).alias("all_sizes"),
        F.coalesce(F.sum("stop").over(before), F.lit(0.0)).alias("stopped"),
        F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("weights"),
    )
    # Were just the lower sources stopped, the level would be this; the first source that stays under its stop shows the final one.
    here = ranked.withColumn("reach", (F.col("all_sizes") * share - F.col("stopped")) / F.col("weights"))
    final = F.min(F.when(F.col("reach") <= F.col("level"), F.struct("level", "rank", "reach"))).over(every)["reach"]
    return here.withColumn("target", F.least(F.col("stop"), F.coalesce(F.col("weight") * final, F.col("stop")))).select("source", "source_size", "target", "rank")


def mix(docs: DataFrame, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """How many words the mix takes of each document.

    docs: doc_id, text, source. Returns for every row doc_id, size, source, source_size,
    target and taken: whole passes over the source take size each, the last pass takes
    documents in random order until its source's budget, rounded down, is spent; the
    document at the cut gives only its first words. So a source's taken words are its
    target, less a fraction of a word. Ties, repeated rows and null ids have the order of
    their ids and texts' hashes; rows equal in those are alike. Empty and null texts and
    sources without words have size, target and taken 0.
    """
    space = Workspace(docs.sparkSession, "mixing")
    narrow = only(docs, "doc_id", "text", "source").select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", size_of(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("same"))
    narrow = space.save(narrow.withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), "doc_id").cast("binary"))), "sizes")
    plan = space.save(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), share), "targets")
    # Ranks stand for sources: no nulls, and as many as there are sources.
    ranked = narrow.join(plan.selectExpr("source as _s", "source_size", "target", "rank"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    order = [F.col("rank"), F.col("key"), F.col("doc_id"), F.col("same")]
    parted = range_parts(ranked, order, space, "parted")
    summed = prefix_sums(parted, "rank", order[1:], {"before": F.col("size")})
    budget = F.floor(F.col("target") + 1e-6).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(MOST_PASSES), F.floor(budget / F.greatest(F.col("source_size"), F.lit(1))))).otherwise(0).cast("bigint")
    rest = budget - whole * F.col("source_size")
    last = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("before")))
    return summed.select("doc_id", "same", "size", "source", "source_size", "target", (whole * F.col("size") + last).alias("taken"))



def mixed(docs: DataFrame, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """docs as the mix takes them: rows it takes nothing of go, others come once for each pass.

    Where a source's budget ends inside a document, the last copy holds its first words,
    joined by single blanks; n_chars, if there, follows. Rows alike in id and text share
    what the mix takes of them all, whichever comes first. Rows of null or empty texts
    go. Further columns of any name come along; an empty table stays empty.
    """
    space = Workspace(docs.sparkSession, "mixed")
    plan = mix(docs, share, seed).where("size > 0").groupBy("doc_id", "same").agg(F.sum("taken").alias("total"), F.max("size").alias("size"), F.count("*").alias("n"))
    plan = space.save(plan.where("total > 0").withColumnRenamed("same", "same_text").withColumnRenamed("doc_id", "id"), "plan")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("same", F.md5(F.coalesce("row.text", F.lit("")).cast("binary")))
    rows = rows.join(plan, F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("id")) & (F.col("same") == F.col("same_text"))).drop("same_text")
    single = rows.where("n = 1").withColumn("number", F.lit(0).cast("bigint"))
    if not plan.where("n > 1").isEmpty():  # rows alike are numbered, however many there are
        alike = space.save(rows.where("n > 1").withColumn("tie", F.monotonically_increasing_id()).withColumn("all", F.lit(0)), "alike")
        order = [F.col("all"), F.col("id").asc_nulls_first(), F.col("same"), F.col("tie")]
        parted = range_parts(alike, order, space, "alike-parted")
        first = parted.groupBy(F.col("id").alias("_i"), F.col("same").alias("_s")).agg(F.min("tie").alias("_t"))
        placed = prefix_sums(parted, "all", order[1:], {"place": F.lit(1).cast("bigint")})
        starts = space.save(placed.join(first, F.col("id").eqNullSafe(F.col("_i")) & (F.col("same") == F.col("_s")) & (F.col("tie") == F.col("_t"))).select("_i", "_s", F.col("place").alias("start")), "alike-starts")
        placed = placed.join(starts, F.col("id").eqNullSafe(F.col("_i")) & (F.col("same") == F.col("_s"))).withColumn("number", F.col("place") - F.col("start"))
        single = single.unionByName(placed.select(*single.columns))
    whole = F.expr("total div (n * size)")
    rest = F.expr("total - total div (n * size) * n * size")
    taken = (whole * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("number") * F.col("size")))).cast("bigint")
    rows = single.withColumn("taken", taken).where("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0)), F.lit(1), left.cast("int")))
    short = left < F.col("size")
    new = {"text": F.when(short, cut).otherwise(F.col("row.text")), "n_chars": F.when(short, F.length(cut).cast("bigint")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return rows.select(*((F.col(f"row.`{c}`") if new.get(c) is None else new[c]).alias(c) for c in docs.columns))

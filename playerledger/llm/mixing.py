"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes are summed by source.  Weights 1, 2, 3, repeating in code-point order
   of the sources (null last), share all words; a target stops at ``MAX_EPOCHS``
   times its source, the excess goes to the others by weight until none is above.
2. Each source is cut into blocks of about ``BLOCK_ROWS`` rows by a seeded hash of
   the row, so block order is a fixed random order of the source.  Every whole
   pass over a source takes all its blocks; the last, partial pass takes blocks
   in order until the target.  What is missing to the target where it ends is
   filled from that block and the ``MORE_BLOCKS`` after it, the largest rows that
   fit first.  The number of blocks a source gives is its exact quota.
3. A binary tree over the output shards splits the quotas: a node draws, by one
   multivariate-hypergeometric sample seeded by the node, how many blocks of each
   source go to its left half.  Leaves hold each shard's exact quotas, and the
   sums to the left tell which stretch of each source's permuted block list is
   the shard's own: shards are disjoint and together take every block once.
4. Rows join their blocks' draws and are sorted by a seeded hash inside a shard.

What passes through the driver has one row a source (sums, weights), as the
mixture's own settings have.  Prefix sums over blocks go in two levels, so no
task holds a source; a block holds a bounded number of rows.

Defined results: null or empty text has size 0 and is drawn with its block; null
sources are one source, the last; rows that repeat are rows of their own (only
when all of id, source and text agree they share their place); an empty table or
one without words takes nothing; input columns may clash with the result's, which
win.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from playerledger.llm.common import stored, with_new, words, workers_ready

#: The weights sources take in turn.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_ROWS = 256
#: Blocks, after the one in which a partial pass ends, that give rows to fill it.
MORE_BLOCKS = 3
#: Words an output shard holds, about: the number of shards follows the corpus.
SHARD_WORDS = 4_000_000
SEED = 20240601
#: Blocks whose prefix sums one task takes at once.
BLOCK_RUN = 4096


def targets(sizes: list[int], weights: list[int], cap: int = MAX_EPOCHS) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``cap`` times its size."""
    found: dict[int, float] = {}
    total = float(sum(sizes))
    while len(found) < len(sizes):
        rest = [i for i in range(len(sizes)) if i not in found]
        left = total - sum(found.values())
        weight = sum(weights[i] for i in rest)
        share = {i: left * weights[i] / weight for i in rest}
        above = [i for i in rest if share[i] > cap * sizes[i]]
        found |= {i: float(cap * sizes[i]) for i in above} if above else share
    return [found[i] for i in range(len(sizes))]


def split_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(quota, offset) of one shard: its blocks of each source and those left of it.

    Walks from the root of the splitting tree to the shard's leaf; each node's
    draw depends on the seed and the node alone, so all shards see one tree.
    """
    lo, hi, node = 0, shards, 1
    quotas, offset = quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        take = int(quotas.sum()) * (mid - lo) // (hi - lo)
        left = np.random.default_rng([seed, node]).multivariate_hypergeometric(quotas, take, method="marginals")
        if shard < mid:
            quotas, hi, node = left, mid, 2 * node
        else:
            quotas, offset, lo, node = quotas - left, offset + left, mid, 2 * node + 1
    return quotas, offset


def stride(n: int, seed: int) -> tuple[int, int]:
    """(a, b) of the permutation j -> (a * j + b) mod n."""
    rng = np.random.default_rng([seed, n])
    a = int(rng.integers(1, n)) if n > 1 else 1
    while math.gcd(a, n) != 1:
        a = a % n + 1
    return a, int(rng.integers(0, n))


def _deal(plan: list[tuple[int, int, int]], shards: int, seed: int):
    """(source, block, epoch, shard) of every drawn block; plan: (source, blocks, quota)."""
    ids = np.array([p[0] for p in plan], np.int64)
    blocks = np.array([p[1] for p in plan], np.int64)
    quotas = np.array([p[2] for p in plan], np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                own, offset = split_quotas(quotas, shards, int(shard), seed)
                for s in np.flatnonzero(own):
                    a, b = stride(int(quotas[s]), seed + int(ids[s]))
                    back = pow(a, -1, int(quotas[s])) if quotas[s] > 1 else 0
                    for at in range(0, int(own[s]), BLOCK_RUN):
                        rank = np.arange(offset[s] + at, offset[s] + min(at + BLOCK_RUN, int(own[s])), dtype=object)
                        j = ((rank - b) * back % int(quotas[s])).astype(np.int64)
                        yield pd.DataFrame({"s": ids[s], "block": j % blocks[s], "epoch": (j // blocks[s]).astype(np.int32),
                                            "shard": np.int32(shard)})
    return run


def _place(id: Column, source: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), id, source, text)


def _block(place: Column, blocks: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(place, 16), blocks)


def _starts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """(s, block, start): words of the source in the blocks before, summed in two levels."""
    run = F.floor(F.col("block") / BLOCK_RUN)
    sums = stored(rows.join(F.broadcast(facts), "s").withColumn("block", _block(F.col("place"), F.col("blocks")))
                  .groupBy("s", "block").agg(F.sum("n").alias("n")), "blocks")
    ahead = F.sum("n").over(W.partitionBy("s").orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    runs = sums.groupBy("s", run.alias("run")).agg(F.sum("n").alias("n")).withColumn("ahead", F.coalesce(ahead, F.lit(0)))
    before = F.sum("n").over(W.partitionBy("s", "run").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    found = sums.withColumn("run", run).join(runs.select("s", "run", "ahead"), ["s", "run"])
    return found.select("s", "block", (F.col("ahead") + F.coalesce(before, F.lit(0))).alias("start"))


def draw(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
         shards: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``draws``: the
    (epoch, shard) pairs for which the mix takes the row.
    """
    workers_ready(docs.sparkSession)
    spark = docs.sparkSession
    key, name, words_in = (F.col(f"`{c}`") for c in (id, source, text))
    size = F.size(words(words_in)).cast("long")
    rows = stored(docs.select(name.alias("name"), size.alias("n"), _place(key, name, words_in, seed).alias("place")), "sizes")
    totals = rows.groupBy("name").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    totals.sort(key=lambda r: (r["name"] is None, str(r["name"] or "").encode()))
    shards = shards or max(1, -(-sum(r["size"] for r in totals) // SHARD_WORDS))
    goal = targets([r["size"] for r in totals], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(totals))])
    facts = [(i, r["name"], r["size"], max(1, math.ceil(r["rows"] / BLOCK_ROWS)), t,
              int(t // r["size"]) if r["size"] else 0) for i, (r, t) in enumerate(zip(totals, goal))]
    facts = spark.createDataFrame(facts, f"s int, name {rows.schema['name'].dataType.simpleString()}, "
                                         "source_size long, blocks long, target double, epochs int")
    # the partial pass ends in the last block that starts before its words are used up,
    # and is filled from there on
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    numbered = rows.join(F.broadcast(facts.select("s", "name")), rows["name"].eqNullSafe(facts["name"])).select("s", "n", "place")
    starts = stored(_starts(numbered, facts), "starts").join(F.broadcast(facts.drop("name")), "s").withColumn("rest", rest)
    quota = (starts.groupBy("s", "blocks", "epochs")
             .agg(F.max(F.when(F.col("start") < F.col("rest"), F.col("block") + 1)).alias("end"))
             .withColumn("part", F.when(F.col("end").isNull(), 0).otherwise(F.least("blocks", F.col("end") + MORE_BLOCKS)))
             .select("s", "blocks", (F.col("epochs") * F.col("blocks") + F.col("part")).alias("quota")).collect())
    plan = sorted((r.s, r.blocks, r.quota) for r in quota if r.quota > 0)
    dealt = spark.range(0, shards, 1, -(-shards // 64)).mapInPandas(
        _deal(plan, shards, seed), "s int, block long, epoch int, shard int")
    draws = dealt.groupBy("s", "block").agg(F.array_sort(F.collect_list(F.struct("epoch", "shard"))).alias("all"))
    # the block in which the partial pass ends, and the next ones: each row that still fits
    last = (starts.filter((F.col("start") < F.col("rest")))
            .groupBy("s").agg(F.max(F.struct("block", "start", "rest", "blocks")).alias("l")).select("s", "l.*"))
    filling = _block(F.col("place"), F.col("blocks")).between(F.col("block"), F.col("block") + MORE_BLOCKS)
    inside = (numbered.join(F.broadcast(last), "s").filter(filling)
              .groupBy("s", "block", "start", "rest", "place").agg(F.sum("n").alias("n"))
              .groupBy("s", "block", "start", "rest").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "place", "n")))
                                                          .alias("order")))
    chosen = F.aggregate(
        "order", F.struct((F.col("rest") - F.col("start")).cast("double").alias("left"), F.array().cast("array<long>").alias("p")),
        lambda acc, x: F.when(x["n"] <= acc["left"], F.struct((acc["left"] - x["n"]).alias("left"),
                                                               F.array_append(acc["p"], x["place"]).alias("p"))).otherwise(acc),
        lambda acc: acc["p"])
    inside = inside.select(F.col("s"), F.col("block").alias("from_block"), chosen.alias("chosen"))  # one row a source
    starts = starts.join(draws, ["s", "block"], "left").join(inside, "s", "left").select(
        F.col("s").alias("of_s"), F.col("block").alias("of_block"),
        F.when(F.col("block") >= F.col("from_block"), F.col("chosen")).alias("of_chosen"),
        F.col("epochs").alias("of_epochs"), F.col("all").alias("of_all"))

    # rows join what was dealt to their block
    placed = with_new(docs, size=size, place_=_place(key, name, words_in, seed))
    facts = facts.select(F.col("s").alias("at_s"), F.col("name").alias("at_name"), F.col("blocks").alias("at_blocks"),
                         F.col("source_size").alias("at_size"), F.col("target").alias("at_target"))
    placed = placed.join(F.broadcast(facts), placed[f"`{source}`"].eqNullSafe(facts["at_name"]))
    placed = placed.withColumn("at_block", _block(F.col("place_"), F.col("at_blocks")))
    out = placed.join(starts, (placed["at_s"] == starts["of_s"]) & (placed["at_block"] == starts["of_block"]), "left")
    fits = F.col("of_chosen").isNull() | F.array_contains("of_chosen", F.col("place_"))
    none = F.array().cast("array<struct<epoch:int,shard:int>>")
    some = F.filter(F.coalesce("of_all", none), lambda d: (d["epoch"] < F.col("of_epochs")) | fits)
    cols = [placed[f"`{c}`"] for c in docs.columns if c.lower() not in ("size", "place_", "source_size", "target", "draws")]
    return out.select(*cols, "size", F.col("at_size").alias("source_size"), F.col("at_target").alias("target"),
                      some.alias("draws"))


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
        shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixed corpus in the columns of ``docs``: a row for each time it is drawn,
    shards kept together, shuffled inside."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id, source, text = (f"c{names.index(c)}" for c in (id, source, text))
    taken = draw(plain, id, source, text, shards, seed).withColumn("draw", F.explode("draws"))
    taken = (taken.withColumn("order", F.xxhash64(F.lit(seed + 1), "draw", id)).withColumn("shard", F.col("draw.shard"))
             .repartition("shard").sortWithinPartitions("shard", "order"))
    return taken.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])

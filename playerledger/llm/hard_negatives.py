"""Hard negatives: candidates that score below a positive, but not far below.

Vectors become whole numbers; a score is the exact inner product of a row with an
anchor.  An anchor's positives are its best rows of the same label; for each of them
the negatives are the best rows of other labels whose score lies between two shares of
the positive's score.

1. Rows are dealt evenly over cells by their id, whatever their label, and every
   block of anchors is copied to each cell: a cell and a block meet in one task.
2. The task keeps the block and reads the cell in tiles.  A tile's scores come from
   Strassen's recursion on int64: sides are padded with zeros until they halve down to
   leaves, and the seven products are added exactly (in whole numbers modulo 2^64, so a
   score is exact whenever it fits a signed 64-bit number).
3. The first pass multiplies only tiles of an anchor's own label and keeps a heap of the
   best rows of each anchor; the second keeps a heap of the best rows inside the window
   of each anchor and positive.  A heap is as long as the wanted list, and the heaps of
   all cells are merged in Spark, cut before and after the shuffle.

All anchors meet all rows: the work is their product, in blocks, and no task holds
more than a block of anchors, a tile and their heaps.

Defined results: rows with a null id, label or vector or with a null or non-finite
component take no part; vectors of different lengths are padded with zeros; components
beyond 64 bits after scaling are cut to the largest number.  Equal scores go by the
smaller id.  An id that stands in several rows is one candidate in a list, with its best
score there, and never its own anchor's; anchors that are equal in id, label and vector
count once, others are mined each by itself.  An empty table, or one without anchors,
gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerledger.llm.common import stored, workers_ready

#: Anchors of a block, about.
BLOCK = 8192
#: Anchors and candidates multiplied at once: their scores take 8 bytes each.
TILE = 1024
#: Candidates of a cell, about.
CELL = 1 << 18
#: Tasks of a pass at most: a task takes its pairs of cell and block one after another.
TASKS = 20_000
#: Halving stops at sides this short.
LEAF = 32
#: Fixed values of the mining: lists and window, in hundredths of the positive's score.
POSITIVES = 5
NEGATIVES = 10
LEAST = 30
MOST = 90
SCALE = 256
#: No row stands here in a heap.
NONE = np.iinfo(np.int64).min


# products --------------------------------------------------------------------

def _padded(x: np.ndarray, rows: int, cols: int) -> np.ndarray:
    if x.shape == (rows, cols):
        return x
    out = np.zeros((rows, cols), np.int64)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def _strassen(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    deeper = levels - 1
    p1 = _strassen(a11 + a22, b11 + b22, deeper)
    p2 = _strassen(a21 + a22, b11, deeper)
    p3 = _strassen(a11, b12 - b22, deeper)
    p4 = _strassen(a22, b21 - b11, deeper)
    p5 = _strassen(a11 + a12, b22, deeper)
    p6 = _strassen(a21 - a11, b11 + b12, deeper)
    p7 = _strassen(a12 - a22, b21 + b22, deeper)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices by Strassen's recursion down to sides of about ``leaf``."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    levels = max(0, min(m, k, n) // leaf).bit_length() - 1 if min(m, k, n) >= leaf else 0
    step = 1 << levels
    m2, k2, n2 = (-(-x // step) * step for x in (m, k, n))
    return _strassen(_padded(a, m2, k2), _padded(b, k2, n2), levels)[:m, :n]


# heaps -----------------------------------------------------------------------

class Heaps:
    """The best (score, id) of many lists, ``size`` each: higher scores first, then smaller ids."""

    def __init__(self, lists: int, size: int):
        self.size = size
        self.score = np.full((lists, size), NONE, np.int64)
        self.id = np.zeros((lists, size), np.int64)

    def push(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        """Offer a tile: ``scores`` and ``wanted`` for the lists ``rows`` (different ones) by the candidates ``ids``."""
        scores = np.where(wanted, scores, NONE)
        floor = self.score[rows, -1]
        if scores.shape[1] > self.size:
            # nothing below the tile's own best can enter; equal scores go by id
            at = scores.shape[1] - self.size
            floor = np.maximum(floor, np.partition(scores, at, axis=1)[:, at])
        r, c = np.nonzero(wanted & (scores >= floor[:, None]) & (scores > NONE))
        if not len(r):
            return
        touched, where = np.unique(r, return_inverse=True)
        lists = rows[touched]
        held = self.score[lists] > NONE
        hr, hc = np.nonzero(held)
        row = np.concatenate((where, hr))
        score = np.concatenate((scores[r, c], self.score[lists][hr, hc]))
        id = np.concatenate((ids[c], self.id[lists][hr, hc]))
        # an id counts once in a list, with its best score
        order = np.lexsort((-score, id, row))
        row, score, id = row[order], score[order], id[order]
        first = np.concatenate(([True], (row[1:] != row[:-1]) | (id[1:] != id[:-1])))
        row, score, id = row[first], score[first], id[first]
        order = np.lexsort((id, -score, row))
        row, score, id = row[order], score[order], id[order]
        start = np.searchsorted(row, np.arange(len(touched)))
        place = np.arange(len(row)) - start[row]
        keep = place < self.size
        row, score, id, place = row[keep], score[keep], id[keep], place[keep]
        fresh = np.full((len(touched), self.size), NONE, np.int64)
        names = np.zeros((len(touched), self.size), np.int64)
        fresh[row, place], names[row, place] = score, id
        self.score[lists], self.id[lists] = fresh, names

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, score, id) of everything held."""
        r, c = np.nonzero(self.score > NONE)
        return r, self.score[r, c], self.id[r, c]


# cells -----------------------------------------------------------------------

def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, padded with zeros to ``width``."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = flat
    return out


def _runs(labels: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)] if len(labels) else []
    yield from zip(cut, cut[1:])


class Block:
    """The anchors of one block, and the heaps of one pass over a cell."""

    def __init__(self, batches: list[pa.RecordBatch], width: int, mining: bool, positives: int, negatives: int, least: int, most: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        col = {n: table.column(n).combine_chunks() for n in ("no", "id", "label", "q", "wins")}
        self.no, self.id, self.label = (col[n].to_numpy() for n in ("no", "id", "label"))
        self.q = _matrix(col["q"], width)
        self.mining, self.least, self.most = mining, least, most
        if mining:
            # one list for each anchor and positive
            wins = col["wins"]
            sizes = np.diff(wins.offsets.to_numpy())
            self.anchor = np.repeat(np.arange(len(self.no)), sizes)
            self.win = wins.flatten().to_numpy(zero_copy_only=False)
            self.heaps = Heaps(len(self.win), negatives)
        else:
            self.heaps = Heaps(len(self.no), positives)

    def meet(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray) -> None:
        columns = np.ascontiguousarray(q.T)
        for at in range(0, len(self.no), TILE):
            own = slice(at, at + TILE)
            if self.mining:
                self.inside(at, product(self.q[own], columns), self.label[own, None] != labels[None, :], ids)
                continue
            for a, b in _runs(labels):
                mine = at + np.flatnonzero(self.label[own] == labels[a])
                if len(mine):
                    scores = product(self.q[mine], columns[:, a:b])
                    self.heaps.push(mine, scores, ids[a:b], ids[None, a:b] != self.id[mine][:, None])

    def inside(self, at: int, scores: np.ndarray, other: np.ndarray, ids: np.ndarray) -> None:
        """Offer the rows of ``other`` labels to the windows of the anchors from ``at`` on."""
        first, last = np.searchsorted(self.anchor, [at, at + len(scores)])
        # lists of a tile at a time, which bounds what stands beside the scores
        for lo in range(first, last, TILE):
            lists = np.arange(lo, min(lo + TILE, last))
            who = self.anchor[lists] - at
            mine, win = scores[who], self.win[lists][:, None]
            wanted = other[who] & (self.least * win <= 100 * mine) & (100 * mine <= self.most * win)
            self.heaps.push(lists, mine, ids, wanted)

    def found(self) -> pa.RecordBatch:
        at, score, id = self.heaps.rows()
        no, win = (self.no[self.anchor[at]], self.win[at]) if self.mining else (self.no[at], np.zeros(len(at), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (no, win, score, id)], ["no", "win", "score", "id"])


def _meet(width: int, mining: bool, positives: int, negatives: int, least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (pair, kind, label): a block's anchors, then the cell's candidates."""
        pair, held, block = None, [], None
        for batch in batches:
            key, kind = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for a, b in _runs(key * 2 + kind):
                if pair is not None and key[a] != pair:
                    if block is not None:
                        yield block.found()
                    held, block = [], None
                pair = key[a]
                if kind[a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if block is None and held:
                    block = Block(held, width, mining, positives, negatives, least, most)
                if block is None:
                    continue
                for at in range(a, b, TILE):
                    part = batch.slice(at, min(TILE, b - at))
                    block.meet(part.column(4).to_numpy(), part.column(5).to_numpy(), _matrix(part.column(6), width))
        if block is not None:
            yield block.found()
    return run


def _passed(anchors: DataFrame, rows: DataFrame, cells: int, blocks: int, width: int, mining: bool, *sizes: int) -> DataFrame:
    """(no, win, score, id): the heaps of every cell and block."""
    names = ["part", "pair", "kind", "no", "id", "label", "q", "wins"]
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"),
                           F.pmod(F.xxhash64("no"), F.lit(blocks)).alias("block"), F.lit(0).alias("kind"), "no", "id", "label", "q", "wins")
    # a cell by id: the rows of one id meet in one heap
    offered = rows.select(F.pmod(F.xxhash64("id"), F.lit(cells)).alias("cell"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                          F.lit(0).cast("long").alias("no"), "id", "label", "q", F.array().cast("array<bigint>").alias("wins"))
    tasks = min(TASKS, cells * blocks)
    both = asked.unionByName(offered).withColumn("pair", F.col("cell").cast("long") * blocks + F.col("block"))
    dealt = (both.withColumn("part", F.pmod("pair", F.lit(tasks)).cast("int")).select(*names)
             .repartitionById(tasks, F.col("part")).sortWithinPartitions("pair", "kind", "label"))
    return dealt.mapInArrow(_meet(width, mining, *sizes), "no long, win long, score long, id long")


def _best(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= size)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(sound, F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")))


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id: str = "vec_id", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` and ``label`` are expressions over ``vectors``; ``least`` and ``most``
    are hundredths of the positive's score.
    """
    spark = vectors.sparkSession
    workers_ready(spark)
    rows = stored(vectors.select(F.col(f"`{id}`").cast("long").alias("id"), label.cast("long").alias("label"),
                                 whole_numbers(F.col(f"`{vector}`")).alias("q"),
                                 F.coalesce(is_anchor, F.lit(False)).alias("asks"))
                  .filter("id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL"), "vectors")
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    once = rows.filter("asks").drop("asks").dropDuplicates()
    anchors = stored(once.withColumn("no", F.monotonically_increasing_id()), "anchors")
    # every cell gives a heap of its own, so there are no more of them than keep all cores busy
    cells = max(2 * spark.sparkContext.defaultParallelism, -(-total // cell))
    blocks = max(1, -(-anchors.count() // block))
    sizes = (positives, negatives, least, most)
    rows, width = rows.drop("asks"), width or 0
    none = F.array().cast("array<bigint>")
    found = _passed(anchors.withColumn("wins", none), rows, cells, blocks, width, False, *sizes)
    best = stored(_best(found, ["no"], positives).select("no", F.col("id").alias("positive_id"), F.col("score").alias("win")), "positives")
    # positives of equal score share their negatives
    wins = best.groupBy("no").agg(F.array_sort(F.collect_set("win")).alias("wins"))
    asking = stored(anchors.join(wins, "no"), "asking")
    found = _passed(asking, rows, cells, blocks, width, True, *sizes)
    worst = _best(found, ["no", "win"], negatives)
    return (anchors.select("no", F.col("id").alias("anchor_id")).join(best, "no").join(worst, ["no", "win"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("win").alias("positive_score"),
                    F.col("score").alias("negative_score")))

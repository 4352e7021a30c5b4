"""Near-duplicate embeddings by sorted projection passes.

1. Rows with equal label and equal vector are one class; only its smallest id
   goes on, with the number of rows it stands for.
2. In each pass the classes of a label are sorted by the concatenated signs of their
   projections on that pass's ``SIGNS`` random hyperplanes (a distributed range sort of
   all labels and passes) and cut into blocks of ``SEGMENT`` rows.
3. Each block is compared with itself and the next one: a window of 512 to 1024
   neighbours.  A window whose last block pair holds a link is handed on to twice as many
   further blocks, until its edge links nothing, so runs of near copies of any length
   are compared whole.  Cosines are computed in double precision.
4. The verified pairs of all passes are united; components come from the distributed
   large-star / small-star rounds.

A pair at the threshold has s equal signs in front with a chance of 0.88^s, wherever the
other vectors are, and meets in a window when no more than a block shares them.  The
passes of a label follow from its measured cells (``plan``), so that such a pair is
missed with a chance below ``MISS``; a label of one block needs one pass and misses
nothing.  Where ``MOST_PASSES`` would not do (a large label whose vectors all lie close
together), and for every label with ``exact=True``, the window is the whole label, in
pairs of blocks.

Defined results: a null label, a null id, a null, empty or zero vector, and one
with null or non-finite components link with nothing (component: the row's own
id); vectors of different length never link; rows that repeat are vectors of their
own, linked to each other (when different vectors share an id they count as one
node of links); an empty table gives an empty table; input columns
named like a result column give way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerledger.llm.common import stored, with_new, workers_ready
from playerledger.llm.components import components

THRESHOLD = 0.93
#: Rows of a block; fewer when their doubles would take more than ``BLOCK_BYTES``.
SEGMENT = 512
BLOCK_BYTES = 16 << 20
#: Rows compared with a block at once.
ROWS_AT_ONCE = 1024
#: Signs of a key.
SIGNS = 48
MISS = 1e-4
LEAST_PASSES = 8
MOST_PASSES = 64
#: Numbers of passes to choose from, and of signs that a label's cells are measured at.
PASSES = (8, 12, 16, 24, 32, 48, MOST_PASSES)
TRIED = tuple(range(0, 26, 2))
SEED = 7


def agree(signs: int, threshold: float = THRESHOLD) -> float:
    """The chance that a pair at the threshold has so many equal signs."""
    return (1 - math.acos(threshold) / math.pi) ** signs


def passes_for(rows: int, threshold: float = THRESHOLD, segment: int = SEGMENT) -> int:
    """Passes so that a pair at the threshold is missed with a chance below ``MISS`` among
    ``rows`` rows that lie evenly."""
    meet = agree(math.ceil(max(0.0, math.log2(max(rows, 1) / segment))), threshold)
    return LEAST_PASSES if meet > 0.99 else max(LEAST_PASSES, math.ceil(math.log(MISS) / math.log1p(-meet)))


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, finite throughout and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors(column: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles, scaled to a largest component of 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = flat.reshape(len(column), -1)
    return out / np.abs(out).max(axis=1, keepdims=True)


def signs(x: np.ndarray, number: int, seed: int) -> np.ndarray:
    """The key of each row in a pass: its signs, the first one most significant."""
    planes = np.random.default_rng([seed, number, x.shape[1]]).standard_normal((SIGNS, x.shape[1]))
    return ((x @ planes.T) > 0) @ (1 << np.arange(SIGNS)[::-1])


def _keys(seed: int):
    """Appends each row's key in every pass; rows: id, label, dim, vector, whole, passes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, passes = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                x, most = vectors(batch.column(3).take(pa.array(rows))), passes[rows]
                for p in range(int(most.max())):
                    on = most > p
                    part = batch.take(pa.array(rows[on]))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:5], pa.array(np.full(len(part), p, np.int32)), pa.array(signs(x[on], p, seed))],
                        ["id", "label", "dim", "vector", "whole", "pass", "key"])
    return run


def links_in(ids: np.ndarray, group: np.ndarray, x: np.ndarray, own: int, threshold: float, window: int = ROWS_AT_ONCE,
             within: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of a group's rows; the first ``own`` rows are compared with all after
    them, or only with those that are not their own."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    for lo in range(0, own, window):
        hi = min(lo + window, own)
        for at in range(lo if within else own, len(ids), window):
            to = min(at + window, len(ids))
            i, j = np.nonzero(x[lo:hi] @ x[at:to].T >= threshold)
            i, j = i + lo, j + at
            on = (i < j) & (group[i] == group[j])
            if on.any():
                a, b = ids[i[on]], ids[j[on]]
                yield np.minimum(a, b), np.maximum(a, b)


def _compare(threshold: float):
    """(i, j, a, b, crossing) of each pair of blocks; rows: i, j, block, id, label, dim, pass, vector.
    Neighbouring blocks also compare the first one's own rows."""
    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block, ids, dims = (table.column(c).to_numpy() for c in ("block", "id", "dim"))
        labels = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        group = labels.astype(np.int64) << 32 | table.column("pass").to_numpy()
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            own = int((block[rows] == i).sum())
            if not own or len(rows) < 2:
                continue
            x = vectors(table.column("vector").take(pa.array(rows)).combine_chunks())
            for s, t in links_in(np.arange(len(rows)), group[rows], x, own, threshold, within=j == i + 1):
                a, b = ids[rows[s]], ids[rows[t]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), i)), pa.array(np.full(len(a), j)), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
                     pa.array(t >= own)], ["i", "j", "a", "b", "crossing"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            at = np.stack([batch.column(c).to_numpy() for c in ("i", "j")])
            cut = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist(), at.shape[1]]
            for a, b in zip(cut, cut[1:]):
                if held and (at[:, a] != last).any():
                    yield from found(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = at[:, a]
        if held:
            yield from found(pa.Table.from_batches(held))
    return run


def _probe(seed: int):
    """(label, dim, key) of the first pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(signs(vectors(part.column(2)), 0, seed))],
                                                 ["label", "dim", "key"])
    return run


def plan(classes: DataFrame, threshold: float = THRESHOLD, seed: int = SEED, segment: int = SEGMENT) -> DataFrame:
    """(label, dim, passes) of the labels above a block; no passes: the window is the whole label.

    A row's signs are as many as it takes until its cell in the first pass has no more
    rows than a block; the fewest ``PASSES`` are taken at which the pairs of a mean row
    are missed with a chance below ``MISS``.
    """
    large = stored(classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > segment),
                   "large_labels")
    keys = classes.join(large, ["label", "dim"], "left_semi").select("label", "dim", "vector").mapInArrow(
        _probe(seed), "label string, dim int, key long")
    tried = F.explode(F.array(*[F.struct(F.lit(n).alias("signs"), F.lit(SIGNS - n).alias("shift")) for n in TRIED]))
    cells = (keys.withColumn("t", tried).groupBy("label", "dim", "t.signs", F.expr("shiftright(key, t.shift)").alias("cell"))
             .agg(F.count(F.lit(1)).alias("n")))
    small = cells.groupBy("label", "dim", "signs").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("n") <= segment, F.col("n")).otherwise(0)).alias("n"))

    def missed(passes: int) -> Column:
        f = [(1 - agree(n, threshold)) ** passes for n in TRIED] + [(1 - agree(TRIED[-1], threshold)) ** passes]
        gain = F.lit(0.0)
        for n, now, after in zip(TRIED, f, f[1:]):
            gain = gain + F.sum(F.when(F.col("signs") == n, F.col("n") * (now - after)).otherwise(0.0))
        return gain / F.max("rows") + f[-1]

    return stored(small.groupBy("label", "dim").agg(F.coalesce(*[F.when(missed(p) <= MISS, F.lit(p)) for p in PASSES], F.lit(0)).alias("passes")),
                  "plan")


def links(classes: DataFrame, threshold: float = THRESHOLD, passes: int | None = None, seed: int = SEED,
          segment: int = SEGMENT, exact: bool = False) -> DataFrame:
    """(a, b), a < b: pairs of classes (id, label, dim, vector) with a cosine of ``threshold`` or more.

    ``passes``: so many for every label; ``exact``: every label's window is the whole label.
    """
    spark = classes.sparkSession
    workers_ready(spark)
    classes = classes.select("id", "label", "dim", "vector")
    kind = classes.schema["vector"].dataType.simpleString()
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    segment = max(16, min(segment, BLOCK_BYTES // (8 * (classes.agg(F.max("dim")).first()[0] or 1))))
    if exact or passes is not None:
        planned = classes.withColumn("passes", F.lit(0 if exact else passes))
    else:
        planned = classes.join(plan(classes, threshold, seed, segment), ["label", "dim"], "left").select(
            *classes.columns, F.coalesce("passes", F.lit(1)).alias("passes"))
    keyed = planned.select(*classes.columns, (F.col("passes") == 0).alias("whole"), F.greatest("passes", F.lit(1)).alias("passes")).mapInArrow(
        _keys(seed), f"id long, label string, dim int, vector {kind}, whole boolean, pass int, key long")
    order = ["dim", "label", "pass", "key", "id"]
    # places in the order of all labels and passes: a task's rows follow those of the tasks before
    placed = stored(stored(keyed, "keyed").repartitionByRange(tasks, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "sorted")
    # one row a task
    before = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n")).select(
        "task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    rows = placed.join(F.broadcast(stored(before, "tasks")), "task").withColumn(
        "block", F.expr(f"(before + at) div {segment}"))
    group = ["dim", "label", "pass"]
    spans = stored(rows.groupBy(*group).agg(F.min("block").alias("lo"), F.max("block").alias("hi"), F.first("whole").alias("whole")), "spans")
    # the last block of the groups that a block has rows of
    ends = stored(spans.repartition(tasks).select(F.explode(F.sequence("lo", "hi")).alias("i"), "hi").groupBy("i").agg(F.max("hi").alias("hi")), "ends")
    far = (spans.filter("whole and hi > lo + 1").select(F.explode(F.sequence("lo", F.col("hi") - 2)).alias("i"), "hi").repartition(tasks)
           .select("i", F.explode(F.sequence(F.col("i") + 2, "hi")).alias("j")))
    asked = stored(ends.select("i", (F.col("i") + 1).alias("j")).union(far).distinct(), "asked")
    all: DataFrame | None = None
    while True:
        seats = asked.select("i", "j", F.explode(F.array("i", "j")).alias("block")).join(
            rows.select("block", "id", "label", "dim", "pass", "vector"), "block")
        dealt = (seats.select("i", "j", "block", "id", "label", "dim", "pass", "vector").repartition(tasks, "i", "j")
                 .sortWithinPartitions("i", "j", "block"))
        found = stored(dealt.mapInArrow(_compare(threshold), "i long, j long, a long, b long, crossing boolean"), "found")
        all = found if all is None else all.union(found)
        # windows whose last pair of blocks links go on, twice as far as they went
        last = asked.groupBy("i").agg(F.max("j").alias("j"))
        linked = found.filter("crossing").select("i", "j").distinct()
        on = last.join(linked, ["i", "j"]).join(ends, "i").filter("j < hi").select(
            "i", F.explode(F.sequence(F.col("j") + 1, F.least(F.col("j") + 2 * (F.col("j") - F.col("i")), F.col("hi")))).alias("j"))
        asked = stored(on, "asked")
        if asked.isEmpty():
            return all.select("a", "b").distinct()


def label_components(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                     threshold: float = THRESHOLD, passes: int | None = None, exact: bool = False) -> DataFrame:
    """``rows`` without the vector, with ``n_links``, ``component_id`` and ``kept``."""
    key, vec, lab = F.col(f"`{id}`").cast("long"), F.col(f"`{vector}`"), F.col(f"`{label}`").cast("string")
    fine = usable(vec) & lab.isNotNull() & key.isNotNull()
    taken = rows.filter(fine).select(key.alias("id"), lab.alias("label"), F.size(vec).alias("dim"), vec.alias("vector"))
    classes = stored(taken.groupBy("label", "dim", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "classes")
    found = stored(links(classes, threshold, passes, exact=exact), "links")
    size = classes.groupBy("id").agg(F.sum("n").alias("size")).withColumnRenamed("id", "b")
    both = found.union(found.select("b", "a"))
    degree = both.join(size, "b").groupBy("a").agg(F.sum("size").alias("others"))
    groups = components(found)
    facts = (classes.select("label", "vector", "id", "n")
             .join(degree, F.col("id") == F.col("a"), "left").join(groups, F.col("id") == F.col("node"), "left")
             .select(F.col("label").alias("at_label"), F.col("vector").alias("at_vector"),
                     (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("at_links"),
                     F.coalesce("component", "id").alias("at_component")))
    joined = rows.join(facts, fine & (lab == F.col("at_label")) & (vec == F.col("at_vector")), "left")
    component = F.coalesce("at_component", key)
    out = with_new(joined, n_links=F.coalesce("at_links", F.lit(0)).cast("long"), component_id=component,
                   kept=component.eqNullSafe(key))
    return out.drop("at_label", "at_vector", "at_links", "at_component", vector)

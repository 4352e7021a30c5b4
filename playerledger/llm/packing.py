"""Best-fit packing of tokenised documents by hierarchical residual merging.

Documents become pieces of at most ``CAPACITY`` tokens (only longer documents are
cut).  Each partition packs its own pieces best-fit, longest first.  Bins that are
full up to ``NEARLY`` tokens are sequences; every other bin becomes one item, as
long as its load, of the next round: groups of underfull bins are packed best-fit
into new bins, and so on up a tree until one group is left or a round joins next
to nothing.  An item keeps its inner order when it is placed, so a piece's offset
is the sum of the offsets on its way up.

A task holds the lengths of at most ``RUN`` pieces or ``GROUP`` bins, never
texts of more than one slice; ids are counted and summed where they are made and
only lengths move on.

Defined results: null or empty text is the closing id alone; rows that repeat
are documents of their own; a null id is carried along; an empty table gives no
pieces; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerledger.llm.common import stored, workers_ready
from playerledger.llm.token_ids import word_ids
from playerledger.llm.words_np import buffer_of, slices

CAPACITY = 4096
#: The id that closes a document.
CLOSING_ID = 1
#: A bin with at most so many free tokens is a finished sequence.
NEARLY = 4
#: Pieces one local packing takes, and underfull bins one merging group takes.
RUN = 1_000_000
GROUP = 200_000
#: Text bytes tokenised at once.
SLICE = 1 << 22
#: A round that joins less than this share of its bins is the last.
LEAST_JOINED = 0.02


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every item and the load of every bin; longest items first,
    each into the fullest bin that still has room.

    Open bins are kept by free room; a bit mask of the rooms in use finds the
    smallest that is large enough.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    loads: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    order = np.argsort(-lengths, kind="stable")
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> need
        if need and fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            b, room = len(loads), capacity
            loads.append(0)
        bins[i], offsets[i] = b, loads[b]
        loads[b] += need
        room -= need
        if room:
            by_room[room].append(b)
            mask |= 1 << room
    return bins, offsets, np.array(loads, np.int64)


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        closing = np.uint32(CLOSING_ID)
        for batch in batches:
            column = batch.column(1).fill_null("")
            _, offsets = buffer_of(column)
            for lo, hi in slices(offsets, SLICE):
                which, piece, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(encoder.of_texts(column.slice(lo, hi - lo))):
                    ids = np.append(ids, closing)
                    for n, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at:at + capacity]
                        which.append(lo + k)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32."""
    workers_ready(docs.sparkSession)
    cols = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = cols.schema["doc_id"].dataType.simpleString()
    return cols.mapInArrow(_cut(path, capacity),
                           f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _pack_partition(capacity: int):
    """Local best-fit; a bin's number is the partition and the bin in it."""
    def packed(table: pa.Table, first: int) -> tuple[pa.Table, int]:
        bins, offsets, loads = best_fit(table.column("length").to_numpy(), capacity)
        return (table.append_column("bin", pa.array(bins + first)).append_column("offset", pa.array(offsets))
                .append_column("load", pa.array(loads[bins]))), len(loads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, rows = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= RUN:
                table, made = packed(pa.Table.from_batches(held), first)
                first, held, rows = first + made, [], 0
                yield from table.to_batches(max_chunksize=10_000)
        if held:
            yield from packed(pa.Table.from_batches(held), first)[0].to_batches(max_chunksize=10_000)
    return run


def _pack_group(level: int, capacity: int):
    def run(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["load", "bin"], ascending=[False, True], kind="stable")
        bins, offsets, loads = best_fit(items["load"].to_numpy(), capacity)
        name = (level << 56) + (int(key[0]) << 28)
        return pd.DataFrame({"child": items["bin"].to_numpy(), "bin": bins + name, "at": offsets, "load": loads[bins]})
    return run


def pack(parts: DataFrame, capacity: int = CAPACITY, nearly: int = NEARLY) -> DataFrame:
    """``parts`` (with a ``length`` column) and ``sequence_id`` and ``offset``.

    ``parts`` has to be a stored table: its partitions are the tree's leaves.
    """
    workers_ready(parts.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    local = stored(parts.mapInArrow(_pack_partition(capacity), schema + ", bin long, offset long, load long"), "local")
    # a bin is told by its first piece
    under = local.filter((F.col("offset") == 0) & (F.col("load") < capacity - nearly)).select("bin", "load")
    n, level, moves = under.count(), 0, []
    while n > 1:
        level, groups = level + 1, -(-n // GROUP)
        node = F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)).alias("node")
        merged = stored(under.select(node, "bin", "load").groupBy("node").applyInPandas(
            _pack_group(level, capacity), "child long, bin long, at long, load long"), "merged")
        moves.append(merged.select("child", F.col("bin").alias("to"), "at"))
        first = merged.filter("at = 0")
        left = first.count()
        if groups == 1 or left > (1 - LEAST_JOINED) * n:
            break
        under = first.filter(F.col("load") < capacity - nearly).select("bin", "load")
        n = under.count()
    out = local.withColumnRenamed("bin", "sequence_id").drop("load")
    for move in moves:
        out = out.join(move, F.col("sequence_id") == F.col("child"), "left").select(
            *[F.col(f"`{c}`") for c in parts.columns], F.coalesce("to", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("at", F.lit(0))).alias("offset"))
    return out


def pack_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    return pack(stored(pieces(docs, path, id, text), "pieces"))

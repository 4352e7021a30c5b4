"""Passages of many words that stand in several documents, whatever their bytes.

Suffix dedup judges strings of a fixed number of bytes; a passage of short words may
be shorter than that.  Here the unit is a window of ``window`` words:

1. Winnowing over word hashes gives every window an anchor (the run of ``GRAM`` words
   with the smallest hash); windows whose anchor stands in one text only are not shared.
   An anchor owns a stretch of window starts, its segment.
2. A segment that stands in several documents is settled by its count.  Of the other
   segments of an anchor, each window is compared by a 128-bit print.
3. Shared windows go back to all texts that hold the segment, and the words they cover
   are counted.

Words are those of ``[^\\x20\\x09-\\x0D]+``, compared byte by byte; white space between
them does not count.  A text that repeats itself in short steps has one row for its
equal segments in a row.  A passage that only repeats inside one document is not shared;
rows that repeat a text share all of it.  Everything that is shuffled is an anchor
(about one for 20 words), a window of an anchor with different segments, or a mark.

Defined results: a null text, an empty one, and one below ``window`` words share
nothing; texts are read whole whatever their length; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerledger.llm import winnow
from playerledger.llm.common import stored, workers_ready
from playerledger.llm.words_np import BYTE, U, _powers, buffer_of, mix, slices, words_of

#: Fewest words of a passage: over 50.
WINDOW = 51
#: Words of an anchor.
GRAM = 12
SLICE = 1 << 18
#: A longer text is winnowed in pieces of so many window starts.
PIECE = 1 << 21
#: Rows of windows in a batch.
ROWS = 50_000


def sums_of(values: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial hash of the first i words."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(winnow.BASE, len(values) + 1)[:-1], dtype=np.uint64, out=out[1:])
    return out


def anchors(values: np.ndarray, ends: np.ndarray, window: int, gram: int = GRAM):
    """(row, place, first, last, hash, sums) of the word hashes ``values`` of consecutive
    texts that end at ``ends``: the text, where the anchor stands, the first and last
    window start it owns, its hash."""
    sums = sums_of(values)
    empty = np.zeros(0, np.int64)
    if len(values) < window:
        return empty, empty, empty, empty, np.zeros(0, np.uint64), sums
    at = np.arange(len(values) - gram + 1)
    grams = winnow.range_hash(sums, at, at + gram)
    low = U((1 << winnow.PLACE_BITS) - 1)
    best = (winnow.sliding_min((grams & ~low) | at.astype(np.uint64), window - gram + 1) & low).astype(np.int64)
    row = np.searchsorted(ends, np.arange(len(best)), "right")
    inside = np.arange(len(best)) + window <= ends[row]
    head = inside.copy()
    head[1:] &= ~inside[:-1] | (best[1:] != best[:-1])
    first = np.flatnonzero(head)
    last = np.flatnonzero(inside & np.concatenate((head[1:] | ~inside[1:], [True])))
    return row[first], best[first], first, last, grams[best[first]], sums


def _found(window: int, gram: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer_of(batch.column(3))
            for lo, hi in slices(offsets, SLICE):
                values, counts = words_of(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], byte=BYTE)
                ends = np.cumsum(counts)
                begins = ends - counts
                # only a text of its own is longer than a piece
                for at in range(0, max(len(values) - window + 1, 0), piece if hi - lo == 1 else max(len(values), 1)):
                    part = values[at:at + piece + window - 1] if hi - lo == 1 else values
                    row, place, first, last, h, sums = anchors(part, np.minimum(ends - at, len(part)), window, gram)
                    if not len(row):
                        continue
                    whole = winnow.range_hash(sums, first, last + window)
                    seg = mix(whole + (place - first).astype(np.uint64) * U(0x9FB21C651E98DF25))
                    n = last - first + 1
                    one, times = winnow.collapsed(row, first, n, h, seg)
                    which = pa.array(row[one] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[one].view(np.int64)), pa.array(seg[one].view(np.int64)),
                         *[batch.column(k).take(which) for k in range(3)],
                         pa.array((first[one] + at - begins[row[one]]).astype(np.int32)), pa.array(n[one].astype(np.int32)),
                         pa.array(times.astype(np.int32))],
                        ["h", "seg", "ta", "tb", "rows", "first", "n", "times"])
    return run


def _windows(window: int):
    """(h, seg, at, u, v, ta, tb, several): the windows asked of each text; u and v are a print."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer_of(batch.column(2))
            lists = batch.column(3)
            flat, border = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            asked = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("h", "seg", "first", "n", "several")}
            for i in range(len(batch)):
                values, _ = words_of(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]), byte=BYTE)
                prints = [sums_of(values), sums_of(mix(values + U(0x5851F42D4C957F2D)))]
                down = _powers(pow(winnow.BASE, -1, 1 << 64), len(values) + 1)
                step = max(1, ROWS // window)
                for k in range(int(border[i]), int(border[i + 1]), step):
                    own = slice(k, min(k + step, int(border[i + 1])))
                    n = asked["n"][own].astype(np.int64)
                    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    start = np.repeat(asked["first"][own], n) + at
                    u, v = (mix((s[start + window] - s[start]) * down[start]).view(np.int64) for s in prints)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(asked["h"][own], n)), pa.array(np.repeat(asked["seg"][own], n)), pa.array(at.astype(np.int32)),
                         pa.array(u), pa.array(v), pa.array(np.full(len(at), batch.column(0)[i].as_py(), np.int64)),
                         pa.array(np.full(len(at), batch.column(1)[i].as_py(), np.int32)), pa.array(np.repeat(asked["several"][own], n))],
                        ["h", "seg", "at", "u", "v", "ta", "tb", "several"])
    return run


def covered(runs: Column, window: int) -> Column:
    """Words under the windows that start in ``runs``, which are in order."""
    def add(acc: Column, r: Column) -> Column:
        end = r["hi"] + window
        more = F.greatest(F.lit(0), end - F.greatest(r["lo"], acc["end"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + more).alias("n"))

    return F.aggregate(runs, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), add, lambda acc: acc["n"])


def least_bytes(window: int) -> int:
    """A text of fewer bytes has no window."""
    return 2 * window - 1


def _several(*more: Column) -> Column:
    """Whether the rows of a group come from different texts."""
    return F.greatest(F.min("ta") != F.max("ta"), F.min("tb") != F.max("tb"), *more)


def shared_words(units: DataFrame, window: int = WINDOW, gram: int = GRAM, piece: int = PIECE) -> DataFrame:
    """(ta, tb, n_passage_words) of the texts that share a window with another row.

    ``units``: (ta, tb, rows, text), each distinct text once with the number of its rows.
    """
    workers_ready(units.sparkSession)
    copied = F.max("rows") > 1
    all = stored(units.filter(F.octet_length("text") >= least_bytes(window)).select("ta", "tb", "rows", "text").mapInArrow(
        _found(window, gram, piece), "h long, seg long, ta long, tb int, rows long, first int, n int, times int"), "word_anchors")
    shared = stored(all.groupBy("h").agg(_several(copied).alias("several")).filter("several").select("h"), "word_shared")
    held = stored(all.join(shared, "h"), "word_segments")
    segs = stored(held.groupBy("h", "seg").agg(
        _several(copied).alias("several"), *[F.first(c).alias(c) for c in ("ta", "tb", "first", "n")]), "word_distinct")
    split = segs.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("several").alias("done")).filter("c > 1 and not done")
    asked = segs.join(split.select("h"), "h").groupBy("ta", "tb").agg(
        F.collect_list(F.struct("h", "seg", "first", "n", "several")).alias("asks"))
    windows = stored(units.select("ta", "tb", "text").join(asked, ["ta", "tb"]).select("ta", "tb", "text", "asks").mapInArrow(
        _windows(window), "h long, seg long, at int, u long, v long, ta long, tb int, several boolean"), "word_windows")
    common = windows.groupBy("u", "v").agg(_several(F.max("several")).alias("common")).filter("common").select("u", "v")
    marks = (windows.filter(~F.col("several")).join(common, ["u", "v"]).select("h", "seg", F.col("at").alias("lo"), F.col("at").alias("hi"))
             .union(segs.filter("several").select("h", "seg", F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"))))
    marks = marks.groupBy("h", "seg").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    # windows reach beyond the next of equal segments: marks from the first to the last cover all between
    step = (F.col("times") - 1) * F.col("n")
    shifted = F.transform("runs", lambda r: F.struct((r["lo"] + F.col("first")).alias("lo"),
                                                     (r["hi"] + F.col("first") + F.col("step")).alias("hi")))
    runs = (held.select("h", "seg", "ta", "tb", "first", step.alias("step")).join(marks, ["h", "seg"]).select("ta", "tb", shifted.alias("runs"))
            .groupBy("ta", "tb").agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs")))
    return runs.select("ta", "tb", covered(F.col("runs"), window).alias("n_passage_words"))

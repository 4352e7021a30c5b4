"""Exact substring dedup: bytes of 400-byte strings that start anywhere else too.

1. Winnowing gives every 400-byte string an anchor; strings whose anchor occurs
   once in the corpus occur once themselves.  Each anchor owns a stretch of string
   starts; the bytes those strings cover are its segment.
2. Equal segments of one anchor are counted as one before anything is shuffled
   further.  An anchor whose segments are all equal is settled by the count; of
   the others each distinct segment is fetched once.
3. Segments go to shards by anchor.  A shard builds the suffix array of its
   segments (Larsson-Sadakane: sort by the first bytes, then refine only unsorted
   groups by doubling ranks, in numpy) and Kasai's common prefixes (along the text,
   only where they do not follow from the place before).  A start is repeated
   when its string has 400 bytes in common with a neighbour in the array.
4. An anchor with too many segments for a shard is spread over several.  These
   export the sorted prints of their distinct strings; prints are cut at
   fixed splitters by binary search, and merge tasks find those of several shards
   by binary search of the smaller in the larger lists.
5. Repeated starts go back to all texts that hold the segment, overlapping strings
   are joined to spans, and the remaining bytes hashed.
6. Passages of over 50 words may have fewer bytes: ``passages`` counts a document's words
   in runs that another document has too.  They are counted, not removed.

Texts are units by their content: one row a distinct text with the number of its
rows is made first, all work is done on units, and rows are joined to what was found
without their text.  Rows that repeat a text of 400 bytes or more hold nothing but
repeated strings.  Everything that moves is a unit, proportional to the anchors (about
one for 170 bytes) or to distinct repeated segments; groups are bounded by
``SHARD_SEGMENTS``.  A text that repeats itself in short steps has one anchor row for
all of its equal segments in a row.

Defined results: null text is empty; texts below 400 bytes keep everything; a
null id is carried along; rows that repeat are repeats of each other; very long texts
are read in pieces; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerledger.llm import passages, winnow
from playerledger.llm.common import stored, workers_ready
from playerledger.llm.words_np import BYTE, U, buffer_of, mix, slices
from playerledger.session import work_folder

SPAN = 400
SLICE = 1 << 18
#: Segments a shard holds at most, about 600 bytes each.
SHARD_SEGMENTS = 4_000
#: Prints one merge task takes, about.
MERGE_PRINTS = 500_000
#: A second byte table: prints of strings have 128 bits.
BYTE_2 = mix(BYTE + U(0x5851F42D4C957F2D))


# suffix arrays ---------------------------------------------------------------

def sevens(text: np.ndarray) -> np.ndarray:
    """For each place the seven symbols from there on as one number; 0 stands beyond the end."""
    n = len(text)
    wide = np.zeros(n + 14, np.int64)
    wide[:n] = text + 1
    key = np.zeros(n + 7, np.int64)
    for j in range(7):
        key = key * 258 + wide[j:n + 7 + j]
    return key


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``text`` (whole numbers from 0 to 256).

    Larsson-Sadakane: suffixes are sorted by seven symbols at first; then, with the
    number of sorted symbols doubling, only groups that are still tied are sorted
    by the rank of what follows.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    key = sevens(text)[:n]
    sa = np.argsort(key, kind="stable")
    sorted_key = key[sa]
    head = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    depth = 7
    # places in the array that belong to tied groups
    tied = np.flatnonzero(~head | ~np.concatenate((head[1:], [True])))
    while len(tied):
        at = sa[tied]
        follow = at + depth
        after = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        key = rank[at] * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[tied] = at
        head = np.concatenate(([True], key[1:] != key[:-1]))
        rank[at] = np.maximum.accumulate(np.where(head, tied, 0))
        tied = tied[~head | ~np.concatenate((head[1:], [True]))]
        depth *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """lcp[i]: symbols the i-th suffix in order has in common with the one before, ``most`` at most.

    Kasai's rule along the text: a suffix whose symbol in front equals the one in
    front of its predecessor in the array has one symbol less in common than the
    suffix one place earlier.  Only the other places are compared, seven symbols
    at a time.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    plcp = np.zeros(n, np.int64)
    i = np.arange(n)
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (text[:-1] == text[np.maximum(before[1:] - 1, 0)])
    start = np.flatnonzero(~follows & (before >= 0))
    key, wide = sevens(text), np.concatenate((text, np.full(7, -1, text.dtype)))
    length, on = np.zeros(len(start), np.int64), np.arange(len(start))
    # not cut at ``most`` here: places after it count down from the true length
    while len(on):
        on = on[key[start[on] + length[on]] == key[before[start[on]] + length[on]]]
        length[on] += 7
    a, b, going = start + length, before[start] + length, np.ones(len(start), bool)
    for k in range(6):
        going &= wide[np.minimum(a + k, n)] == wide[np.minimum(b + k, n)]
        length += going
    plcp[start] = length
    # the others count down from the last place that was compared
    base = np.maximum.accumulate(np.where(follows, -1, i))
    plcp = np.where(follows, np.maximum(plcp[base] - (i - base), 0), plcp)
    plcp[before < 0] = 0
    return np.minimum(plcp[sa], most)


# anchors and segments --------------------------------------------------------

#: A longer text is winnowed in pieces of so many string starts.
PIECE = 1 << 22


def _found(piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer_of(batch.column(3))
            for lo, hi in slices(offsets, SLICE):
                for at in range(int(offsets[lo]), max(int(offsets[lo]) + 1, int(offsets[hi]) - SPAN + 1), piece):
                    end = int(offsets[hi]) if hi - lo > 1 else min(at + piece + SPAN - 1, int(offsets[hi]))
                    border = offsets[lo:hi + 1] - at if hi - lo > 1 else np.array([0, end - at])
                    row, place, first, last, gram, sums = winnow.anchors(data[at:end], border, SPAN)
                    if len(row):
                        whole = winnow.range_hash(sums, first, last + SPAN)
                        seg = mix(whole + (place - first).astype(np.uint64) * U(0x9FB21C651E98DF25))
                        n = last - first + 1
                        one, times = winnow.collapsed(row, first, n, gram, seg)
                        which = pa.array(row[one] + lo)
                        start = at - offsets[lo + row[one]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(gram[one].view(np.int64)), pa.array(seg[one].view(np.int64)),
                             *[batch.column(k).take(which) for k in range(3)],
                             pa.array((first[one] + start).astype(np.int32)), pa.array(n[one].astype(np.int32)),
                             pa.array(times.astype(np.int32))],
                            ["h", "seg", "ta", "tb", "rows", "first", "n", "times"])
                    if hi - lo > 1:
                        break
    return run


def units_of(texts: DataFrame, least: int = SPAN) -> DataFrame:
    """(ta, tb, rows, text): each distinct text of ``least`` bytes or more, named by 96 bits, with
    the number of its rows."""
    named = texts.filter(F.octet_length("text") >= least).select(
        F.xxhash64("text").alias("ta"), F.hash("text").alias("tb"), "text")
    units = named.groupBy("ta", "tb").agg(F.count(F.lit(1)).alias("rows"), F.first("text").alias("text"))
    # in as many buckets as a shuffle has parts: joins by (ta, tb) move no text again
    spark = texts.sparkSession
    path = work_folder(spark, "units")
    name = f"playerledger_units_{path[-12:]}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units.write.format("parquet").option("path", path).bucketBy(parts, "ta", "tb").saveAsTable(name)
    return spark.table(name)


def segments(units: DataFrame, piece: int = PIECE) -> DataFrame:
    """(h, seg, ta, tb, rows, first, n, times) of every segment whose anchor occurs more than once.

    ``h`` is the anchor, ``seg`` the segment's content, ``first`` the first of the ``n`` string
    starts it owns in the text (ta, tb), which has ``rows`` rows; the segment stands there
    ``times`` times in a row.
    """
    workers_ready(units.sparkSession)
    all = stored(units.filter(F.octet_length("text") >= SPAN).select("ta", "tb", "rows", "text").mapInArrow(
        _found(piece), "h long, seg long, ta long, tb int, rows long, first int, n int, times int"), "anchors")
    # tables of their own: a join of two plain scans can be dealt anew where one anchor is hot
    shared = stored(all.groupBy("h").agg(F.sum(F.col("rows") * F.col("times")).alias("c")).filter("c > 1").select("h"), "shared")
    return stored(all.join(shared, "h"), "segments")


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, split, h, seg, n, once, data): the segments asked of each text."""
    for batch in batches:
        data, offsets = buffer_of(batch.column(0))
        lists = batch.column(1)
        flat = lists.flatten()
        border = lists.offsets.to_numpy()
        row = np.repeat(np.arange(len(batch)), np.diff(border))
        first, n = flat.field("first").to_numpy(), flat.field("n").to_numpy()
        for at in range(0, len(row), 5_000):
            part = slice(at, at + 5_000)
            begin = offsets[row[part]] + first[part]
            cut = [data[a:b].tobytes() for a, b in zip(begin, begin + n[part] + SPAN - 1)]
            yield pa.RecordBatch.from_arrays(
                [*[flat.field(c).slice(at, 5_000) for c in ("shard", "split", "h", "seg", "n", "once")], pa.array(cut, pa.binary())],
                ["shard", "split", "h", "seg", "n", "once", "data"])


# shards ----------------------------------------------------------------------

REF = np.dtype([("h", np.int64), ("seg", np.int64), ("at", np.int32)])
FOUND = "kind int, h long, seg long, part int, prints binary, refs binary, runs array<struct<lo:int,hi:int>>"


def runs_of(marked: np.ndarray) -> list[dict]:
    """The stretches of true values as first and last place."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return [{"lo": int(a), "hi": int(b) - 1} for a, b in zip(edge[0::2], edge[1::2])]


def _sorted_prints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit prints of the strings at ``at``, sorted, and the order."""
    out = np.empty((len(at), 2), ">u8")
    for k, table in enumerate((BYTE, BYTE_2)):
        sums = winnow.prefix_sums(data, table)
        out[:, k] = winnow.range_hash(sums, at, at + SPAN)
    prints = out.reshape(-1).view("S16")
    order = np.argsort(prints, kind="stable")
    return prints[order], order


def shard_repeats(h: np.ndarray, seg: np.ndarray, n: np.ndarray, once: np.ndarray, data: list[bytes], split: bool,
                  parts: int) -> Iterator[tuple]:
    """What one shard finds: (0, h, seg, .., runs) for segments with repeated starts and,
    for a split anchor, (1, .., part, prints, refs) for the merge."""
    sizes = np.array([len(d) for d in data], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    joined = np.frombuffer(b"\0".join(data), np.uint8)
    text = joined.astype(np.int16) + 1
    text[begin[1:] - 1] = 0
    sa = suffix_array(text)
    lcp = common_prefixes(text, sa, SPAN)
    alike = np.zeros(len(text), bool)
    # only starts that a segment owns count, as strings and as their partners
    owner = np.repeat(np.arange(len(n)), sizes + 1)[:len(text)]
    own = np.arange(len(text)) - begin[owner] < n[owner]
    group = np.cumsum(lcp < SPAN)
    mine = own[sa]
    several = np.bincount(group[mine], minlength=group[-1] + 1) > 1
    alike[sa[mine & several[group]]] = True
    for i in np.flatnonzero(once):
        found = alike[begin[i]:begin[i] + n[i]]
        if found.any():
            yield 0, int(h[i]), int(seg[i]), None, None, None, runs_of(found)
    if split:
        # one start of each string that is repeated here, and every other start
        heads = np.zeros(len(text), bool)
        first = np.unique(group[mine], return_index=True)[1]
        heads[sa[mine][first]] = True
        at = np.flatnonzero(own & (heads | ~alike))
        prints, order = _sorted_prints(joined, at)
        at = at[order]
        refs = np.zeros(len(at), REF)
        refs["h"], refs["seg"] = h[owner[at]], seg[owner[at]]
        refs["at"] = np.where(once[owner[at]] & ~alike[at], at - begin[owner[at]], -1)
        splitters = np.array([(k * (1 << 64) // parts).to_bytes(8, "big") + b"\0" * 8 for k in range(1, parts)], "S16")
        cut = [0, *np.searchsorted(prints, splitters).tolist(), len(prints)]
        for part, (a, b) in enumerate(zip(cut, cut[1:])):
            if a < b:
                yield 1, None, None, part, prints[a:b].tobytes(), refs[a:b].tobytes(), None


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that agree in the first column, which is sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(0).to_numpy()
        cut = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)] if len(key) else []
        for a, b in zip(cut, cut[1:]):
            if held and held[-1].column(0)[0].as_py() != int(key[a]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


FOUND_TYPE = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("seg", pa.int64()), ("part", pa.int32()),
                        ("prints", pa.binary()), ("refs", pa.binary()),
                        ("runs", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in FOUND_TYPE]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, FOUND_TYPE)], schema=FOUND_TYPE)


def _shards(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            _, split, h, seg, n, once = (table.column(k).to_numpy() for k in range(6))
            yield _rows(list(shard_repeats(h, seg, n, once, table.column(6).to_pylist(), bool(split[0]), parts)))
    return run


# merging ---------------------------------------------------------------------

def merged(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(prints, refs) in all lists whose print is in more than one of them.

    Sorted lists are merged two by two; the shorter is looked up in the longer by
    binary search.
    """
    found: list[np.ndarray] = []
    while len(lists) > 1:
        lists.sort(key=lambda x: len(x[0]))
        level = []
        for (p, r), (q, s) in zip(lists[0::2], lists[1::2]):
            at = np.searchsorted(q, p)
            same = (at < len(q)) & (q[np.minimum(at, len(q) - 1)] == p)
            found += [r[same], s[at[same]]]
            level.append((np.insert(q, at[~same], p[~same]), np.insert(s, at[~same], r[~same])))
        lists = level + ([lists[-1]] if len(lists) % 2 else [])
    refs = np.concatenate(found) if found else np.zeros(0, REF)
    return refs[refs["at"] >= 0]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _grouped(batches):
        lists = [(np.frombuffer(p, "S16"), np.frombuffer(r, REF))
                 for p, r in zip(table.column(1).to_pylist(), table.column(2).to_pylist())]
        refs = np.unique(merged(lists))
        rows = []
        if len(refs):
            cut = [0, *(np.flatnonzero((refs["h"][1:] != refs["h"][:-1]) | (refs["seg"][1:] != refs["seg"][:-1])) + 1).tolist(),
                   len(refs)]
            for a, b in zip(cut, cut[1:]):
                marked = np.zeros(int(refs["at"][b - 1]) + 1, bool)
                marked[refs["at"][a:b]] = True
                rows.append((0, int(refs["h"][a]), int(refs["seg"][a]), None, None, None, runs_of(marked)))
        yield _rows(rows)


# the whole -------------------------------------------------------------------

def repeated_starts(units: DataFrame, shard_segments: int = SHARD_SEGMENTS, piece: int = PIECE) -> DataFrame:
    """(ta, tb, runs): for each text the stretches of places where a repeated string starts."""
    held = segments(units, piece)
    segs = stored(held.groupBy("h", "seg").agg(
        F.sum(F.col("rows") * F.col("times")).alias("occ"), *[F.first(c).alias(c) for c in ("ta", "tb", "first", "n")]), "distinct")
    several = stored(segs.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "several")
    todo = stored(segs.join(several, "h"), "todo")
    total, large = todo.agg(F.count(F.lit(1)), F.sum(F.when(F.col("c") > shard_segments, 1))).first()
    shards = -(-2 * total // shard_segments) or 1
    parts = -(-(large or 0) * 200 // MERGE_PRINTS) or 1
    split = F.col("c") > shard_segments
    spread = F.pmod("seg", F.ceil(F.col("c") / shard_segments * 2))
    asked = todo.select("ta", "tb", F.struct(
        F.when(split, F.xxhash64("h", spread)).otherwise(F.pmod(F.xxhash64("h"), F.lit(shards))).alias("shard"),
        split.alias("split"), "h", "seg", "n", (F.col("occ") == 1).alias("once"), "first").alias("ask"))
    asked = asked.groupBy("ta", "tb").agg(F.collect_list("ask").alias("asks"))
    one = units.join(asked, ["ta", "tb"]).select("text", "asks")
    data = one.mapInArrow(_bytes, "shard long, split boolean, h long, seg long, n int, once boolean, data binary")
    found = stored(data.repartition("shard").sortWithinPartitions("shard").mapInArrow(_shards(parts), FOUND), "found")
    prints = found.filter("kind = 1").select("part", "prints", "refs").repartition("part").sortWithinPartitions("part")
    more = prints.mapInArrow(_merge, FOUND)
    marks = (found.filter("kind = 0").union(more).select("h", "seg", "runs")
             .union(segs.filter("occ > 1").select("h", "seg", F.array(F.struct(
                 F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"))))))
    # strings reach beyond the next of equal segments: marks from the first to the last cover all between
    step = (F.col("times") - 1) * F.col("n")
    marked = held.select("h", "seg", "ta", "tb", "first", step.alias("step")).join(marks, ["h", "seg"])
    shifted = F.transform("runs", lambda r: F.struct((r["lo"] + F.col("first")).alias("lo"),
                                                     (r["hi"] + F.col("first") + F.col("step")).alias("hi")))
    return (marked.select("ta", "tb", shifted.alias("runs")).groupBy("ta", "tb")
            .agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs")))


def spans_of(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of the bytes covered by strings that start from ``lo`` to ``hi``; ``lo`` ascending."""
    end = np.maximum.accumulate(hi + SPAN)
    new = np.concatenate(([True], lo[1:] > end[:-1]))
    return lo[new], end[np.concatenate((new[1:], [True]))]


SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _cut(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer_of(batch.column(2))
            lists = batch.column(3)
            flat, border = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            lows, highs = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "hi"))
            for first, last in slices(offsets, 1 << 22):
                rows = []
                for i in range(first, last):
                    text, own = data[offsets[i]:offsets[i + 1]], slice(border[i], border[i + 1])
                    a, b = spans_of(lows[own], highs[own])
                    spans = [{"lo": x, "hi": y} for x, y in zip(a.tolist(), b.tolist())]
                    edges = [0, *np.stack((a, b), 1).reshape(-1).tolist(), len(text)]
                    parts = [text[x:y] for x, y in zip(edges[0::2], edges[1::2])]
                    digest = hashlib.sha256()
                    for part in parts:
                        digest.update(part)
                    rows.append((len(text) - sum(map(len, parts)), len(spans), digest.hexdigest(), spans,
                                 b"".join(p.tobytes() for p in parts) if with_bytes else None))
                kinds = [pa.int64()] * 2 + [pa.string(), SPANS, pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(first, last - first) for k in range(2)], *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                    ["ta", "tb", "n_removed", "n_spans", "sha", "spans", "kept"])
    return run


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", shard_segments: int = SHARD_SEGMENTS,
                    piece: int = PIECE, with_bytes: bool = True, window: int = passages.WINDOW) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept, n_passage_words) for every row of
    ``docs``; ``spans`` is what was removed, ``kept`` the remaining bytes (null when not asked for),
    ``n_passage_words`` the words in runs of ``window`` words that another row has too."""
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    units = units_of(rows.select("text"), min(SPAN, passages.least_bytes(window)))
    runs = repeated_starts(units, shard_segments, piece)
    found = units.select("ta", "tb", "text").join(runs, ["ta", "tb"]).select("ta", "tb", "text", "runs").mapInArrow(
        _cut(with_bytes), "ta long, tb int, n_removed long, n_spans long, sha string, spans array<struct<lo:int,hi:int>>, kept binary")
    # rows meet what was found without their text, whole texts need no worker
    whole = F.col("text").cast("binary")
    own = rows.select("id", F.xxhash64("text").alias("ta"), F.hash("text").alias("tb"), F.octet_length("text").cast("long").alias("n_bytes"),
                      F.sha2(whole, 256).alias("whole_sha"), (whole if with_bytes else F.lit(None).cast("binary")).alias("whole"))
    return (own.join(found, ["ta", "tb"], "left").join(passages.shared_words(units, window), ["ta", "tb"], "left").select(
        F.col("id").alias(id), "n_bytes", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")],
        F.coalesce("sha", "whole_sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"), F.coalesce("kept", "whole").alias("kept"),
        F.coalesce("n_passage_words", F.lit(0)).cast("long").alias("n_passage_words")))

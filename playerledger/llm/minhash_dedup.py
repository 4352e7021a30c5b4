"""Near-duplicate documents by SuperMinHash signatures.

1. One pass over the texts: the set of five-word shingles of every document (as
   64-bit hashes), a 128-bit print of the whole set, and a SuperMinHash signature
   of 128 slots cut into 32 bands of 4.  At the threshold of 0.75 a pair shares
   no band with a chance of 5e-6.
2. Documents with equal sets are one class; the classes are numbered, and of each only
   the text of its smallest id goes on.
3. Band buckets with two or more classes give candidates.  Within a bucket
   signatures are compared in blocks; at first each member names its best partner.
   Then buckets that still hold several components get their members' texts, and
   their pairs across components whose signatures agree nearly as much as the
   threshold asks are confirmed on the spot, each in the first bucket it shares.
   Members of a bucket's largest component are only compared with the others, so a
   group of thousands of near copies costs a pair a member, and no agreeing pair
   across components is left untested.  Buckets above a bound are first compared in
   parts; when components are known from those, each pair of parts in which a member
   outside the bucket's largest component stands is a block of its own.
4. Candidates are confirmed on full shingle sets, classes grouped by connected
   components; a component gets the name of its smallest id last.

Defined results: null or empty text (or no words) has no shingles and links with
nothing; fewer words than five are one shingle; rows with a null id link with
nothing; rows that repeat an id are one document for linking, with whatever each of
their texts links to, and all get its verdict; texts are read whole, whatever their
length; an empty table gives an empty table; other columns are ignored, whatever their
names.  ``one_of_each`` keeps a single row of a document that is repeated, that with the
smallest hash of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerledger.llm import words_np
from playerledger.llm.common import free_name, stored, workers_ready
from playerledger.llm.components import components

U = np.uint64
SHINGLE = 5
PERCENT = 75
SLOTS = 128
BANDS = 32
#: Texts are taken in slices of so many bytes.
SLICE = 1 << 20
#: Slots in which two signatures must agree to be tested (at the threshold 96 do, with a
#: deviation of 5: four deviations less).
LEAST_SLOTS = 76
#: Larger buckets are compared in blocks of two parts.
LARGE_BUCKET = 2048
#: Parsed shingle sets kept at hand while pairs are confirmed.
SETS_AT_HAND = 64


def superminhash(row: np.ndarray, values: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """(rows, slots) signature of the sets ``values`` grouped by ``row``.

    Element by element SuperMinHash visits the slots in its own random order and
    offers rank + fraction to the rank-th slot of that order.  Here all elements
    take rank j together; a set whose slots are all filled with values up to j
    can gain nothing from rank j on and stops early.  A set without elements
    keeps infinity.
    """
    h = np.full((rows, slots), np.inf)
    active = np.arange(len(values))
    order = None
    for j in range(slots):
        if not len(active):
            break
        rnd = words_np.mix(values[active] + U((j + 1) * int(words_np.BASE) % (1 << 64)))
        fraction = (rnd >> U(32)).astype(np.float64) / 4294967296.0
        k = j + (((rnd & U(0xFFFFFFFF)) * U(slots - j)) >> U(32)).astype(np.int64)
        if j == 0:
            slot = k
        else:
            i = np.arange(len(active))
            slot = order[i, k].astype(np.int64)
            order[i, k] = order[:, j]
            order[:, j] = slot
        at = row[active]
        np.minimum.at(h.reshape(-1), at * slots + slot, fraction + j)
        on = (h.max(axis=1) > j + 1)[at]
        if order is None:
            kept = k[on]
            order = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(kept), slots)).copy()
            i = np.arange(len(kept))
            order[i, kept] = 0
            order[:, 0] = kept
        elif not on.all():
            order = order[on]
        active = active[on]
    return h


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(rows, bands): one hash a band, different bands never meet."""
    rows, slots = signature.shape
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(rows, bands, slots // bands)
    out = np.zeros((rows, bands), np.uint64)
    for j in range(bits.shape[2]):
        out = words_np.mix(out * U(0xD1342543DE82EF95) + bits[:, :, j])
    return words_np.mix(out + np.arange(bands, dtype=np.uint64) * words_np.BASE)


def distinct_shingles(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, row of each, value) of the distinct shingles, slice by slice."""
    data, offsets = words_np.buffer_of(column)
    for lo, hi in words_np.slices(offsets, SLICE):
        hashed, counts = words_np.words_of(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        row, value = words_np.shingles(hashed, counts, k)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        yield lo, hi, row[first], value[first]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, row, value in distinct_shingles(batch.column(1), SHINGLE):
            n = hi - lo
            sizes = np.bincount(row, minlength=n)
            prints = np.zeros((2, n), np.uint64)
            np.add.at(prints[0], row, value)
            np.add.at(prints[1], row, words_np.mix(value))
            signature = superminhash(row, value, n)
            bands = band_hashes(signature)
            short = words_np.mix(signature.view(np.uint64)).astype(np.uint16)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), _signed(bands.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), batch.column(2).slice(lo, n), pa.array(sizes.astype(np.int64)),
                 _signed(prints[0]), _signed(prints[1]), flat,
                 pa.array([x.tobytes() for x in short], pa.binary())],
                ["id", "t", "n_shingles", "print_a", "print_b", "bands", "prints"])


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text, t): ``t`` tells the texts of one id apart."""
    return docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("t"))


def signatures(docs: DataFrame, id: str, text: str) -> DataFrame:
    workers_ready(docs.sparkSession)
    return _rows(docs, id, text).mapInArrow(
        _sign, "id long, t long, n_shingles long, print_a long, print_b long, bands array<long>, prints binary")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at_hand: dict[int, np.ndarray] = {}

    def shingle_set(key: int, column: pa.Array, i: int) -> np.ndarray:
        if key not in at_hand:
            if len(at_hand) >= SETS_AT_HAND:
                at_hand.clear()
            data, offsets = words_np.buffer_of(column.slice(i, 1))
            hashed, counts = words_np.words_of(data, offsets)
            at_hand[key] = np.unique(words_np.shingles(hashed, counts, SHINGLE)[1])
        return at_hand[key]

    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        linked = np.zeros(len(a), bool)
        for i in range(len(a)):
            x, y = shingle_set(int(a[i]), batch.column(2), i), shingle_set(int(b[i]), batch.column(3), i)
            both = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - both
            linked[i] = union > 0 and 100 * both >= PERCENT * union
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(linked)], ["a", "b", "linked"])


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, linked) for pairs of ids, by the full shingle sets of their texts."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return stored(joined.mapInArrow(_confirm, "a long, b long, linked boolean"), "confirmed")


def _agreeing(prints: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Slots in which each of the members ``lo`` to ``hi`` agrees with each member."""
    out = np.zeros((hi - lo, len(prints)), np.int16)
    if len(prints) <= 64:
        out += (prints[lo:hi, None, :] == prints[None, :, :]).sum(axis=2, dtype=np.int16)
    else:
        for s in range(prints.shape[1]):
            out += prints[lo:hi, s, None] == prints[None, :, s]
    return out


def _first_band(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).reshape(len(x), BANDS, -1).all(axis=2).argmax(axis=1)


def bucket_pairs(c: np.ndarray, prints: np.ndarray, top: int | None, band: int = -1, side: np.ndarray | None = None
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of one bucket across components whose signatures agree in ``LEAST_SLOTS`` or more.

    Members outside the largest component give their ``top`` best partners, or all;
    of all partners only those with whom ``band`` is the first band they share, as
    each other band they share has a bucket of its own.  Members of one ``side`` are
    not compared.
    """
    names, sizes = np.unique(c, return_counts=True)
    if len(names) < 2:
        return
    ask = np.flatnonzero(c != names[np.argmax(sizes)]) if top is None or sizes.max() > 1 else np.arange(len(c))
    order = np.concatenate((ask, np.setdiff1d(np.arange(len(c)), ask)))
    c, prints = c[order], prints[order]
    for lo in range(0, len(ask), 256):
        hi = min(lo + 256, len(ask))
        slots = _agreeing(prints, lo, hi)
        slots[c[lo:hi, None] == c[None, :]] = 0
        if side is not None:
            slots[side[order[lo:hi], None] == side[order][None, :]] = 0
        if top is not None and top < len(c):
            best = np.argpartition(-slots, top - 1, axis=1)[:, :top]
            i, j = np.repeat(np.arange(hi - lo), top), best.reshape(-1)
            on = slots[i, j] >= LEAST_SLOTS
            i, j = i[on], j[on]
        else:
            i, j = np.nonzero(slots >= LEAST_SLOTS)
            if band >= 0 and len(i):
                first = [_first_band(prints[i[at:at + 4096] + lo], prints[j[at:at + 4096]]) for at in range(0, len(i), 4096)]
                here = np.concatenate(first) == band
                i, j = i[here], j[here]
        yield order[i + lo], order[j]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows ordered by bucket, some whole buckets at a time; a bucket is held until the next begins."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        bucket = batch.column(0).to_numpy()
        at = len(bucket) - int((bucket[::-1] != bucket[-1]).argmax()) if (bucket != bucket[-1]).any() else 0
        if at or (held and held[-1].column(0)[0].as_py() != bucket[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _cut_buckets(table: pa.Table) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(rows, ids, components, prints, band) of each bucket."""
    bucket, band, ids, c = (table.column(k).to_numpy() for k in range(4))
    prints = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint16).reshape(len(ids), SLOTS)
    cut = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(ids)]))
    for a, b in zip(cut.tolist(), cut[1:].tolist()):
        if a < b:
            yield slice(a, b), ids[a:b], c[a:b], prints[a:b], int(band[a])


def _pair_batch(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    x, y = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    both = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y))), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def _candidates(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _buckets(batches):
            found = [(ids[i], ids[j]) for _, ids, c, prints, _ in _cut_buckets(table) for i, j in bucket_pairs(c, prints, top)]
            if found:
                yield _pair_batch(found)
    return run


def _sides(table: pa.Table, rows: slice) -> np.ndarray | None:
    """The part of each of a block's members, if the block is one of two parts."""
    side = table.column("side").to_numpy()[rows]
    return side if side[0] >= 0 else None


def _agreeing_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each bucket that have a pair to be confirmed."""
    for table in _buckets(batches):
        for rows, _, c, prints, band in _cut_buckets(table):
            asked = np.zeros(len(c), bool)
            for i, j in bucket_pairs(c, prints, None, band, _sides(table, rows)):
                asked[i] = asked[j] = True
            if asked.any():
                yield from table.take(pa.array(rows.start + np.flatnonzero(asked))).combine_chunks().to_batches()


def _links_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed links across components of each bucket, whose members' texts are at hand."""
    for table in _buckets(batches):
        found = []
        for rows, ids, c, prints, band in _cut_buckets(table):
            pairs = list(bucket_pairs(c, prints, None, band, _sides(table, rows)))
            if not any(len(i) for i, _ in pairs):
                continue
            i, j = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            texts, sets = table.column("text").slice(rows.start, rows.stop - rows.start).combine_chunks(), {}
            for k in np.unique(np.concatenate((i, j))).tolist():
                data, offsets = words_np.buffer_of(texts.slice(k, 1))
                sets[k] = np.unique(words_np.shingles(*words_np.words_of(data, offsets), SHINGLE)[1])
            # one member at a time against its partners in components not yet joined to its own
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            edge = [0, *(np.flatnonzero(i[1:] != i[:-1]) + 1).tolist(), len(i)]
            for a, b in zip(edge, edge[1:]):
                own = sets[int(i[a])]
                for at in range(a, b, 64):
                    part = j[at:min(at + 64, b)]
                    part = part[c[part] != c[i[a]]]
                    if not len(part):
                        continue
                    others = [sets[int(k)] for k in part]
                    sizes = np.array([len(o) for o in others])
                    flat = np.concatenate(others)
                    place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                    both = np.add.reduceat((own[place] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
                    linked = part[100 * both >= PERCENT * (len(own) + sizes - both)]
                    if len(linked):
                        found.append((np.full(len(linked), ids[i[a]]), ids[linked]))
                        c = np.where(np.isin(c, c[linked]), c[i[a]], c)
        if found:
            yield _pair_batch(found)


def candidates(members: DataFrame) -> DataFrame:
    """(a, b): each member's best partner in each of its buckets."""
    dealt = members.select("bucket", "band", "id", F.col("id").alias("c"), "prints")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_candidates(1), "a long, b long").distinct()


def remaining_links(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): all confirmed links across components that the buckets still hold.

    Only buckets with several components get their texts, and only links come out.
    """
    now = stored(members.join(labels, members["id"] == labels["node"], "left")
                 .select("bucket", "band", "id", F.coalesce("component", "id").alias("c"), "prints"), "labelled")
    split = now.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("bucket")
    rows = now.join(split, "bucket").join(texts, "id").select("bucket", "band", "id", "c", "prints", "text", F.lit(-1).alias("side"))
    return stored(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_links_within, "a long, b long"), "remaining")


def crossing_links(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): all confirmed links across components of buckets too large for one task.

    Members outside a bucket's largest component are cut into parts that meet each
    other and every part of the largest.  Only rows with an agreeing partner get texts.
    """
    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    now = stored(members.join(labels, members["id"] == labels["node"], "left")
                 .select("bucket", "id", F.coalesce("component", "id").alias("c"), "prints"), "labelled")
    held = now.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("bucket").agg(
        F.max_by("c", F.struct("k", "c")).alias("most"), F.max("k").alias("inside"), (F.sum("k") - F.max("k")).alias("outside"))
    part_rows = max(1, LARGE_BUCKET // 2)
    held = held.filter("outside > 0").select("bucket", "most", F.ceil(F.col("outside") / part_rows).cast("int").alias("asking"),
                                             F.ceil(F.col("inside") / part_rows).cast("int").alias("asked"))
    asks, place = F.col("c") != F.col("most"), F.xxhash64("id", "bucket")
    part = F.when(asks, F.pmod(place, "asking")).otherwise(F.col("asking") + F.pmod(place, "asked")).cast("int")
    others = F.sequence(F.lit(0), F.when(asks, F.col("asking") + F.col("asked")).otherwise(F.col("asking")) - 1)
    blocks = (now.join(held, "bucket").withColumn("part", part).withColumn("other", F.explode(others))
              .select(F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).alias("bucket"), F.lit(-1).alias("band"), "id", "c", "prints",
                      F.when(F.col("part") == F.col("other"), -1).otherwise(F.col("part")).alias("side")))
    rows = stored(blocks.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _agreeing_members, "bucket long, band int, id long, c long, prints binary, side int"), "agreeing")
    rows = rows.join(texts, "id").select("bucket", "band", "id", "c", "prints", "text", "side")
    return stored(rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_links_within, "a long, b long"), "crossing")


def sized(members: DataFrame) -> DataFrame:
    """(bucket, band, id, n, lead) of buckets with two members or more."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lead")).filter("n > 1")
    return stored(members.join(sizes, "bucket").select("bucket", "band", "id", "n", "lead"), "members")


def bounded(members: DataFrame) -> DataFrame:
    """``sized`` members with those above ``LARGE_BUCKET`` in parts, the whole bucket's smallest id in each.

    Parts find most components; what they leave is for ``crossing_links``.
    """
    part = F.pmod(F.xxhash64("id", "bucket"), F.ceil(F.col("n") / LARGE_BUCKET * 2)).alias("part")
    large = members.filter(F.col("n") > LARGE_BUCKET).select("bucket", "id", "lead", part)
    parts = large.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("lead"))
    cut = large.select("bucket", "part", "id").union(parts.select("bucket", "part", F.col("lead").alias("id"))).distinct()
    cut = cut.join(parts, ["bucket", "part"]).select(
        F.xxhash64("bucket", "part").alias("bucket"), F.lit(-1).alias("band"), "id", F.col("n") + 1, "lead")
    return members.filter(F.col("n") <= LARGE_BUCKET).union(cut)


def label(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, t, n_shingles, component_id) for every row of ``docs``; ``id`` as long, ``t`` a hash of its text."""
    signed = stored(signatures(docs, id, text), "signed")
    sets = signed.filter("n_shingles > 0 and id is not null")
    # a table of its own: its join with the rows can be dealt anew where a class is hot;
    # classes are numbered, as an id with several texts is in several of them
    classes = stored(sets.groupBy("print_a", "print_b").agg(
        F.min(F.struct("id", "t")).alias("of"), F.first("bands").alias("bands"), F.first("prints").alias("prints"))
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    whole = sized(classes.select(F.col("class").alias("id"), F.posexplode("bands").alias("band", "bucket"))
                  .groupBy("bucket", "id").agg(F.min("band").alias("band")))
    large = whole.filter(F.col("n") > LARGE_BUCKET)
    members = whole if large.isEmpty() else bounded(whole)
    asked = classes.join(members.select(F.col("id").alias("class")).distinct(), "class", "left_semi").select("class", "of.id", "of.t")
    texts = stored(_rows(docs, id, text).join(asked, ["id", "t"]).select(F.col("class").alias("id"), "text").dropDuplicates(["id"]), "texts")
    # copies belong to their class; an id with several texts ties their classes together
    classed = stored(sets.join(classes.select("print_a", "print_b", "class"), ["print_a", "print_b"])
                     .select("id", "class").distinct(), "classed")
    several = classed.groupBy("id").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi")
    tied = classed.join(several, "id").select(F.col("class").alias("a"), F.col("lo").alias("b"))
    # a bucket of two is settled by its one pair
    two = members.filter("n = 2 and id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b"))
    prints = classes.select("class", "prints")
    more = members.filter("n > 2").select("bucket", "band", "id").join(prints, F.col("id") == F.col("class"))
    more = stored(more.select("bucket", "band", "id", "prints"), "more")
    tested = confirm(two.union(candidates(more)).distinct(), texts).filter("linked").select("a", "b").union(tied)
    labels = components(tested)
    last = remaining_links(more, labels, texts)
    if not last.isEmpty():
        tested = tested.union(last)
        labels = components(tested)
    if not large.isEmpty():
        far = crossing_links(large.join(prints, F.col("id") == F.col("class")), labels, texts)
        if not far.isEmpty():
            labels = components(tested.union(far))
    # components of classes become components of ids, named by the smallest
    of_class = labels.select(F.col("node").alias("class"), "component")
    grouped = stored(classed.join(of_class, "class", "left").select("id", F.coalesce("component", "class").alias("component"))
                     .distinct(), "grouped")
    least = stored(grouped.groupBy("component").agg(F.min("id").alias("component_id")), "least")
    groups = grouped.join(least, "component").select("id", "component_id")
    return (signed.select("id", "t", "n_shingles").join(groups, "id", "left")
            .select("id", "t", "n_shingles", F.coalesce("component_id", "id").alias("component_id")))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group, in their own columns.

    Rows without an id stay: nothing links them.
    """
    name, hashed, rows = (free_name(docs, x) for x in ("kept_id", "kept_text", "kept_rows"))
    kept = label(docs, id, text).filter("id = component_id").groupBy(F.col("id").alias(name)).agg(
        F.min("t").alias(hashed), F.count(F.lit(1)).alias(rows))
    key, own = F.col(f"`{id}`"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    found = docs.join(kept, key == F.col(name), "left").filter(key.isNull() | (F.col(name).isNotNull() & (own == F.col(hashed))))
    alone = F.coalesce(F.col(rows), F.lit(1)) == 1
    again = found.filter(~alone).dropDuplicates([id])
    return found.filter(alone).unionByName(again).drop(name, hashed, rows)

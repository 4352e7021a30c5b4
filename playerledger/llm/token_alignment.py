"""Alignment of two tokenizers: which tokens of a text end at the same byte.

Both vocabularies encode the same bytes (a space and the text).  A byte where a token
of each ends is a shared cut; between two neighbouring cuts lies a group of tokens
that only match as a whole.  Two tokens that end together are linked, and a pair of
ids is counted over the corpus by its links.

1. A text is cut at single spaces, where both vocabularies cut too; every distinct
   word is encoded by the libraries once and remembered.  Texts with other runs of
   white space are encoded whole.
2. Cuts are found by divide and conquer: in an interval between two cuts, the ends of
   the first vocabulary nearest to the middle are looked up among the second one's by
   bisection, farther and farther out, until one is shared; the interval falls into
   the two halves beside it.  An interval without an inner cut is a group.  All
   intervals of many texts go through each step together, in numpy.
3. Links of a text are kept as packed id pairs in a stored table; tasks count them, and
   Spark adds the counts up.
4. Of two linked tokens one is a tail of the other, so there are at most as many pairs
   as all tokens of both vocabularies have bytes (``most_pairs``).  The counts are
   therefore small whatever the corpus is, and go to every task.

Defined results: texts that are null, empty or not reproduced byte by byte by both
vocabularies have no tokens; special strings are plain text; texts are aligned whole,
whatever their length; rows that repeat count again; a null id is carried along; an
empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerledger.llm.common import stored, workers_ready
from playerledger.llm.token_counts import _vocabulary
from playerledger.llm.token_ids import Memory, dictionary
from playerledger.llm.words_np import buffer_of, slices

#: Text bytes aligned together.
SLICE = 1 << 20
#: Words remembered at most.
MOST_WORDS = 400_000
#: Texts that are not cut at spaces: a space beside white space or at an end, or
#: characters that not every library takes for white space.
WHOLE = r"[ ][\s\p{Z}\x{85}]|^[\s\p{Z}\x{85}]|[ ]$|[\x1c-\x1f]"
WORD_START = "▁"


# vocabularies ----------------------------------------------------------------

class Pair:
    """Two vocabularies: a byte-level one of ``tokenizers`` and one of ``sentencepiece``."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        special = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        texts = _vocabulary(path_a)[1]
        self.bytes_a = [special.get(i) or (texts[i] if i < len(texts) else b"") for i in range(max([len(texts), *(i + 1 for i in special)]))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(WORD_START, " ").encode()
                        for i, p in enumerate(pieces)]
        #: Whether no piece reaches from one word into the next.
        self.by_word = not any(WORD_START in p.lstrip(WORD_START) for p in pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.words = Memory(MOST_WORDS)
        self.decimal, self.width = _decimals(max(len(self.bytes_a), len(self.bytes_b)))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The packed ids of both vocabularies for whole texts; None where they don't give the text's bytes."""
        out = []
        found_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        for t, a, b in zip(texts, found_a, self.b.encode(texts, num_threads=1)):
            a, whole = a.ids, (" " + t).encode()
            good = b"".join([self.bytes_a[i] for i in a]) == whole == b"".join([self.bytes_b[i] for i in b])
            out.append((np.array(a, np.uint32).tobytes(), np.array(b, np.uint32).tobytes()) if good else None)
        return out

    def encode_words(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """``encode`` of words without a space, many a call: the first vocabulary cuts before each space."""
        joined = " " + " ".join(words)
        (a,) = self.a.encode_batch_fast([joined], add_special_tokens=False)
        a, whole = np.array(a.ids, np.uint32), joined.encode()
        spaces = np.flatnonzero(np.frombuffer(whole, np.uint8) == 0x20)
        ends = np.append(spaces[1:], len(whole))
        upto_a = np.cumsum(self.size_a[a])
        cut_a = np.concatenate(([0], np.searchsorted(upto_a, ends, "right")))
        found = self.b.encode(words, num_threads=1)
        b = np.fromiter(chain.from_iterable(found), np.uint32)
        cut_b = np.cumsum([0, *map(len, found)])
        bytes_a, bytes_b = (b"".join(map(t.__getitem__, x.tolist())) for t, x in ((self.bytes_a, a), (self.bytes_b, b)))
        upto_b = np.concatenate(([0], np.cumsum(self.size_b[b])))
        if not (bytes_a == whole == bytes_b and (upto_b[cut_b[1:]] == ends).all()):
            return self.encode(words)  # some word does not come back as it is
        data_a, data_b = a.tobytes(), b.tobytes()
        at_a, at_b = (4 * cut_a).tolist(), (4 * cut_b).tolist()
        return [(data_a[i:j], data_b[k:m]) for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:])]

    def look_up(self, words: list[str]) -> list:
        def make(new: list[str]) -> list:
            found = []
            for at in range(0, len(new), 4096):
                found += self.encode_words(new[at:at + 4096])
            # a word that does not fit is known as such
            return [f or () for f in found]
        return self.words.look_up(words, make)

    def of_texts(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text in both vocabularies, empty where it has none; ``texts`` without nulls."""
        odd = pc.match_substring_regex(texts, WHOLE) if self.by_word else pa.array([True] * len(texts))
        codes, offsets, distinct = dictionary(pc.split_pattern(pc.if_else(odd, "", texts), " "))
        packed = [(b"", b"") if not w else None for w in distinct]
        asked = [i for i, w in enumerate(distinct) if w]
        for i, p in zip(asked, self.look_up([distinct[i] for i in asked])):
            packed[i] = p
        bad = np.array([not p for p in packed], bool)[codes]
        bad = np.add.reduceat(bad, offsets[:-1]) > 0 if len(bad) else np.zeros(len(texts), bool)
        sides = []
        for k in range(2):
            data = [p[k] if p else b"" for p in packed]
            ids = np.frombuffer(b"".join(data), np.uint32)
            sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
            starts = np.cumsum(sizes) - sizes
            n = sizes[codes]
            ends = np.cumsum(n)
            flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - n), n)]
            border = np.concatenate((np.zeros(1, np.int64), ends))[offsets]
            sides.append([flat[x:y] for x, y in zip(border, border[1:])])
        none = np.zeros(0, np.uint32)
        for i in np.flatnonzero(bad):
            sides[0][i] = sides[1][i] = none
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        for i in whole.tolist():
            (found,) = self.encode([texts[i].as_py()])
            sides[0][i], sides[1][i] = (np.frombuffer(x, np.uint32) for x in found) if found else (none, none)
        return sides[0], sides[1]


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits of each number below ``n``, from the left, with a free place behind; their number)."""
    width = np.array([len(str(i)) for i in range(n)], np.int64)
    rows = "".join([str(i).ljust(int(width[-1]) + 1) for i in range(n)])
    return np.frombuffer(rows.encode(), np.uint8).reshape(n, -1), width


@lru_cache(maxsize=2)
def pair_of(path_a: str, path_b: str) -> Pair:
    """One pair, and its memory of words, for each worker process."""
    return Pair(path_a, path_b)


# divide and conquer ----------------------------------------------------------

def groups(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(upto_a, upto_b): for each group in order the number of tokens up to its end.

    ``ends_a`` and ``ends_b`` are the ascending byte ends of all tokens of many texts;
    ``docs_a`` and ``docs_b`` the numbers of tokens up to the end of each text that has any.
    """
    lo_a, lo_b = (np.concatenate(([0], d[:-1])) for d in (docs_a, docs_b))
    hi_a, hi_b = docs_a, docs_b
    tried = np.zeros(len(hi_a), np.int64)
    done_a, done_b = [], []
    while len(hi_a):
        inner = hi_a - lo_a - 1
        # no inner end left to look up, on either side: a group
        leaf = (tried >= inner) | (hi_b - lo_b == 1)
        done_a.append(hi_a[leaf])
        done_b.append(hi_b[leaf])
        lo_a, hi_a, lo_b, hi_b, tried, inner = (x[~leaf] for x in (lo_a, hi_a, lo_b, hi_b, tried, inner))
        if not len(hi_a):
            break
        # the next ends outward from the middle: twice as many in each round without a cut
        n = np.minimum(tried + 1, inner - tried)
        row = np.repeat(np.arange(len(n)), n)
        step = tried[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = lo_a[row] + inner[row] // 2 + np.where(step % 2 == 1, -((step + 1) // 2), step // 2)
        meets = np.searchsorted(ends_b, ends_a[at])
        shared = np.flatnonzero(ends_b[meets] == ends_a[at])
        # the first of an interval is the nearest
        cut, first = np.unique(row[shared], return_index=True)
        at, meets = at[shared[first]], meets[shared[first]]
        found = np.zeros(len(n), bool)
        found[cut] = True
        rest = ~found
        tried = tried + n
        parts = [(lo_a[found], at + 1, lo_b[found], meets + 1), (at + 1, hi_a[found], meets + 1, hi_b[found]),
                 (lo_a[rest], hi_a[rest], lo_b[rest], hi_b[rest])]
        halves = np.zeros(2 * len(at), np.int64)
        tried = np.concatenate((halves, tried[rest]))
        lo_a, hi_a, lo_b, hi_b = (np.concatenate([p[k] for p in parts]) for k in range(4))
        # in the order of the text: neighbouring look-ups stay near each other
        order = np.argsort(lo_a, kind="stable")
        lo_a, hi_a, lo_b, hi_b, tried = (x[order] for x in (lo_a, hi_a, lo_b, hi_b, tried))
    upto_a = np.concatenate(done_a) if done_a else np.zeros(0, np.int64)
    upto_b = np.concatenate(done_b) if done_b else np.zeros(0, np.int64)
    order = np.argsort(upto_a)
    return upto_a[order], upto_b[order]


def written(pair: Pair, ids_a: np.ndarray, ids_b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray,
            last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, places): ``a1,a2|b1;a3|b2,b3`` of many texts, one after another; ``places`` is
    where each group ends.  ``last`` marks the groups that end a text."""
    n_a, n_b = (np.diff(u, prepend=0) for u in (upto_a, upto_b))
    total = len(ids_a) + len(ids_b)
    ids = np.empty(total, np.int64)
    mark = np.full(total, ord(","), np.uint8)
    # a group's tokens of the first vocabulary stand before those of the second
    ids[np.arange(len(ids_a)) + np.repeat(upto_b - n_b, n_a)] = ids_a
    ids[np.arange(len(ids_b)) + np.repeat(upto_a, n_b)] = ids_b
    ends = upto_a + upto_b
    mark[ends - n_b - 1] = ord("|")
    mark[ends - 1] = ord(";")
    width = pair.width[ids] + 1
    rows = pair.decimal[ids]
    rows[np.arange(total), width - 1] = mark
    width[ends[last] - 1] -= 1
    out = rows[np.arange(rows.shape[1])[None, :] < width[:, None]]
    return out, np.cumsum(width)[ends - 1]


# Spark -----------------------------------------------------------------------

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, groups string"


def _packed(pair: Pair) -> np.dtype:
    return np.dtype(np.uint32 if len(pair.bytes_a) * len(pair.bytes_b) < 1 << 32 else np.uint64)


def _aligned(pair: Pair, texts: pa.Array, with_groups: bool) -> list[pa.Array]:
    """The columns of ``ALIGNED`` for some texts."""
    a, b = pair.of_texts(texts)
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    ids_a, ids_b = (np.concatenate(side) if side else np.zeros(0, np.uint32) for side in (a, b))
    some = n_a > 0
    docs_a, docs_b = np.cumsum(n_a)[some], np.cumsum(n_b)[some]
    upto_a, upto_b = groups(np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b]), docs_a, docs_b)
    # a text's last group ends with the text
    border = np.searchsorted(upto_a, docs_a)
    text, place = written(pair, ids_a, ids_b, upto_a, upto_b, border)
    links = (ids_a[upto_a - 1].astype(np.int64) * len(pair.bytes_b) + ids_b[upto_b - 1]).astype(_packed(pair))
    n = np.zeros(len(texts), np.int64)
    n[some] = np.diff(border + 1, prepend=0)
    upto = np.cumsum(n)
    digests, packed, said = [], [], []
    begin = 0
    for i, k in enumerate(n.tolist()):
        end = int(place[upto[i] - 1]) if k else begin
        own = text[begin:end]
        digests.append(hashlib.sha256(own).hexdigest() if k else "")
        packed.append(links[upto[i] - k:upto[i]].tobytes())
        said.append(own.tobytes().decode() if with_groups else None)
        begin = end
    # without empty tokens every shared end is one link
    return [pa.array(n_a), pa.array(n_b), pa.array(n), pa.array(n), pa.array(digests, pa.string()), pa.array(packed, pa.binary()),
            pa.array(said, pa.string())]


def _align(path_a: str, path_b: str, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for batch in batches:
            column = batch.column(1).fill_null("")
            _, offsets = buffer_of(column)
            for lo, hi in slices(offsets, SLICE):
                cols = _aligned(pair, column.slice(lo, hi - lo), with_groups)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *cols],
                                                 ["id", *[c.split()[0] for c in ALIGNED.split(", ")]])
    return run


def align(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text",
          with_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, links, groups) of every row of ``docs``.

    ``links`` are the linked id pairs in order, packed as a * (size of B) + b;
    ``groups`` the written groups (null when not asked for).
    """
    workers_ready(docs.sparkSession)
    cols = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return cols.mapInArrow(_align(path_a, path_b, with_groups), f"id {cols.schema['id'].dataType.simpleString()}, {ALIGNED}")


def _tally(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _packed(pair_of(path_a, path_b))
        pairs, counts = np.zeros(0, kind), np.zeros(0, np.int64)
        for batch in batches:
            data = batch.column(0).cast(pa.large_binary())
            flat = np.concatenate([np.frombuffer(x, kind) for x in data.to_pylist()] or [pairs[:0]])
            new, n = np.unique(flat, return_counts=True)
            # what a task holds is bounded by the pairs that the vocabularies allow
            pairs, where = np.unique(np.concatenate((pairs, new)), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, n)), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(counts)], ["pair", "n"])
    return run


def most_pairs(path_a: str, path_b: str) -> int:
    """How many id pairs can end together: each token's tails, at most one token of the other side for each."""
    pair = pair_of(path_a, path_b)
    return int(pair.size_a.sum() + pair.size_b.sum())


def pair_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(pair, n, best): links of each id pair, and whether none of its B id has more."""
    workers_ready(aligned.sparkSession)
    pair = pair_of(path_a, path_b)
    counts = stored(aligned.select("links").mapInArrow(_tally(path_a, path_b), "pair long, n long")
                    .groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    side = F.pmod("pair", F.lit(len(pair.bytes_b)))
    top = counts.groupBy(side.alias("b")).agg(F.max("n").alias("top"))
    return counts.withColumn("b", side).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _weigh(path_a: str, path_b: str, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _packed(pair_of(path_a, path_b))
        pairs, n, best = known.value
        for batch in batches:
            rows = [np.frombuffer(x, kind) for x in batch.column(6).to_pylist()]
            sizes = np.array([len(x) for x in rows], np.int64)
            at = np.searchsorted(pairs, np.concatenate(rows or [np.zeros(0, kind)]).astype(np.int64))
            ends = np.cumsum(sizes)
            sums = [np.concatenate(([0], np.cumsum(x[at])))  for x in (best.astype(np.int64), n)]
            sums = [s[ends] - s[ends - sizes] for s in sums]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(6)], *[pa.array(s) for s in sums]],
                                             ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"])
    return run


def alignment(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    aligned = stored(align(docs, path_a, path_b, id, text).drop("groups"), "aligned")
    counts = pair_counts(aligned, path_a, path_b).toArrow().sort_by("pair")
    if len(counts) > most_pairs(path_a, path_b):
        raise AssertionError("more pairs than the vocabularies allow")
    known = docs.sparkSession.sparkContext.broadcast(tuple(counts.column(c).to_numpy() for c in ("pair", "n", "best")))
    out = aligned.mapInArrow(
        _weigh(path_a, path_b, known), f"id {aligned.schema['id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
                                       "n_links long, groups_sha256 string, n_best long, count_sum long")
    return out.withColumnRenamed("id", id)

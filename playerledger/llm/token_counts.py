"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-level BPE vocabulary cuts a text into pre-tokens and merges inside each.
``PrefixCounts`` runs a dynamic programme over the bytes of a chunk of text: for
each prefix the one last token that its encoding ends in, hence
``count[i] = count[i - len(last)] + 1``.  A token may follow another only if the
library encodes the two joined as just these two, so the table is exact at every
prefix and nothing is encoded again to answer a truncation or budget question.

Texts are cut before every space that is followed by something else; the
vocabulary always cuts there too, so a text's counts are the chunks' counts
added up, and each distinct chunk's table is built once and remembered.  Texts
with a special string in them are counted by the library itself.

``prefixes`` cuts a text into pre-tokens once and reads each one's table at every
character.  A cut changes pre-tokens at its end only: white space in front of it becomes
one pre-token, and a contraction is cut like other text.  ``within`` walks the chunks up
to the one where a budget ends and asks that one's table: a prefix of more tokens may
have a longer one of fewer behind it, but never beyond the next border.

Defined results: null text is empty and has no tokens; texts are counted whole
whatever their length; repeated rows are counted one by one; an empty table gives
an empty table; input columns named like a result column give way.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerledger.llm.common import workers_ready
from playerledger.llm.token_ids import Memory, dictionary, tokenizer
from playerledger.llm.words_np import buffer_of, slices

LIMIT = 512
SLICE = 1 << 23
#: Chunks and pre-tokens remembered at most.
MOST_CHUNKS = 400_000
MOST_PIECES = 500_000
#: Pairs of tokens remembered at most.
MOST_PAIRS = 500_000
#: A border of every byte-level vocabulary: before a space that something else follows.
CUT = re.compile(r" (?=\S)")
#: The vocabularies' white space (the Unicode property).
BLANK = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
#: Chunks that a budget's walk counts at once.
CHUNKS_AT_ONCE = 128
#: Texts in which cutting at each space would not do: a space beside white space or at an
#: end, or characters that not every library takes for white space.
IN_A_ROW = r"[ ][\s\p{Z}\x{85}]|^[ ]|[ ]$|[\x1c-\x1f]"


def chunks(text: str) -> list[str]:
    """``text`` cut at borders of its pre-tokens."""
    at = [0, *[m.start() for m in CUT.finditer(text) if m.start()], len(text)]
    return [text[a:b] for a, b in zip(at, at[1:]) if a < b]


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[dict[bytes, int], list[bytes], list[str], dict[tuple[int, int], int]]:
    """(token bytes -> id, id -> bytes, special strings, merge (left, right) -> rank)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    # printable stand-ins of the 256 bytes, as byte-level vocabularies write them
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
    special = [t["content"] for t in model.get("added_tokens", [])]
    ids = {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    texts: list[bytes] = [b""] * (max(ids.values()) + 1)
    for t, i in ids.items():
        texts[i] = t
    merges = {}
    for rank, m in enumerate(model["model"]["merges"]):
        left, right = m.split(" ") if isinstance(m, str) else m
        merges[ids[bytes(byte_of[c] for c in left)], ids[bytes(byte_of[c] for c in right)]] = rank
    return ids, texts, special, merges


class PrefixCounts:
    """Token counts at every byte of a pre-token, exact for one vocabulary."""

    def __init__(self, path: str):
        self.path = path
        self.ids, self.texts, self.special, self.merges = _vocabulary(path)
        self.longest = max(map(len, self.texts))
        self.follows: dict[int, bool] = {}
        self.own = {i for i, t in enumerate(self.texts) if t and self._merged(t) == [i]}
        self.chunks, self.pieces = Memory(MOST_CHUNKS), Memory(MOST_PIECES)

    def _merged(self, data: bytes) -> list[int]:
        """The encoding of a pre-token by its merges."""
        out = [self.ids[data[i:i + 1]] for i in range(len(data))]
        while len(out) > 1:
            ranked = [(self.merges.get(p, 1 << 30), i) for i, p in enumerate(zip(out, out[1:]))]
            rank, _ = min(ranked)
            if rank == 1 << 30:
                break
            at, joined = 0, []
            while at < len(out):
                if at + 1 < len(out) and self.merges.get((out[at], out[at + 1])) == rank:
                    joined.append(self.ids[self.texts[out[at]] + self.texts[out[at + 1]]])
                    at += 2
                else:
                    joined.append(out[at])
                    at += 1
            out = joined
        return out

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``left`` then ``right`` is how their joined bytes are encoded."""
        key = left << 32 | right
        found = self.follows.get(key)
        if found is None:
            if len(self.follows) >= MOST_PAIRS:
                self.follows.clear()
            found = self.follows[key] = self._merged(self.texts[left] + self.texts[right]) == [left, right]
        return found

    def tables(self, pieces: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """count[i]: tokens of the first i bytes, for each pre-token; the list lives until the next.

        In order, a pre-token keeps what the one before it had for their common start.
        """
        ids, own, follows, longest = self.ids, self.own, self.may_follow, self.longest
        count, last, before = [0], [-1], b""
        for piece in sorted(pieces):
            same, most = 0, min(len(piece), len(before))
            while same < most and piece[same] == before[same]:
                same += 1
            del count[same + 1:], last[same + 1:]
            for end in range(same + 1, len(piece) + 1):
                for start in range(end - 1, max(0, end - longest) - 1, -1):
                    token = ids.get(piece[start:end])
                    if token is not None and (token in own if not start else follows(last[start], token)):
                        count.append(count[start] + 1)
                        last.append(token)
                        break
            before = piece
            yield piece, count

    def spans(self, text: str) -> list[tuple[int, int]]:
        """The vocabulary's pre-tokens, cut by the library."""
        return [span for _, span in tokenizer(self.path).pre_tokenizer.pre_tokenize_str(text)]

    def of_pieces(self, found: set[str]) -> dict[str, int]:
        def make(new: list[str]) -> list[int]:
            n = {piece: count[-1] for piece, count in self.tables(p.encode() for p in new)}
            return [n[p.encode()] for p in new]

        asked = list(found)
        return dict(zip(asked, self.pieces.look_up(asked, make)))

    def of_chunks(self, found: list[str]) -> list[int]:
        """Token counts of chunks.  A space, letters and a mark are cut here, the rest by
        the library, those with a space in front together."""
        cut: list[list[str]] = [[] for _ in found]
        together = []
        for i, c in enumerate(found):
            if c[1:].isalpha() and c[0] == " ":
                cut[i] = [c]
            elif c[1:-1].isalpha() and c[0] == " " and c[-1] in ",.":
                cut[i] = [c[:-1], c[-1]]
            elif c[:1] == " " and c[1:2].strip():
                together.append(i)
            else:
                cut[i] = [c[a:b] for a, b in self.spans(c)]
        for at in range(0, len(together), 1024):
            part = together[at:at + 1024]
            text = "".join([found[i] for i in part])
            ends, k = list(accumulate(len(found[i]) for i in part)), 0
            for a, b in self.spans(text):
                while a >= ends[k]:
                    k += 1
                cut[part[k]].append(text[a:b])
        n = self.of_pieces({p for pieces in cut for p in pieces})
        return [sum([n[p] for p in pieces]) for pieces in cut]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of whole texts (a string array without nulls), as the library counts them."""
        odd = pc.match_substring_regex(texts, "|".join([IN_A_ROW, *map(re.escape, self.special)]))
        plain = pc.if_else(odd, "", texts)
        codes, offsets, distinct = dictionary(pc.split_pattern(plain, " "))
        spaced = np.array(self.chunks.look_up([" " + w if w else "" for w in distinct], self.of_chunks), np.int64)
        n = spaced[codes]
        # the first word of a text has no space in front
        first = offsets[:-1]
        alone, where = np.unique(codes[first], return_inverse=True)
        n[first] = np.array(self.chunks.look_up([distinct[i] for i in alone.tolist()], self.of_chunks), np.int64)[where]
        out = np.add.reduceat(n, first) if len(n) else np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[i] = self.count(texts[int(i)].as_py())
        return out

    def count(self, text: str) -> int:
        """Tokens of one text, whatever white space or special strings it has."""
        if any(s in text for s in self.special):
            return len(tokenizer(self.path).encode(text, add_special_tokens=False).ids)
        return sum(self.chunks.look_up(chunks(text), self.of_chunks))

    def _plain_prefixes(self, text: str) -> list[int]:
        """count[i]: tokens of ``text[:i]``, without regard to special strings."""
        cut = [text[a:b] for a, b in self.spans(text)]
        # white space in a row is one pre-token wherever a cut follows it
        rows = [text[m.start():m.end()] for m in BLANK.finditer(text)]
        asked = {p.encode() for p in cut} | {r.encode() for r in rows}
        of = {piece: list(count) for piece, count in self.tables(asked)}

        def at_characters(piece: str) -> list[int]:
            data = piece.encode()
            count = of[data]
            return count[1:] if len(data) == len(piece) else [count[n] for n in accumulate(len(c.encode()) for c in piece)]

        out, done, row, before = [0], 0, iter(rows), 0
        left: list[int] = []
        for piece in cut:
            # the white space that the pre-token is or begins with
            blank = ""
            if BLANK.match(piece):
                blank = piece if BLANK.fullmatch(piece) else piece[:1]
                if not left:
                    # counts of all white space from here on, one a character
                    left, before = at_characters(next(row)), done
            out += [before + n for n in left[:len(blank)]]
            left = left[len(blank):]
            rest = piece[len(blank):]
            if rest and piece[0] == "'" and piece[1:].isalpha():
                parts = [self.spans(piece[:i]) for i in range(1, len(piece) + 1)]
                n = self.of_pieces({piece[a:b] for p in parts for a, b in p})
                out += [done + sum(n[piece[a:b]] for a, b in p) for p in parts]
            elif rest:
                out += [done + n for n in at_characters(piece)[len(blank):]]
            done += of[piece.encode()][-1]
        return out

    def prefixes(self, text: str) -> list[int]:
        """count[i]: tokens of ``text[:i]``, for every character i."""
        if not any(s in text for s in self.special):
            return self._plain_prefixes(text)
        out, done, at = [0], 0, 0
        for m in re.finditer("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))), text):
            # a special string is one token once it is complete, and plain text before
            part = self._plain_prefixes(text[at:m.end() - 1])
            out += [done + n for n in part[1:]]
            done += part[m.start() - at] + 1
            out.append(done)
            at = m.end()
        return out + [done + n for n in self._plain_prefixes(text[at:])[1:]]

    def within(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of ``text`` that has at most ``budget`` tokens."""
        if any(s in text for s in self.special):
            return max(i for i, n in enumerate(self.prefixes(text)) if n <= budget)
        # borders with the tokens before them, of chunks that no white space stands in front of
        done, start, begin, base = 0, 0, 0, 0
        borders = chain((m.start() for m in CUT.finditer(text) if m.start()), [len(text)])
        while ends := list(islice(borders, CHUNKS_AT_ONCE)):
            found = [text[a:b] for a, b in zip([start, *ends], ends)]
            for chunk, n in zip(found, self.chunks.look_up(found, self.of_chunks)):
                if not BLANK.match(text[start - 1:start]):
                    begin, base = start, done
                if done + n > budget:
                    part = text[begin:start + len(chunk) + 1]
                    return begin + max(i for i, k in enumerate(self._plain_prefixes(part)) if base + k <= budget)
                done, start = done + n, start + len(chunk)
        return len(text)


@lru_cache(maxsize=2)
def prefix_counts(path: str) -> PrefixCounts:
    """One table memory for each worker process and vocabulary."""
    return PrefixCounts(path)


def _count(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counts(path)
        for batch in batches:
            column = batch.column(1).fill_null("")
            _, offsets = buffer_of(column)
            for lo, hi in slices(offsets, SLICE):
                n = counter.counts(column.slice(lo, hi - lo))
                n_bytes = np.diff(offsets[lo:hi + 1])
                cut = n_bytes.copy()
                for i in np.flatnonzero(n > limit):
                    text = column[lo + int(i)].as_py()
                    cut[i] = len(text[:counter.within(text, limit)].encode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n_bytes), pa.array(n, pa.int64()), pa.array(cut)],
                    ["id", "n_bytes", "n_tokens", "cut_bytes"])
    return run


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, cut_bytes) for every row of ``docs``; ``cut_bytes`` is the
    length of the text's longest prefix, in whole characters, of at most ``limit`` tokens."""
    workers_ready(docs.sparkSession)
    cols = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    out = cols.mapInArrow(_count(path, limit), f"id {cols.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, cut_bytes long")
    return out.select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "cut_bytes")

"""Token ids of whole texts, encoding each distinct word once.

For vocabularies whose pre-tokens never cross white space (and that drop it), a
text's ids are its words' ids in order.  A slice of texts is split and
dictionary-encoded by Arrow; its distinct words are encoded by the
``tokenizers`` library in batches and remembered, and the ids of the texts are
gathered by numpy.  Texts with control characters that split words but not
pre-tokens are encoded whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers at most, which bounds its memory.  When they are full and
#: still miss more than ``MISSES`` of a slice's distinct words, the memory starts again.
MOST_WORDS = 400_000
MISSES = 0.9
#: Longer words are encoded each time.
LONG_WORD = 64
ODD = "[\\x1c-\\x1f]"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def encode(path: str, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def encode_words(path: str, words: list[str], stop: str = "\x01", run: int = 256) -> list[bytes]:
    """Packed ids of each word, many words a call with the one-token word ``stop`` between them."""
    (mark,), = encode(path, [stop])
    plain = [w for w in words if w and stop not in w]
    runs = [plain[at:at + run] for at in range(0, len(plain), run)]
    found: dict[str, bytes] = {"": b""}
    for part, ids in zip(runs, encode(path, [f" {stop} ".join(part) for part in runs]) if runs else []):
        ids = np.array(ids, np.uint32)
        ends = np.flatnonzero(ids == mark)
        data = ids.tobytes()
        found.update(zip(part, [data[a:b] for a, b in zip([0, *(ends * 4 + 4).tolist()], [*(ends * 4).tolist(), len(data)],
                                                          strict=True)], strict=True))
    odd = [w for w in words if stop in w]
    found.update(zip(odd, [np.array(i, np.uint32).tobytes() for i in encode(path, odd)] if odd else []))
    return [found[w] for w in words]


def dictionary(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(codes, offsets, distinct) of an Arrow array of string lists."""
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), offsets - offsets[0], coded.dictionary.to_pylist()


class Memory(dict):
    """What is known of words, up to ``most`` of them; starts again when it is full and
    misses more than ``MISSES`` of what is asked."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.stale = most, False

    def look_up(self, asked: list[str], make) -> list:
        """The values of ``asked``; ``make`` gets the list of those not known."""
        if self.stale:
            self.clear()
        found = list(map(self.get, asked))
        holes = [i for i, v in enumerate(found) if v is None]
        new = [asked[i] for i in holes]
        made = make(new) if new else []
        for i, v in zip(holes, made):
            found[i] = v
        room = self.most - len(self)
        self.stale = room <= 0 and len(new) > MISSES * len(asked)
        self.update([x for x in zip(new, made) if len(x[0]) <= LONG_WORD][:max(0, room)])
        return found


class WordIds:
    """Ids of texts as unsigned 32-bit arrays."""

    def __init__(self, path: str):
        self.path, self.known = path, Memory(MOST_WORDS)

    def of_texts(self, texts: pa.Array) -> list[np.ndarray]:
        """``texts``: a string array without nulls."""
        odd = pc.match_substring_regex(texts, ODD)
        plain = pc.if_else(odd, "", texts)
        codes, offsets, distinct = dictionary(pc.utf8_split_whitespace(plain))
        packed = self.known.look_up(distinct, lambda new: encode_words(self.path, new))
        # a text that begins or ends with white space has empty words: no ids
        data = np.frombuffer(b"".join(packed), np.uint32)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[codes]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - n), n)
        ids = data[at]
        border = np.concatenate((np.zeros(1, np.int64), ends))[offsets]
        out = [ids[a:b] for a, b in zip(border, border[1:])]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[i] = np.array(encode(self.path, [texts[int(i)].as_py()])[0], np.uint32)
        return out


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    """One memory of words for each worker process and vocabulary."""
    return WordIds(path)

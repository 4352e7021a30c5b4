"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, and only the document has a label.

* Encoding: a passage is 50 words in a row (the last one of a text may be shorter).  Every
  word has three learned vectors: one of its letters (a hashed table), one of its shape
  (first and last character, capitals, symbols and digits inside, length), one for being
  the same as one of the two words before.  A passage is their mean through tanh.
* Gated attention: passage k weighs softmax(w . (tanh(h V) * sigmoid(h U))) in its bag.
* Score: the logistic function of the weighted passage representation.

All parameters are trained together, in numpy, from document labels: cross entropy and
Adam over small groups of documents, the average of the last rounds kept.  The sample
is bounded: of the labelled rows outside the held-out ones the ``MOST_LABELLED`` first
in the order of a hash of their id, without texts above ``MOST_BYTES``.  It is trained
in one task, since its size does not grow with the corpus.  Every document is then
scored where it stands, over all its passages; the model has a fixed size.

Labels, language, source and id are no inputs of a score: a text has the same score
wherever it stands.

Defined results: null or empty text is a bag of one passage without words, whose vector
is zero; texts are read whole in pieces; repeated rows are scored one by one; rows with
a null label, or without a document, are not learned from, and a document with several
labels has their mean, rounded up at a half; a null id is scored and not held out; without
labels, or with one label only, the score is the smoothed share of label 1; an empty
table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerledger.llm import words_np
from playerledger.llm.common import workers_ready
from playerledger.llm.words_np import U, buffer_of, slices

#: Words of a passage.
PASSAGE = 50
#: Labelled documents learned from at most, and the longest text among them.
MOST_LABELLED = 4096
MOST_BYTES = 1 << 16
#: Hashed words, and the sizes of a passage's vector and of the gates.
WORDS = 1 << 13
WIDTH = 16
GATES = 12
ROUNDS = 12
AVERAGED = 4
GROUP = 32
RATE = 0.01
DECAY = 1e-5
SEED = 12
THRESHOLD = 0.7
SLICE = 1 << 20

# Kinds of bytes that a word's shape is made of.
LETTER, CAPITAL, DIGIT, SYMBOL, MARK, BEYOND = range(6)
KIND = np.full(256, MARK, np.int64)
KIND[ord("a"):ord("z") + 1] = LETTER
KIND[ord("A"):ord("Z") + 1] = CAPITAL
KIND[ord("0"):ord("9") + 1] = DIGIT
KIND[list(b"#*$%&|<>")] = SYMBOL
KIND[128:] = BEYOND
#: first kind, last kind, five flags of what is inside, five classes of length
SHAPES = 6 * 6 * 32 * 5
SAME = 4
ROWS = WORDS + SHAPES + SAME


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# passages --------------------------------------------------------------------

def _shapes(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    kind = KIND[piece]
    inside = np.zeros(len(starts), np.int64)
    # a first capital is common; only those behind it count
    for bit, (which, begin) in enumerate(((CAPITAL, starts + 1), (DIGIT, starts), (SYMBOL, starts), (MARK, starts), (BEYOND, starts))):
        upto = np.concatenate(([0], np.cumsum(kind == which)))
        inside |= ((upto[ends] - upto[begin]) > 0).astype(np.int64) << bit
    length = np.searchsorted([2, 4, 8, 16], ends - starts, "left")
    return ((kind[starts] * 6 + kind[ends - 1]) * 32 + inside) * 5 + length


def _rows_of(hashed: np.ndarray, shape: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """The three table rows of each word; ``passage`` is ascending."""
    same = np.zeros(len(hashed), np.int64)
    for back in (1, 2):
        if len(hashed) > back:
            same[back:] |= ((hashed[back:] == hashed[:-back]) & (passage[back:] == passage[:-back])).astype(np.int64) << (back - 1)
    return np.stack(((hashed % U(WORDS)).astype(np.int64), WORDS + shape, WORDS + SHAPES + same), 1)


def passages(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, passage, bag) pieces of consecutive texts: three table rows of every word, the
    passage each word is in, from 0 on, and the text of each passage.

    A single text of any length comes in several pieces, several texts in one.  A text
    without words has one passage that no word is in.
    """
    n = len(offsets) - 1
    gap = np.insert(data, offsets[1:-1], 0x20) if n > 1 else data
    last = offsets[1:] + np.arange(n)
    many = n > 1
    hashed, shape, place = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, seen = 0, False
    for piece in words_np.pieces(gap, words_np.SEPARATOR):
        starts, ends = words_np.bounds(piece)
        if len(starts):
            hashed = np.concatenate((hashed, words_np.hash_words(piece, starts, ends, words_np.BYTE_LOWER)))
            shape = np.concatenate((shape, _shapes(piece, starts, ends)))
            place = np.concatenate((place, starts + at))
        at += len(piece)
        whole = len(hashed) // PASSAGE * PASSAGE
        if not many and whole:
            number = np.arange(whole) // PASSAGE
            yield _rows_of(hashed[:whole], shape[:whole], number), number, np.zeros(number[-1] + 1, np.int64)
            hashed, shape, place, seen = hashed[whole:], shape[whole:], place[whole:], True
    if not many and seen and not len(hashed):
        return
    # what is left of a single text, or all words of several
    text = np.searchsorted(last, place, "right") if many else np.zeros(len(place), np.int64)
    n_words = np.bincount(text, minlength=n)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    within = np.arange(len(text)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    number = (np.cumsum(n_passages) - n_passages)[text] + within // PASSAGE
    yield _rows_of(hashed, shape, number), number, np.repeat(np.arange(n), n_passages)


# the model -------------------------------------------------------------------

@dataclass
class Model:
    """Table of word vectors, bias of the encoder, gates V and U, attention w, output."""

    table: np.ndarray
    bias: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    out: np.ndarray
    base: np.ndarray

    def saved(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, **{f.name: getattr(self, f.name) for f in fields(self)})
        return file.getvalue()

    @staticmethod
    def loaded(data: bytes) -> Model:
        held = np.load(io.BytesIO(data))
        return Model(**{f.name: held[f.name] for f in fields(Model)})

    @staticmethod
    def fresh(share: float, rng: np.random.Generator) -> Model:
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return Model(small(ROWS, WIDTH), np.zeros(WIDTH, np.float32), small(WIDTH, GATES), small(WIDTH, GATES), small(GATES),
                     small(WIDTH), np.array([np.log(share / (1 - share))], np.float32))

    def encoded(self, rows: np.ndarray, passage: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(h, words): the vector of each of ``n`` passages and its number of words."""
        words = np.bincount(passage, minlength=n)
        mean = np.zeros((n, WIDTH), np.float32)
        if len(rows):
            first = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
            total = np.add.reduceat(self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.table[rows[:, 2]], first, axis=0)
            mean[passage[first]] = total / words[passage[first], None]
        return np.tanh(mean + self.bias) * (words > 0)[:, None], words

    def gated(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(attention before the softmax, tanh gate, sigmoid gate)."""
        t, g = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        return (t * g) @ self.w, t, g


def _sums(x: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``x`` by bag; bags are ascending and none is empty."""
    return np.add.reduceat(x, np.searchsorted(bag, np.arange(n)), axis=0)


def softmax(a: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
    top = np.maximum.reduceat(a, np.searchsorted(bag, np.arange(n)))
    e = np.exp(a - top[bag])
    return e / _sums(e, bag, n)[bag]


def gradients(m: Model, rows: np.ndarray, passage: np.ndarray, bag: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy of some bags and its gradient by every parameter."""
    n = len(label)
    h, words = m.encoded(rows, passage, len(bag))
    a, t, g = m.gated(h)
    weight = softmax(a, bag, n)
    z = _sums(weight[:, None] * h, bag, n)
    logit = z @ m.out + m.base[0]
    p = 1 / (1 + np.exp(-logit))
    loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
    dlogit = ((p - label) / n).astype(np.float32)
    dz = dlogit[:, None] * m.out
    d = {"out": z.T @ dlogit, "base": np.array([dlogit.sum()], np.float32)}
    dweight = np.sum(h * dz[bag], axis=1)
    da = weight * (dweight - _sums(weight * dweight, bag, n)[bag])
    d["w"] = (t * g).T @ da
    dt, dg = da[:, None] * m.w * g * (1 - t * t), da[:, None] * m.w * t * g * (1 - g)
    d["v"], d["u"] = h.T @ dt, h.T @ dg
    dh = weight[:, None] * dz[bag] + dt @ m.v.T + dg @ m.u.T
    dx = dh * (1 - h * h) * (words > 0)[:, None]
    d["bias"] = dx.sum(axis=0)
    share = (dx / np.maximum(words, 1)[:, None])[passage]
    at = rows.reshape(-1)
    table = np.zeros((ROWS, WIDTH), np.float32)
    for k in range(WIDTH):
        table[:, k] = np.bincount(at, np.repeat(share[:, k], 3), ROWS)
    d["table"] = table
    return loss, d


def trained(texts: list[bytes], label: np.ndarray) -> Model:
    """A model of labelled texts; the same texts in the same order give the same model."""
    rng = np.random.default_rng(SEED)
    share = (label.sum() + 1) / (len(label) + 2)
    m = Model.fresh(float(share), rng)
    if len(np.unique(label)) < 2:
        m.out[:] = 0
        return m
    bags = []
    for text in texts:
        parts = list(passages(np.frombuffer(text, np.uint8), np.array([0, len(text)])))
        begin = np.cumsum([0, *[len(p[2]) for p in parts]])
        bags.append((np.concatenate([p[0] for p in parts]).astype(np.int32),
                     np.concatenate([p[1] + b for p, b in zip(parts, begin)]), int(begin[-1])))
    names = [f.name for f in fields(Model)]
    mean = {k: np.zeros_like(getattr(m, k)) for k in names}
    power = {k: np.zeros_like(getattr(m, k)) for k in names}
    kept, step = None, 0
    for turn in range(ROUNDS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), GROUP):
            some = order[at:at + GROUP]
            sizes = [bags[i][2] for i in some]
            begin = np.cumsum([0, *sizes])
            rows = np.concatenate([bags[i][0] for i in some])
            passage = np.concatenate([bags[i][1] + b for i, b in zip(some, begin)])
            _, d = gradients(m, rows, passage, np.repeat(np.arange(len(some)), sizes), label[some])
            step += 1
            for k in names:
                x = getattr(m, k)
                mean[k] += 0.1 * (d[k] - mean[k])
                power[k] += 0.001 * (d[k] ** 2 - power[k])
                x -= RATE * (mean[k] / (1 - 0.9 ** step) / (np.sqrt(power[k] / (1 - 0.999 ** step)) + 1e-8) + DECAY * x)
        if turn >= ROUNDS - AVERAGED:
            now = {k: getattr(m, k) / AVERAGED for k in names}
            kept = now if kept is None else {k: kept[k] + now[k] for k in names}
    return Model(**{k: v.astype(np.float32) for k, v in kept.items()})


def scored(m: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of each of several consecutive texts."""
    n = len(offsets) - 1
    top, total, z = np.full(n, -np.inf), np.zeros(n), np.zeros((n, WIDTH))
    for rows, passage, bag in passages(data, offsets):
        h, _ = m.encoded(rows, passage, len(bag))
        a = m.gated(h)[0].astype(np.float64)
        # the softmax over a text's passages goes on from piece to piece
        new = top.copy()
        np.maximum.at(new, bag, a)
        shrink = np.exp(top - new)
        e = np.exp(a - new[bag])
        total, z, top = total * shrink, z * shrink[:, None], new
        np.add.at(total, bag, e)
        np.add.at(z, bag, e[:, None] * h)
    return 1 / (1 + np.exp(-(z / total[:, None] @ m.out.astype(np.float64) + float(m.base[0]))))


# Spark -----------------------------------------------------------------------

def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((h, text, label) for b in batches for h, text, label in zip(*(c.to_pylist() for c in b.columns)))
    model = trained([t.encode() for _, t, _ in rows], np.array([y for _, _, y in rows], np.float32))
    yield pa.RecordBatch.from_arrays([pa.array([model.saved()], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
          most: int = MOST_LABELLED, most_bytes: int = MOST_BYTES) -> Model:
    """The model of the labelled documents that are not held out, ``most`` of them."""
    workers_ready(docs.sparkSession)
    known = (labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y")).withColumn("h", F.xxhash64("id")))
    # at most ``most`` short rows: their size is bounded
    chosen = F.broadcast(known.orderBy("h", "id").limit(most))
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sample = texts.filter(F.octet_length("text") <= most_bytes).join(chosen, "id").select("h", "text", "y")
    # ids that stand in many rows may not make the sample larger
    sample = sample.orderBy("h", "text").limit(most)
    found = sample.coalesce(1).mapInArrow(_train, "model binary").collect()
    return Model.loaded(bytes(found[0]["model"])) if found else trained([], np.zeros(0, np.float32))


def _score(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.loaded(known.value)
        for batch in batches:
            data, offsets = buffer_of(batch.column(1))
            for lo, hi in slices(offsets, SLICE):
                s = scored(model, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(s)], ["id", "score"])
    return run


def classify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``."""
    workers_ready(docs.sparkSession)
    cols = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(model.saved())  # of a fixed size
    out = cols.mapInArrow(_score(known), f"id {cols.schema['id'].dataType.simpleString()}, score double")
    return out.select(F.col("id").alias(id), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))

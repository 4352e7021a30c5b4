"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Words are counted over all training documents in Spark.  The frequent words and the
end of a text are model classes of their own; all others share classes by the
letters they end in.  A token's probability is the model's probability of its class
after the four tokens before, times the word's share of its class (its count plus
a half; every class also keeps a half for words never seen), so probabilities of
all words after any context sum to one.

The model: a context is the sum of its tokens' vectors, weighted by place and
dimension; a class's score is the product with its own vector, plus a bias.  It is
trained in numpy by noise-contrastive estimation: the true class against classes
drawn from the corpus' class counts.  Every partition trains on all its training
tokens; parameters are averaged by tokens up a tree, and a second round goes on
from the average with the other half of the documents.  Scoring normalises in
batched matrix products over all classes.

Counts of the ``HEAD`` most frequent words (a fixed bound) go to the tasks; the
other words of a document are joined to the count table in Spark.

Defined results: null or empty text is one end token; a null id is training; rows
that repeat are counted and scored one by one; texts are read whole; without
training documents all classes are equally likely; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerledger.llm import words_np
from playerledger.llm.common import stored, workers_ready
from playerledger.llm.words_np import U, buffer_of, mix, slices

#: Words whose counts every task holds: 12 bytes each.
HEAD = 500_000
#: Classes of one word each (the end of a text among them), and classes by ending.
SINGLES = 128
ENDINGS = 128
CLASSES = SINGLES + ENDINGS
#: Stands before the beginning of a text.
PAD = CLASSES
CONTEXT = 4
DIMENSIONS = 24
NOISE = 32
BATCH = 1024
RATE = 0.3
ROUNDS = 2
SEED = 11
#: Text bytes of one slice, and of one count.
SLICE = 1 << 20
COUNTED = 1 << 24
#: Parameter rows averaged in one task.
FAN_IN = 32
#: The end of a text, as a word's hash.
END = int(mix(np.array([0xE4D], np.uint64))[0])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# tokens ----------------------------------------------------------------------

def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, endings, ends): the tokens of consecutive texts, each closed by the end
    token; ``ends`` holds the number of tokens up to each text's end."""
    n = len(offsets) - 1
    gap = np.insert(data, offsets[1:-1], 0x20)
    last = offsets[1:] + np.arange(n)
    found, endings, at, where = [], [], 0, []
    for piece in words_np.pieces(gap, words_np.SEPARATOR):
        starts, ends = words_np.bounds(piece)
        if len(starts):
            found.append(words_np.hash_words(piece, starts, ends, words_np.BYTE_LOWER))
            final = LOWER[piece[ends - 1]].astype(np.int64)
            before = np.where(ends - starts > 1, LOWER[piece[ends - 2]], 0)
            endings.append(mix((final * 256 + before).astype(np.uint64)) % U(ENDINGS))
            where.append(starts + at)
        at += len(piece)
    hashed = np.concatenate(found) if found else np.zeros(0, np.uint64)
    ending = np.concatenate(endings).astype(np.int64) if found else np.zeros(0, np.int64)
    upto = np.searchsorted(np.concatenate(where) if found else np.zeros(0, np.int64), last, "left")
    return np.insert(hashed, upto, U(END)), np.insert(ending, upto, 0), upto + np.arange(1, n + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffer_of(batch.column(0))
        for lo, hi in slices(offsets, COUNTED):
            parts = [tokens(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])[:2]
                     for a, b in ((lo + x, lo + y) for x, y in slices(offsets[lo:hi + 1] - offsets[lo], SLICE))]
            hashed, ending = (np.concatenate([p[k] for p in parts]) for k in range(2))
            order = np.argsort(hashed)
            hashed, ending = hashed[order], ending[order]
            first = np.flatnonzero(np.concatenate(([True], hashed[1:] != hashed[:-1])))
            times = np.diff(np.concatenate((first, [len(hashed)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashed[first].view(np.int64)), pa.array(ending[first].astype(np.int32)), pa.array(times)],
                ["word", "ending", "c"])


# the model -------------------------------------------------------------------

@dataclass
class Model:
    """What the tasks need: head words (sorted hashes and counts), single words with
    their classes, class weights, parameters."""

    head: np.ndarray
    head_counts: np.ndarray
    singles: np.ndarray
    single_class: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    outputs: np.ndarray
    places: np.ndarray
    bias: np.ndarray
    n: int
    v: int

    @property
    def shares(self) -> np.ndarray:
        return self.weights / self.weights.sum()

    def packed(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (self.vectors, self.outputs, self.places, self.bias)])

    def unpacked(self, flat: np.ndarray) -> Model:
        parts, at = [], 0
        for x in (self.vectors, self.outputs, self.places, self.bias):
            parts.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return replace(self, vectors=parts[0], outputs=parts[1], places=parts[2], bias=parts[3])

    def classes(self, hashed: np.ndarray, ending: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.singles, hashed), len(self.singles) - 1)
        return np.where(self.singles[at] == hashed, self.single_class[at], SINGLES + ending)


def contexts(classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(tokens, CONTEXT): the classes before each token, nearest first; ``PAD`` before a text."""
    begin = np.repeat(np.concatenate(([0], ends[:-1])), np.diff(np.concatenate(([0], ends))))
    at = np.arange(len(classes))[:, None] - np.arange(1, CONTEXT + 1)[None, :]
    return np.where(at >= begin[:, None], classes[np.maximum(at, 0)], PAD)


def predicted(model: Model, context: np.ndarray) -> np.ndarray:
    out = model.vectors[context[:, 0]] * model.places[0]
    for j in range(1, CONTEXT):
        out += model.vectors[context[:, j]] * model.places[j]
    return out


def _add(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """into[rows] += values, rows may repeat."""
    order = np.argsort(rows.astype(np.int16), kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    into[rows[first]] += np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Noise-contrastive steps with rates that shrink by the squares seen (AdaGrad)."""

    def __init__(self, model: Model, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.noise_log = np.log(NOISE * model.shares).astype(np.float32)
        self.cumulative = np.cumsum(model.shares)
        self.squares = [np.full(x.shape, 1e-2, np.float32) for x in self.parameters()]

    def parameters(self) -> list[np.ndarray]:
        m = self.model
        return [m.vectors, m.outputs, m.places, m.bias]

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        q = predicted(m, context)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), CLASSES - 1)
        # derivative of the log likelihood that each class is told apart as true or noise
        true = 1 / (1 + np.exp(np.clip((q * m.outputs[target]).sum(1) + m.bias[target] - self.noise_log[target], -30, 30)))
        false = -1 / (1 + np.exp(-np.clip(q @ m.outputs[noise].T + m.bias[noise] - self.noise_log[noise], -30, 30)))
        dq = true[:, None] * m.outputs[target] + false @ m.outputs[noise]
        grads = [np.zeros_like(x) for x in self.parameters()]
        _add(grads[1], target, true[:, None] * q)
        np.add.at(grads[1], noise, false.T @ q)
        grads[3] += np.bincount(target, true, CLASSES).astype(np.float32)
        np.add.at(grads[3], noise, false.sum(0))
        for j in range(CONTEXT):
            _add(grads[0], context[:, j], dq * m.places[j])
            grads[2][j] = (dq * m.vectors[context[:, j]]).sum(0)
        for x, g, s in zip(self.parameters(), grads, self.squares):
            g /= n
            s += g * g
            x += RATE * g / np.sqrt(s)


def _train(model, round: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        part = TaskContext.get().partitionId()
        trainer = Trainer(m.unpacked(m.packed()), SEED + 1000 * round)
        seen = 0
        for batch in batches:
            data, offsets = buffer_of(batch.column(0))
            for lo, hi in slices(offsets, SLICE):
                hashed, ending, ends = tokens(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                classes = m.classes(hashed, ending)
                context = contexts(classes, ends)
                order = trainer.rng.permutation(len(classes))
                for at in range(0, len(order), BATCH):
                    pick = order[at:at + BATCH]
                    trainer.step(context[pick], classes[pick])
                seen += len(classes)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([float(seen)]),
                 pa.array([trainer.model.packed().astype(np.float64).tobytes()], pa.binary())], ["part", "weight", "params"])
    return run


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part", kind="stable")
    weight, total = rows["weight"].to_numpy(), 0.0
    for w, p in zip(weight, rows["params"]):
        total = total + w * np.frombuffer(p)
    return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "weight": [weight.sum()], "params": [(total / weight.sum()).tobytes()]})


def averaged(parts: DataFrame) -> np.ndarray | None:
    """The mean of parameter rows (part, weight, params), up a tree of ``FAN_IN``."""
    parts, step = stored(parts, "params"), FAN_IN
    while parts.count() > FAN_IN:
        parts = stored(parts.groupBy(F.floor(F.col("part") / step).alias("node")).applyInPandas(
            lambda rows: _average(rows), "part long, weight double, params binary"), "params")
        step *= FAN_IN
    rows = parts.toPandas()
    return np.frombuffer(_average(rows)["params"].iloc[0]) if len(rows) else None


def train(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """The trained model and the count table (word, ending, c) of the training documents."""
    workers_ready(docs.sparkSession)
    spark = docs.sparkSession
    key, words = F.col(f"`{id}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    learn = docs.filter(~held_out(key))
    counts = stored(learn.select(words).mapInArrow(_count, "word long, ending int, c long")
                    .groupBy("word", "ending").agg(F.sum("c").alias("c")), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # the smallest count whose words, with all more frequent ones, fit in the head
    least, held = 1, 0
    for r in counts.groupBy("c").count().orderBy(F.desc("c")).limit(HEAD).collect():
        if held + r["count"] > HEAD:
            least = r["c"] + 1
            break
        held += r["count"]
        least = r["c"]
    head = counts.filter(F.col("c") >= least).select("word", "c").toPandas()
    hashed = head["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashed)
    hashed, c = hashed[order], head["c"].to_numpy(np.int64)[order]
    top = np.lexsort((hashed, -c))
    top = top[hashed[top] != U(END)][:SINGLES - 1]
    singles = np.concatenate((hashed[top], np.array([END], np.uint64)))
    place = np.argsort(singles)
    # class weights: counts plus a half a word, and a half for the unseen
    table = spark.createDataFrame([(int(w), k) for k, w in enumerate(singles.view(np.int64).tolist())], "word long, single int")
    weights = np.full(CLASSES, 0.5)
    of = F.coalesce("single", F.lit(SINGLES) + F.col("ending")).alias("k")
    for r in counts.join(F.broadcast(table), "word", "left").groupBy(of).agg(F.sum(F.col("c") + 0.5).alias("w")).collect():
        weights[r["k"]] += r["w"]
    rng = np.random.default_rng(SEED)
    draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    model = Model(hashed, c, singles[place], place, weights, draw(CLASSES + 1, DIMENSIONS), draw(CLASSES, DIMENSIONS),
                  np.full((CONTEXT, DIMENSIONS), 1.0 / CONTEXT, np.float32), np.log(weights / weights.sum()).astype(np.float32), n, v)
    for round in range(ROUNDS):
        part = learn.filter(F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(ROUNDS)) == round)
        sent = spark.sparkContext.broadcast(model)
        flat = averaged(part.select(words).mapInArrow(_train(sent, round), "part long, weight double, params binary"))
        if flat is not None:
            model = model.unpacked(flat)
    return model, counts


# scores ----------------------------------------------------------------------

def log_probabilities(model: Model, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logs of the normalised class probabilities."""
    out = np.empty(len(target))
    for at in range(0, len(target), BATCH):
        part = slice(at, at + BATCH)
        scores = predicted(model, context[part]) @ model.outputs.T
        scores += model.bias
        own = scores[np.arange(len(scores)), target[part]].astype(np.float64)
        high = scores.max() if len(scores) else 0
        if high > 60:
            scores -= scores.max(axis=1, keepdims=True)
            own = scores[np.arange(len(scores)), target[part]].astype(np.float64)
        np.exp(scores, out=scores)
        out[part] = own - np.log(scores.sum(axis=1, dtype=np.float64))
    return out


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        logs = np.log10(m.head_counts + 0.5)
        spread = np.log10(m.weights)
        for batch in batches:
            data, offsets = buffer_of(batch.column(1))
            for lo, hi in slices(offsets, SLICE):
                hashed, ending, ends = tokens(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                classes = m.classes(hashed, ending)
                model_log = log_probabilities(m, contexts(classes, ends), classes) / np.log(10) - spread[classes]
                begin = np.concatenate(([0], ends[:-1]))
                row = np.repeat(np.arange(hi - lo), ends - begin)
                # the distinct words are looked up, not the tokens
                word, back = np.unique(hashed, return_inverse=True)
                at = np.minimum(np.searchsorted(m.head, word), max(len(m.head) - 1, 0))
                known = m.head[at] == word if len(m.head) else np.zeros(len(word), bool)
                value = np.where(known, logs[at], 0.0) if len(m.head) else np.zeros(len(word))
                rest = np.flatnonzero(~known[back])
                pairs, times = np.unique(np.stack((row[rest], back[rest])), axis=1, return_counts=True) if len(rest) else (
                    np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
                border = np.searchsorted(pairs[0], np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(ends - begin),
                     pa.array(np.add.reduceat(known[back].astype(np.int64), begin)),
                     pa.array(np.add.reduceat(value[back], begin)), pa.array(np.add.reduceat(model_log, begin)),
                     pa.ListArray.from_arrays(pa.array(border), pa.array(word[pairs[1]].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(border), pa.array(times.astype(np.int32)))],
                    ["id", "n_tokens", "known", "logs", "model", "words", "times"])
    return run


def score(docs: DataFrame, model: Model, counts: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every row of ``docs``: base_score by counts alone, score by the model."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    cols = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = cols.schema["id"].dataType.simpleString()
    rows = stored(cols.mapInArrow(_score(sent), f"id {kind}, n_tokens long, known long, logs double, model double, "
                                                "words array<long>, times array<int>")
                  .withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "row", F.col("x.words").alias("word"), F.col("x.times").alias("t"))
    looked = (rare.join(counts.select("word", "c"), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("t")).otherwise(F.lit(0))).alias("more"),
        F.sum(F.col("t") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("more_logs")))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    whole = F.log10(F.lit(model.n + 0.5 * (model.v + 1)))
    return rows.drop("words", "times").join(looked, "row", "left").select(
        F.col("id").alias(id), held_out(F.col("id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(model.n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * whole).alias("base_score"), (F.col("model") + logs).alias("score"))

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playerledger.llm import hard_negatives
from playerledger.llm.hard_negatives import Heaps, mine, product

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (64, 64, 64), (70, 33, 129), (0, 4, 4), (9, 0, 9)])
@pytest.mark.parametrize("leaf", [1, 4, 32])
def test_strassen_is_exact(shape, leaf):
    r = np.random.default_rng(3)
    m, k, n = shape
    a, b = r.integers(-2**28, 2**28, (m, k)), r.integers(-2**28, 2**28, (k, n))
    assert (product(a, b, leaf) == a @ b).all()


def test_heaps_keep_the_best_by_score_then_id():
    r = random.Random(4)
    heaps, told = Heaps(3, 4), [[], [], []]
    for _ in range(30):
        ids = np.array([r.randint(0, 25) for _ in range(6)])
        rows = np.array(r.sample(range(3), 2))
        scores = np.array([[r.randint(0, 6) for _ in ids] for _ in rows])
        wanted = np.array([[r.random() < 0.7 for _ in ids] for _ in rows])
        heaps.push(rows, scores, ids, wanted)
        for i, row in enumerate(rows):
            told[row] += [(int(s), int(d)) for s, d, w in zip(scores[i], ids, wanted[i]) if w]
    for row in range(3):
        best = {}
        for s, d in told[row]:
            best[d] = max(best.get(d, s), s)
        want = sorted(((s, d) for d, s in best.items()), key=lambda x: (-x[0], x[1]))[:4]
        assert list(zip(heaps.score[row].tolist(), heaps.id[row].tolist())) == want


def brute(rows, anchor, relabel):
    """The contract, row by row."""
    use = []
    for id, v, label in rows:
        if id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((id, relabel(id, label), tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = set()
    for id, label, q in sorted({u for u in use if anchor(u[0])}):
        score = lambda w: sum(x * y for x, y in zip(q, w))
        def best(cands, n):
            top = {}
            for d, s in cands:
                top[d] = max(top.get(d, s), s)
            return sorted(top.items(), key=lambda x: (-x[1], x[0]))[:n]
        for pid, p in best([(d, score(w)) for d, lab, w in use if lab == label and d != id], 5):
            near = [(d, score(w)) for d, lab, w in use if lab != label]
            for rank, (d, s) in enumerate(best([x for x in near if 30 * p <= 100 * x[1] <= 90 * p], 10), 1):
                out.add((id, pid, rank, d, p, s))
    return out


def mined(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = mine(df, F.col("vec_id") % 10 == 0, label, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return out


def relabel(id, label):
    return (label + 1) % 10 if id % 7 == 0 else label


def vectors(n, dims, seed, labels=3):
    r = random.Random(seed)
    centre = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    out = []
    for i in range(n):
        label = r.randrange(labels)
        out.append((i, [c + 0.6 + r.gauss(0, 0.8) for c in centre[label]], label))
    return out


def test_equals_brute_force(spark, monkeypatch):
    rows = vectors(400, 12, 5)
    # ties, copies, an odd component, rows that take no part
    rows += [(1000 + i, rows[3][1], 2) for i in range(40)] + [(2000, rows[3][1], 0), (2010, [0.0] * 12, 1)]
    rows += [(3000, None, 1), (3010, [float("nan")] * 12, 1), (3020, [1.0] * 11 + [float("inf")], 0), (3030, [None] + [1.0] * 11, 0),
             (3040, [1.0] * 12, None), (None, [1.0] * 12, 1)]
    want = brute(rows, lambda i: i % 10 == 0, relabel)
    assert {tuple(r) for r in mined(spark, rows).collect()} == want
    # several blocks, cells and tiles
    monkeypatch.setattr(hard_negatives, "TILE", 7)
    monkeypatch.setattr(hard_negatives, "TASKS", 5)
    got = mined(spark, rows, cell=50, block=9).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_repeated_rows_and_lengths(spark):
    rows = vectors(60, 6, 8)
    rows += rows[:20]  # every anchor and candidate again
    rows += [(10, rows[11][1], 1), (13, rows[17][1], 0), (13, rows[18][1], 0)]  # an id with several rows
    rows += [(70, rows[2][1][:4], 1), (71, [], 2)]  # shorter vectors
    got = mined(spark, rows).collect()
    want = brute([(i, (v + [0.0] * 6)[:6], c) for i, v, c in rows], lambda i: i % 10 == 0, relabel)
    assert {tuple(r) for r in got} == want


def test_empty_and_other_columns(spark):
    assert mined(spark, []).count() == 0
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]).count() == 0  # no anchor
    assert mined(spark, [(10, [1.0], 1)]).count() == 0  # no positive
    rows = [(i, v, c, 5, "x") for i, v, c in vectors(80, 4, 9)]
    got = mined(spark, rows, SCHEMA + ", score long, q string")
    assert {tuple(r) for r in got.collect()} == brute([r[:3] for r in rows], lambda i: i % 10 == 0, relabel)


def test_negative_and_zero_positives(spark):
    rows = [(10, [1.0, 0.0], 1), (11, [-1.0, 0.0], 1), (12, [0.0, 1.0], 1), (13, [-0.5, 0.0], 2), (15, [0.0, 3.0], 2)]
    got = {tuple(r) for r in mined(spark, rows).collect()}
    assert got == brute(rows, lambda i: i % 10 == 0, relabel) == {(10, 12, 1, 15, 0, 0)}

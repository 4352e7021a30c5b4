import random
import zlib

import numpy as np
import pytest

from playerledger.llm import quality_classifier as qc

TESTDATA = "/root/testdata/sf0.01"


def joined(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def prose(r, n):
    return " ".join(r.choice("the of and stone river light garden walks slowly under an open sky".split()) for _ in range(n)) + "."


def junk(r, n):
    return " ".join(r.choice("BUY NOW!! $$$cheap% win##".split()) for _ in range(n))


def test_gradients_equal_differences():
    r = np.random.default_rng(0)
    m = qc.Model.fresh(0.7, r)
    for f in ("table", "bias", "v", "u", "w", "out", "base"):
        setattr(m, f, getattr(m, f).astype(np.float64) * (1 if f == "base" else 8))
    ((rows, passage, bag),) = qc.passages(*joined([b"alpha beta Gamma!! x1 " * 40, b"", b"one two $$$ " * 30]))
    y = np.array([1.0, 0.0, 1.0])
    _, d = qc.gradients(m, rows, passage, bag, y)
    for k in ("out", "base", "w", "v", "u", "bias", "table"):
        x = getattr(m, k)
        spots = [(int(rows[5, j]), 3) for j in range(3)] if k == "table" else [tuple(r.integers(0, s) for s in x.shape) for _ in range(4)]
        for at in spots:
            old = x[at]
            x[at] = old + 1e-5
            up = qc.gradients(m, rows, passage, bag, y)[0]
            x[at] = old - 1e-5
            down = qc.gradients(m, rows, passage, bag, y)[0]
            x[at] = old
            assert float(d[k][at]) == pytest.approx((up - down) / 2e-5, rel=2e-3, abs=1e-7)


def test_attention_is_a_softmax_over_each_bag():
    bag = np.array([0, 0, 1, 2, 2, 2])
    w = qc.softmax(np.array([0.0, 2.0, 5.0, -1000.0, 1.0, 1.0]), bag, 3)
    assert np.bincount(bag, w).tolist() == pytest.approx([1, 1, 1])
    assert w[3] == 0 and w[4] == w[5] == 0.5


def test_passages_do_not_depend_on_how_texts_come(monkeypatch):
    r = random.Random(1)
    texts = [prose(r, n).encode() for n in (1, 49, 50, 51, 100, 730)] + [b"", b" \n ", b"x" * 4000, b"one"]
    model = qc.Model.fresh(0.6, np.random.default_rng(2))
    whole = qc.scored(model, *joined(texts))
    one = np.array([qc.scored(model, *joined([t]))[0] for t in texts])
    monkeypatch.setattr(qc.words_np, "PIECE", 64)
    pieces = np.array([qc.scored(model, *joined([t]))[0] for t in texts])
    assert np.allclose(whole, one, atol=1e-6) and np.allclose(whole, pieces, atol=1e-6)
    assert ((0 <= whole) & (whole <= 1)).all()


def split(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_learns_and_handles_odd_input(spark):
    r = random.Random(3)
    docs = [(i, prose(r, r.randint(1, 200)) if i % 3 else junk(r, r.randint(20, 200)), 5, "x") for i in range(400)]
    # junk in one passage of many
    docs += [(1000 + i, prose(r, 100) + " " + junk(r, 60) + " " + prose(r, 100), 5, "x") for i in range(40)]
    labels = [(i, int(i % 3 > 0)) for i in range(400)] + [(1000 + i, 0) for i in range(40)]
    labels += [(1, 1), (1, 0), (None, 0), (2, None), (77777, 1)]
    odd = [(None, "no id", 1, "y"), (5000, None, 1, "y"), (5001, "", 1, "y"), (5002, "  \n", 1, "y"), (3, docs[3][1], 1, "y"), (5003, "w" * 300_000, 1, "y")]
    d = split(spark, docs + odd, "doc_id long, text string, score int, held_out string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    model = qc.train(d, lab)
    out = qc.classify(d, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(docs) + len(odd)
    truth = {i: y for i, y in labels[:440]}
    held = [x for x in rows if x.held_out and x.doc_id in truth]
    assert len(held) > 60 and np.mean([x.predicted == truth[x.doc_id] for x in held]) > 0.95
    for x in rows:
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7)
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2)
    by_id = {x.doc_id: x.score for x in rows}
    assert by_id[5000] == by_id[5001] == by_id[5002]
    # the same texts and labels in other partitions give the same model
    again = qc.train(d.repartition(7), lab.repartition(3))
    assert np.allclose(again.table, model.table) and np.allclose(again.out, model.out)


def test_held_out_labels_are_not_learned(spark):
    r = random.Random(4)
    docs = [(i, prose(r, 60) if i % 2 else junk(r, 60)) for i in range(80)]
    lab = [(i, i % 2) for i in range(80)]
    wrong = [(i, 1 - y) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, y) for i, y in lab]
    a, b = (qc.train(split(spark, docs), spark.createDataFrame(x, "doc_id long, quality int")) for x in (lab, wrong))
    assert (a.table == b.table).all() and (a.out == b.out).all()


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = split(spark, [(1, "a text"), (2, None)])
    assert {x.score for x in qc.classify(docs, qc.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {round(x.score, 6) for x in qc.classify(docs, qc.train(docs, one)).collect()} == {round(2 / 3, 6)}
    assert qc.classify(split(spark, []), qc.train(docs, none)).count() == 0


def test_held_out_documents_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = qc.classify(docs, qc.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([x.predicted == x.quality for x in rows]) > 0.95

import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from playerledger.llm import lm_score, registry

REPO = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


def low(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [None]


def lm_rows(n=2500):
    r = random.Random(4)
    # two languages: a word tells much about the next
    vocab = [["alo", "bero", "cano", "dimo", "elo", "foro"], ["ukt", "vist", "wont", "xert", "yast", "zunt"]]
    rows = []
    for i in range(n):
        words = vocab[r.randint(0, 1)]
        rows.append((i, " ".join(r.choice(words) + r.choice(["", "", "", str(r.randint(0, 400))]) for _ in range(r.randint(0, 80)))))
    return rows + [(5000, None), (5001, ""), (None, "alo  BERO\nnever"), (5003, "unseen zzz"), rows[0], (5004, "é" * 300_000 + " alo")]


@pytest.mark.parametrize("head", [500_000, 9])
def test_scores_against_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(lm_score, "HEAD", head)
    rows = lm_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model, counts = lm_score.train(df)
    out = lm_score.score(df, model, counts).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in rows if not held(i) for w in low(t))
    n, v = sum(c.values()), len(c)
    assert len(out) == len(rows) and {x.train_tokens for x in out} == {n}
    by = {i: t for i, t in rows}
    for x in out:
        w = low(by[x.doc_id])
        base = sum(math.log10((c[y] + 0.5) / (n + 0.5 * (v + 1))) for y in w)
        assert (x.n_tokens, x.n_known, x.held_out) == (len(w), sum(c[y] > 0 for y in w), held(x.doc_id))
        assert abs(x.base_score - base) < 1e-6 and x.score < 0
    new = [x for x in out if x.held_out]
    assert sum(x.score for x in new) > sum(x.base_score for x in new)


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame(lm_rows(60), "doc_id long, text string")
    model, _ = lm_score.train(df)
    context = np.random.default_rng(0).integers(0, lm_score.CLASSES + 1, (20, lm_score.CONTEXT))
    total = sum(np.exp(lm_score.log_probabilities(model, context, np.full(20, k))) for k in range(lm_score.CLASSES))
    assert np.allclose(total, 1, atol=1e-4)
    assert abs(model.weights.sum() - (model.n + 0.5 * model.v + 0.5 * lm_score.CLASSES)) < 1e-6


def test_lm_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model, counts = lm_score.train(empty)
    assert lm_score.score(empty, model, counts).count() == 0
    one = spark.createDataFrame([(1, "a b", 3)], "doc_id long, text string, score int")
    x = lm_score.score(one, *lm_score.train(one)).first()
    assert x.n_tokens == 3


# the pipeline ----------------------------------------------------------------

def test_stages_keep_columns_and_their_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash_dedup", "mixing", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, k
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_against_its_parts(spark):
    from collections import defaultdict

    from tests.llm.test_dedup import brute_near
    from tests.llm.test_quality import base, brute_lines, line_fails
    docs = [(r.doc_id, r.text, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    clean = []
    for i, t, s, n in docs:
        lines = t.split("\n")
        good = [x for x in lines if not line_fails(x)]
        words, _, _, _, repeats = base(t)
        chars, left = sum(map(len, lines)), sum(map(len, good))
        if words >= 50 and 100 * repeats <= 50 * words and (chars - left) * 1000 <= 400 * chars:
            clean.append((i, "\n".join(good), s, n))
    source = {i: s for i, _, s, _ in clean}
    kept = [(i, t) for i, t in brute_lines(clean)]
    group = brute_near(kept)
    kept = {i: t for i, t in kept if group[i] == i}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {x.doc_id for x in out} <= set(kept)
    # every drawn copy has all its pieces, and the words drawn meet the targets
    copies = Counter(x.doc_id for x in out if x.piece == 0)
    pieces = Counter((x.doc_id, x.piece) for x in out)
    assert all(n == copies[i] <= 3 for (i, _), n in pieces.items())
    size, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t in kept.items():
        size[source[i]] += len(t.split())
        most[source[i]] = max(most[source[i]], len(t.split()))
        taken[source[i]] += copies[i] * len(t.split())
    from playerledger.llm.mixing import targets
    names = sorted(size)
    for s, goal in zip(names, targets([size[s] for s in names], [1 + i % 3 for i in range(len(names))])):
        assert goal - most[s] <= taken[s] <= goal + 1e-6


def test_registered_queries_and_oracles(spark):
    from tools.oracle_check import check
    import __spark_entry__ as entry
    assert [k for k in registry.QUERIES if k.startswith("op")] == list(registry.QUERIES)
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in registry.QUERIES} == set(range(1, 14))
    assert "pipeline" in entry.queries() and set(registry.ORACLE_SQL) <= set(entry.oracle_sql())
    res = check(spark, SF, names=list(registry.ORACLE_SQL), verbose=False)
    assert not {k: v for k, v in res.items() if not v["ok"]}


def test_entry_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "playerledger"):
        (tmp_path / name).symlink_to(REPO / name)
    (tmp_path / "playerledger").unlink()
    (tmp_path / "playerledger").mkdir()
    for p in (REPO / "playerledger").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "playerledger" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not [k for k in q if k.startswith('op')]"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})

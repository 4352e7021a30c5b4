import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from playerledger.llm import components, embedding_dedup, minhash_dedup, suffix_dedup, words_np


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


@pytest.mark.parametrize("size", [500_000, 20])
def test_components(spark, monkeypatch, size):
    monkeypatch.setattr(components, "LINKS_A_TASK", size)
    r = random.Random(2)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(500, 540)] + [(7, 7), (None, 3)]
    parent = list(range(600))
    for a, b in edges:
        if a is not None:
            parent[find(parent, a)] = find(parent, b)
    least = {}
    for a in range(600):
        least.setdefault(find(parent, a), a)
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: least[find(parent, x)] for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# near duplicates -------------------------------------------------------------

def test_word_hashes_do_not_depend_on_place():
    texts = ["Hello  world", None, "", "hello\tWORLD x" + "y" * 700_000 + " end", "  é É  "]
    data, offsets = words_np.buffer_of(pa.array(texts))
    hashed, counts = words_np.words_of(data, offsets)
    assert counts.tolist() == [2, 0, 0, 4, 2]
    assert hashed[0] == hashed[2] and hashed[1] == hashed[3] and hashed[6] != hashed[7]
    for i, t in enumerate(texts):
        one, _ = words_np.words_of(*words_np.buffer_of(pa.array([t])))
        assert one.tolist() == hashed[counts[:i].sum():counts[:i + 1].sum()].tolist()


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for n, share in ((8, 0.5), (40, 0.75), (300, 0.75), (2000, 0.3)):
        for _ in range(20):
            both = rng.integers(0, 1 << 63, int(n * share)).astype(np.uint64)
            a, b = (np.concatenate((both, rng.integers(0, 1 << 63, n - len(both)).astype(np.uint64))) for _ in range(2))
            row = np.repeat([0, 1], [len(a), len(b)])
            h = minhash_dedup.superminhash(row, np.concatenate((a, b)), 2)
            assert np.isfinite(h).all() and sorted(np.floor(h[0]).astype(int))[0] == 0
            errors.append((h[0] == h[1]).mean() - len(both) / (2 * n - len(both)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert np.isinf(minhash_dedup.superminhash(np.zeros(0, int), np.zeros(0, np.uint64), 1)).all()


def shingle_set(t):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near(rows):
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                parent[find(parent, i)] = find(parent, j)
    least = {}
    for i in ids:
        least.setdefault(find(parent, i), i)
    return {i: least[find(parent, i)] for i in ids}


def near_rows():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(2, 5)))
    rows, k = [], 0
    for _ in range(12):
        text = [word() for _ in range(r.choice([3, 6, 40, 150]))]
        for _ in range(r.randint(1, 25)):
            t = list(text)
            for _ in range(r.randint(0, max(1, len(t) // 25))):
                t[r.randrange(len(t))] = word()
            rows.append((k, r.choice([" ", "  ", "\n"]).join(t).upper() if r.random() < 0.2 else " ".join(t)))
            k += 1
    r.shuffle(rows)
    return rows + [(9000, None), (9001, ""), (9002, " \n"), (9003, "x"), (9004, "X"), (9005, rows[0][1]), (9005, rows[0][1]), (None, rows[0][1]),
                   (9006, "w " * 30_000)]


@pytest.mark.parametrize("large", [2048, 4])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(minhash_dedup, "LARGE_BUCKET", large)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = minhash_dedup.label(df).collect()
    assert len(out) == len(rows)
    truth, sizes = brute_near(rows), {i: len(shingle_set(t)) for i, t in rows}
    for x in out:
        assert x.component_id == (truth[x.id] if x.id is not None else None)
        assert x.id is None or x.n_shingles == sizes[x.id]


def test_links_inside_large_buckets_are_all_found(spark, monkeypatch):
    # form letters at about 0.70 to each other; 60 pairs of them at about 0.76
    monkeypatch.setattr(minhash_dedup, "LARGE_BUCKET", 8)
    r = random.Random(12)
    words = lambda n: [f"{r.randrange(1 << 40):x}" for _ in range(n)]
    letter, rows = words(200), []
    for k in range(60):
        shared = words(10)
        rows += [(10 * k + i, " ".join(letter + shared + words(32))) for i in range(2)]
    truth = brute_near(rows)
    assert sum(i != c for i, c in truth.items()) == 60
    got = {x.id: x.component_id for x in minhash_dedup.label(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == truth


def test_one_of_each_keeps_columns_and_null_ids(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(1, text, 5), (2, text, 6), (None, text, 7), (3, None, 8)], "doc_id long, text string, kept_id int")
    out = minhash_dedup.one_of_each(df)
    assert out.columns == df.columns and {x.kept_id for x in out.collect()} == {5, 7, 8}
    assert minhash_dedup.one_of_each(df.limit(0)).count() == 0


# embeddings ------------------------------------------------------------------

def vector_rows():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((30, 16))
    rows = []
    for i in range(500):
        v = base[rng.integers(30)] + rng.standard_normal(16) * rng.choice([0, 0.1, 0.25, 0.4])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    nan, inf = float("nan"), float("inf")
    return rows + [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [nan] * 16, 1), (2003, rows[5][1], None), (None, rows[5][1], 0),
                   (2004, [], 1), (2005, [1.0, 2.0], 1), (2006, [2.0, 4.0], 1), (2007, rows[7][1], rows[7][2]), (2008, [None] * 16, 1),
                   (2009, [inf] + [0.0] * 15, 1)]


def brute_vectors(rows):
    ok = [i for i, (k, v, lab) in enumerate(rows) if k is not None and lab is not None and v and
          all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent, degree = list(range(len(rows))), [0] * len(rows)
    for a in ok:
        for b in ok:
            if b < a and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    degree[a] += 1
                    degree[b] += 1
                    parent[find(parent, a)] = find(parent, b)
    least = {}
    for a in ok:
        root = find(parent, a)
        least[root] = min(least.get(root, 1 << 60), rows[a][0])
    return {rows[a][0]: (degree[a], least[find(parent, a)] if a in ok else rows[a][0]) for a in range(len(rows))}


def test_embedding_links_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = embedding_dedup.label_components(df, passes=embedding_dedup.passes_for(10_000)).collect()
    truth = brute_vectors(rows)
    assert {x.vec_id: (x.n_links, x.component_id) for x in out} == truth
    assert all(x.kept == (x.vec_id == x.component_id) for x in out)


def test_runs_longer_than_a_window_are_compared_whole():
    rng = np.random.default_rng(1)
    x = rng.standard_normal(12) + rng.standard_normal((300, 12)) * 0.01
    ids, group = np.arange(300), np.zeros(300, int)
    pairs = [np.stack(p, 1) for p in embedding_dedup.links_in(ids, group, x, 300, 0.93, window=16)]
    assert len(np.unique(np.concatenate(pairs), axis=0)) == 300 * 299 // 2


def test_segments_are_compared_with_the_next(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(vector_rows()[:200], "id long, vector array<float>, label string").withColumn("dim", F.lit(16))
    whole = embedding_dedup.links(df, passes=30).collect()
    assert whole and sorted(whole) == sorted(embedding_dedup.links(df, passes=30, segment=64).collect())


def test_near_copies_over_many_segments_are_compared_whole(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal(16) + rng.standard_normal((300, 16)) * 0.01
    df = spark.createDataFrame([(i, "a", 16, [float(c) for c in v]) for i, v in enumerate(x)], "id long, label string, dim int, vector array<double>")
    assert embedding_dedup.links(df, passes=12, segment=32).count() == 300 * 299 // 2


def test_pairs_of_a_dense_and_an_even_label_are_found(spark):
    # 1500 vectors at cosines of about 0.87, 200 of them with a partner at 0.935 or so; and a label spread evenly
    rng = np.random.default_rng(4)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    mean, noise = unit(rng.standard_normal((1, 64))), unit(rng.standard_normal((1500, 64)))
    noise[:200] = unit(noise[200:400] + 0.75 * noise[:200])
    x = {"dense": unit(mean + 0.39 * noise), "even": unit(rng.standard_normal((1500, 64)))}
    x["even"][:200] = unit(x["even"][200:400] + 0.35 * x["even"][:200])
    df = spark.createDataFrame([(i + 10_000 * (k == "even"), k, 64, v.tolist()) for k in x for i, v in enumerate(x[k])],
                               "id long, label string, dim int, vector array<double>")
    truth = {(int(a) + o, int(b) + o) for k, o in (("dense", 0), ("even", 10_000))
             for a, b in zip(*np.nonzero(np.triu(x[k] @ x[k].T >= 0.93, 1)))}
    passes = {r.label: r.passes for r in embedding_dedup.plan(df, segment=64).collect()}
    assert passes["even"] > 1 and (passes["dense"] == 0 or passes["dense"] > passes["even"])
    got = {(r.a, r.b) for r in embedding_dedup.links(df, segment=64).collect()}
    assert len(truth) > 300 and got <= truth and len(got) >= 0.995 * len(truth)
    assert {(r.a, r.b) for r in embedding_dedup.links(df, segment=64, exact=True).collect()} == truth


def test_embedding_edges(spark):
    df = spark.createDataFrame([(1, [1.0], 1, "x")], "vec_id long, embedding array<double>, label int, N_LINKS string")
    out = embedding_dedup.label_components(df)
    assert [c.lower() for c in out.columns].count("n_links") == 1 and out.first().n_links == 0
    assert embedding_dedup.label_components(df.limit(0)).count() == 0
    assert embedding_dedup.passes_for(10**9) > embedding_dedup.passes_for(10**5) >= embedding_dedup.LEAST_PASSES


# repeated strings ------------------------------------------------------------

def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for t in range(120):
        n = int(rng.integers(1, 150))
        x = rng.integers(0, rng.integers(1, 4) + 1, n)
        if t % 3 == 0 and n > 40:
            x[20:40] = x[:20]
        s = [bytes(x.astype(np.uint8)[i:]) for i in range(n)]
        sa = suffix_dedup.suffix_array(x)
        assert sa.tolist() == sorted(range(n), key=lambda i: s[i])
        same = [0] + [next((k for k, (p, q) in enumerate(zip(s[sa[i - 1]], s[sa[i]])) if p != q),
                           min(len(s[sa[i - 1]]), len(s[sa[i]]))) for i in range(1, n)]
        assert suffix_dedup.common_prefixes(x, sa, 1 << 20).tolist() == same


def brute_repeats(texts, span=400):
    seen = defaultdict(int)
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - span + 1):
            seen[b[i:i + span]] += 1
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if seen[b[i:i + span]] > 1:
                gone[i:i + span] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("shard,piece", [(4000, 1 << 22), (6, 700)])
def test_repeats_equal_brute_force(spark, monkeypatch, shard, piece):
    monkeypatch.setattr(suffix_dedup, "MERGE_PRINTS", 2_000)
    r = random.Random(3)
    text = lambda n: " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(n))
    shared = [text(120) for _ in range(4)]
    texts = [text(r.randint(10, 200)) for _ in range(30)]
    texts += [text(r.randint(0, 80)) + " " + r.choice(shared) + " " + text(r.randint(0, 80)) for _ in range(60)]
    texts += [None, "", "x" * 399, "x" * 400, "y" * 900, "ab" * 500, shared[0][5:500] + "q" + shared[0][100:600]] + [text(100)] * 3
    r.shuffle(texts)
    ids = [None if i == 5 else i for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in suffix_dedup.without_repeats(df, shard_segments=shard, piece=piece).collect()}
    for i, t, truth in zip(ids, texts, brute_repeats(texts)):
        x = got[i]
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == truth
        assert hashlib.sha256(x.kept).hexdigest() == truth[3] and sum(s.hi - s.lo for s in x.spans) == truth[1]
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


def test_repeats_in_texts_that_repeat_themselves(spark):
    r = random.Random(8)
    text = lambda n: " ".join("".join(r.choice("abcde") for _ in range(5)) for _ in range(n))
    long, dull = text(90), "=" * 3000 + "\n"
    texts = [" " * 20_000, text(50) + dull + text(40), dull * 2 + long, "-+" * 700 + "x", long[:399] + " " * 500, text(80), ("ab " * 133)[:399], None]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, N_BYTES string, ta int")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.without_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)
    # one row for equal segments in a row, not one a byte
    segments = suffix_dedup.segments(suffix_dedup.units_of(df.select("text")))
    assert segments.count() < 400 and segments.agg({"times": "max"}).first()[0] > 10_000


def test_union_find():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 60, 400):
        u, v = rng.integers(0, 300, n), rng.integers(0, 300, n)
        parent = list(range(300))
        for a, b in zip(u.tolist(), v.tolist()):
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
        truth = {x: find(parent, x) for x in {*u.tolist(), *v.tolist()} if find(parent, x) != x}
        assert dict(zip(*(x.tolist() for x in components.union_find(u, v)))) == truth
    line = np.arange(5000)
    assert set(components.union_find(line[1:], line[:-1])[1].tolist()) == {0}


WORDS_A = "one two three four five six seven eight nine ten eleven twelve thirteen"
WORDS_B = "red orange yellow green blue indigo violet black white grey brown pink gold"


@pytest.mark.parametrize("turn", [False, True])
def test_an_id_with_several_texts_ties_what_they_link_to(spark, turn):
    """Rows (1, A), (1, B), (2, A'), (3, B') are one group, whatever comes first."""
    rows = [(1, WORDS_A), (1, WORDS_B), (2, WORDS_A + " end"), (3, WORDS_B + " end"), (4, "something else that stands alone here")]
    rows = rows[::-1] if turn else rows
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = {(r.id, r.component_id) for r in minhash_dedup.label(df).collect()}
        assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_one_row_of_a_repeated_document_stays(spark):
    rows = [(1, WORDS_A, "x", 7), (1, WORDS_A, "x", 7), (1, WORDS_B, "x", 7), (2, WORDS_A + " end", "y", 8), (3, None, "z", 9),
            (3, None, "z", 9), (None, WORDS_A, "n", 1), (None, WORDS_A, "n", 1), (5, "", "e", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id string, component_id int")
    got = minhash_dedup.one_of_each(df)
    assert got.columns == df.columns
    got = sorted(((r.doc_id or 0, r.kept_id) for r in got.collect()))
    assert got == [(0, "n"), (0, "n"), (1, "x"), (3, "z"), (5, "e")]

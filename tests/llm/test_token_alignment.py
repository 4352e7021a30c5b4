import hashlib
import random

import numpy as np
import pytest

from playerledger.llm import token_alignment
from playerledger.llm.common import tokenizer_file
from playerledger.llm.token_alignment import align, alignment, groups, most_pairs, pair_of

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = ["", None, "a", " ", "  two  spaces ", " leading", "trailing ", "tab\tand\nline\n\n end\n", "\nfirst", "x \n y",
       "<|endoftext|> plain <s> text </s>", "naïve café ﬁ ½ é", "汉字 日本語 🎉🎉 ​ z", "a\x1cb c\x00d", "<0x41> ▁x",
       "word" * 3000, "1234567890 " * 50, "…!!!??? --- ''' don't I'll", "A" * 5000, "ab cd", "　wide"]


def brute(text):
    """(a ids, b ids, groups) of a text, straight from the libraries and sets of ends."""
    pair = pair_of(A, B)
    if not text:
        return [], [], []
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    whole = (" " + text).encode()
    if any(b"".join(t[i] for i in ids) != whole for t, ids in ((pair.bytes_a, a), (pair.bytes_b, b))):
        return [], [], []
    ends_a, ends_b = (np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((pair.bytes_a, a), (pair.bytes_b, b)))
    out, x, y = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        i, j = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        out.append((a[x:i], b[y:j]))
        x, y = i, j
    return a, b, out


def said(found):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)


def want(texts):
    """The rows of the query: n_a .. groups_sha256 for each text."""
    found = [brute(t) for t in texts]
    count = {}
    for _, _, g in found:
        for x, y in g:
            count[x[-1], y[-1]] = count.get((x[-1], y[-1]), 0) + 1
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for a, b, g in found:
        n = [count[x[-1], y[-1]] for x, y in g]
        best = sum(count[x[-1], y[-1]] == top[y[-1]] for x, y in g)
        out.append((len(a), len(b), len(g), len(g), best, sum(n), hashlib.sha256(said(g).encode()).hexdigest() if g else ""))
    return out


def texts(n, seed):
    r = random.Random(seed)
    parts = ["the ", "quick", " brown", "fox", ".", "\n", " ", "ünï", "Straße ", "12", "x1", "!!", "zz", "日本", "\t"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_divide_and_conquer_finds_all_cuts(seed):
    r = random.Random(seed)
    ends = [[], []]
    docs = [[], []]
    at, cuts = 0, []
    for _ in range(20):
        n = r.randint(1, 200)
        own = [sorted({r.randint(1, n) for _ in range(r.randint(0, n))} | {n}) for _ in range(2)]
        cuts += [at + c for c in sorted(set(own[0]) & set(own[1]))]
        for k in range(2):
            ends[k] += [at + e for e in own[k]]
            docs[k].append(len(ends[k]))
        at += n
    a, b = np.array(ends[0]), np.array(ends[1])
    upto_a, upto_b = groups(a, b, *(np.array(d) for d in docs))
    assert a[upto_a - 1].tolist() == b[upto_b - 1].tolist() == cuts


def test_a_long_interval_with_one_cut():
    a, b = np.arange(1, 5001) * 2, np.concatenate((np.arange(0, 5000) * 2 + 1, [10_000]))
    b[3] = 4  # the only shared inner end
    b = np.unique(b)
    upto_a, upto_b = groups(a, b, np.array([len(a)]), np.array([len(b)]))
    assert a[upto_a - 1].tolist() == [4, 10_000] == b[upto_b - 1].tolist()


def test_query_equals_brute_force(spark, monkeypatch):
    rows = [*ODD, *texts(120, 1), "the quick brown", "the quick brown"]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(rows)], "doc_id long, text string, links string, n_a int")
    expected = want(rows)
    got = alignment(df, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect()}
    assert [got[i] for i in range(len(rows))] == expected
    # smaller slices and tasks
    monkeypatch.setattr(token_alignment, "SLICE", 300)
    pair = pair_of(A, B)
    out = align(df.repartition(3), A, B, with_groups=True).collect()
    for r in out:
        a, b, g = brute(rows[r.id])
        assert (r.n_a, r.n_b, r.groups) == (len(a), len(b), said(g))
        packed = np.frombuffer(r.links, np.uint32)
        assert [(int(p) // len(pair.bytes_b), int(p) % len(pair.bytes_b)) for p in packed] == [(x[-1], y[-1]) for x, y in g]


def test_pairs_are_bounded_by_tails():
    pair = pair_of(A, B)
    for rows in (ODD, texts(50, 2)):
        linked = {(x[-1], y[-1]) for t in rows for x, y in brute(t)[2]}
        for x, y in linked:
            p, q = pair.bytes_a[x], pair.bytes_b[y]
            assert p.endswith(q) or q.endswith(p)
    assert most_pairs(A, B) < 1_000_000


def test_empty_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment(empty, A, B).count() == 0
    rows = [(None, "same text here"), (5, "same text here"), (5, "same text here"), (6, None)]
    got = sorted(((r.doc_id or 0, r.n_links, r.count_sum, r.n_best) for r in
                  alignment(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()))
    assert got == [(0, 3, 9, 3), (5, 3, 9, 3), (5, 3, 9, 3), (6, 0, 0, 0)]

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from playerledger.llm import license_scan, mixing, packing, token_counts, token_ids
from playerledger.llm.common import tokenizer_file

WORD, BYTE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
ODD = ["a\x1cb c", "it's <|endoftext|>x <|startoftext|> Ünï  ﬁ İx", "", " ", "  ", " é" + "́" * 3 + " ́a", "x" * 3000 + " y\n\n\n z",
       "ΣΑΣ don't WE'LL 12 345½", "\x01 a b\x01", "a\x85b\xa0c​d　e f\x0bg", " é  x \n y\t z  ", "a \xa0 b  　c", " \n", "x ",
       "\x85 a \x85b", "a\x85 \x85b c", "\n a b", " a", "a\n b\n", "z  q", "😀 👩‍👩‍👧 ok", "\x00 \x7f"]


def texts(n=150, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioulnréñ'.,A1") for _ in range(r.randint(1, 12)))
    return ODD + ["".join(word() + r.choice([" ", " ", " ", "\n", "  "]) for _ in range(r.randint(0, 300))) for _ in range(n)]


def test_word_ids_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_ids, "MOST_WORDS", 500)
    all = texts()
    encoder = token_ids.WordIds(WORD)
    for at in range(0, len(all), 40):
        part = all[at:at + 40]
        for t, ids in zip(part, encoder.of_texts(pa.array(part))):
            assert ids.tolist() == token_ids.tokenizer(WORD).encode(t, add_special_tokens=False).ids, t[:40]


def test_counts_equal_the_library():
    all = texts()
    counter = token_counts.PrefixCounts(BYTE)
    truth = [len(token_ids.tokenizer(BYTE).encode(t, add_special_tokens=False).ids) for t in all]
    for _ in range(2):
        assert counter.counts(pa.array(all)).tolist() == truth
    assert counter.counts(pa.array([], pa.string())).tolist() == []


def library_count(text):
    return len(token_ids.tokenizer(BYTE).encode(text, add_special_tokens=False).ids)


def test_every_prefix_and_budget():
    counter = token_counts.PrefixCounts(BYTE)
    r = random.Random(9)
    blanks = ["".join(r.choice(" \n\t\xa0\u2003ab'sré1!") for _ in range(120)) for _ in range(25)]
    spaced = ["".join(r.choice(["     ", " ", "\n", "we'll", "'ve", "ab", "!?", "中文", "<|endoftext|>", "<|end"]) for _ in range(50)) for _ in range(15)]
    for t in [x for x in texts(8) if len(x) < 900] + blanks + spaced:
        truth = [library_count(t[:i]) for i in range(len(t) + 1)]
        assert counter.prefixes(t) == truth, t
        for budget in (0, 1, 7, 40):
            assert counter.within(t, budget) == max(i for i, n in enumerate(truth) if n <= budget), (t, budget)


def test_prefixes_of_a_text_without_borders_are_linear():
    counter = token_counts.PrefixCounts(BYTE)
    r = random.Random(2)
    t = "".join(r.choice("abcdefgh") for _ in range(40_000))
    found = counter.prefixes(t)
    assert len(found) == len(t) + 1 and all(found[i] == library_count(t[:i]) for i in (1, 100, 7_777, 40_000))
    assert counter.within(t, 5_000) == max(i for i, n in enumerate(found) if n <= 5_000)


def test_token_counts_of_a_table(spark):
    long = "é x" * 700 + " <|endoftext|>"
    df = spark.createDataFrame([(1, "a b", 5), (None, None, 6), (3, "x " * 600, 7), (3, "x " * 600, 7), (4, long, 8)],
                               "doc_id long, text string, n_tokens int")
    out = token_counts.token_counts(df, BYTE)
    rows = sorted([tuple(x) for x in out.collect()], key=str)
    assert len(rows) == 5 and (None, 0, 0, False, 0) in rows and (1, 3, 2, False, 3) in rows
    assert [x for x in rows if x[0] == 3][0][1] == 1200 and [x for x in rows if x[0] == 3][0][3]
    for k, t in ((3, "x " * 600), (4, long)):
        best = max(i for i in range(len(t) + 1) if library_count(t[:i]) <= token_counts.LIMIT)
        assert [x for x in rows if x[0] == k][0][4] == len(t[:best].encode())
    assert token_counts.token_counts(df.limit(0), BYTE).count() == 0


# packing ---------------------------------------------------------------------

def test_best_fit_takes_the_fullest_bin_with_room():
    r = random.Random(1)
    for _ in range(200):
        cap = r.randint(5, 60)
        sizes = np.array([r.randint(1, cap) for _ in range(r.randint(0, 80))], np.int64)
        bins, offsets, loads = packing.best_fit(sizes, cap)
        open_bins: list[int] = []
        for i in np.argsort(-sizes, kind="stable"):
            fits = [k for k, load in enumerate(open_bins) if load + sizes[i] <= cap]
            best = max((open_bins[k] for k in fits), default=None)
            if best is None:
                open_bins.append(int(sizes[i]))
            else:
                open_bins[open_bins.index(best)] += int(sizes[i])
        assert sorted(loads.tolist()) == sorted(open_bins)
        for b in range(len(loads)):
            at = 0
            for i in sorted(np.flatnonzero(bins == b), key=lambda i: offsets[i]):
                assert offsets[i] == at
                at += sizes[i]
            assert at == loads[b] <= cap


def check_packed(rows, capacity):
    by = {}
    for x in rows:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    return len(by)


def test_packing_documents(spark):
    all = texts(60) + ["w " * 9000, None]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(all)] + [(0, all[0], "x"), (None, "n", "y")],
                               "doc_id long, text string, length string").repartition(6)
    rows = packing.pack_documents(df, WORD).collect()
    for i, t in enumerate(all):
        ids = np.array([*token_ids.tokenizer(WORD).encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        truth = [(k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
        got = sorted((x.piece, x.start, x.length, x.ids_crc32) for x in rows if x.doc_id == i)
        assert got == sorted(truth * (2 if i == 0 else 1))
    n = check_packed(rows, 4096)
    assert n <= -(-sum(x.length for x in rows) // 4096) + 1
    assert packing.pack_documents(df.limit(0), WORD).count() == 0


@pytest.mark.parametrize("group", [200_000, 7])
def test_tree_merge(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    r = random.Random(8)
    sizes = [r.randint(1, 100) for _ in range(400)]
    parts = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "item long, length long").repartition(16)
    from playerledger.llm.common import stored
    rows = packing.pack(stored(parts, "parts"), capacity=128, nearly=2).collect()
    assert sorted((x.item, x.length) for x in rows) == sorted(enumerate(sizes))
    assert check_packed(rows, 128) <= 1.06 * sum(sizes) / 128 + 2


# mixing ----------------------------------------------------------------------

def test_targets():
    assert mixing.targets([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    assert mixing.targets([100, 1, 1], [1, 2, 3]) == [96, 3, 3]
    assert mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []
    r = random.Random(5)
    for _ in range(200):
        sizes = [r.randint(0, 1000) for _ in range(r.randint(1, 9))]
        got = mixing.targets(sizes, [1 + i % 3 for i in range(len(sizes))])
        assert abs(sum(got) - sum(sizes)) < 1e-6 and all(t <= 3 * s + 1e-6 for t, s in zip(got, sizes))


def test_splitting_tree_deals_every_block_once():
    quotas = np.array([1, 0, 57, 300])
    for shards in (1, 2, 7, 16):
        leaves = [mixing.split_quotas(quotas, shards, s) for s in range(shards)]
        at = np.zeros(4, int)
        for quota, offset in leaves:
            assert offset.tolist() == at.tolist()
            at += quota
        assert at.tolist() == quotas.tolist()
        totals = [q.sum() for q, _ in leaves]
        assert max(totals) - min(totals) <= shards.bit_length()


def mix_rows(n=3000):
    r = random.Random(6)
    rows = [(i, r.choice(["a", "a", "a", "B", "é", "𝒳", None]), "w " * r.choice([1, 5, 30, 200])) for i in range(n)]
    return rows + [(n, "tiny", "one two"), (n + 1, "a", None), (n + 2, "a", ""), (None, "a", "x y"), rows[0], rows[0]]


def test_mix_meets_its_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumnRenamed("doc_id", "doc_id")
    out = mixing.draw(df).collect()
    assert len(out) == len(rows)
    names = sorted({s for _, s, _ in rows if s is not None}, key=lambda s: s.encode()) + [None]
    size = Counter()
    for _, s, t in rows:
        size[s] += len((t or "").split())
    truth = dict(zip(names, mixing.targets([size[s] for s in names], [1 + i % 3 for i in range(len(names))])))
    taken = Counter()
    for x in out:
        assert x.size == len((x.text or "").split()) and x.source_size == size[x.source]
        assert abs(x.target - truth[x.source]) < 1e-6 and len(x.draws) <= 3
        taken[x.source] += x.size * len(x.draws)
    for s in names:
        assert taken[s] <= truth[s] + 1e-6 and truth[s] - taken[s] <= max(2, 0.01 * truth[s]), s
    again = mixing.draw(df.repartition(5)).collect()
    key = lambda x: str((x.doc_id, x.source, x.text, x.draws))
    assert sorted(map(key, out)) == sorted(map(key, again))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(len(x.draws) for x in out)


def test_mix_edges(spark):
    df = spark.createDataFrame([(1, "a", None, 2)], "doc_id long, source string, text string, size int")
    out = mixing.draw(df)
    assert [c for c in out.columns if c == "size"] == ["size"] and out.first().draws == []
    assert mixing.draw(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).columns == df.columns


# licences --------------------------------------------------------------------

def brute_scan(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    places, labels = [], set()
    for i in range(len(w)):
        for phrase, label in license_scan.BASE.items():
            if w[i:i + len(phrase.split())] == phrase.split():
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_pieces_agree_with_the_whole(monkeypatch):
    r = random.Random(7)
    bits = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "x", "é", "permission is hereby granted"]
    for _ in range(60):
        t = " ".join(r.choice(bits) for _ in range(r.randint(0, 80)))
        monkeypatch.setattr(license_scan, "PIECE", 1 << 18)
        whole = license_scan.scan(t.encode())
        assert whole[:5] == brute_scan(t)
        for size in (1, 7, 40):
            monkeypatch.setattr(license_scan, "PIECE", size)
            assert license_scan.scan(t.encode()) == whole


def test_license_scan_equals_brute_force(spark):
    r = random.Random(3)
    bits = ["gnu", "General", "public", "LICENSE", "apache", "cc", "by", "mit", "x", "é", "\n", "--", "cc-by", "MIT License"]
    rows = [(i, r.choice([" ", "  ", "-"]).join(r.choice(bits) for _ in range(r.randint(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "mit license"), (903, "cc by " * 20_000), (904, "cc by " * 3), (904, "cc by " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([tuple(x) for x in license_scan.licenses(df).collect()], key=str)
    assert sorted([(x[0], *x[1:6]) for x in got], key=str) == sorted([(i, *brute_scan(t)) for i, t in rows], key=str)
    for x in got:
        assert 0 <= x[7] <= 1 and set(x[5].split(",")) <= set(x[6].split(",")) and x[6] == ",".join(sorted(set(x[6].split(","))))
    assert license_scan.licenses(df.limit(0)).count() == 0


@pytest.mark.parametrize("expression,choices", [
    ("MIT", {("mit",)}),
    ("MIT OR Apache-2.0", {("mit",), ("apache-2.0",)}),
    ("MIT AND (BSD-3-Clause OR GPL-2.0+)", {("bsd-3-clause", "mit"), ("gpl-2.0+", "mit")}),
    ("MIT OR BSD AND ISC", {("mit",), ("bsd", "isc")}),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", {("gpl-2.0 with classpath-exception-2.0",), ("mit",)}),
    ("(MIT", {("mit",)}), ("MIT AND", {("mit",)}), ("AND MIT", set()), ("", set()), ("MIT */", {("mit",)}),
    ("(MIT OR (ISC)) AND X", {("mit", "x"), ("isc", "x")}),
])
def test_license_expressions(expression, choices):
    assert {tuple(sorted(x)) for x in license_scan.alternatives(expression)} == choices


def test_license_tags():
    found = license_scan.scan(b"// SPDX-License-Identifier: (MIT OR ISC) AND Zlib\ncode under the MIT License")
    assert found[4] == "mit" and set(found[5].split(",")) == {"mit", "isc", "zlib"} and found[6] == 1.0


def test_license_choices_follow_the_operators():
    """OR lets one choose, AND does not; a line that names no licence gives nothing."""
    told = lambda line: license_scan.scan(f"// SPDX-License-Identifier: {line}\n".encode())
    assert told("MIT OR GPL-2.0")[5:] == ("gpl-2.0,mit", 1.0, "gpl-2.0;mit")
    assert told("MIT AND GPL-2.0")[5:] == ("gpl-2.0,mit", 1.0, "gpl-2.0+mit")
    assert told("(MIT OR ISC) AND Apache-2.0 */")[7] == "apache-2.0+isc;apache-2.0+mit"
    assert told("MIT.")[5:] == ("mit", 1.0, "mit")
    assert told("see the file LICENSE")[5:] == ("", 0.0, "")
    assert told("MIT\n# SPDX-License-Identifier: MIT\n# SPDX-License-Identifier: BSD-2-Clause OR Zlib")[7] == "bsd-2-clause;zlib|mit"


def test_license_columns_of_the_input_may_clash(spark):
    df = spark.createDataFrame([(None, "mit license", "x", 3)], "doc_id long, text string, labels string, n_words int")
    row = license_scan.licenses(df).first()
    assert (row.doc_id, row.n_words, row.labels, row.choices) == (None, 2, "mit", "")


@pytest.mark.parametrize("lengths", [[9, 3, 3, 3], [400] + [5] * 900, [7] * 10, [1000, 1]])
def test_mixing_comes_near_the_target(spark, lengths):
    """Small sources, one block a source, a document longer than what is missing: what the
    mix leaves free is less than the smallest row it could still take."""
    rows = [(i, f"s{s}", " ".join(["w"] * n)) for s in range(3) for i, n in enumerate(lengths, s * 10_000)]
    got = mixing.draw(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    for s in range(3):
        mine = [r for r in got if r.source == f"s{s}"]
        target, taken = mine[0].target, sum(r.size * len(r.draws) for r in mine)
        epochs = target // mine[0].source_size
        left = [r.size for r in mine if len(r.draws) <= epochs]
        assert taken <= target + 1e-6 and (target - taken < min(left, default=1) or len(mine) > mixing.BLOCK_ROWS)
        assert target - taken <= max(r.size for r in mine)

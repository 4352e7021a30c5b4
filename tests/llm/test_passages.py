import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from playerledger.llm import passages, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    """Words in runs of ``window`` words that another row has too."""
    rows = defaultdict(set)
    split = [WORD.findall(t or "") for t in texts]
    for i, w in enumerate(split):
        for k in range(len(w) - window + 1):
            rows[tuple(w[k:k + window])].add(i)
    out = []
    for w in split:
        hit = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if len(rows[tuple(w[k:k + window])]) > 1:
                hit[k:k + window] = True
        out.append(int(hit.sum()))
    return out


def table(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    return rows.select("id", F.coalesce("text", F.lit("")).alias("text")).select("id", "text", F.xxhash64("text").alias("ta"), F.hash("text").alias("tb"))


def units(rows):
    return suffix_dedup.units_of(rows.select("text"), 1)


@pytest.mark.parametrize("window,gram,piece", [(51, 12, 1 << 21), (9, 3, 40)])
def test_shared_words_equal_brute_force(spark, window, gram, piece):
    r = random.Random(window + piece)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (window - 1, window, window + 1, window + 30, 3 * window)]
    texts = [text(r.randint(0, 3 * window)) for _ in range(20)]
    texts += [text(r.randint(0, 60)) + r.choice(" \t\n") + r.choice(shared).replace(" ", r.choice([" ", "\n", "  "])) + " " + text(r.randint(0, 60))
              for _ in range(40)]
    alone = text(window + 5)  # repeats inside one document only
    texts += [None, "", " \n", alone + " x " + alone, "a " * 400, "a " * 300 + "b", "a b c " * 150, "x " + "c a b " * 60, text(2 * window) + " " + shared[4] + " " + shared[3]]
    texts += [text(window + 20)] * 3 + [text(window - 1)] * 2
    rows = table(spark, texts)
    found = passages.shared_words(units(rows), window, gram, piece)
    got = {x.id: x.n_passage_words or 0 for x in rows.join(found, ["ta", "tb"], "left").collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)
    assert passages.shared_words(units(rows.limit(0))).count() == 0


def test_short_passages_are_reported_not_removed(spark):
    r = random.Random(4)
    words = lambda n: " ".join("".join(r.choice("abcdef") for _ in range(5)) for _ in range(n))
    passage = words(56)
    assert len(passage) < suffix_dedup.SPAN
    texts = [words(80) + " " + passage + " " + words(40), passage + " " + words(90), words(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_removed, x.n_passage_words) for x in suffix_dedup.without_repeats(df).collect()}
    assert got == {0: (0, 56), 1: (0, 56), 2: (0, 0)}

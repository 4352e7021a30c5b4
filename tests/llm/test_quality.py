import random
import re
from collections import Counter

from pyspark.sql import functions as F

from playerledger.llm import line_dedup, quality_rules

SCHEMA = "doc_id long, text string, source string, n_chars long"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base(t):
    w = words(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if grams[w[i], w[i + 1], w[i + 2]] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))


def line_fails(x):
    n = len(words(x))
    seps = sum(c in "|»›•" for c in x)
    symbols = sum(c in "#*$%&|<>" for c in x)
    end = x.rstrip(" \t\n\x0b\x0c\r")[-1:]
    return n > 0 and ((seps >= 2 and n <= 4 * (seps + 1)) or (n > 8 and end not in ".!?:;,\"')]»”’…。！？"
                      and not re.search(r"[.!?…。！？][\x20\x09-\x0D]", x)) or symbols > n
                      or (len(x) <= 200 and bool(re.search(quality_rules.BOILERPLATE, x))))


def texts(seed=1, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé𝒳") for _ in range(r.randint(1, 3)))
    line = lambda: " ".join(word() for _ in range(r.randint(1, 25))) + r.choice([".", "", " | a | b", "!\t", "***", "\r"])
    out = ["\n".join(line() for _ in range(r.randint(1, 12))) for _ in range(n)]
    return out + [None, "", " \n\t", "a", "one two three", "x\x85y\xa0z", "a b c a b c a b c", "Click here. " * 3, "w " * 3000, "a a a a a"]


def test_judge_equals_brute_force(spark):
    rows = [(i, t, "s", len(t or "")) for i, t in enumerate(texts())]
    rows += [rows[0], (None, rows[1][1], None, None)]
    out = quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text), r.text
        lines = (r.text or "").split("\n")
        good = [x for x in lines if not line_fails(x)]
        chars, left = sum(map(len, lines)), sum(map(len, good))
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert r.clean_text == "\n".join(good) and r.n_failed_lines == len(lines) - len(good)
        assert r.kept == (not failed and (chars - left) * 1000 <= 400 * chars)


def test_clean_prose_is_kept_and_menus_go(spark):
    prose = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) + "." for i in range(8))
    menu = "\n".join("home | about | shop | news" for _ in range(1)) + "\n" + "\n".join(f"a{i} | b{i} | c{i}" for i in range(40))
    df = spark.createDataFrame([(1, prose, "s", 5), (2, menu, "s", 5), (3, prose + "\nAll rights reserved", "s", 5)], SCHEMA)
    kept = {r.doc_id: r for r in quality_rules.keep_clean(df).collect()}
    assert set(kept) == {1, 3} and kept[1].text == prose and kept[3].text == prose and kept[3].n_chars == len(prose)


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, N_WORDS int, kept string")
    out = quality_rules.judge(df)
    assert sorted(c.lower() for c in out.columns).count("n_words") == 1 and out.first().n_words == 2
    assert quality_rules.keep_clean(df.limit(0)).columns == df.columns
    assert quality_rules.judge(df.limit(0)).count() == 0


def brute_lines(rows, ratio=0.1, least=3):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r")
    pages, counts = Counter(), Counter()
    for _, text, host, _ in rows:
        if host is not None:
            pages[host] += 1
            counts.update({(host, key(x)) for x in (text or "").split("\n") if key(x)})
    gone = {k for k, n in counts.items() if n >= least and n > ratio * pages[k[0]]}
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if (h, key(x)) not in gone)) for i, t, h, _ in rows]


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(4)
    common = ["Menu", " Menu ", "Footer text", "rare line", ""]
    rows = []
    for i in range(400):
        lines = [f"own {i} {k}" for k in range(r.randint(0, 4))] + [x for x in common if r.random() < 0.12]
        r.shuffle(lines)
        rows.append((i, "\n".join(lines + lines[:1]), r.choice(["a", "a", "b", "c", None]), 1))
    rows += [(1000, None, "a", 1), (None, "Menu\nMenu", "a", 1), rows[3], rows[3], (1001, "only", "single", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = line_dedup.drop_boilerplate(df)
    got = sorted(((r.doc_id, r.clean_text) for r in out.collect()), key=str)
    assert got == sorted(brute_lines(rows), key=str)
    assert out.agg(F.sum("n_dropped")).first()[0] > 0
    back = line_dedup.without_boilerplate(df)
    assert back.columns == df.columns and back.count() == len(rows)


def test_line_dedup_edges(spark):
    df = spark.createDataFrame([(1, "x", "h", "c")], "doc_id long, text string, source string, site_keys string")
    assert line_dedup.without_boilerplate(df).collect() == df.collect()
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_no_python_in_native_plans(spark):
    df = spark.createDataFrame([(1, "x", "h", 1)], SCHEMA)
    for out in (quality_rules.judge(df), line_dedup.drop_boilerplate(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

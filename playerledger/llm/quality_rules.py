"""Quality rules: line-first cleaning of whole documents.

Every line is judged on its own by three rules (punctuation, navigation,
boilerplate); failing lines are removed, and a document that loses more than
``max_lost`` of its characters is rejected.  Before that a document can fail the
base rules: too few words, or too many words inside repeated three-word windows.

Everything is column expressions: no shuffle, no Python.

Defined results for odd input: null or empty text has no words and fails the
base rules; repeated rows are judged one by one; a null id is passed through;
input columns named like a result column give way to it; an empty table gives an
empty table.  Blank lines are always kept and count as no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerledger.llm.common import SPACE, free_name, let, with_new, words

#: Symbols counted by the base rules.
SYMBOLS = "#*$%&|<>"
#: Separators of menus and link rows.
SEPARATORS = "|»›•"
#: A sentence that ends inside a line.
SENTENCE = r"[.!?…。！？][\x20\x09-\x0D]"
#: A line of prose ends with one of these, spaces after it ignored.
ENDS_WELL = ".!?:;,\"')]»”’…。！？"
#: Page furniture, not prose, when it stands on a line of its own.
BOILERPLATE = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)"
               r"|accept (all )?cookies|enable javascript|lorem ipsum|click here|skip to content|back to top)")
BOILERPLATE_CHARS = 200
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A longer line without a sentence's end in it or behind it fails; shorter ones are taken as headings.
HEADING_WORDS = 8
#: Separators that make a line a menu, and the words between two of them at most.
MENU_SEPARATORS = 2
MENU_WORDS = 4
MAX_LOST = 0.4


def count_chars(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit("[" + chars + "]"))


def repeat_words(w: Column) -> Column:
    """Words that lie in a three-word window occurring at least twice in ``w``.

    Windows are hashed into the high bits of a long with their place in the low
    bits; sorting the longs puts equal windows side by side.  Only the windows
    that meet a neighbour there are compared as text, so the count is exact.
    """
    n = F.size(w)
    # places fit into so many low bits
    bits = F.ceil(F.log2(n + F.lit(1))).cast("int")

    def top(key: Column) -> Column:
        return F.call_function("shiftright", key, bits)

    def beside(s: Column, same) -> Column:
        """Elements of the sorted array ``s`` that equal one of their neighbours."""
        return F.filter(s, lambda x, i: ((i > 0) & same(s[i - 1], x)) | ((i < F.size(s) - 1) & same(F.get(s, i + 1), x)))

    def covered(places: Column) -> Column:
        return F.aggregate(
            places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    def exact(maybe: Column) -> Column:
        texts = F.sort_array(F.transform(
            maybe, lambda p: F.struct(F.concat_ws(" ", w[p], w[p + 1], w[p + 2]).alias("g"), p.alias("p"))))
        found = let(texts, lambda s: beside(s, lambda a, b: a["g"] == b["g"]))
        return covered(F.sort_array(F.transform(found, lambda x: x["p"])))

    keys = F.transform(F.slice(w, 1, n - 2), lambda a, i: F.call_function(
        "shiftleft", F.xxhash64(a, F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long")))
    places = let(F.sort_array(keys), lambda s: F.transform(
        beside(s, lambda a, b: top(a) == top(b)),
        lambda k: (k - F.call_function("shiftleft", top(k), bits)).cast("int")))
    return F.when(n < 4, F.lit(0)).otherwise(let(places, lambda p: F.when(F.size(p) > 0, exact(p)).otherwise(F.lit(0))))


def line_ok(line: Column) -> Column:
    """The verdict of the line rules; blank lines pass.  Words are counted on suspect lines only."""
    n, seps = F.size(words(line)), count_chars(line, SEPARATORS)
    body = F.rtrim(line, F.lit(SPACE))
    menu = (seps >= MENU_SEPARATORS) & (n <= MENU_WORDS * (seps + 1))
    # punctuation: prose ends its lines, and does not hold more symbols than words
    unended = ~F.substring(body, -1, 1).isin(*ENDS_WELL) & (n > HEADING_WORDS) & ~line.rlike(SENTENCE)
    symbols = count_chars(line, SYMBOLS)
    noisy = (symbols > 0) & (symbols > n)
    furniture = (F.length(line) <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    return (F.trim(line, F.lit(SPACE)) == "") | ~(menu | unended | noisy | furniture)


def judge(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``n_lines``, ``n_failed_lines``,
    ``lost`` (share of the characters on failed lines), ``clean_text`` and ``kept``.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    measured = let(words(t), lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("chars"), repeat_words(w).alias("n_repeat")))
    cleaned = let(F.split(t, "\n", -1), lambda lines: let(
        F.filter(lines, line_ok), lambda good: F.struct(
            F.array_join(good, "\n").alias("text"),
            F.length(F.array_join(good, "")).alias("left"),
            F.length(F.array_join(lines, "")).alias("chars"),
            F.size(lines).alias("n"), (F.size(lines) - F.size(good)).alias("bad"),
            let(F.filter(lines, lambda x: F.trim(x, F.lit(SPACE)) != ""),
                lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("repeats"))))
    # a generator's columns: filters on the verdict do not pull the work down a second time
    at = free_name(docs, "judged")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(F.struct(
        measured.alias("words"), cleaned.alias("lines")))).alias(at))
    n_words, n_repeat = F.col(f"{at}.words.n_words"), F.col(f"{at}.words.n_repeat")
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    lost = F.when(F.col(f"{at}.lines.chars") > 0, 1 - F.col(f"{at}.lines.left") / F.col(f"{at}.lines.chars")).otherwise(F.lit(0.0))
    # chars removed against chars: whole numbers decide, so every engine agrees
    too_much = (F.col(f"{at}.lines.chars") - F.col(f"{at}.lines.left")) * 1000 > F.col(f"{at}.lines.chars") * int(round(max_lost * 1000))
    out = with_new(
        out, n_words=n_words.cast("long"),
        word_chars=F.col(f"{at}.words.chars").cast("long"),
        n_symbols=count_chars(t, SYMBOLS).cast("long"),
        n_dup_lines=F.col(f"{at}.lines.repeats").cast("long"), n_repeat_words=n_repeat.cast("long"),
        base_failed=failed, n_lines=F.col(f"{at}.lines.n").cast("long"), n_failed_lines=F.col(f"{at}.lines.bad").cast("long"),
        lost=lost, clean_text=F.col(f"{at}.lines.text"), kept=~failed & ~too_much)
    return out.drop(at)


def keep_clean(docs: DataFrame, text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """The documents that pass, with their failed lines removed, in the columns of ``docs``."""
    out = judge(docs, text).filter("kept")
    new = {text: F.col("clean_text")} | ({chars: F.length("clean_text").cast("long")} if chars in docs.columns else {})
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])

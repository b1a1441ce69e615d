"""Text expressions against Python's own string functions."""

import re

from pyspark.sql import functions as F

from tagloom.functions import text as tx
from tagloom.operators import clean

TEXTS = [
    "", " ", "a", "two words", "  double  spaces ", "tab\tline\nbreak\r\n", " nbsp ", "x\x1cy\x1f",
    " em　wide sep", "\x85nel\x85", "café under_score 42", "éunder wraps", "A-B c's ß İ",
    "ñandú—ciónes", "one​zero-width", "end\n",
]


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def results(df, **exprs):
    rows = df.select("i", *[e.alias(k) for k, e in exprs.items()]).orderBy("i").collect()
    return [{k: r[k] for k in exprs} for r in rows]


def test_whitespace_rules_equal_python(spark):
    t = F.col("t")
    got = results(column(spark, TEXTS), words=tx.words(t), strip=tx.strip(t), parts=tx.space_count(t),
                  tokens=tx.tokens(t), n=tx.word_count(t), chars=tx.char_count(t))
    for text, r in zip(TEXTS, got):
        assert r["words"] == text.split()
        assert r["n"] == len(text.split())
        assert r["strip"] == text.strip()
        assert r["parts"] == len(text.split(" "))
        assert r["chars"] == len(text)
        if "İ" not in text:  # the dotted capital I lower-cases to two characters in Python
            assert r["tokens"] == re.findall(r"\b\w\w+\b", text.lower())


def test_class_of_spaces_is_complete():
    assert set(tx.SPACES) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_ngrams(spark):
    df = column(spark, ["aa bb cc", "aa", ""])
    got = results(df, g=tx.ngrams(tx.tokens(F.col("t")), 1, 3))
    assert got[0]["g"] == ["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"]
    assert got[1]["g"] == ["aa"] and got[2]["g"] == []


def test_clean_lemmas(spark):
    df = column(spark, ['a" "b_c d ee', "__ _ x yy"])
    assert [r["c"] for r in results(df, c=tx.clean_lemmas(F.col("t")))] == ["abc ee", "yy"]


def test_signature_stops_at_line_break(spark):
    texts = ["story —me", "keep —a\nb", "end —me\n", "two —a\nx —b", "nel —a\x85b", "none"]
    df = column(spark, texts).withColumnRenamed("t", "description")
    got = [r["description"] for r in clean.strip_signature(df).orderBy("i").collect()]
    assert got == [re.sub(r"—.*$", "", t).strip() for t in texts]


def test_truncation_suffix(spark):
    texts = ["cut... See full summary »", "cut.. See full summary »", "cut.....   See full synopsis »",
             "cut... see full summary »", "cut... See full summary »\n", "cut... See full summary » more"]
    df = column(spark, texts).withColumnRenamed("t", "description")
    got = [r["description"] for r in clean.strip_truncation_suffix(df).orderBy("i").collect()]
    pattern = r"\.{3,} *See full (?:summary|synopsis) »$"
    assert got == [re.sub(pattern, "", t).strip() for t in texts]
    assert clean.count_truncation_suffix(df).first()[0] == sum(bool(re.search(pattern, t)) for t in texts)


def test_placeholders_count_first_match_only(spark):
    from tagloom.fixed import PLACEHOLDER_PATTERNS

    texts = ["Add a Plot", "it is Under Wraps", "éunder wraps", "Plot\nunknown", "PLOT is UNKNOWN", "tba", "tban",
             "plot unknown and under wraps", "not available", "is not available", "the story is not available",
             "Coming soon", "now coming soon", "the synopsis is unavailable",
             "\u017ftory not di\u017fclo\u017fed", "PLOT UN\u212aNOWN", "\u0130n development", None]
    left = [t for t in texts if t is not None]
    removed = []
    for p in PLACEHOLDER_PATTERNS:
        hit = [t for t in left if re.search(p, t, re.I)]
        removed.append(len(hit))
        left = [t for t in left if t not in hit]
    df = column(spark, texts).withColumnRenamed("t", "description")
    counts = {r["pattern_no"]: r["removed"] for r in clean.placeholder_counts(df).collect()}
    assert [counts[i] for i in range(len(removed))] == removed
    assert counts[-1] == sum(removed)
    kept = [r["description"] for r in clean.drop_placeholders(df).collect()]
    assert sorted(t for t in kept if t) == sorted(left) and None in kept


def test_length_limits_are_strict(spark):
    texts = [" ".join(["w"] * n) for n in (10, 11, 199, 200)] + ["a  " * 5 + "b"]
    df = column(spark, texts).withColumnRenamed("t", "description")
    assert sorted(r["i"] for r in clean.prune_by_length(df).collect()) == [1, 2, 4]

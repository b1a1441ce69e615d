"""Text expressions with the regex, whitespace and length rules of Python strings.

Python ``re`` on ``str`` equals Java regex under the flags d (only ``\\n`` ends a line) and
U (Unicode classes), plus i and u for case-insensitive matching.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() holds.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Word characters: letters, numbers, underscore.
WORD = r"\p{L}\p{N}_"
TOKEN_PATTERN = f"[{WORD}]{{2,}}"


def py_regex(pattern: str, ignore_case: bool = False) -> str:
    return ("(?iudU)" if ignore_case else "(?dU)") + pattern


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Regex search; a null text is no match."""
    return F.coalesce(text.rlike(py_regex(pattern, ignore_case)), F.lit(False))


def remove(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, py_regex(pattern), "")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def plain_spaces(text: Column) -> Column:
    """Every whitespace character as a blank."""
    return F.translate(text, SPACES, " " * len(SPACES))


def words(text: Column) -> Column:
    """Whitespace split without empty parts. A character map and a split at one blank cost less
    than half of a regular expression over the whole whitespace class."""
    return F.array_remove(F.split(plain_spaces(text), " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def space_count(text: Column) -> Column:
    """Number of parts of ``split(' ')``: single spaces, empty parts counted."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + F.lit(1)


def char_count(text: Column) -> Column:
    return F.length(text)


def tokens(text: Column, stop_words: list[str] | str | None = None) -> Column:
    """Lower-cased runs of two or more word characters, optionally without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return without(found, stop_words)


def plain_words(text: Column, stop_words: list[str] | str | None = None) -> Column:
    """Keep ASCII letters, digits and whitespace, lower-case, split on whitespace."""
    kept = F.lower(F.regexp_replace(plain_spaces(text), "[^a-zA-Z0-9 ]", ""))
    return without(F.array_remove(F.split(kept, " "), ""), stop_words)


def stop_list(stop_words: list[str] | str | None) -> list[str]:
    from tagloom.fixed import ENGLISH_STOP_WORDS

    if stop_words is None:
        return []
    if isinstance(stop_words, str):
        if stop_words != "english":
            raise ValueError(f"no stop word list named {stop_words!r}")
        return ENGLISH_STOP_WORDS
    return list(stop_words)


def without(tokens_: Column, stop_words: list[str] | str | None) -> Column:
    listed = stop_list(stop_words)
    if not listed:
        return tokens_
    return F.filter(tokens_, lambda t: ~t.isin(listed))


def ngrams(tokens_: Column, lo: int, hi: int) -> Column:
    """Word n-grams of sizes lo..hi, joined by one space."""
    if not 1 <= lo <= hi:
        raise ValueError("need 1 <= lo <= hi")

    def of_size(n: int) -> Column:
        if n == 1:
            return tokens_
        starts = F.when(
            F.size(tokens_) >= n, F.sequence(F.lit(1), F.size(tokens_) - F.lit(n - 1))
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens_, i, n), " "))

    return reduce(lambda a, b: F.concat(a, b), [of_size(n) for n in range(lo, hi + 1)])


# Letters outside ASCII that case-insensitive regexes equate with i, s and k.
FOLDING_LETTERS = ["\u0130", "\u0131", "\u017f", "\u212a"]


def holds_any(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def may_match(text: Column, marks: list[str]) -> Column:
    """Cheap test in front of a case-insensitive regex: byte search in the lower-cased text for
    literals the regex needs. The one-element array makes the lower-casing happen once."""
    found = F.exists(F.array(F.lower(text)), lambda low: holds_any(low, marks))
    return F.coalesce(found | holds_any(text, FOLDING_LETTERS), F.lit(False))


def contains_any(text: Column, parts: list[str]) -> Column:
    """Case-sensitive: does the text hold one of these substrings?"""
    return F.coalesce(holds_any(text, parts), F.lit(False))


def clean_lemmas(text: Column) -> Column:
    """Drop ``" "`` and underscores, split on whitespace, keep words longer than one."""
    bare = F.replace(F.replace(text, F.lit('" "'), F.lit("")), F.lit("_"), F.lit(""))
    return F.array_join(F.filter(words(bare), lambda w: F.length(w) > 1), " ")


def id_suffix(identifier: Column) -> Column:
    """The id without its two-letter prefix."""
    return F.substr(identifier, F.lit(3))

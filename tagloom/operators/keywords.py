"""Keywords as substrings of texts, for keyword tables of any size: an inverted index of q-grams, then verification.

Every keyword is looked up by one of its q-grams (Q bytes of UTF-8, or the whole keyword if shorter): the one in the fewest texts. A
first look at the texts counts the texts of every q-gram of a keyword, a second one meets the anchors, which gives candidate pairs
(id, keyword); a last look at the text of a candidate tells whether the keyword is there. One look serves all labels, and no keyword
stands in the plan. Only counts and candidates are shuffled or written, never the q-grams of the texts. The driver and every task
hold the q-grams of the keywords as numbers: SPACE of them at most, whatever the keywords.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import written

Q = 3
STARTS = [(1 << 24) + (1 << 16) + (1 << 8), (1 << 24) + (1 << 16), 1 << 24, 0]  # the first number of the q-grams of 0 to Q bytes
SPACE = STARTS[0] + 1
SLICE_BYTES = 1 << 20


def parts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of about SLICE_BYTES: number of the first text, the bytes on end, and the offsets of the texts in them."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        raw = b"".join(x for x in texts.slice(at, to - at).cast(pa.large_binary()).to_pylist() if x)
        yield at, np.frombuffer(raw, np.uint8), np.concatenate([[0], ends[at:to] - done])
        at = to


def grams(raw: np.ndarray, ends: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and number of the q-grams in ``wanted`` (a flag for every number), once a text each and ordered by text. Without
    ``wanted``, those of Q bytes, and for a shorter text the whole of it."""
    keys = [np.zeros(0, np.int64)]
    size = np.diff(ends)
    for q in range(Q + 1):
        if q == 0:
            row = np.flatnonzero(size == 0) if wanted is None else np.arange(len(size) if wanted[STARTS[0]] else 0)
            keys.append(row * SPACE + STARTS[0])
            continue
        n = len(raw) - q + 1
        if n <= 0 or wanted is not None and not wanted[STARTS[q] : STARTS[q - 1]].any():
            continue
        code = np.full(n, STARTS[q] >> 8 * q, np.int32)
        for k in range(q):
            code = code << 8 | raw[k : k + n]
        at = np.arange(n) if wanted is None else np.flatnonzero(wanted[code])
        row = np.searchsorted(ends, at, "right") - 1
        inside = at + q <= ends[row + 1]
        if wanted is None and q < Q:
            inside &= size[row] == q
        keys.append(row[inside] * SPACE + code[at[inside]])
    key = np.unique(np.concatenate(keys))
    return key // SPACE, key % SPACE


def grams_of(codes: np.ndarray | None = None):
    """A function from texts to their distinct q-grams, or those among ``codes``."""
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        wanted = flags(codes)
        for batch in batches:
            counts, found = np.zeros(len(batch), np.int64), [np.zeros(0, np.int64)]
            for at, raw, ends in parts(batch):
                row, code = grams(raw, ends, wanted)
                counts[at : at + len(ends) - 1] = np.bincount(row, minlength=len(ends) - 1)
                found.append(code)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found), pa.int32()))

    return run


def flags(codes: np.ndarray | None) -> np.ndarray | None:
    if codes is None:
        return None
    wanted = np.zeros(SPACE, bool)
    wanted[codes] = True
    return wanted


def text_counts(texts: DataFrame, codes: np.ndarray) -> DataFrame:
    """(code, n): in how many texts (_text) each of the ascending ``codes`` is, where that is any; counted in the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = flags(codes), np.zeros(len(codes), np.int64)
        for batch in batches:
            for _, raw, ends in parts(batch.column(0)):
                total += np.bincount(np.searchsorted(codes, grams(raw, ends, wanted)[1]), minlength=len(codes))
        some = total > 0
        yield pa.RecordBatch.from_pydict({"code": pa.array(codes[some], pa.int32()), "n": pa.array(total[some], pa.int64())})

    return texts.select("_text").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def keyword_hits(df: DataFrame, keywords: DataFrame, identifier: str = "id", column: str = "description",
                 keyword: str = "keyword") -> DataFrame:
    """(id, keyword), once each: the keywords that occur in the lower-cased text of a record.

    Null texts and keywords match nothing; an empty keyword is in every text. Keywords are taken as they are written.
    """
    texts = df.select(F.col(identifier).alias("id"), F.lower(column).alias("_text")).where("_text is not null")
    words = written(keywords.select(F.col(keyword).alias("keyword")).where("keyword is not null").distinct(), "keywords")
    own = written(words.select("keyword", F.explode(grams_of()(F.col("keyword"))).alias("code")), "keyword-grams")
    codes = np.sort(own.select("code").distinct().toArrow().column("code").to_numpy())  # SPACE numbers at most
    if not len(codes):
        return texts.select("id", F.lit("").alias("keyword")).limit(0)
    rare = own.join(text_counts(texts, codes), "code").groupBy("keyword").agg(F.min(F.struct("n", "code"))["code"].alias("code"), F.count(F.lit(1)).alias("met"))
    # A keyword with a q-gram that is in no text is in none.
    all_met = own.groupBy("keyword").agg(F.count(F.lit(1)).alias("met"))
    anchors = written(rare.join(all_met, ["keyword", "met"], "left_semi").select("keyword", "code"), "anchors")
    chosen = np.sort(anchors.select("code").distinct().toArrow().column("code").to_numpy())
    met = texts.select("id", F.explode(grams_of(chosen)(F.col("_text"))).alias("code"))
    candidates = met.join(anchors, "code").groupBy(F.col("id").alias("_id")).agg(F.collect_set("keyword").alias("_words"))
    found = texts.join(candidates, F.col("id").eqNullSafe(F.col("_id"))).select(
        "id", F.explode(F.filter("_words", lambda k: F.contains("_text", k))).alias("keyword"))
    return found.distinct()


def keyword_fractions(df: DataFrame, lists: DataFrame, identifier: str = "id", column: str = "description") -> DataFrame:
    """(id, label, fraction): share of a label's keywords (label, keyword; repeats count) that are in the text; labels without a hit
    are left out."""
    lists = written(lists.where("keyword is not null").groupBy("label", "keyword").agg(F.count(F.lit(1)).alias("n")), "keyword-lists")
    total = lists.groupBy("label").agg(F.sum("n").alias("total"))
    hits = keyword_hits(df, lists, identifier, column).join(lists, "keyword").groupBy("id", "label").agg(F.sum("n").alias("n"))
    return hits.join(total, "label").select("id", "label", (F.col("n") / F.col("total")).alias("fraction"))


def boost_proba_by_table(df: DataFrame, lists: DataFrame, vocabulary: list[str], identifier: str = "id",
                         text: str = "description", proba: str = "proba") -> DataFrame:
    """decide.boost_proba with the keywords in a table: each label's keyword fraction is added to its probability."""
    cells = F.map_from_entries(F.collect_list(F.struct("label", "fraction")))
    boost = keyword_fractions(df, lists, identifier, text).groupBy(F.col("id").alias("_id")).agg(cells.alias("_boost"))
    names = F.lit(list(vocabulary))
    more = F.transform(proba, lambda p, i: p + F.coalesce(F.try_element_at("_boost", F.get(names, i)), F.lit(0.0)))
    return df.join(boost, F.col(identifier).eqNullSafe(F.col("_id")), "left").withColumn(proba, more).select(*df.columns)

"""URL verdicts: host and path rules, and for all other URLs the ratio of two character language models.

A model is a variable-order Markov chain over 32 symbols (the 26 letters, digit, ``.``, ``-``, ``/``, other, edge): contexts
of up to three symbols, each order smoothed by the next shorter one in Witten-Bell fashion. One model is counted from
accepted URLs, one from rejected URLs; a URL's score is the mean log-likelihood difference per symbol of its host and
path, and URLs below a threshold are blocked. The threshold is the one of least balanced error on a fifth of the labelled
URLs that is kept out of the counts. Both models are one table of 2^20 numbers, whatever the input.

Null URLs and URLs without ``://`` have an empty host and path and meet no rule; the models judge the empty string. Where
one of the two labels has no URL, nothing is blocked by the models.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import arrays

EDGE, OTHER, SYMBOLS, ORDER = 0, 31, 32, 3
CODE = np.full(256, OTHER, np.int64)
CODE[97:123] = CODE[65:91] = np.arange(1, 27)
CODE[48:58] = 27
CODE[[46, 45, 47]] = 28, 29, 30
# Bins of the calibration: scores from -BINS / PER_UNIT to BINS / PER_UNIT.
BINS, PER_UNIT = 4000, 400
KEPT_OUT = 5


def host(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    found = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(at > 0, found).otherwise("")


def path(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule ``host/path`` that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text in sorted(rules, key=len):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, rules[text]).otherwise(verdict)
    return rule, verdict


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and code (context and symbol) of every symbol of each text, the closing edge included."""
    raw, ends = arrays.flat_bytes(texts)
    size = np.diff(ends) + ORDER + 1
    at = np.cumsum(size) - size
    symbols = np.zeros(int(size.sum()), np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    symbols[np.arange(len(raw)) - ends[row] + at[row] + ORDER] = CODE[raw]
    code = symbols[ORDER:].copy()
    for k in range(1, ORDER + 1):
        code |= symbols[ORDER - k : len(symbols) - k] << (5 * k)
    owner = np.repeat(np.arange(len(texts)), size)[ORDER:]
    place = np.arange(ORDER, len(symbols)) - at[owner]
    return owner[place >= ORDER], code[place >= ORDER]


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Log probability of each symbol in each context of ORDER symbols."""
    by_order = [counts.reshape([SYMBOLS] * (ORDER + 1))]
    for _ in range(ORDER):
        by_order.append(by_order[-1].sum(axis=0))
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for c in reversed(by_order):
        total, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), p)
    return np.log(p).reshape(-1)


class Model:
    def __init__(self, ratio: np.ndarray, threshold: float = -np.inf):
        self.ratio, self.threshold = ratio.astype(np.float32), threshold

    def score(self, texts: pa.Array) -> np.ndarray:
        row, code = grams(texts)
        return np.bincount(row, self.ratio[code], len(texts)) / np.maximum(np.bincount(row, minlength=len(texts)), 1)


def score(text: Column, model: Model, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield arrays.joined([pa.array(shared.value.score(x)) for x in arrays.slices(batch)], pa.float64())

    return scored(text)


def fit(labelled: DataFrame) -> Model:
    """Models and threshold from all rows (text, accepted) with neither null."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("accepted").cast("boolean").alias("accepted")).dropna()
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(KEPT_OUT)).cast("int"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = batch.column("accepted").to_numpy(zero_copy_only=False)
            at = 0
            for x in arrays.slices(batch.column("text")):
                row, code = grams(x)
                key, n = np.unique(code | (flags[at : at + len(x)][row].astype(np.int64) << (5 * (ORDER + 1))), return_counts=True)
                at += len(x)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    # At most 2 * 32^4 rows reach the driver.
    found = rows.where("fold > 0").select("text", "accepted").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(2 * SYMBOLS ** (ORDER + 1))
    counts[found["key"].to_numpy()] = found["n"].to_numpy()
    rejected, accepted = counts.reshape(2, -1)
    model = Model(log_probabilities(accepted) - log_probabilities(rejected))
    if not rejected.any() or not accepted.any():
        return model
    # At most 2 * (2 * BINS + 1) rows reach the driver.
    binned = F.greatest(F.least(F.floor(score(F.col("text"), model, spark) * PER_UNIT), F.lit(BINS)), F.lit(-BINS)).cast("int")
    held = rows.where("fold = 0").select("accepted", binned.alias("bin")).groupBy("accepted", "bin").count().collect()
    tally = np.zeros((2, 2 * BINS + 1))
    for r in held:
        tally[int(r["accepted"]), r["bin"] + BINS] += r["count"]
    if tally.sum(axis=1).all():
        # Wrong below each possible threshold: accepted URLs under it, rejected ones from it on.
        share = tally / tally.sum(axis=1, keepdims=True)
        wrong = np.concatenate([[0], np.cumsum(share[1])]) + 1 - np.concatenate([[0], np.cumsum(share[0])])
        best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
        model.threshold = float(((best[0] + best[-1]) / 2 - BINS) / PER_UNIT)
    return model


def judge(pages: DataFrame, rules: dict[str, str], rejected_terms: list[str], url: str = "url") -> DataFrame:
    """``pages`` with the columns host, path, rule, verdict (allow or block) and score.

    The models learn from all URLs with a host: one counts as rejected if a part of its host between dots and hyphens is
    among ``rejected_terms``, and as accepted otherwise.
    """
    address = F.col(url)
    df = pages.withColumn("host", host(address)).withColumn("path", path(address))
    df = df.withColumn("host", F.coalesce("host", F.lit(""))).withColumn("path", F.coalesce("path", F.lit("")))
    text = F.lower(F.concat("host", "path"))
    listed = F.exists(F.split("host", "[.-]"), lambda x: x.isin(rejected_terms))
    model = fit(df.where("host != ''").select(text.alias("text"), (~listed).alias("accepted")))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") < model.threshold, "block").otherwise("allow")
    return df.withColumn("score", score(text, model, pages.sparkSession)).withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, own))

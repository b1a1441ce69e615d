"""Record cleaning: filters, text repair, group merge, override and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import fixed
from tagloom.functions import text as tx
from tagloom.operators.ranking import keep_first
from tagloom.session import bounded_list


# --- filters and projections -------------------------------------------------------------

def project_used(df: DataFrame) -> DataFrame:
    return df.select(*fixed.RECORD_COLUMNS)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=fixed.RECORD_COLUMNS)


def exclude_labels(df: DataFrame, names: list[str] = fixed.EXCLUDED_LABELS,
                   column: str = "genre") -> DataFrame:
    """Drop rows whose raw label string contains one of the names, in any case, anywhere."""
    return df.filter(~tx.matches(F.col(column), "|".join(names), ignore_case=True))


def is_placeholder(column: Column, patterns: list[str]) -> Column:
    """Does the text match any pattern? One alternation; for the known patterns only texts that
    hold one of their literals reach the regex."""
    hit = tx.matches(column, tx.any_of(patterns), ignore_case=True)
    if patterns == fixed.PLACEHOLDER_PATTERNS:
        return tx.may_match(column, fixed.PLACEHOLDER_MARKS) & hit
    return hit


def drop_placeholders(df: DataFrame, patterns: list[str] = fixed.PLACEHOLDER_PATTERNS,
                      column: str = "description") -> DataFrame:
    """Drop rows whose text matches any pattern."""
    return df.filter(~is_placeholder(F.col(column), patterns))


def placeholder_counts(df: DataFrame, patterns: list[str] = fixed.PLACEHOLDER_PATTERNS,
                       column: str = "description") -> DataFrame:
    """(pattern_no, pattern, removed): a row counts for the first pattern it matches; patterns
    that remove nothing show 0, and the row with pattern_no -1 holds the total."""
    col = F.col(column)
    first = reduce(
        lambda acc, i: F.when(tx.matches(col, patterns[i], ignore_case=True), i).otherwise(acc),
        reversed(range(len(patterns))),
        F.lit(None).cast("int"),
    )
    counts = [F.count_if(F.col("_first") == i).alias(f"_{i}") for i in range(len(patterns))]
    counts.append(F.count("_first").alias("_total"))
    # Texts without a match, nearly all of them, meet one alternation instead of every pattern.
    one_row = df.filter(is_placeholder(col, patterns)).select(first.alias("_first")).agg(*counts)
    rows = [F.struct(F.lit(i).alias("pattern_no"), F.lit(p).alias("pattern"),
                     F.col(f"_{i}").alias("removed")) for i, p in enumerate(patterns)]
    rows.append(F.struct(F.lit(-1).alias("pattern_no"), F.lit("total").alias("pattern"),
                         F.col("_total").alias("removed")))
    return one_row.select(F.inline(F.array(*rows)))


def strip_truncation_suffix(df: DataFrame, column: str = "description") -> DataFrame:
    col = F.col(column)
    cut = F.when(F.contains(col, F.lit("See full")), tx.remove(col, fixed.TRUNCATION_SUFFIX)).otherwise(col)
    return df.withColumn(column, tx.strip(cut))


def count_truncation_suffix(df: DataFrame, column: str = "description") -> DataFrame:
    return df.agg(F.count_if(tx.matches(F.col(column), fixed.TRUNCATION_SUFFIX)).alias("truncated"))


def strip_signature(df: DataFrame, column: str = "description") -> DataFrame:
    """Cut from the first dash that has no line break after it (but for a final one)."""
    col = F.col(column)
    cut = F.when(F.contains(col, F.lit("\u2014")), tx.remove(col, fixed.SIGNATURE)).otherwise(col)
    return df.withColumn(column, tx.strip(cut))


def prune_by_length(df: DataFrame, lower: int = fixed.MIN_WORDS, upper: int = fixed.MAX_WORDS,
                    column: str = "description") -> DataFrame:
    """Keep texts with lower < parts < upper, both strict, counted by single spaces."""
    n = tx.space_count(F.col(column))
    return df.filter((n > lower) & (n < upper))


def drop_meta_text(df: DataFrame, column: str = "description") -> DataFrame:
    pattern = "|".join(fixed.META_PHRASES)
    return df.filter(~tx.matches(F.col(column), pattern, ignore_case=True))


def prune_texts(df: DataFrame, column: str = "description") -> DataFrame:
    """The training-set filter: length limits, then meta phrases."""
    return drop_meta_text(prune_by_length(df, column=column), column)


def needs_override(df: DataFrame) -> DataFrame:
    """Distinct ids whose text is cut off or missing."""
    return df.filter(tx.contains_any(F.col("description"), fixed.OVERRIDE_MARKS)) \
        .select("movie_id").distinct()


def count_truncated(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.contains("description", F.lit("See full summary"))).alias("truncated"))


def drop_label(df: DataFrame, label: str, column: str = "labels") -> DataFrame:
    """Remove one label everywhere; records left without any label go."""
    return df.withColumn(column, F.array_remove(column, label)).filter(F.size(column) > 0)


def keep_labels(df: DataFrame, names: list[str], column: str = "labels") -> DataFrame:
    """Restrict the label set; records left without any label go."""
    kept = F.filter(F.col(column), lambda v: v.isin(list(names)))
    return df.withColumn(column, kept).filter(F.size(column) > 0)


def label_slice(df: DataFrame, label: str, column: str = "labels", target: str = "y") -> DataFrame:
    return df.withColumn(target, F.array_contains(column, label).cast("int"))


# --- merge, override, de-duplicate --------------------------------------------------------

def longest_text(column: Column) -> Column:
    """Aggregate: the longest text that is not the empty mark, ties to the smallest text;
    the empty mark when nothing else is there. Carries each text once."""
    real = F.when(column != fixed.EMPTY_TEXT, F.struct((-F.length(column)).alias("n"), column.alias("t")))
    return F.coalesce(F.min(real)["t"], F.lit(fixed.EMPTY_TEXT))


def merge_groups(df: DataFrame) -> DataFrame:
    """One row per (movie_id, movie_name): sorted distinct labels and the longest text.

    Labels are exploded so that the state of a group is bounded by the label vocabulary; only
    the first exploded row carries the text.
    """
    parts = df.select(
        "movie_id", "movie_name", "description",
        F.posexplode(F.split("genre", ", ")).alias("_pos", "_label"),
    )
    return parts.groupBy("movie_id", "movie_name").agg(
        F.array_sort(F.collect_set(tx.strip(F.col("_label")))).alias("labels"),
        longest_text(F.when(F.col("_pos") == 0, F.col("description"))).alias("description"),
    )


def override_text(df: DataFrame, override: DataFrame) -> DataFrame:
    """Left join by id; the new text wins where there is one. ``override`` must be unique by id
    (see read_override). Spark broadcasts it only below its own size threshold."""
    new = override.select(F.col("movie_id"), F.col("description").alias("_new"))
    return (
        df.join(new, "movie_id", "left")
        .withColumn("description", F.coalesce("_new", "description"))
        .drop("_new")
        .select(*df.columns)
    )


def unique_override(df: DataFrame, order: list[str]) -> DataFrame:
    """(ids, plots, order...) -> unique (movie_id, description), first complete row per id."""
    complete = df.dropna(subset=["ids", "plots"])
    return keep_first(complete, ["ids"], order).select(
        F.col("ids").alias("movie_id"), F.col("plots").alias("description")
    )


def missing_ids(ids: DataFrame, got: DataFrame) -> DataFrame:
    """Wanted ids without a non-null text so far."""
    done = got.filter(F.col("description").isNotNull()).select("movie_id")
    return ids.select("movie_id").distinct().join(done, "movie_id", "left_anti")


def dedup_by_text(df: DataFrame) -> DataFrame:
    """First record per text. A hash in front of the text as part of the key lets the sorts of
    the aggregation compare numbers; whole texts are compared only where hashes agree."""
    keyed = df.withColumn("_hash", F.xxhash64("description"))
    return keep_first(keyed, ["_hash", "description"], ["movie_id", "movie_name"]).drop("_hash")


def dedup_by_id(df: DataFrame) -> DataFrame:
    return keep_first(df, ["movie_id"], ["movie_name"])


def label_vocabulary(df: DataFrame, column: str = "labels") -> DataFrame:
    return df.select(F.explode(column).alias("label")).distinct().orderBy("label")


def load_vocabulary(df: DataFrame, column: str = "labels", limit: int = 10_000) -> list[str]:
    """The sorted vocabulary as a driver list; refuses more than ``limit`` labels."""
    return bounded_list(df.select(F.explode(column).alias("label")).distinct(), limit)

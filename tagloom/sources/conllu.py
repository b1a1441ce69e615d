"""CoNLL-U corpora with ``# movie_id``, ``# genre`` and ``# text`` comment lines.

Reading: the text source splits at the line that starts a record, so a file is read by many
tasks and one row is one record. Writing: one output line per row, range-partitioned and sorted
by record, so that no record is ever gathered in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.text import WHITESPACE, strip
from tagloom.operators.ranking import head_n

MARK = "# movie_id"


def after_equals(line: Column) -> Column:
    """Everything after the first ``=``."""
    return strip(F.regexp_replace(line, r"(?s)^[^=]*=", ""))


def between_equals(line: Column) -> Column:
    """The second part of a split at ``=``."""
    return strip(F.get(F.split(line, "="), 1))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(lines array<string>) of each record, the first line holding the id, plus file order."""
    raw = spark.read.option("lineSep", "\n" + MARK).text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_start"),
                     F.monotonically_increasing_id().alias("_row"))
    # The separator is cut off, except in front of the first record of a file. Lines before
    # the first record belong to none.
    started = raw.filter(F.col("value").rlike(rf"^(?:{MARK})?[ \t]*="))
    return started.select(F.split("value", "\n").alias("lines"), "_file", "_start", "_row")


def scan_conllu(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(movie_id, genre array<int>, description, lemmatized_description array<string>)."""
    found = records(spark, path)
    if limit is not None:
        found = head_n(found, limit, ["_file", "_start", "_row"])
    lines = F.col("lines")
    with_prefix = lambda p: F.filter(lines, lambda x: F.startswith(x, F.lit(p)))
    genres = with_prefix("# genre")  # the last one holds
    genre = F.split(F.regexp_replace(between_equals(F.get(genres, F.size(genres) - 1)), r"[\[\]']", ""), " ")
    token_lines = F.filter(lines, lambda x: x.rlike(r"^\p{Nd}"))
    return found.select(
        between_equals(F.get(lines, 0)).alias("movie_id"),
        genre.cast("array<int>").alias("genre"),
        F.array_join(F.transform(with_prefix("# text"), after_equals), " ").alias("description"),
        F.transform(token_lines, lambda x: F.get(F.split(x, "\t"), 2)).alias("lemmatized_description"),
    )


def scan_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Token grain: (movie_id, sent_no, tok_no, form, lemma, upos), numbered from 1."""
    lines = F.posexplode("lines")
    rows = records(spark, path).select(between_equals(F.get("lines", 0)).alias("movie_id"), "lines")
    # Sentence number = number of "# text" lines up to the token line.
    marks = F.transform("lines", lambda x, i: F.when(F.startswith(x, F.lit("# text")), i))
    rows = rows.withColumn("_marks", F.array_compact(marks)).select(
        "movie_id", "_marks", lines.alias("_at", "line"))
    tokens = rows.filter(F.col("line").rlike(r"^\p{Nd}"))
    parts = F.split("line", "\t")
    sent = F.filter("_marks", lambda m: m < F.col("_at"))
    return tokens.select(
        "movie_id", F.size(sent).alias("sent_no"),
        F.regexp_extract(F.get(parts, 0), r"^\d+", 0).cast("int").alias("tok_no"),
        F.get(parts, 1).alias("form"), F.get(parts, 2).alias("lemma"), F.get(parts, 3).alias("upos"),
    )


def write_conllu(records_: DataFrame, sentences: DataFrame, tokens: DataFrame, path: str) -> None:
    """records_: (movie_id, genre array<int>); sentences: (movie_id, sent_no, text); tokens:
    (movie_id, sent_no, tok_no, form, lemma, upos). Sentences with a blank text are left out.

    Rows become lines: two header lines per record, a text line per sentence, token lines, and
    a blank line after each sentence. All lines of a record go to one sorted partition."""
    ten = F.concat_ws("\t", F.col("tok_no").cast("string"), F.col("form"), F.col("lemma"),
                      F.coalesce("upos", F.lit("_")), *[F.lit("_")] * 6)
    one_line = F.regexp_replace(strip(F.col("text")), f"[{WHITESPACE}]+", " ")
    last = F.lit(2**31 - 1)
    heads = records_.select("movie_id", F.inline(F.array(
        F.struct(F.lit(0).alias("s"), F.lit(0).alias("t"),
                 F.concat(F.lit(f"{MARK} = "), F.col("movie_id")).alias("value")),
        F.struct(F.lit(0).alias("s"), F.lit(1).alias("t"),
                 F.concat(F.lit("# genre = ["), F.array_join(F.col("genre").cast("array<string>"), " "),
                          F.lit("]")).alias("value")),
    )))
    texts = sentences.select("movie_id", "sent_no", one_line.alias("text")).filter("text <> ''").select("movie_id", F.inline(F.array(
        F.struct(F.col("sent_no").alias("s"), F.lit(0).alias("t"),
                 F.concat(F.lit("# text = "), F.col("text")).alias("value")),
        F.struct(F.col("sent_no").alias("s"), last.alias("t"), F.lit("").alias("value")),
    )))
    words = tokens.select("movie_id", F.col("sent_no").alias("s"), F.col("tok_no").alias("t"),
                          ten.alias("value"))
    lines = heads.unionByName(texts).unionByName(words)
    lines.repartitionByRange("movie_id").sortWithinPartitions("movie_id", "s", "t") \
        .select("value").write.text(path)

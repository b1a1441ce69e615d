"""Text features in long form ``(id, term, ...)`` and, for MLlib, as sparse rows.

A record is one row, so its terms are counted inside the row (sorted, then run lengths) and no
text is ever shuffled. TF-IDF writes the counts in blocks with numbered terms (termblocks.py), so
that only the distinct terms of each block are grouped by term.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import text as tx
from tagloom.operators import termblocks
from tagloom.operators.ranking import dense_position, keep_first
from tagloom.session import scratch_path, written

VECTORIZERS = ("count", "tf-idf")
SLICE_WORDS = 1 << 16
BROADCAST_VALUES = 1 << 23  # numbers of a vector table that every task may hold
SLICE_VALUES = 1 << 24  # numbers of a slice of a larger one
DRIVER_VALUES = 1 << 23  # numbers of a matrix of word vectors that the driver may hold


def tokenize(df: DataFrame, column: str = "description", name: str = "tokens") -> DataFrame:
    return df.withColumn(name, tx.tokens(F.col(column)))


def remove_stopwords(df: DataFrame, tokens: str = "tokens",
                     stop_words: list[str] | str = "english") -> DataFrame:
    return df.withColumn(tokens, tx.without(F.col(tokens), stop_words))


def ngrams(df: DataFrame, lo: int, hi: int, tokens: str = "tokens") -> DataFrame:
    return df.withColumn(tokens, tx.ngrams(F.col(tokens), lo, hi))


def terms_of(text: Column, ngram: tuple[int, int] = (1, 1),
             stop_words: list[str] | str | None = None) -> Column:
    found = tx.tokens(text, stop_words)
    return found if ngram == (1, 1) else tx.ngrams(found, *ngram)


def counted(df: DataFrame, terms: Column, name: str, count: str) -> DataFrame:
    """(id, name, count): the distinct terms of every row with their numbers of occurrences,
    without a shuffle. Rows without terms, or with null, give nothing."""
    t = F.col("_t")
    runs = df.select("id", F.sort_array(terms).alias("_t"))
    starts = F.array_compact(F.transform(t, lambda x, i: F.when((i == 0) | (x != F.get(t, i - 1)), i)))
    runs = runs.select("id", "_t", starts.alias("_s"))
    s = F.col("_s")
    ends = F.transform(s, lambda _, i: F.coalesce(F.get(s, i + 1), F.size(t)))
    cells = F.zip_with(s, ends, lambda a, b: F.struct(F.get(t, a).alias(name), (b - a).cast("long").alias(count)))
    return runs.select("id", F.inline(cells))


def word_counts(df: DataFrame, identifier: str = "id", column: str = "description") -> DataFrame:
    """(id, word, n) of whitespace words. Rows that share an id are counted together, and only those are shuffled."""
    rows = df.select(F.col(identifier).alias("id"), F.col(column).alias("_text"))
    words = tx.words(F.col("_text"))
    shared = written(rows.groupBy("id").agg(F.count(F.lit(1)).alias("_r")).where("_r > 1").select(F.col("id").alias("_id")), "shared-ids")
    if shared.isEmpty():
        return counted(rows, words, "word", "n")
    same = F.col("id").eqNullSafe(F.col("_id"))
    alone, many = (counted(rows.join(shared, same, how), words, "word", "n") for how in ("left_anti", "left_semi"))
    return alone.unionByName(many.groupBy("id", "word").agg(F.sum("n").alias("n")))


def count_vectorize(df: DataFrame, ngram: tuple[int, int] = (1, 1),
                    stop_words: list[str] | str | None = None,
                    identifier: str = "id", column: str = "description") -> DataFrame:
    """(id, term, tf), one row of ``df`` per id. Every term is kept."""
    rows = df.select(F.col(identifier).alias("id"), F.col(column).alias("_text"))
    if ngram == (1, 1):
        return counted(rows, tx.tokens(F.col("_text"), stop_words), "term", "tf")
    # Tokens first, as a column of their own, so that n-grams do not tokenize twice.
    rows = rows.select("id", tx.tokens(F.col("_text"), stop_words).alias("_text"))
    return counted(rows, tx.ngrams(F.col("_text"), *ngram), "term", "tf")


def vocabulary(tf: DataFrame) -> DataFrame:
    """(term, index): distinct terms, numbered alphabetically from 0."""
    return dense_position(tf.select("term").distinct(), ["term"], "index")


def document_frequency(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf(df: Column, n: Column) -> Column:
    return F.log((n + 1.0) / (df + 1.0)) + 1.0


def inverse_frequency(tf: DataFrame, documents: DataFrame) -> DataFrame:
    """(term, idf) with idf = ln((1+n)/(1+df)) + 1, n counting empty texts too."""
    return document_frequency(tf).select("term", idf(F.col("df"), document_count(documents)).alias("idf"))


def weigh(tf: DataFrame, weights: DataFrame, sublinear: bool = False) -> DataFrame:
    """(id, term, weight): tf x idf, rows scaled to unit length. Terms without idf drop out."""
    raw = (F.lit(1.0) + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    joined = tf.join(weights, "term").select("id", "term", (raw * F.col("idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("id")))
    return joined.select("id", "term", (F.col("_w") / norm).alias("weight"))


def tfidf(df: DataFrame, sublinear: bool = False, stop_words: list[str] | str | None = None,
          ngram: tuple[int, int] = (1, 1), identifier: str = "id",
          column: str = "description") -> DataFrame:
    """(id, term, weight), one row of ``df`` per id."""
    return termblocks.tfidf(text_blocks(df, F.col(identifier), ngram, stop_words, column), document_count(df), sublinear)


def text_blocks(df: DataFrame, key: Column, ngram: tuple[int, int] = (1, 1), stop_words: list[str] | str | None = None,
                column: str = "description") -> DataFrame:
    rows = df.select(key.alias("_key"), tx.tokens(F.col(column), stop_words).alias("_text"))
    return termblocks.coded(rows, F.col("_text") if ngram == (1, 1) else tx.ngrams(F.col("_text"), *ngram), F.col("_key"))


def document_count(documents: DataFrame) -> Column:
    return documents.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()


def max_abs_tfidf(df: DataFrame, sublinear: bool = False, stop_words: list[str] | str | None = None,
                  ngram: tuple[int, int] = (1, 1), identifier: str = "id", column: str = "description") -> DataFrame:
    """``tfidf`` divided by the largest weight of the term in ``df``."""
    return termblocks.max_abs_scaled(text_blocks(df, F.col(identifier), ngram, stop_words, column), document_count(df), sublinear)


def label_tfidf_sums(df: DataFrame, sublinear: bool = False, labels: str = "labels", column: str = "description") -> DataFrame:
    """(label, term, w): ``tfidf`` added up over the rows of each label."""
    return termblocks.label_sums(text_blocks(df, F.col(labels), column=column), document_count(df), sublinear)


def max_abs_fit(features: DataFrame, value: str = "weight") -> DataFrame:
    return features.groupBy("term").agg(F.max(F.abs(value)).alias("scale"))


def max_abs_apply(features: DataFrame, fitted: DataFrame, value: str = "weight") -> DataFrame:
    """Divide by the training maximum of the term; an unseen or all-zero term divides by 1."""
    scale = F.coalesce(F.nullif(F.col("scale"), F.lit(0.0)), F.lit(1.0))
    return features.join(fitted, "term", "left").withColumn(value, F.col(value) / scale) \
        .select(*features.columns)


# --- rows for MLlib -----------------------------------------------------------------------

def sparse_rows(features: DataFrame, index: DataFrame, size: int, ids: DataFrame,
                value: str = "weight") -> DataFrame:
    """(id, features) as MLlib sparse vectors for all ids, empty texts included.

    The vectors are written once to the shared folder in MLlib's own storage layout and read
    back as vectors: no Python per row, and a fitting loop rereads a table that survives the
    loss of executors. A row's list is bounded by the distinct terms of its text.
    """
    cells = features.join(index, "term").select(
        "id", F.struct(F.col("index").cast("int").alias("i"), F.col(value).cast("double").alias("v")).alias("c")
    )
    everyone = ids.select("id", F.lit(None).cast("struct<i:int,v:double>").alias("c"))
    rows = cells.unionByName(everyone).groupBy("id").agg(F.array_sort(F.collect_list("c")).alias("c"))
    parts = F.struct(F.col("c")["i"].alias("indices"), F.col("c")["v"].alias("values"))
    return vector_table(rows.select("id", parts.alias("features")), size, scratch_path(ids.sparkSession, "vectors"))


def vector_table(rows: DataFrame, size: int, path: str, extra: list[str] | None = None) -> DataFrame:
    """Write (id, features struct<indices, values>, extra...) and read it with MLlib vectors."""
    stored = rows.select("id", F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.col("features")["indices"].alias("indices"), F.col("features")["values"].alias("values"),
    ).alias("features"), *(extra or []))
    stored.write.parquet(path)
    fields = [T.StructField("features", VectorUDT()) if f.name == "features" else f for f in stored.schema]
    return rows.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def vector_parts(column: str) -> Column:
    """Sparse MLlib vector -> struct<indices, values>, without unfolding it."""
    stored = F.unwrap_udt(F.col(column))
    return F.struct(stored["indices"].alias("indices"), stored["values"].alias("values"))


# --- word vectors -------------------------------------------------------------------------

def unique_vectors(vectors: DataFrame, order: list[str]) -> DataFrame:
    return keep_first(vectors, ["word"], order)


def means_in_row(vectors: DataFrame, size: int, sums: bool = False):
    """A function from word lists to the mean vector of the known words, for a table of bounded size: nothing is shuffled. With ``sums``
    to their sum with their number behind, or to null where there is none."""
    table = vectors.toArrow()
    names, matrix = table["word"].combine_chunks(), table["vec"].combine_chunks().flatten().to_numpy().reshape(-1, size)

    @F.arrow_udf("array<double>")
    def means(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = np.zeros((len(batch), size))
            found = pc.index_in(batch.flatten(), names)
            row = np.repeat(np.arange(len(batch)), batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            held = found.is_valid().to_numpy(zero_copy_only=False)
            place, row = found.drop_null().to_numpy(zero_copy_only=False), row[held]
            n = np.bincount(row, minlength=len(batch))
            for at in range(0, len(row), SLICE_WORDS):
                part, own = place[at : at + SLICE_WORDS], row[at : at + SLICE_WORDS]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                out[own[first]] += np.add.reduceat(matrix[part], first, axis=0, dtype=np.float64)
            if sums:
                cells = pa.array(np.hstack([out, n[:, None]])[n > 0].ravel())
                yield pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum((n > 0) * (size + 1))], pa.int32()), cells, mask=pa.array(n == 0))
                continue
            out /= np.maximum(n, 1)[:, None]
            yield pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), size).cast(pa.list_(pa.float64()))

    return means


def mean_embedding(df: DataFrame, vectors: DataFrame, size: int, identifier: str = "id",
                   column: str = "description") -> DataFrame:
    """(id, embedding array<double>): mean of the vectors of the words that have one, repeats
    counted; zeros when there is none. Words are the whitespace split."""
    rows = df.select(F.col(identifier).alias("id"), F.col(column).alias("_text"))
    known = vectors.select("word", F.col("vec").cast("array<double>").alias("vec")).where("word is not null and vec is not null")
    if known.limit(BROADCAST_VALUES // size + 1).count() <= BROADCAST_VALUES // size:
        return rows.select("id", means_in_row(known, size)(tx.words(F.col("_text"))).alias("embedding"))
    # A larger table goes to the tasks in slices. A text gives one sum for each slice that knows one of its words; neither words nor
    # vectors are shuffled.
    own = vectors.schema["vec"].dataType  # floats take half the room
    known = written(known.select("word", F.col("vec").cast(own).alias("vec")), "known-vectors")
    slices = -(-known.count() // max(SLICE_VALUES // size, 1))
    parts = []
    for k in range(slices):
        part = known.where(F.pmod(F.xxhash64("word"), F.lit(slices)) == k)
        parts.append(rows.select("id", means_in_row(part, size, sums=True)(tx.words(F.col("_text"))).alias("s")).where("s is not null"))
    total = reduce(DataFrame.unionByName, parts).groupBy("id").agg(*[F.sum(F.get("s", i)).alias(f"s{i}") for i in range(size + 1)])
    means = total.select("id", F.array(*[F.col(f"s{i}") / F.col(f"s{size}") for i in range(size)]).alias("m"))
    zero = F.array_repeat(F.lit(0.0), size)
    every = df.select(F.col(identifier).alias("id"))
    return every.join(means, "id", "left").select(
        "id", F.coalesce("m", zero).alias("embedding")
    )


def train_word_vectors(df: DataFrame, column: str = "description", vector_size: int = 100,
                       window: int = 5, min_count: int = 5, epochs: int = 5, seed: int = 42069,
                       partitions: int = 8) -> DataFrame:
    """(word, vec): Word2Vec on whitespace words (MLlib's skip-gram).

    The vectors depend on ``partitions``, so it is a number of its own and not that of the cores.
    MLlib keeps the vocabulary x size matrix on the driver; a vocabulary of more than ``DRIVER_VALUES`` numbers is
    trained in blocks (negative sampling) instead, which stay on the executors."""
    from pyspark.ml.feature import Word2Vec

    from tagloom.operators import wordblocks

    known = df.select(F.explode(tx.words(F.col(column))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    if known.limit(DRIVER_VALUES // vector_size + 1).count() > DRIVER_VALUES // vector_size:
        return wordblocks.train_word_blocks(df, column, vector_size, window, min_count, epochs, seed=seed)
    sentences = df.select(tx.words(F.col(column)).alias("words"))
    model = Word2Vec(
        inputCol="words", vectorSize=vector_size, windowSize=window, minCount=min_count,
        maxIter=epochs, seed=seed,
        numPartitions=partitions,
    ).fit(sentences)
    return model.getVectors().select("word", vector_to_array("vector").cast("array<float>").alias("vec"))


def pca_project(df: DataFrame, k: int = 2, identifier: str = "id", column: str = "embedding") -> DataFrame:
    """(id, projection array<double>) onto the k first principal axes. MLlib forms the d x d
    covariance on the driver."""
    from pyspark.ml.feature import PCA

    rows = df.select(identifier, array_to_vector(F.col(column).cast("array<double>")).alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(rows)
    return model.transform(rows).select(identifier, vector_to_array("_p").alias("projection"))

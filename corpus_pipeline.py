"""The corpus pipeline: toxicity, near duplicates, benchmark passages, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and reads it again as the documents of the next stage. All stages but the last return the columns of the documents; the
last returns ids per document. No stage gathers texts, links or classes on the driver.

- toxicity: documents with a score of 0.3 or more go.
- near_duplicates: one document of each class stays, that with the smallest id.
- decontaminate: documents with a passage of a benchmark item go.
- personal_data: spans are replaced by their kind in brackets, and n_chars follows the text.
- tokens: SentencePiece ids with an end id, and whether decoding gives back the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import decontaminate, pii, piecebpe, probminhash, toxicity
from tagloom.llm.common import fresh, table
from tagloom.llm.queries import TOXIC, piece_model, toxicity_model
from tagloom.session import written

# SQL cannot express learned scores, ProbMinHash or the tokenizer; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = fresh(docs, "toxicity")
    scored = docs.withColumn(score, toxicity.score("text", toxicity_model(docs, spark, sf_dir)))
    return scored.where(F.col(score) < TOXIC).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = fresh(docs, "benchmark_hits")
    marked = docs.withColumn(found, F.size(decontaminate.hits(F.col("text"), table(spark, sf_dir, "benchmark"))))
    return marked.where(F.col(found) == 0).select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = fresh(docs, "pii_spans")
    masked = pii.find(docs, "text", found).withColumn("text", pii.masked(F.col("text"), F.col(found)))
    if "n_chars" in docs.columns:
        changed = F.size(found) > 0
        masked = masked.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = piecebpe.encode_decode(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), piece_model())
    same = F.col("decoded") == F.replace("text", F.lit(piecebpe.SPACE), F.lit(" "))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

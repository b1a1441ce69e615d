"""Bindings of the given tables to records, labels, scores and weights, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.functions import text as tx
from tagloom.operators import clean, evaluate, explore, models
from tagloom.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}

# Digits kept on both sides when a result is a floating-point number.
DIGITS = 9


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a Spark query and, where there is one, its SQL over the named common tables."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql, needs)
        return fn
    return add


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


def with_tables(sql: str, needs: tuple[str, ...]) -> str:
    wanted: set[str] = set()

    def visit(n: str) -> None:
        if n not in wanted:
            wanted.add(n)
            for d in CTES[n][1]:
                visit(d)

    for n in needs:
        visit(n)
    parts = [f"{n} as (\n{CTES[n][0]}\n)" for n in CTES if n in wanted]
    return (f"with {', '.join(parts)}\n{sql}") if parts else sql


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rnd(column, digits: int = DIGITS):
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits)


# The same whitespace class as functions.text.WHITESPACE, spelled for the SQL engine.
WS = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
      r"\x{202f}\x{205f}\x{3000}")


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def sql_words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{WS}]+')"


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# --- raw records: documents with markers by source, so that every cleaning rule has work ----

# Every text is read. Sources 0 and 3 also have one row more per document that holds a
# placeholder only; its doc_id is negative, so that doc_id stays a key.
KEYS = [
    "concat('tt', cast(doc_id div 2 as string)) as movie_id",
    "concat('name ', lang, ' ', cast(doc_id div 4 as string)) as movie_name",
]
TEXT = """case source when 'src1' then concat(text, '... See full summary »')
        when 'src2' then concat(text, '—', source)
        when 'src4' then concat('Still under wraps: ', text)
        when 'src6' then concat(text, '..... See full synopsis »')
        when 'src7' then concat('A story Directed By ', source, ' ', text)
        else text end as description"""
PLACEHOLDER = "case source when 'src0' then 'Add a Plot' else 'Plot details are UNKNOWN' end as description"
GENRE = "case source when 'src5' then concat(lang, ', News') else concat(lang, ', ', source) end as genre"


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    empty = d.filter("source in ('src0', 'src3')")
    return d.selectExpr(*KEYS, TEXT, GENRE, "doc_id").unionByName(
        empty.selectExpr(*KEYS, PLACEHOLDER, GENRE, "-1 - doc_id as doc_id"))


def sql_div(expr: str) -> str:
    return expr.replace(" div ", " // ").replace("as string", "as varchar")


cte("raw", f"""select {", ".join(map(sql_div, KEYS))}, {TEXT}, {GENRE}, doc_id from documents
union all
select {", ".join(map(sql_div, KEYS))}, {PLACEHOLDER}, {GENRE}, -1 - doc_id as doc_id from documents where source in ('src0', 'src3')""")


def override_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(ids, plots, doc_id): new texts for documents marked as poor; some are missing."""
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs.join(marks.filter("quality = 0"), "doc_id").selectExpr(
        "concat('tt', cast(doc_id div 2 as string)) as ids",
        "case when toxic = 1 then null else concat('Override: ', text) end as plots", "doc_id")


def override(spark: SparkSession, sf: str) -> DataFrame:
    return clean.unique_override(override_rows(spark, sf), ["doc_id"])


cte("override_rows", """select concat('tt', cast(doc_id // 2 as varchar)) as ids,
  case when toxic = 1 then null else concat('Override: ', text) end as plots, doc_id
from documents join labels using (doc_id) where quality = 0""")
cte("override", """select ids as movie_id, arg_min(plots, doc_id) as description
from override_rows where plots is not null group by ids""", "override_rows")


# --- documents as labelled records ----------------------------------------------------------

def docs(spark: SparkSession, sf: str) -> DataFrame:
    """(id, description, labels = [language, source], lang, source)."""
    rows = spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    return rows.select(F.col("doc_id").alias("id"), F.col("text").alias("description"),
                       F.array("lang", "source").alias("labels"), "lang", "source")


def lang_docs(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the language as the only label."""
    return docs(spark, sf).select("id", "description", F.array("lang").alias("labels"))


cte("docs", "select doc_id as id, text as description, lang, source from documents")
cte("doc_labels", "select id, unnest([lang, source]) as label from docs", "docs")
cte("lang_labels", "select id, lang as label from docs", "docs")
cte("doc_voc", "select distinct label from doc_labels", "doc_labels")
cte("tf", f"""select id, term, count(*) as tf from (
  select id, unnest({sql_tokens('description')}) as term from docs) group by id, term""", "docs")
cte("ndocs", "select cast(count(*) as double) as n from docs", "docs")


def doc_scored(spark: SparkSession, sf: str) -> DataFrame:
    """(id, description, y_true, y_pred): the truth is language and source; the prediction is
    right where the document is marked good and not toxic, else guesses English."""
    marks = table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    d = docs(spark, sf).join(marks, "id", "left")
    guess = F.array_compact(F.array(
        F.when(F.col("quality") == 1, F.col("lang")).otherwise("en"),
        F.when(F.col("toxic") == 0, F.col("source")),
    ))
    return d.select("id", "description", F.array_sort("labels").alias("y_true"),
                    F.array_sort(F.array_distinct(guess)).alias("y_pred"))


def doc_vocabulary(spark: SparkSession, sf: str) -> list[str]:
    return clean.load_vocabulary(docs(spark, sf))


cte("doc_pred", """select distinct id, label from (
  select id, unnest([case when quality = 1 then lang else 'en' end,
                     case when toxic = 0 then source end]) as label
  from docs left join labels on doc_id = id) where label is not null""", "docs")
cte("doc_grid", """select d.id, v.label, cast(t.id is not null as int) as t, cast(p.id is not null as int) as p
from docs d cross join doc_voc v
left join doc_labels t on t.id = d.id and t.label = v.label
left join doc_pred p on p.id = d.id and p.label = v.label""", "docs", "doc_labels", "doc_voc", "doc_pred")
cte("doc_rec", """select id, sum(t * p) as tp, sum(t) as nt, sum(p) as np, count(*) as n_labels,
  case when sum(greatest(t, p)) = 0 then 0.0 else sum(t * p) / sum(greatest(t, p)) end as jaccard
from doc_grid group by id""", "doc_grid")


# --- marked documents as a one-label problem ---------------------------------------------------

def binary_docs(spark: SparkSession, sf: str, marked: str = "inner") -> DataFrame:
    """(id, description, y, proba, p): truth = quality mark, probability from the word count.
    ``marked="left"`` keeps documents without a mark; their y is null."""
    d = docs(spark, sf).join(table(spark, sf, "labels").withColumnRenamed("doc_id", "id"), "id", marked)
    wc = tx.word_count(F.col("description")).cast("double")
    d = d.select("id", "description", F.col("quality").alias("y"), (wc / (wc + 100.0)).alias("proba"))
    return d.withColumn("p", (F.col("proba") >= 0.5).cast("int"))


cte("bin_all", f"""select id, description, y, wc / (wc + 100.0) as proba, cast(wc / (wc + 100.0) >= 0.5 as int) as p, cast(wc as bigint) as len, marked
from (select id, description, quality as y, doc_id is not null as marked, cast(len({sql_words('description')}) as double) as wc
      from docs left join labels on doc_id = id)""", "docs")
cte("bin", "select * exclude (marked) from bin_all where marked", "bin_all")


# --- orders as records, part types as labels ----------------------------------------------------

def items(spark: SparkSession, sf: str) -> DataFrame:
    """(id, label, t, p, q) occurrences."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus", "l_returnflag", "l_quantity")
    pt = table(spark, sf, "part").select("p_partkey", "p_type")
    return li.join(pt, li.l_partkey == pt.p_partkey).select(
        F.col("l_orderkey").alias("id"), F.col("p_type").alias("label"),
        (F.col("l_linestatus") == "F").alias("t"), (F.col("l_returnflag") != "A").alias("p"),
        F.col("l_quantity").alias("q"))


def order_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))


def order_vocabulary(spark: SparkSession, sf: str) -> list[str]:
    return clean.load_vocabulary(table(spark, sf, "part").select(F.array("p_type").alias("labels")))


def order_labels(spark: SparkSession, sf: str) -> DataFrame:
    """(id, labels) of the orders that have items."""
    return items(spark, sf).groupBy("id").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def all_order_labels(spark: SparkSession, sf: str) -> DataFrame:
    """(id, labels) of all orders; without items the labels are empty."""
    every = order_ids(spark, sf).select("id", F.lit(None).cast("string").alias("label"))
    return items(spark, sf).select("id", "label").unionByName(every) \
        .groupBy("id").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def order_scored(spark: SparkSession, sf: str) -> DataFrame:
    """(id, y_true, y_pred) of all orders, those without items included; one shuffle."""
    none = F.lit(None).cast("string")
    rows = items(spark, sf).select(
        "id", F.when(F.col("t"), F.col("label")).alias("t"), F.when(F.col("p"), F.col("label")).alias("p"))
    every = order_ids(spark, sf).select("id", none.alias("t"), none.alias("p"))
    return evaluate.label_sets(rows.unionByName(every))


def order_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Long (id, label, p): share of the order's quantity."""
    sums = items(spark, sf).groupBy("id", "label").agg(F.sum("q").alias("s"))
    # A window over one order holds at most one row per label.
    total = F.sum("s").over(Window.partitionBy("id"))
    return sums.select("id", "label", (F.col("s") / total).alias("p"))


def order_proba(spark: SparkSession, sf: str) -> DataFrame:
    """(id, proba dense) of all orders."""
    from tagloom.operators import decide

    return decide.dense_scores(order_scores(spark, sf), order_vocabulary(spark, sf), order_ids(spark, sf))


cte("items", """select l_orderkey as id, p_type as label, l_linestatus = 'F' as t, l_returnflag <> 'A' as p, l_quantity as q
from lineitem join part on l_partkey = p_partkey""")
cte("voc", "select distinct p_type as label from part")
cte("ids", "select o_orderkey as id from orders")
cte("order_labels", "select distinct id, label from items", "items")
cte("truth", "select distinct id, label from items where t", "items")
cte("pred", "select distinct id, label from items where p", "items")
cte("grid", """select ids.id, voc.label, cast(truth.id is not null as int) as t, cast(pred.id is not null as int) as p
from ids cross join voc
left join truth on truth.id = ids.id and truth.label = voc.label
left join pred on pred.id = ids.id and pred.label = voc.label""", "ids", "voc", "truth", "pred")
cte("rec", """select id, sum(t * p) as tp, sum(t) as nt, sum(p) as np, sum(greatest(t, p)) as nu, count(*) as nl
from grid group by id""", "grid")
cte("conf", """select label, cast(sum((1 - t) * (1 - p)) as bigint) as tn, cast(sum((1 - t) * p) as bigint) as fp,
  cast(sum(t * (1 - p)) as bigint) as fn, cast(sum(t * p) as bigint) as tp
from grid group by label""", "grid")
cte("proba", """select ids.id, voc.label, coalesce(s.s / t.total, 0.0) as p
from ids cross join voc
left join (select id, label, sum(q) as s from items group by id, label) s on s.id = ids.id and s.label = voc.label
left join (select id, sum(q) as total from items group by id) t on t.id = ids.id""", "ids", "voc", "items")


def decided(df: DataFrame, vocabulary: list[str], hot: str = "pred") -> DataFrame:
    """(id, predicted labels as one string)."""
    from tagloom.functions.labels import decode_labels

    return df.select("id", F.array_join(decode_labels(F.col(hot), vocabulary), "|").alias("labels"))


# --- term weights per label ---------------------------------------------------------------------

def lang_model(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Naive Bayes of the language, and the label names."""
    d = lang_docs(spark, sf)
    names = clean.load_vocabulary(d)
    counts = explore.words_by_combination(d, tx.tokens(F.col("description")))
    return models.bayes_fit(counts, names), names


def lang_weights(spark: SparkSession, sf: str) -> DataFrame:
    """(label, term, weight): log-odds of a term within and outside a language."""
    long = models.bayes_weights(*lang_model(spark, sf))
    return long.select("label", "term", (F.col("log_pos") - F.col("log_neg")).alias("weight"))


cte("bayes", """select v.label, t.term,
  ln((coalesce(p.pos, 0) + 1.0) / (s.pos_sum + m.v)) as log_pos,
  ln((t.alls - coalesce(p.pos, 0) + 1.0) / (m.grand - s.pos_sum + m.v)) as log_neg
from (select term, sum(tf) as alls from tf group by term) t
cross join (select distinct label from lang_labels) v
cross join (select cast(count(distinct term) as double) as v, cast(sum(tf) as double) as grand from tf) m
join (select label, cast(sum(tf) as double) as pos_sum from tf join lang_labels using (id) group by label) s on s.label = v.label
left join (select label, term, sum(tf) as pos from tf join lang_labels using (id) group by label, term) p
  on p.label = v.label and p.term = t.term""", "tf", "lang_labels")
cte("lang_weights", "select label, term, log_pos - log_neg as weight from bayes", "bayes")

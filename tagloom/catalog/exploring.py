"""Exploration queries: label and text profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom import fixed
from tagloom.catalog.tables import (DIGITS, WS, cte, docs, items, order_labels, order_vocabulary, query,
                                    raw_records, rnd, sql_list, sql_tokens, sql_words)
from tagloom.functions import text as tx
from tagloom.operators import explore, keywords
from tagloom.plans import reports

STOP = sql_list(fixed.ENGLISH_STOP_WORDS)

cte("order_combo", "select id, string_agg(label, ', ' order by label) as combination, count(*) as k from order_labels group by id", "order_labels")
cte("pairs", """select a.label as label_a, b.label as label_b, count(*) as n from order_labels a join order_labels b
on a.id = b.id and a.label <> b.label group by a.label, b.label""", "order_labels")
cte("matrix", """select a.label as label_a, b.label as label_b, coalesce(p.n, 0) as n
from voc a cross join voc b left join pairs p on p.label_a = a.label and p.label_b = b.label""", "voc", "pairs")


@query("label_distribution", "select label, count(*) as n from order_labels group by label", ("order_labels",))
def label_distribution(spark, sf):
    return explore.label_distribution(order_labels(spark, sf))


@query("label_occurrences", "select label, count(*) as n from items group by label", ("items",))
def label_occurrences(spark, sf):
    """Every occurrence counted, without forming records first."""
    return items(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("label_share", f"select label, count(*) as n, round(count(*) / (select count(*) from order_labels), {DIGITS}) as share from order_labels group by label", ("order_labels",))
def label_share(spark, sf):
    return explore.label_share(order_labels(spark, sf)).withColumn("share", rnd("share"))


@query("label_combinations", """select combination, count(*) as n from order_combo where k > 1 group by combination
order by n desc, combination limit 20""", ("order_combo",))
def label_combinations(spark, sf):
    return explore.label_combinations(order_labels(spark, sf))


@query("label_pairs", "select label_a, label_b, n from pairs", ("pairs",))
def label_pairs(spark, sf):
    return explore.pair_counts(order_labels(spark, sf))


@query("cooccurrence", "select label_a, label_b, n from matrix", ("matrix",))
def cooccurrence(spark, sf):
    return explore.cooccurrence(order_labels(spark, sf), order_vocabulary(spark, sf))


@query("cooccurrence_normalized", f"""select label_a, label_b, round(coalesce(m.n / t.n, 0.0), {DIGITS}) as share
from matrix m left join (select label, count(*) as n from order_labels group by label) t on t.label = m.label_b""",
       ("matrix", "order_labels"))
def cooccurrence_normalized(spark, sf):
    found = explore.cooccurrence_normalized(order_labels(spark, sf), order_vocabulary(spark, sf))
    return found.withColumn("share", rnd("share"))


def conflicting(key: str, target: str) -> None:
    sql = f"""select p.key, p.value, p.n, d.number_different_values
from (select {key} as key, {target} as value, count(*) as n from raw where {key} is not null group by all) p
join (select key, count(*) as number_different_values from (select distinct {key} as key, {target} as value from raw) group by key) d
using (key) where number_different_values <> 1"""

    @query(f"conflicting_{key}_{target}", sql, ("raw",))
    def run(spark, sf):
        return explore.conflicting_duplicates(raw_records(spark, sf), key, target)


for _key, _target in [("movie_id", "genre"), ("movie_id", "description"), ("movie_name", "genre"),
                      ("movie_name", "description"), ("movie_name", "movie_id")]:
    conflicting(_key, _target)


def histogram_sql(length: str, bins: int, high: int) -> str:
    width = high // bins
    return f"""select cast(b as int) as bin, cast(b * {width} as int) as low, count(l.len) as n
from range({bins}) t(b) left join (select {length} as len from raw) l
  on l.len between 0 and {high} and least(l.len // {width}, {bins - 1}) = b
group by b"""


@query("length_histogram_words", histogram_sql(f"len({sql_words('description')})", 75, 150), ("raw",))
def length_histogram_words(spark, sf):
    return explore.length_histogram(raw_records(spark, sf), "word")


@query("length_histogram_chars", histogram_sql("length(description)", 500, 1000), ("raw",))
def length_histogram_chars(spark, sf):
    return explore.length_histogram(raw_records(spark, sf), "char")


@query("length_summary", f"""select round(avg(n), {DIGITS}) as mean, quantile_cont(cast(n as double), 0.25) as q1,
  quantile_cont(cast(n as double), 0.5) as median, quantile_cont(cast(n as double), 0.75) as q3, cast(max(n) as int) as longest
from (select length(text) as n from documents)""")
def length_summary(spark, sf):
    return explore.length_summary(docs(spark, sf)).withColumn("mean", rnd("mean"))


def bins_sql(title: str, length: str, bins: int, high: int) -> str:
    width = high // bins
    return f"""select '{title}', cast(b * {width} as varchar), 'n', cast(count(l.len) as double)
from range({bins}) t(b) left join (select {length} as len from docs) l
  on l.len between 0 and {high} and least(l.len // {width}, {bins - 1}) = b
group by b"""


@query("exploration_report", f"""
select 'label' as section, label as name, 'n' as metric, cast(count(*) as double) as value from doc_labels group by label
union all select 'label', label, 'share', round(count(*) / (select count(*) from doc_labels), {DIGITS}) from doc_labels group by label
union all select * from (select 'combination', c, 'n', cast(count(*) as double) as n from (
  select string_agg(label, ', ' order by label) as c from doc_labels group by id having count(*) > 1) group by c order by n desc, c limit 20)
union all {bins_sql('words', f"len({sql_words('description')})", 75, 150)}
union all {bins_sql('chars', 'length(description)', 500, 1000)}
union all select 'length', null, m, v from (
  unpivot (select round(avg(n), {DIGITS}) as mean, quantile_cont(cast(n as double), 0.25) as q1,
    quantile_cont(cast(n as double), 0.5) as median, quantile_cont(cast(n as double), 0.75) as q3, cast(max(n) as double) as longest
    from (select length(description) as n from docs))
  on mean, q1, median, q3, longest into name m value v)""", ("docs", "doc_labels"))
def exploration_report(spark, sf):
    return reports.exploration_report(docs(spark, sf)).withColumn("value", rnd("value"))


@query("text_lengths", f"""select id, cast(len({sql_words('description')}) as int) as words,
  cast(len(string_split(description, ' ')) as int) as parts, cast(length(description) as int) as chars from docs""", ("docs",))
def text_lengths(spark, sf):
    t = F.col("description")
    return docs(spark, sf).select("id", tx.word_count(t).alias("words"), tx.space_count(t).alias("parts"),
                                  tx.char_count(t).alias("chars"))


@query("corpus_top_words", f"""select word, count(*) as n from (select unnest({sql_tokens('description')}) as word from docs)
where word not in ({STOP}) group by word order by n desc, word limit 20""", ("docs",))
def corpus_top_words(spark, sf):
    d = docs(spark, sf).select(tx.tokens(F.col("description")).alias("tokens"))
    return explore.corpus_top_words(d, "tokens")


cte("label_words", f"""select l.label, w.word, count(*) as n from doc_labels l join (
    select id, unnest({sql_words(f"lower(regexp_replace(description, '[^a-zA-Z0-9{WS}]', '', 'g'))")}) as word from docs) w using (id)
  where w.word not in ({STOP}) group by l.label, w.word""", "docs", "doc_labels")
cte("top_words", """select label, cast(rank as int) as rank, word, n from (
  select *, row_number() over (partition by label order by n desc, word) as rank from label_words) where rank <= 20""", "label_words")


@query("top_words_per_label", "select * from top_words", ("top_words",))
def top_words_per_label(spark, sf):
    return explore.top_words_per_label(docs(spark, sf))


@query("write_top_words", "select label, string_agg(word, '|' order by rank) as words from top_words group by label", ("top_words",))
def write_top_words(spark, sf):
    """Top words per label as JSON, read back."""
    from tagloom.session import scratch_path
    from tagloom.sources import jsonfiles

    path = scratch_path(spark, "topwords")
    jsonfiles.write_top_words(explore.top_words_per_label(docs(spark, sf)), path)
    return spark.read.schema("label string, words array<string>").json(path) \
        .withColumn("words", F.array_join("words", "|"))


@query("drop_shared_keywords", """select label, rank, word, n from top_words
where word not in (select word from top_words group by word having count(*) >= 2)""", ("top_words",))
def drop_shared_keywords(spark, sf):
    return explore.drop_shared_keywords(explore.top_words_per_label(docs(spark, sf)))


@query("keyword_index", """select d.id, t.label, round(count(*) / any_value(s.n), 9) as fraction from docs d join top_words t on contains(lower(d.description), t.word)
join (select label, cast(count(*) as double) as n from top_words group by label) s on s.label = t.label group by d.id, t.label""", ("docs", "top_words"))
def keyword_index(spark, sf):
    """Share of the top words of every label that a text holds, found by an index of their q-grams."""
    d = docs(spark, sf)
    lists = explore.top_words_per_label(d).select("label", F.col("word").alias("keyword"))
    return keywords.keyword_fractions(d, lists).withColumn("fraction", F.round("fraction", 9))


@query("distinct_values", """select movie_id, string_agg(distinct genre, ' / ' order by genre) as genres from raw group by movie_id""", ("raw",))
def distinct_values(spark, sf):
    """Distinct label strings per id; their number is bounded by the label combinations."""
    return raw_records(spark, sf).groupBy("movie_id").agg(
        F.array_join(F.array_sort(F.collect_set("genre")), " / ").alias("genres"))

"""Feature, similarity, split, balancing and model queries."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tagloom import fixed
from tagloom.catalog.tables import (DIGITS, cte, doc_scored, docs, lang_docs, lang_model, lang_weights, query, rnd, sql_list,
                                    sql_tokens, sql_words, table, all_order_labels)
from tagloom.functions import text as tx
from tagloom.operators import (balance, clean, explore, features, hashed, models, neighbours, quota, ranking, similarity, sketch,
                               split, wordblocks)
from tagloom.plans import experiments
from tagloom.session import scratch_path, written
from tagloom.sources import vectors as vector_files


def r(expr: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits})"


STOP = sql_list(fixed.ENGLISH_STOP_WORDS)

# --- text features --------------------------------------------------------------------------

@query("tokenize", f"select id, array_to_string({sql_tokens('description')}, ' ') as tokens from docs", ("docs",))
def tokenize(spark, sf):
    return features.tokenize(docs(spark, sf)).select("id", F.array_join("tokens", " ").alias("tokens"))


@query("remove_stopwords", f"""select id, array_to_string(list_filter({sql_tokens('description')}, lambda t: t not in ({STOP})), ' ') as tokens
from docs""", ("docs",))
def remove_stopwords(spark, sf):
    d = features.remove_stopwords(features.tokenize(docs(spark, sf)))
    return d.select("id", F.array_join("tokens", " ").alias("tokens"))


@query("count_vectorize", "select id, term, tf from tf", ("tf",))
def count_vectorize(spark, sf):
    return features.count_vectorize(docs(spark, sf))


@query("count_vectorize_stop_words", f"select id, term, tf from tf where term not in ({STOP})", ("tf",))
def count_vectorize_stop_words(spark, sf):
    return features.count_vectorize(docs(spark, sf), stop_words="english")


@query("feature_vocabulary", "select term, row_number() over (order by term) - 1 as index from (select distinct term from tf)", ("tf",))
def feature_vocabulary(spark, sf):
    return features.vocabulary(features.count_vectorize(docs(spark, sf)))


@query("ngrams", f"""select id, term, count(*) as tf from (
  select id, t[i] as term from (select id, t, unnest(range(1, len(t) + 1)) as i from (select id, {sql_tokens('description')} as t from docs))
  union all select id, concat(t[i], ' ', t[i + 1]) from (select id, t, unnest(range(1, len(t))) as i from (select id, {sql_tokens('description')} as t from docs))
) group by id, term""", ("docs",))
def ngrams(spark, sf):
    return features.count_vectorize(docs(spark, sf), ngram=(1, 2))


cte("idf", "select term, ln((1.0 + n) / (1.0 + count(*))) + 1.0 as idf from tf cross join ndocs group by term, n", "tf", "ndocs")
cte("tfidf", """select id, term, w / sqrt(sum(w * w) over (partition by id)) as weight
from (select id, term, tf * idf as w from tf join idf using (term))""", "tf", "idf")
cte("tfidf_sub", """select id, term, w / sqrt(sum(w * w) over (partition by id)) as weight
from (select id, term, (1.0 + ln(tf)) * idf as w from tf join idf using (term))""", "tf", "idf")


def weights(df, column="weight"):
    return df.withColumn(column, rnd(column))


@query("document_frequency", f"select term, count(*) as df, {r('any_value(idf)')} as idf from tf join idf using (term) group by term", ("tf", "idf"))
def document_frequency(spark, sf):
    d = docs(spark, sf)
    tf = features.count_vectorize(d)
    n = d.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    return features.document_frequency(tf).withColumn("idf", rnd(features.idf(F.col("df"), n)))


@query("tfidf", f"select id, term, {r('weight')} as weight from tfidf", ("tfidf",))
def tfidf(spark, sf):
    return weights(features.tfidf(docs(spark, sf)))


@query("tfidf_sublinear", f"select id, term, {r('weight')} as weight from tfidf_sub", ("tfidf_sub",))
def tfidf_sublinear(spark, sf):
    return weights(features.tfidf(docs(spark, sf), sublinear=True))


@query("max_abs_scale", f"select id, term, {r('weight / max(weight) over (partition by term)')} as weight from tfidf", ("tfidf",))
def max_abs_scale(spark, sf):
    return weights(features.max_abs_tfidf(docs(spark, sf)))


BROADCAST_WORDS = 1 << 20  # words, each with one number, that every task may hold


def word_vectors(spark, sf):
    """The vectors, named after the distinct words of all texts: the most frequent word has the first one; equal counts by word."""
    e = ranking.dense_position(table(spark, sf, "embeddings").select("vec_id", "embedding"), ["vec_id"], "place")
    words = docs(spark, sf).select(F.explode(tx.words(F.col("description"))).alias("word")).groupBy("word").agg((-F.count(F.lit(1))).alias("minus"))
    named = ranking.dense_position(written(words, "words"), ["minus", "word"], "place")
    return written(named.join(e, "place").select("word", F.col("embedding").alias("vec")), "named-vectors")


cte("vectors", f"""select word, embedding as vec from (
  select word, row_number() over (order by count(*) desc, word) - 1 as place from (select unnest({sql_words('description')}) as word from docs) group by word)
join (select embedding, row_number() over (order by vec_id) - 1 as place from embeddings) using (place)""", "docs")
cte("doc_words", f"select id, word, count(*) as n from (select id, unnest({sql_words('description')}) as word from docs) group by id, word", "docs")


@query("embed_lookup", f"select id, word, n, {r('cast(vec[1] as double)')} as first_value from doc_words join vectors using (word)", ("doc_words", "vectors"))
def embed_lookup(spark, sf):
    """The words of each text that have a vector."""
    first = word_vectors(spark, sf).select("word", rnd(F.get("vec", 0).cast("double")).alias("first_value"))
    first = written(first, "first-values")
    if first.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS:
        first = F.broadcast(first)  # the counted words are not shuffled then
    return features.word_counts(docs(spark, sf)).join(first, "word").select("id", "word", "n", "first_value")


@query("mean_embedding", f"""select d.id, cast(g.i - 1 as int) as dim, {r('coalesce(m.v, 0.0)')} as value
from docs d cross join range(1, 65) g(i)
left join (select id, i, sum(n * cast(vec[i] as double)) / sum(n) as v
  from doc_words join vectors using (word) cross join range(1, 65) t(i) group by id, i) m on m.id = d.id and m.i = g.i""",
       ("docs", "doc_words", "vectors"))
def mean_embedding(spark, sf):
    e = features.mean_embedding(docs(spark, sf), word_vectors(spark, sf), 64)
    return weights(e.select("id", F.posexplode("embedding").alias("dim", "value")), "value")


@query("save_load_vectors", f"select word, cast(len(vec) as int) as size, {r('cast(vec[64] as double)')} as last_value from vectors", ("vectors",))
def save_load_vectors(spark, sf):
    path = scratch_path(spark, "wordvectors")
    vector_files.save_vectors(word_vectors(spark, sf), path)
    back = vector_files.load_vectors(spark, path)
    return back.select("word", F.size("vec").alias("size"), rnd(F.get("vec", 63).cast("double")).alias("last_value"))


@query("train_word_vectors", f"""select word, cast(100 as int) as size from (
  select unnest({sql_words('description')}) as word from docs) group by word having count(*) >= 5""", ("docs",))
def train_word_vectors(spark, sf):
    return features.train_word_vectors(docs(spark, sf)).select("word", F.size("vec").alias("size"))


@query("block_word_vectors", "select lang, true as nearer from docs group by lang", ("docs",))
def block_word_vectors(spark, sf):
    """Whether the frequent words of each language, which occur together, lie nearer to each other than to those of any other."""
    d = docs(spark, sf)
    vecs = wordblocks.train_word_blocks(d, vector_size=48, epochs=3)
    words = d.select("lang", F.explode(tx.words(F.col("description"))).alias("word")).groupBy("word") \
        .agg(F.min("lang").alias("lang"), F.max("lang").alias("other"), F.count(F.lit(1)).alias("n")).where("lang = other")
    chosen = ranking.top_per_group(words, ["lang"], [F.desc("n"), F.asc("word")], 50).join(vecs, "word")
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    unit = array_to_vector(F.transform("vec", lambda x: x / length))
    means = chosen.groupBy("lang").agg(vector_to_array(Summarizer.mean(unit)).alias("m"))
    every = means.agg(F.collect_list(F.struct("lang", "m")).alias("all"))  # a row per language
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return every.select(F.inline(F.transform("all", lambda a: F.struct(a["lang"].alias("lang"), F.forall(
        "all", lambda b: (a["lang"] == b["lang"]) | (dot(a["m"], a["m"]) > dot(a["m"], b["m"]))).alias("nearer")))))


@query("pca_axes", """select cast(c.c as int) as component, cast(g.i - 1 as int) as dim, 0.0::double as residual from range(1, 3) c(c) cross join range(1, 65) g(i)""")
def pca_axes(spark, sf):
    """Covariance times axis minus variance times axis, in every dimension, of the axes that pca_project projects on; they
    vanish for the eigenvectors. The axes are read off the projections: covariance of a dimension with a projection, over its variance."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    p = features.pca_project(e, 2).join(e, "id")
    cells = p.select("id", "projection", F.posexplode("embedding").alias("dim", "x"))
    axes = cells.select("dim", F.inline(F.transform("projection", lambda y, i: F.struct((i + 1).alias("component"), y.alias("y")))), "x") \
        .groupBy("component", "dim").agg((F.covar_pop("x", "y") / F.var_pop("y")).alias("a"), F.var_pop("y").alias("v"))
    axes = written(axes, "axes")
    means = cells.groupBy("dim").agg(F.avg("x").alias("m"))
    centred = written(cells.select("id", "dim", "x").join(means, "dim").select("id", "dim", (F.col("x") - F.col("m")).alias("c")), "centred")
    y = centred.join(axes.select("component", "dim", "a"), "dim").groupBy("id", "component").agg(F.sum(F.col("c") * F.col("a")).alias("y"))
    cov = centred.join(y, "id").groupBy("component", "dim").agg(F.avg(F.col("c") * F.col("y")).alias("cov"))
    return cov.join(axes, ["component", "dim"]).select("component", "dim", (F.round(F.col("cov") - F.col("v") * F.col("a"), 8) + 0.0).alias("residual"))


@query("pca_sparse", """select cast(a.a as int) as component, cast(b.a as int) as other, cast(a.a = b.a as int)::double as dot, true as ordered
from range(1, 4) a(a) cross join range(1, 4) b(a)""")
def pca_sparse(spark, sf):
    """Products of the three leading axes of the TF-IDF rows of words and word pairs, and whether their variances fall."""
    d = docs(spark, sf)
    cells = features.tfidf(d, ngram=(1, 2)).select("id", F.col("term").alias("column"), F.col("weight").alias("value"))
    found = sketch.fit(cells, d, 3)
    axis = found.axes.select("axis", F.posexplode("axis").alias("component", "a")).select("component", "a", F.posexplode("axis").alias("other", "b"))
    falls = F.lit([bool(x) for x in (found.variances[:1].tolist() and [True]) + [b <= a for a, b in zip(found.variances, found.variances[1:])]])
    return axis.groupBy("component", "other").agg(F.sum(F.col("a") * F.col("b")).alias("dot")).select(
        (F.col("component") + 1).alias("component"), (F.col("other") + 1).alias("other"), (F.round("dot", 6) + 0.0).alias("dot"),
        F.get(falls, F.col("component")).alias("ordered"))


@query("pca_project")
def pca_project(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return features.pca_project(e).select("id", rnd(F.get("projection", 0), 6).alias("x"), rnd(F.get("projection", 1), 6).alias("y"))


# --- comparing labels -----------------------------------------------------------------------

cte("superdoc_tf", "select label, term, sum(tf) as tf from tf join doc_labels using (id) group by label, term", "tf", "doc_labels")
cte("superdoc", """select label, term, w / sqrt(sum(w * w) over (partition by label)) as weight from (
  select label, term, (1.0 + ln(tf)) * (ln((1.0 + n) / (1.0 + df)) + 1.0) as w
  from superdoc_tf join (select term, count(*) as df from superdoc_tf group by term) using (term)
  cross join (select cast(count(distinct label) as double) as n from superdoc_tf))""", "superdoc_tf")
cte("avg_tfidf", """select label, term, sum(weight) / n as weight from tfidf_sub join doc_labels using (id)
join (select label, count(*) as n from doc_labels group by label) using (label) group by label, term, n""", "tfidf_sub", "doc_labels")


def superdoc(spark, sf):
    counts = explore.words_by_combination(docs(spark, sf), tx.tokens(F.col("description")))
    return similarity.label_superdoc_tfidf(counts)


def average(spark, sf):
    return similarity.label_avg_tfidf(docs(spark, sf))


@query("label_superdoc_tfidf", f"select label, term, {r('weight')} as weight from superdoc", ("superdoc",))
def label_superdoc_tfidf(spark, sf):
    return weights(superdoc(spark, sf))


@query("label_avg_tfidf", f"select label, term, {r('weight')} as weight from avg_tfidf", ("avg_tfidf",))
def label_avg_tfidf(spark, sf):
    return weights(average(spark, sf))


COS = "sum(a.weight * coalesce(b.weight, 0)) / nullif(sqrt(sum(a.weight * a.weight)) * sqrt(sum(coalesce(b.weight, 0) * coalesce(b.weight, 0))), 0)"


def topk_sql(source: str) -> str:
    return f"""select a.label, {r(f'coalesce({COS}, 0.0)')} as cosine
from (select *, row_number() over (partition by label order by weight desc, term) as rn from {source}) a
left join {source} b on b.term = a.term and b.label = 'en' where a.rn <= 100 and a.label <> 'en' group by a.label"""


@query("tfidf_topk_similarity_superdoc", topk_sql("superdoc"), ("superdoc",))
def tfidf_topk_similarity_superdoc(spark, sf):
    return weights(similarity.tfidf_topk_similarity(written(superdoc(spark, sf), "weights"), "en"), "cosine")


@query("tfidf_topk_similarity_avg", topk_sql("avg_tfidf"), ("avg_tfidf",))
def tfidf_topk_similarity_avg(spark, sf):
    return weights(similarity.tfidf_topk_similarity(written(average(spark, sf), "weights"), "en"), "cosine")


@query("label_vector_similarity", f"""select a.label, {r(COS, 7)} as cosine, {r('sqrt(sum((a.weight - b.weight) * (a.weight - b.weight)))', 6)} as euclidean
from lang_weights a join lang_weights b on b.term = a.term and b.label = 'en' where a.label <> 'en' group by a.label""", ("lang_weights",))
def label_vector_similarity(spark, sf):
    s = similarity.label_vector_similarity(lang_weights(spark, sf), "en")
    return s.select("label", rnd("cosine", 7).alias("cosine"), rnd("euclidean", 6).alias("euclidean"))


# Model weights tie in blocks (terms with equal counts) and the last bits of a logarithm differ
# between engines, so both sides rank the weights rounded to 9 digits.
cte("ranked_weights", "select label, term, round(weight, 9) as weight from lang_weights", "lang_weights")


def ranked_weights(spark, sf):
    return weights(lang_weights(spark, sf))


cte("picked", """select label, term from (
  select *, row_number() over (partition by label order by weight desc, term) as hi, row_number() over (partition by label order by weight, term) as lo
  from ranked_weights) where hi <= 100 or lo <= 100""", "ranked_weights")
cte("scaled", """select label, term, case when weight > 0 then coalesce((weight - pmin) / nullif(pmax - pmin, 0), 0.0)
  when weight < 0 then -coalesce((weight - nmax) / nullif(nmin - nmax, 0), 0.0) else 0.0 end as weight
from ranked_weights join (select label, min(weight) filter (where weight > 0) as pmin, max(weight) filter (where weight > 0) as pmax,
  min(weight) filter (where weight < 0) as nmin, max(weight) filter (where weight < 0) as nmax from ranked_weights group by label) using (label)""", "ranked_weights")


@query("extreme_feature_similarity", f"""select a.label, {r(COS, 6)} as cosine, {r('sqrt(sum((a.weight - b.weight) * (a.weight - b.weight)))', 6)} as euclidean
from scaled a join picked using (label, term) join scaled b on b.term = a.term and b.label = 'en' where a.label <> 'en' group by a.label""", ("picked", "scaled"))
def extreme_feature_similarity(spark, sf):
    s = similarity.extreme_feature_similarity(ranked_weights(spark, sf), "en")
    return s.select("label", rnd("cosine", 6).alias("cosine"), rnd("euclidean", 6).alias("euclidean"))


cte("top_weights", "select label, rn as rank, term, weight from (select *, cast(row_number() over (partition by label order by weight desc, term) as int) as rn from ranked_weights)", "ranked_weights")


@query("top_features", "select label, rank, term, weight from top_weights where rank <= 10", ("top_weights",))
def top_features(spark, sf):
    return similarity.top_features(ranked_weights(spark, sf)).select("label", "rank", "term", "weight")


@query("feature_ranking", "select label, rank, term, weight, (select max(weight) from ranked_weights) as global_max from top_weights where rank <= 10", ("top_weights", "ranked_weights"))
def feature_ranking(spark, sf):
    return similarity.feature_ranking(ranked_weights(spark, sf))


@query("shared_top_features", f"""select a.label, {r('count(b.term) / 500.0')} as share
from top_weights a left join top_weights b on b.term = a.term and b.label = 'en' and b.rank <= 500
where a.rank <= 500 and a.label <> 'en' group by a.label""", ("top_weights",))
def shared_top_features(spark, sf):
    return weights(similarity.shared_top_features(ranked_weights(spark, sf), "en"), "share")


cte("predicted", "select id, label from doc_pred where label in (select label from lang_labels)", "doc_pred", "lang_labels")


cte("doc_words_at", f"""select id, unnest(range(len(w))) as position, unnest(w) as word
from (select id, {sql_words('description')} as w from docs)""", "docs")
cte("combo", """select d.id, coalesce(string_agg(p.label, '|' order by p.label), '') as combo
from docs d left join predicted p using (id) group by d.id""", "docs", "predicted")
cte("combo_sums", """select combo, term, sum(weight) as w from (select distinct combo, unnest(string_split(combo, '|')) as label from combo)
join lang_weights using (label) group by combo, term""", "combo", "lang_weights")


@query("explain_record", f"""select w.id, cast(w.position as int) as position, w.word,
  {r('case when s.w > 0 then coalesce(s.w / nullif(m.m, 0), 0.0) else 0.0 end', 7)} as score
from doc_words_at w join combo c using (id) left join combo_sums s on s.combo = c.combo and s.term = w.word
left join (select combo, max(w) as m from combo_sums group by combo) m on m.combo = c.combo""", ("doc_words_at", "combo", "combo_sums"))
def explain_record(spark, sf):
    """Every word of every text, scored by the weights of the predicted language."""
    langs = clean.load_vocabulary(lang_docs(spark, sf))
    d = doc_scored(spark, sf).withColumn("y_pred", F.filter("y_pred", lambda v: v.isin(langs)))
    out = similarity.explain_records(d, lang_weights(spark, sf))
    return out.withColumn("score", rnd("score", 7))


@query("word_score_scale", f"""select label, term, {r('greatest(case when weight > 0 then weight / m else 0.0 end, 0.1)')} as shade
from ranked_weights join (select label, max(weight) as m from ranked_weights group by label) using (label)""", ("ranked_weights",))
def word_score_scale(spark, sf):
    from tagloom.functions.labels import shade, word_score

    w = ranked_weights(spark, sf)
    top = w.groupBy("label").agg(F.max("weight").alias("m"))
    return w.join(top, "label").select("label", "term", rnd(shade(word_score(F.col("weight"), F.col("m")))).alias("shade"))


# --- splits -----------------------------------------------------------------------------------

cte("strata", """select id, stratum, row_number() over (partition by stratum order by md5(concat(cast(id as varchar), '42069'))) as rn,
  cast(concat('0x', substr(md5(stratum), 1, 6)) as bigint) as o1, cast(concat('0x', substr(md5(stratum), 7, 6)) as bigint) as o2
from (select id, coalesce(string_agg(label, '|' order by label), '') as stratum from ids left join order_labels using (id) group by id)""", "ids", "order_labels")


def off(o: str, ratio: float) -> str:
    return f"(cast({o} as double) / 16777216.0 / {ratio})"


def taken(rank: str, o: str, ratio: float) -> str:
    return f"(floor(({rank} + {off(o, ratio)}) * cast({ratio} as double)) - floor({off(o, ratio)} * cast({ratio} as double)))"


def picked(rank: str, o: str, ratio: float) -> str:
    return f"({taken(rank, o, ratio)} > {taken(f'({rank} - 1)', o, ratio)})"


T1 = picked("rn", "o1", 0.1)


@query("stratified_split", f"""select id, case when {T1} then 'test' else 'train' end as split,
  not {T1} and {picked(f"(rn - {taken('rn', 'o1', 0.1)})", 'o2', 0.1)} as dev from strata""", ("strata",))
def stratified_split(spark, sf):
    return split.stratified_split(all_order_labels(spark, sf)).select("id", "split", "dev")


@query("train_val_test", f"""select id, case when not {picked('rn', 'o1', 0.2)} then 'train'
  when {picked(taken('rn', 'o1', 0.2), 'o2', 0.5)} then 'test' else 'val' end as split from strata""", ("strata",))
def train_val_test(spark, sf):
    return split.train_val_test(all_order_labels(spark, sf)).select("id", "split")


@query("train_val_split", f"select id, case when {picked('rn', 'o1', 0.2)} then 'val' else 'train' end as split from strata", ("strata",))
def train_val_split(spark, sf):
    return split.train_val_test(all_order_labels(spark, sf), test_share=0).select("id", "split")


@query("stratified_kfold", "select id, cast((rn - 1 + o1) % 5 as int) as fold from strata", ("strata",))
def stratified_kfold(spark, sf):
    return split.stratified_kfold(all_order_labels(spark, sf)).select("id", "fold")


def brand_sets(spark, sf):
    """(id, labels): every order with the brands of its parts; nearly all sets differ."""
    items = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    held = items.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set("p_brand")).alias("labels"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")).join(held, "id", "left") \
        .withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


cte("brands", "select distinct l_orderkey as id, p_brand as label from lineitem join part on l_partkey = p_partkey")


@query("quota_split", """select label as part, count(*) as n, true as within from brands group by label
union all select concat(a.label, '|', b.label), count(*), true from brands a join brands b on a.id = b.id and a.label < b.label
group by a.label, b.label having count(*) * 0.1 >= 1
union all select '', count(*), true from orders""", ("brands",))
def quota_split(spark, sf):
    """Records of every brand and of every frequent pair of brands, and whether their share in the test part is less than one
    record off."""
    parts = quota.quota_split(brand_sets(spark, sf), 0.1)
    rows = parts.select(F.explode(F.concat(F.array(F.lit("")), quota.parts_of("labels"))).alias("part"), (F.col("split") == "test").cast("int").alias("t"))
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    return counts.where(~F.contains("part", F.lit("|")) | (F.col("n") * 0.1 >= 1)) \
        .select("part", "n", (F.abs(F.col("t") - 0.1 * F.col("n")) < 1).alias("within"))


# --- class weights and balancing ----------------------------------------------------------------

cte("class_sizes", "select label, count(*) as pos, n - count(*) as neg, n from doc_labels cross join (select count(*) as n from docs) group by label, n", "doc_labels", "docs")


def doc_names(spark, sf):
    return clean.load_vocabulary(docs(spark, sf))


@query("class_weights", f"select label, {r('n / (2.0 * pos)')} as weight_pos, {r('n / (2.0 * neg)')} as weight_neg from class_sizes", ("class_sizes",))
def class_weights(spark, sf):
    w = balance.class_weights(docs(spark, sf), doc_names(spark, sf))
    return w.select("label", rnd("weight_pos").alias("weight_pos"), rnd("weight_neg").alias("weight_neg"))


@query("log_class_weights", f"select label, {r('w / avg(w) over ()')} as weight from (select label, ln(n / (pos + 1.0)) as w from class_sizes)", ("class_sizes",))
def log_class_weights(spark, sf):
    return weights(balance.log_class_weights(docs(spark, sf), doc_names(spark, sf)))


@query("smote_plan", """select label, pos, neg, pos > (0.25 / 1.25) * n as skip,
  case when pos > (0.25 / 1.25) * n then 0 else greatest(cast(floor(0.25 * neg) as bigint) - pos, 0) end as synthesize from class_sizes""", ("class_sizes",))
def smote_plan(spark, sf):
    return balance.smote_plan(docs(spark, sf), doc_names(spark, sf), 0.25)


def embedded(spark, sf, label: int):
    """(id, features dense, y): one embedding class against the rest."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"),
        (F.col("label") == label).cast("int").alias("y"))


DISTANCE = "sqrt(list_sum(list_transform(range(1, 65), lambda i: (cast(a.embedding[i] as double) - cast(b.embedding[i] as double)) * (cast(a.embedding[i] as double) - cast(b.embedding[i] as double)))))"
DRAW = "cast(concat('0x', substr(md5(concat_ws('|', id, copy, '{tag}')), 1, 8)) as bigint) / 4294967296.0"
SEED = fixed.SMOTE_SEED
cte("minority", f"""select vec_id as id, embedding, row_number() over (order by md5(concat_ws('|', vec_id, '{SEED}')), vec_id) as place,
  count(*) over () as n, (select greatest(cast(floor(0.5 * sum(cast(label <> 1 as int))) as bigint) - sum(cast(label = 1 as int)), 0) from embeddings) as made
from embeddings where label = 1""")
cte("minority_near", f"""select a.id, b.id as other, row_number() over (partition by a.id order by {DISTANCE}, b.id) as rank
from minority a join minority b on a.id <> b.id""", "minority")
cte("synthetic", f"""select id, copy, floor({DRAW.format(tag=f'n{SEED}')} * 5) + 1 as rank, {DRAW.format(tag=f'u{SEED}')} as u
from (select id, unnest(range(1, cast(made // n + cast(place <= made % n as bigint) + 1 as bigint))) as copy from minority)""", "minority")


@query("smote", f"""select vec_id as id, cast(0 as bigint) as copy, cast(label = 1 as int) as y, cast(g.i - 1 as int) as dim, {r('cast(embedding[g.i] as double)', 7)} as value
from embeddings cross join range(1, 65) g(i)
union all
select s.id, s.copy, 1, cast(g.i - 1 as int), {r('cast(a.embedding[g.i] as double) + u * (cast(b.embedding[g.i] as double) - cast(a.embedding[g.i] as double))', 7)}
from synthetic s join minority_near m on m.id = s.id and m.rank = s.rank join minority a on a.id = s.id join minority b on b.id = m.other
cross join range(1, 65) g(i)""", ("minority", "minority_near", "synthetic"))
def smote(spark, sf):
    """Every component of all vectors after balancing one embedding class to half of the rest."""
    rows = embedded(spark, sf, 1)
    plan = rows.select(F.when(F.col("y") == 1, F.array(F.lit("1"))).otherwise(F.array().cast("array<string>")).alias("labels"))
    line = balance.smote_plan(plan, ["1"], 0.5).first()
    out = balance.smote(rows, line["synthesize"])
    return out.select("id", "copy", "y", F.posexplode("features").alias("dim", "value")).withColumn("value", rnd("value", 7))


# --- neighbours ---------------------------------------------------------------------------------

def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


cte("near", f"""select * from (select *, row_number() over (partition by id order by distance, neighbour_id) as rn from (
  select a.vec_id as id, b.vec_id as neighbour_id, {DISTANCE} as distance from embeddings a join embeddings b on a.vec_id <> b.vec_id)) where rn <= 5""")


@query("nearest_neighbours", f"select id, cast(rn as int) as rank, neighbour_id, {r('distance', 7)} as distance from near", ("near",))
def nearest_neighbours(spark, sf):
    v = vectors(spark, sf)
    return neighbours.nearest(v, v, 5, exclude_self=True).withColumn("distance", rnd("distance", 7))


@query("hashed_neighbours", f"""select id, cast(5 as bigint) as found, cast(0 as bigint) as wrong, true as recall
from (select vec_id as id from embeddings)""")
def hashed_neighbours(spark, sf):
    """For every embedding the number of neighbours found by hash tables, how many of their distances are wrong, and whether
    nine tenths of all nearest ones are among them."""
    v = vectors(spark, sf)
    got = written(hashed.nearest_hashed(v, v, 5, exclude_self=True), "hashed")
    truth = neighbours.nearest(v, v, 5, exclude_self=True).select("id", "neighbour_id", F.lit(1).alias("true"))
    other = v.select(F.col("id").alias("neighbour_id"), F.col("vector").alias("other"))
    squares = F.aggregate(F.zip_with("vector", "other", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    rows = got.join(v, "id").join(other, "neighbour_id").join(truth, ["id", "neighbour_id"], "left")
    one = rows.groupBy("id").agg(F.count(F.lit(1)).alias("found"),
                                 F.sum((F.abs(F.sqrt(squares) - F.col("distance")) > 1e-9).cast("int")).alias("wrong"), F.count("true").alias("hits"))
    one = written(one, "hits")
    recall = one.agg((F.sum("hits") >= 0.9 * F.sum("found")).alias("r")).scalar()
    return one.select("id", "found", "wrong", recall.alias("recall"))


cte("marked", "select vec_id, embedding, quality, toxic from embeddings join labels on doc_id = vec_id")


@query("knn", f"""select id, label, {r('count(*) / 5.0')} as p from (
  select a.vec_id as id, b.vec_id as other, b.quality, b.toxic, row_number() over (partition by a.vec_id order by {DISTANCE}, b.vec_id) as rn
  from embeddings a cross join marked b)
join (values ('quality'), ('toxic')) v(label) on (label = 'quality' and quality = 1) or (label = 'toxic' and toxic = 1)
where rn <= 5 group by id, label""", ("marked",))
def knn(spark, sf):
    """Label shares among the five nearest marked embeddings, for every embedding."""
    p = neighbours.knn_proba(marked_vectors(spark, sf), vectors(spark, sf), 5)
    return p.withColumn("p", rnd("p"))


def marked_vectors(spark, sf):
    """(id, vector, labels): embeddings whose document is marked; labels may be empty."""
    marks = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.array_compact(F.array(
        F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic"))).alias("labels"))
    return vectors(spark, sf).join(marks, "id")


# --- models -------------------------------------------------------------------------------------

MARKS = ["quality", "toxic"]


def marked_rows(spark, sf):
    return marked_vectors(spark, sf).select("id", array_to_vector("vector").alias("features"), "labels")


def fitted(name: str, sql: str | None = None, needs: tuple[str, ...] = (), **options) -> None:
    @query(f"fit_{name}", sql, needs)
    def run(spark, sf):
        """One model per mark on the embeddings; probabilities for all marked records."""
        rows = marked_rows(spark, sf)
        model = models.fit_multilabel(rows, MARKS, name, n_features=64, **options)
        scored = model.predict_proba(rows)
        return scored.select("id", *[rnd(F.get("proba", i), 6).alias(v) for i, v in enumerate(MARKS)])


fitted("lreg", class_weight="balanced")
fitted("svm")
# A tree of full depth gives back the marks it was fitted on.
fitted("dt", "select vec_id as id, cast(quality as double) as quality, cast(toxic as double) as toxic from marked", ("marked",))
fitted("rf")
fitted("mlp")


U = "(cast(concat('0x', substr(md5(concat_ws('|', vec_id, bag, '{seed}')), 1, 8)) as bigint) / 4294967296.0)"


@query("bootstrap_copies", f"""select vec_id as id, cast(bag as int) as bag, cast(len(list_filter({models.POISSON_STEPS}, lambda s: u >= s)) as int) as copies
from (select vec_id, bag, {U.format(seed=fixed.SEED)} as u from marked cross join range({models.BAGS}) b(bag)) where u >= {models.POISSON_STEPS[0]}""", ("marked",))
def bootstrap_copies(spark, sf):
    """How often each marked record is drawn into each bag of the bagged models; records left out have no row."""
    rows = marked_rows(spark, sf).select("id", F.lit(1).alias("w"))
    bags = [models.resampled(rows, bag, fixed.SEED).select("id", F.lit(bag).alias("bag"), F.col("w").alias("copies"))
            for bag in range(models.BAGS)]
    return reduce(lambda a, b: a.unionByName(b), bags)


@query("lreg_optimum", """select label, cast(g.i - 1 as int) as dim, 0.0::double as slope
from (values ('quality'), ('toxic')) v(label) cross join range(1, 66) g(i)""")
def lreg_optimum(spark, sf):
    """Slope of the objective of the logistic models at the fitted coefficients, per record; the last
    dimension is the intercept. It vanishes at the optimum."""
    rows = marked_rows(spark, sf)
    model = models.fit_multilabel(rows, MARKS, "lreg", n_features=64, tol=1e-12)
    scored = model.predict_proba(rows).select("labels", "proba", F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"))
    slopes = []
    for i, v in enumerate(MARKS):
        miss = F.get("proba", i) - F.array_contains("labels", v).cast("double")
        coefficients = F.array(*[F.lit(float(c)) for c in model.models[v][0].coefficients], F.lit(0.0))
        one = scored.select(F.posexplode(F.transform("x", lambda x: x * miss)).alias("dim", "g")) \
            .groupBy("dim").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n"))
        slopes.append(one.select(F.lit(v).alias("label"), "dim",
                                 (F.round((F.col("g") + F.get(coefficients, F.col("dim"))) / F.col("n"), 5) + 0.0).alias("slope")))
    return reduce(lambda a, b: a.unionByName(b), slopes)


@query("model_weights")
def model_weights(spark, sf):
    """Coefficients of the logistic models by embedding dimension."""
    model = models.fit_multilabel(marked_rows(spark, sf), MARKS, "lreg", n_features=64)
    index = spark.range(64).select(F.col("id").cast("int").alias("index"), F.concat(F.lit("dim"), "id").alias("term"))
    return models.model_weights(model, index).withColumn("weight", rnd("weight", 4))


@query("bayes_weights", f"select label, term, {r('log_pos', 8)} as log_pos, {r('log_neg', 8)} as log_neg from bayes", ("bayes",))
def bayes_weights(spark, sf):
    m = models.bayes_weights(*lang_model(spark, sf))
    return m.select("label", "term", rnd("log_pos", 8).alias("log_pos"), rnd("log_neg", 8).alias("log_neg"))


@query("bayes", """select d.id, v.label, cast(coalesce(s.s, 0.0) + v.prior >= 0 as int) as hit
from docs d cross join (select label, ln(count(*) / cast((select count(*) from docs) - count(*) as double)) as prior from lang_labels group by label) v
left join (select id, label, sum(tf * (log_pos - log_neg)) as s from tf join bayes using (term) group by id, label) s
  on s.id = d.id and s.label = v.label""", ("docs", "lang_labels", "tf", "bayes"))
def bayes(spark, sf):
    d = lang_docs(spark, sf)
    model, names = lang_model(spark, sf)
    tf = written(features.count_vectorize(d), "counts")
    p = models.bayes_proba(tf, d, model, models.bayes_priors(d, names), names)
    return p.select("id", "label", (F.col("p") >= 0.5).cast("int").alias("hit"))


cte("lang_folds", """select id, label, cast((rn - 1 + o1) % 5 as int) as fold from (
  select id, label, row_number() over (partition by label order by md5(concat(cast(id as varchar), '42069'))) as rn,
    cast(concat('0x', substr(md5(label), 1, 6)) as bigint) as o1 from lang_labels)""", "lang_labels")
# f is the fold left out.
cte("fold_counts", """select f, label, term, cast(sum(tf) as double) as c from tf join lang_folds using (id) join range(5) t(f) on f <> fold
group by f, label, term""", "tf", "lang_folds")
cte("fold_terms", "select f, term, sum(c) as c from fold_counts group by f, term", "fold_counts")
cte("fold_weights", """select a.f, p.label, a.term,
  ln((coalesce(t.c, 0.0) + 1.0) / (p.c + m.v)) - ln((a.c - coalesce(t.c, 0.0) + 1.0) / (m.c - p.c + m.v)) as w
from fold_terms a
join (select f, label, sum(c) as c from fold_counts group by f, label) p on p.f = a.f
join (select f, count(*) as v, sum(c) as c from fold_terms group by f) m on m.f = a.f
left join fold_counts t on t.f = a.f and t.label = p.label and t.term = a.term""", "fold_counts", "fold_terms")


@query("out_of_fold_bayes", """select d.id, d.fold, v.label, cast(coalesce(s.s, 0.0) + v.prior >= 0 as int) as hit
from lang_folds d
join (select f, label, ln(n / (sum(n) over (partition by f) - n)) as prior from (
  select f, label, cast(count(*) as double) as n from lang_folds join range(5) t(f) on f <> fold group by f, label)) v on v.f = d.fold
left join (select id, w.label, sum(tf * w) as s from tf join lang_folds using (id) join fold_weights w on w.f = fold and w.term = tf.term
  group by id, w.label) s on s.id = d.id and s.label = v.label""", ("lang_folds", "tf", "fold_weights"))
def out_of_fold_bayes(spark, sf):
    """Language of every document by naive Bayes on the four folds that it is not in."""
    d = lang_docs(spark, sf)
    p = models.bayes_out_of_fold(d, clean.load_vocabulary(d))
    return p.select("id", "fold", "label", (F.col("p") >= 0.5).cast("int").alias("hit"))


# --- experiments ----------------------------------------------------------------------------------

def mark_docs(spark, sf):
    """(id, description, lemmatized_description, labels): marked documents with language and marks as labels; the
    words stand in for lemmas."""
    marks = table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    return docs(spark, sf).join(marks, "id").select(
        "id", "description", F.array_join(tx.words(F.col("description")), " ").alias("lemmatized_description"),
        F.array_sort(F.array_compact(F.array(
            F.col("lang"), F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic")))).alias("labels"))


def standard_runs(spark, sf, runs):
    d = mark_docs(spark, sf)
    out = experiments.run_matrix(d, clean.load_vocabulary(d), runs)
    return out.withColumn("value", rnd("value", 6))


@query("run_matrix")
def run_matrix(spark, sf):
    """The standard runs without synthetic records."""
    return standard_runs(spark, sf, experiments.PLAIN_RUNS)


@query("run_matrix_synthetic")
def run_matrix_synthetic(spark, sf):
    """The standard runs with synthetic records."""
    return standard_runs(spark, sf, experiments.SYNTHETIC_RUNS)


@query("run_binary")
def run_binary(spark, sf):
    """One label with and without the keyword rule."""
    d = mark_docs(spark, sf)
    names, words = clean.load_vocabulary(d), ["the", "ing", "ther"]
    scored = experiments.score_binary(d, "en", names)  # one model for both rules
    plain = experiments.binary_decision(scored).withColumn("rule", F.lit("plain"))
    boosted = experiments.binary_decision(scored, words).withColumn("rule", F.lit("boosted"))
    return plain.unionByName(boosted)

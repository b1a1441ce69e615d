"""Decision and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.tables import (DIGITS, binary_docs, cte, decided, doc_scored, doc_vocabulary, docs, items,
                                    order_ids, order_proba, order_scored, order_scores, order_vocabulary, query,
                                    rnd, sql_words)
from tagloom.functions import labels as lb
from tagloom.functions import text as tx
from tagloom.operators import decide, evaluate, ranking
from tagloom.plans import reports
from tagloom.session import scratch_path, written
from tagloom.sources import csvfiles


def r(expr: str) -> str:
    return f"round({expr}, {DIGITS})"


def ratio(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(cast({b} as double), 0), 0.0)"


def rounded(df, *names):
    return df.withColumns({n: rnd(n) for n in names or [f.name for f in df.schema if f.dataType.typeName() == "double"]})


# Per-record scores over (tp, nt, np, nu, nl).
SCORES = {
    "jaccard": ratio("tp", "nu"),
    "hamming": ratio("nu - tp", "nl"),
    "accuracy": ratio("nl - nu + tp", "nl"),
    "balanced_accuracy": f"""case when nt > 0 and nt < nl then ({ratio('tp', 'nt')} + {ratio('nl - nu', 'nl - nt')}) / 2.0
        when nt > 0 then {ratio('tp', 'nt')} else {ratio('nl - nu', 'nl - nt')} end""",
    "f1": ratio("2 * tp", "nt + np"),
    "precision": ratio("tp", "np"),
    "recall": ratio("tp", "nt"),
}
OVERLAP = "(tp - (nu - tp)) / (nu + 1e-9)"
SUMMARY = {
    "jaccard": f"avg({SCORES['jaccard']})", "hamming": "sum(nu - tp) / sum(cast(nl as double))",
    "accuracy": "avg(cast(nu = tp as double))", "f1": f"avg({SCORES['f1']})",
    "precision": f"avg({SCORES['precision']})", "recall": f"avg({SCORES['recall']})",
    "at_least_one": "avg(cast(tp >= 1 as double))", "at_least_two": "avg(cast(tp >= 2 as double))",
    "signed_overlap": f"avg({OVERLAP})",
}
# Per-label scores over (tn, fp, fn, tp).
PRECISION, RECALL = ratio("tp", "tp + fp"), ratio("tp", "tp + fn")
F1 = ratio("2 * tp", "2 * tp + fp + fn")
BALANCED = f"""case when tp + fn > 0 and tn + fp > 0 then ({RECALL} + {ratio('tn', 'tn + fp')}) / 2.0
  when tp + fn > 0 then {RECALL} else {ratio('tn', 'tn + fp')} end"""


@query("multilabel_metrics", "select " + ", ".join(f"{r(e)} as {m}" for m, e in SUMMARY.items()) + " from rec", ("rec",))
def multilabel_metrics(spark, sf):
    return rounded(evaluate.multilabel_metrics(order_scored(spark, sf), len(order_vocabulary(spark, sf))))


def one_metric(name: str, sql_name: str) -> None:
    @query(name, f"select {r(SUMMARY[sql_name])} as {sql_name} from rec", ("rec",))
    def run(spark, sf):
        n = len(order_vocabulary(spark, sf))
        return rounded(evaluate.multilabel_metrics(order_scored(spark, sf), n, [sql_name]))


for _name, _metric in [("jaccard_samples", "jaccard"), ("hamming_loss", "hamming"), ("subset_accuracy", "accuracy"),
                       ("signed_overlap", "signed_overlap")]:
    one_metric(_name, _metric)


@query("precision_recall_f1_samples", f"select {r(SUMMARY['precision'])} as precision, {r(SUMMARY['recall'])} as recall, {r(SUMMARY['f1'])} as f1 from rec", ("rec",))
def precision_recall_f1_samples(spark, sf):
    n = len(order_vocabulary(spark, sf))
    return rounded(evaluate.multilabel_metrics(order_scored(spark, sf), n, ["precision", "recall", "f1"]))


@query("at_least_k", f"select {r('avg(cast(tp >= 3 as double))')} as at_least_three from rec", ("rec",))
def at_least_k(spark, sf):
    scored = evaluate.counts(order_scored(spark, sf))
    return rounded(scored.agg(evaluate.at_least_k(3).alias("at_least_three")))


@query("signed_overlap_record", f"select id, {r(OVERLAP)} as signed_overlap from rec", ("rec",))
def signed_overlap_record(spark, sf):
    return rounded(evaluate.signed_overlap_record(order_scored(spark, sf)).select("id", "signed_overlap"))


def record_metric(metric: str) -> None:
    @query(f"record_{metric}", f"select id, {r(SCORES[metric])} as score from rec", ("rec",))
    def run(spark, sf):
        n = len(order_vocabulary(spark, sf))
        return rounded(evaluate.score_per_record(order_scored(spark, sf), n, metric).select("id", "score"))


for _m in SCORES:
    record_metric(_m)


@query("compute_metrics", f"""
select 'jaccard' as metric, null as label, {r(SUMMARY['jaccard'])} as value from rec
union all select 'hamming', null, {r(SUMMARY['hamming'])} from rec
union all select concat('confusion_matrix:', k), label, cast(v as double) from (
  unpivot (select label, tn, fp, fn, tp from conf) on tn, fp, fn, tp into name k value v)""", ("rec", "conf"))
def compute_metrics(spark, sf):
    names = ["jaccard", "hamming", "confusion_matrix"]
    return rounded(evaluate.compute_metrics(order_scored(spark, sf), order_vocabulary(spark, sf), names))


@query("confusion_per_label", "select label, tn, fp, fn, tp from conf", ("conf",))
def confusion_per_label(spark, sf):
    return evaluate.confusion_per_label(order_scored(spark, sf), order_vocabulary(spark, sf))


cte("report", f"select label as name, {PRECISION} as precision, {RECALL} as recall, {F1} as f1, tp + fn as support, tp, fp, fn from conf", "conf")


cte("averages", f"""select name, {r('precision')} as precision, {r('recall')} as recall, {r('f1')} as f1, support from report
union all select 'micro avg', {r(ratio('sum(tp)', 'sum(tp + fp)'))}, {r(ratio('sum(tp)', 'sum(tp + fn)'))},
  {r(ratio('2 * sum(tp)', 'sum(2 * tp + fp + fn)'))}, cast(sum(support) as bigint) from report
union all select 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1)')}, cast(sum(support) as bigint) from report
union all select 'weighted avg', {r('sum(precision * support) / sum(support)')}, {r('sum(recall * support) / sum(support)')},
  {r('sum(f1 * support) / sum(support)')}, cast(sum(support) as bigint) from report
union all select 'samples avg', {r(SUMMARY['precision'])}, {r(SUMMARY['recall'])}, {r(SUMMARY['f1'])}, cast(sum(nt) as bigint) from rec""", "report", "rec")


@query("classification_report", "select * from averages", ("averages",))
def classification_report(spark, sf):
    return rounded(evaluate.classification_report(order_scored(spark, sf), order_vocabulary(spark, sf)))


@query("balanced_accuracy", f"select label, {r(BALANCED)} as balanced_accuracy from conf", ("conf",))
def balanced_accuracy(spark, sf):
    scored, names = order_scored(spark, sf), order_vocabulary(spark, sf)
    return rounded(evaluate.metrics_per_label(scored, names, ("balanced_accuracy",)).drop("share"))


@query("metrics_per_label", f"""select label, {r(BALANCED)} as balanced_accuracy, {r(PRECISION)} as precision, {r(RECALL)} as recall,
  {r('(tp + fn) / (select sum(tp + fn) from conf)')} as share from conf""", ("conf",))
def metrics_per_label(spark, sf):
    return rounded(evaluate.metrics_per_label(order_scored(spark, sf), order_vocabulary(spark, sf)))


@query("rank_metrics", f"select label, {r(F1)} as f1 from conf", ("conf",))
def rank_metrics(spark, sf):
    scored, names = order_scored(spark, sf), order_vocabulary(spark, sf)
    table_ = evaluate.metrics_per_label(scored, names, ("f1",)).drop("share")
    return evaluate.rank_metrics(rounded(table_), "f1")


@query("prediction_histogram", "select label, tp + fp as n from conf", ("conf",))
def prediction_histogram(spark, sf):
    return evaluate.prediction_histogram(order_scored(spark, sf), order_vocabulary(spark, sf))


@query("score_by_label_support", f"""select label, count(*) as support, {r('avg(jaccard)')} as score
from truth join (select id, {SCORES['jaccard']} as jaccard from rec) using (id) group by label""", ("truth", "rec"))
def score_by_label_support(spark, sf):
    return rounded(evaluate.score_by_label_support(order_scored(spark, sf), len(order_vocabulary(spark, sf))))


@query("evaluation_report", f"""
select 'whole' as section, null::varchar as name, m as metric, v as value from (
  unpivot (select {', '.join(f"cast({r(e)} as double) as {m}" for m, e in SUMMARY.items())} from rec)
  on {', '.join(SUMMARY)} into name m value v)
union all select 'label', label, m, v from (
  unpivot (select label, {r(BALANCED)} as balanced_accuracy, {r(PRECISION)} as precision, {r(RECALL)} as recall,
    {r('(tp + fn) / (select sum(tp + fn) from conf)')} as share from conf)
  on balanced_accuracy, precision, recall, share into name m value v)
union all select 'predictions', label, 'n', cast(tp + fp as double) from conf
union all select 'support', label, m, v from (
  unpivot (select label, cast(count(*) as double) as support, {r('avg(jaccard)')} as score
    from truth join (select id, {SCORES['jaccard']} as jaccard from rec) using (id) group by label)
  on support, score into name m value v)
union all select 'average', name, m, v from (
  unpivot (select name, precision, recall, f1, cast(support as double) as support from averages)
  on precision, recall, f1, support into name m value v)""", ("rec", "conf", "truth", "averages"))
def evaluation_report(spark, sf):
    return rounded(reports.evaluation_report(order_scored(spark, sf), order_vocabulary(spark, sf)))


cte("bin_conf", """select count(*) filter (where y = 0 and p = 0) as tn, count(*) filter (where y = 0 and p = 1) as fp,
  count(*) filter (where y = 1 and p = 0) as fn, count(*) filter (where y = 1 and p = 1) as tp from bin""", "bin")
ACCURACY = ratio("tp + tn", "tp + tn + fp + fn")
BINARY_SQL = f"{r(PRECISION)} as precision, {r(RECALL)} as recall, {r(F1)} as f1, {r(ACCURACY)} as accuracy, {r(BALANCED)} as balanced_accuracy"


@query("binary_report", f"select {BINARY_SQL} from bin_conf", ("bin_conf",))
def binary_report(spark, sf):
    return rounded(evaluate.binary_report(binary_docs(spark, sf)))


@query("binary_slice_report", f"select {BINARY_SQL} from conf where label = (select min(label) from voc)", ("conf", "voc"))
def binary_slice_report(spark, sf):
    """The first label of the orders as a one-label problem."""
    label = order_vocabulary(spark, sf)[0]
    return rounded(evaluate.binary_report(evaluate.binary_slice(order_scored(spark, sf), label)))


cte("doc_len", f"select id, cast(len({sql_words('description')}) as bigint) as len from docs", "docs")


@query("metrics_by_length", f"""select cast(b as int) as bin, {r('b * (m.longest / 9.0)')} as low, count(x.id) as n, {r('avg(x.jaccard)')} as score
from range(9) t(b) cross join (select max(len) as longest from doc_len) m
left join (select id, len, jaccard from doc_len join doc_rec using (id)) x
  on x.len < m.longest and x.len >= b * (m.longest / 9.0) and x.len < (b + 1) * (m.longest / 9.0)
group by b, m.longest""", ("doc_len", "doc_rec"))
def metrics_by_length(spark, sf):
    return rounded(evaluate.metrics_by_length(doc_scored(spark, sf), len(doc_vocabulary(spark, sf))))


cte("binned", "select *, ntile(20) over (order by len, md5(cast(id as varchar))) as b from bin", "bin")


@query("equal_count_bins", "select id, cast(ntile(20) over (order by len, md5(cast(id as varchar))) as int) as bin from bin_all", ("bin_all",))
def equal_count_bins(spark, sf):
    d = docs(spark, sf).select("id", tx.word_count(F.col("description")).alias("len"))
    return ranking.equal_count_bins(d, "len", "id").select("id", "bin")


@query("metrics_by_length_quantile", f"""select bin, range, n, {r(F1)} as score from (
  select cast(b as int) as bin, concat(min(len), '-', max(len)) as range, count(*) as n,
    count(*) filter (where y = 0 and p = 1) as fp, count(*) filter (where y = 1 and p = 0) as fn,
    count(*) filter (where y = 1 and p = 1) as tp from binned group by b)""", ("binned",))
def metrics_by_length_quantile(spark, sf):
    return rounded(evaluate.metrics_by_length_quantile(binary_docs(spark, sf)))


SAMPLE = f"""select s.id, {r('s.jaccard')} as jaccard, d.description,
  (select string_agg(label, '|' order by label) from doc_labels t where t.id = s.id) as y_true,
  (select string_agg(label, '|' order by label) from doc_pred p where p.id = s.id) as y_pred
from (select id, jaccard from doc_rec order by {{order}} limit 30) s join docs d using (id)"""


def sample_columns(df):
    return rounded(df.select("id", "jaccard", "description", F.array_join("y_true", "|").alias("y_true"),
                             F.array_join("y_pred", "|").alias("y_pred")))


@query("worst_records", SAMPLE.format(order="jaccard, id"), ("doc_rec", "docs", "doc_labels", "doc_pred"))
def worst_records(spark, sf):
    return sample_columns(evaluate.worst_records(doc_scored(spark, sf), len(doc_vocabulary(spark, sf))))


@query("best_records", SAMPLE.format(order="jaccard desc, id desc"), ("doc_rec", "docs", "doc_labels", "doc_pred"))
def best_records(spark, sf):
    return sample_columns(evaluate.best_records(doc_scored(spark, sf), len(doc_vocabulary(spark, sf))))


EXTREME = """(select id, description, y, proba, p, 'high' as side from bin order by {score} desc, id desc limit 15)
union all (select id, description, y, proba, p, 'low' from bin order by {score}, id limit 15)"""


@query("binary_bad_samples", EXTREME.format(score="(1.0 - proba) + y"), ("bin",))
def binary_bad_samples(spark, sf):
    return evaluate.binary_bad_samples(binary_docs(spark, sf)).drop("rank_score")


@query("binary_good_samples", EXTREME.format(score="proba + y"), ("bin",))
def binary_good_samples(spark, sf):
    return evaluate.binary_good_samples(binary_docs(spark, sf)).drop("rank_score")


# --- alignment, comparison --------------------------------------------------------------------

@query("align_truth_pred", """select ids.id,
  coalesce((select string_agg(label, '|' order by label) from truth where truth.id = ids.id), '') as y_true,
  coalesce((select string_agg(label, '|' order by label) from pred where pred.id = ids.id), '') as y_pred
from ids""", ("ids", "truth", "pred"))
def align_truth_pred(spark, sf):
    found = items(spark, sf)
    both = evaluate.align_truth_pred(order_ids(spark, sf), found.filter("t"), found.filter("p"))
    return both.select("id", F.array_join("y_true", "|").alias("y_true"), F.array_join("y_pred", "|").alias("y_pred"))


@query("align_long", """select coalesce(t.id, p.id) as id, coalesce(t.label, p.label) as label,
  cast(t.id is not null as int) as t, cast(p.id is not null as int) as p
from truth t full join pred p on t.id = p.id and t.label = p.label""", ("truth", "pred"))
def align_long(spark, sf):
    found = items(spark, sf)
    return evaluate.align_long(found.filter("t"), found.filter("p"))


cte("hard", "select id, label, cast(p >= 0.5 as int) as p from proba", "proba")
cte("conf2", """select g.label, sum((1 - t) * (1 - h.p)) as tn, sum((1 - t) * h.p) as fp, sum(t * (1 - h.p)) as fn, sum(t * h.p) as tp
from grid g join hard h using (id, label) group by g.label""", "grid", "hard")


def order_threshold(spark, sf):
    """(id, y_true, y_pred, y_hard): two predictions of the same orders."""
    names = order_vocabulary(spark, sf)
    hard = decide.labels_over(order_scores(spark, sf), order_ids(spark, sf), name="y_hard")
    return order_scored(spark, sf).join(hard, "id"), names


@query("compare_runs", f"""select a.label, {r('a.recall')} as recall_a, {r('b.recall')} as recall_b, {r('b.recall - a.recall')} as recall_diff,
  {r('a.precision')} as precision_a, {r('b.precision')} as precision_b, {r('b.precision - a.precision')} as precision_diff
from (select label, {PRECISION} as precision, {RECALL} as recall from conf) a
join (select label, {PRECISION} as precision, {RECALL} as recall from conf2) b using (label)""", ("conf", "conf2"))
def compare_runs(spark, sf):
    both, names = order_threshold(spark, sf)
    both = written(both, "decisions")  # two runs, each counted and summed
    metrics = ("precision", "recall")
    a = evaluate.metrics_per_label(both, names, metrics)
    b = evaluate.metrics_per_label(both.select("id", "y_true", F.col("y_hard").alias("y_pred")), names, metrics)
    return rounded(evaluate.compare_runs(a, b, ["label"], list(metrics)))


@query("compare_records", f"""select a.id, {r('b.j - a.j')} as jaccard_diff
from (select id, {SCORES['jaccard']} as j from rec) a join (
  select id, case when sum(greatest(t, h.p)) = 0 then 0.0 else sum(t * h.p) / sum(greatest(t, h.p)) end as j
  from grid join hard h using (id, label) group by id) b using (id)""", ("rec", "grid", "hard"))
def compare_records(spark, sf):
    """Per-record difference of two runs; both predictions sit on the same row, so no join."""
    both, _ = order_threshold(spark, sf)
    diff = lb.jaccard(F.col("y_true"), F.col("y_hard")) - lb.jaccard(F.col("y_true"), F.col("y_pred"))
    return rounded(both.select("id", diff.alias("jaccard_diff")))


@query("model_agreement", f"""select label, {r('(n11 + n00) / n')} as agreement,
  {r('(n11 * n00 - n10 * n01) / nullif(sqrt((n11 + n10) * (n11 + n01) * (n00 + n10) * (n00 + n01)), 0)')} as correlation
from (select label, cast(count(*) as double) as n, cast(count(*) filter (where g.p = 1 and h.p = 1) as double) as n11,
    cast(count(*) filter (where g.p = 1 and h.p = 0) as double) as n10, cast(count(*) filter (where g.p = 0 and h.p = 1) as double) as n01,
    cast(count(*) filter (where g.p = 0 and h.p = 0) as double) as n00
  from grid g join hard h using (id, label) group by label)""", ("grid", "hard"))
def model_agreement(spark, sf):
    both, names = order_threshold(spark, sf)
    return rounded(evaluate.model_agreement(both, names, "y_pred", "y_hard"))


GUESS = "cast(concat('0x', substr(md5(concat(cast(id as varchar), '|', label, '|42069')), 1, 8)) as bigint) / 4294967296.0 < 0.25"


@query("random_guess_baseline", f"""select {r(SUMMARY['jaccard'])} as jaccard, {r(SUMMARY['hamming'])} as hamming, {r(SUMMARY['f1'])} as f1
from (select id, sum(t * p) as tp, sum(t) as nt, sum(p) as np, sum(greatest(t, p)) as nu, count(*) as nl
  from (select id, label, t, cast({GUESS} as int) as p from grid) group by id)""", ("grid",))
def random_guess_baseline(spark, sf):
    names = order_vocabulary(spark, sf)
    guess = evaluate.random_guess(order_scored(spark, sf).drop("y_pred"), names, 42069, 0.25)
    return rounded(evaluate.multilabel_metrics(guess, len(names), ["jaccard", "hamming", "f1"]))


# --- decisions ------------------------------------------------------------------------------

cte("best", "select id, max(p) as top, min(case when p > 0 then 0 else 1 end) as none from proba group by id", "proba")


def chosen(condition: str) -> str:
    return f"""select id, coalesce(string_agg(label, '|' order by label) filter (where {condition}), '') as labels
from (select *, max(p) over (partition by id) as top, row_number() over (partition by id order by p desc, label) as rn from proba) group by id"""


@query("dense_scores", f"select id, string_agg(cast(cast(p * 1000000 as bigint) as varchar), ' ' order by label) as proba from proba group by id", ("proba",))
def dense_scores(spark, sf):
    micro = F.transform("proba", lambda x: F.rint(x * 1000000).cast("long").cast("string"))
    return order_proba(spark, sf).select("id", F.array_join(micro, " ").alias("proba"))


@query("predict_threshold", chosen("p >= 0.5"), ("proba",))
def predict_threshold(spark, sf):
    return decided(decide.predict_threshold(order_proba(spark, sf)), order_vocabulary(spark, sf))


@query("predict_at_least_one", chosen("p >= 0.5 or (top < 0.5 and p >= top)"), ("proba",))
def predict_at_least_one(spark, sf):
    return decided(decide.predict_at_least_one(order_proba(spark, sf)), order_vocabulary(spark, sf))


@query("predict_threshold_argmax", chosen("p > 0.425 or (top <= 0.425 and rn = 1)"), ("proba",))
def predict_threshold_argmax(spark, sf):
    return decided(decide.predict_threshold_argmax(order_proba(spark, sf)), order_vocabulary(spark, sf))


@query("sigmoid_threshold", f"""select id, label, {r('1.0 / (1.0 + exp(-4.0 * (p - 0.3)))')} as p, cast(p > 0.3 as int) as hit from proba""", ("proba",))
def sigmoid_threshold(spark, sf):
    names = order_vocabulary(spark, sf)
    x = order_proba(spark, sf).select("id", F.posexplode("proba").alias("i", "p"))
    label = F.element_at(lb.literal_names(names), F.col("i") + 1)
    return x.select("id", label.alias("label"), rnd(lb.sigmoid((F.col("p") - 0.3) * 4.0)).alias("p"),
                    (F.col("p") > 0.3).cast("int").alias("hit"))


@query("predict_excluding", """select id, coalesce(string_agg(label, '|' order by label) filter (
    where p >= 0.5 or (hits = 0 and label <> skip and p >= top)), '') as labels
from (select *, max(case when label <> skip then p end) over (partition by id) as top,
        sum(cast(p >= 0.5 as int)) over (partition by id) as hits
      from proba cross join (select min(label) as skip from voc)) group by id""", ("proba", "voc"))
def predict_excluding(spark, sf):
    names = order_vocabulary(spark, sf)
    return decided(decide.predict_excluding(order_proba(spark, sf), names, names[0]), names)


@query("argmax_label", "select id, label from (select *, row_number() over (partition by id order by p desc, label) as rn from proba) where rn = 1", ("proba",))
def argmax_label(spark, sf):
    return decide.argmax_label(order_proba(spark, sf), order_vocabulary(spark, sf)).select("id", "label")


KEYWORDS = {"en": ["the", "ing", "war", "ther"], "de": ["der", "und", "sch"], "fr": ["les", "eau", "que"],
            "es": ["los", "ción", "ue"]}


def fraction_sql(label: str, text: str = "lower(description)") -> str:
    hits = " + ".join(f"cast(contains({text}, '{k}') as int)" for k in KEYWORDS[label])
    return f"(({hits}) / {float(len(KEYWORDS[label]))})"


@query("keyword_fraction", "select id, " + ", ".join(f"{r(fraction_sql(v))} as {v}" for v in sorted(KEYWORDS)) + " from docs", ("docs",))
def keyword_fraction(spark, sf):
    t = F.col("description")
    return docs(spark, sf).select("id", *[rnd(lb.keyword_fraction(t, KEYWORDS[v])).alias(v) for v in sorted(KEYWORDS)])


@query("keyword_match", " union all ".join(f"select id, '{v}' as label, '{k}' as keyword from docs where contains(lower(description), '{k}')"
                                          for v in sorted(KEYWORDS) for k in KEYWORDS[v]), ("docs",))
def keyword_match(spark, sf):
    """Which keyword of which label occurs in which text."""
    low = F.lower("description")
    pairs = F.array(*[F.struct(F.lit(v).alias("label"), F.lit(k).alias("keyword")) for v in sorted(KEYWORDS) for k in KEYWORDS[v]])
    d = docs(spark, sf).select("id", low.alias("low"))
    hits = F.filter(pairs, lambda x: F.contains(F.col("low"), x["keyword"]))
    return d.select("id", F.inline(hits))


@query("predict_binary_boosted", f"select id, y, cast(proba * 0.5 + {fraction_sql('en')} > 0.5 as int) as p from bin_all", ("bin_all",))
def predict_binary_boosted(spark, sf):
    half = binary_docs(spark, sf, "left").withColumn("proba", F.col("proba") * 0.5)
    return decide.predict_binary_boosted(half, KEYWORDS["en"]).select("id", "y", "p")


def boosted(v: str) -> str:
    return f"(proba * 0.5 + {fraction_sql(v)})"


@query("boost_proba", f"select id, " + ", ".join(f"{r(boosted(v))} as {v}" for v in sorted(KEYWORDS)) + " from bin_all", ("bin_all",))
def boost_proba(spark, sf):
    names = sorted(KEYWORDS)
    d = binary_docs(spark, sf, "left").withColumn("proba", F.array_repeat(F.col("proba") * 0.5, len(names)))
    out = decide.boost_proba(d, KEYWORDS, names)
    return out.select("id", *[rnd(F.get("proba", i)).alias(v) for i, v in enumerate(names)])


@query("write_predictions", """select concat('tt', cast(id as varchar)) as movie_id,
  coalesce(string_agg(label, '|' order by label) filter (where p = 1), '') as y_pred,
  coalesce(string_agg(label, '|' order by label) filter (where t = 1), '') as y_true from doc_grid group by id""", ("doc_grid",))
def write_predictions(spark, sf):
    """0/1 vectors written as a prediction table and decoded again."""
    names = doc_vocabulary(spark, sf)
    path = scratch_path(spark, "predictions")
    rows = doc_scored(spark, sf).select(
        F.concat(F.lit("tt"), F.col("id").cast("string")).alias("movie_id"),
        lb.encode_labels(F.col("y_pred"), names).alias("y_pred"), lb.encode_labels(F.col("y_true"), names).alias("y_true"))
    csvfiles.write_predictions(rows, path)
    back = spark.read.schema(rows.schema).parquet(path)
    text = lambda c: F.array_join(lb.decode_labels(F.col(c), names), "|").alias(c)
    return back.select("movie_id", text("y_pred"), text("y_true"))


# --- label and score functions -----------------------------------------------------------------

@query("encode_labels", "select id, string_agg(cast(t as varchar), ' ' order by label) as hot from grid group by id", ("grid",))
def encode_labels(spark, sf):
    hot = lb.encode_labels(F.col("y_true"), order_vocabulary(spark, sf))
    return order_scored(spark, sf).select("id", F.array_join(hot.cast("array<string>"), " ").alias("hot"))


@query("decode_labels", "select id, coalesce(string_agg(label, '|' order by label) filter (where t = 1), '') as labels from grid group by id", ("grid",))
def decode_labels(spark, sf):
    names = order_vocabulary(spark, sf)
    hot = order_scored(spark, sf).select("id", lb.encode_labels(F.col("y_true"), names).alias("pred"))
    return decided(hot, names)


@query("set_overlap", f"select id, {r(SCORES['jaccard'])} as jaccard, {r(OVERLAP)} as signed from rec", ("rec",))
def set_overlap(spark, sf):
    d = order_scored(spark, sf)
    t, p = F.col("y_true"), F.col("y_pred")
    signed = lb.signed_overlap(F.size(F.array_intersect(t, p)), F.size(t), F.size(p))
    return d.select("id", rnd(lb.jaccard(t, p)).alias("jaccard"), rnd(signed).alias("signed"))


@query("length_bins", """select id, cast(least(len * 9 // (select max(len) from doc_len), 9) as int) as bin from doc_len""", ("doc_len",))
def length_bins(spark, sf):
    """Equal-width bin of each text length; the longest text lies on the upper edge."""
    d = docs(spark, sf).select("id", tx.word_count(F.col("description")).alias("len"))
    top = d.agg(F.max("len").alias("m")).scalar()
    return d.select("id", (F.width_bucket(F.col("len").cast("double"), F.lit(0.0), top.cast("double"), F.lit(9)) - 1).cast("int").alias("bin"))


@query("id_suffix", "select movie_id, substr(movie_id, 3) as bare from raw", ("raw",))
def id_suffix(spark, sf):
    from tagloom.catalog.tables import raw_records

    return raw_records(spark, sf).select("movie_id", tx.id_suffix(F.col("movie_id")).alias("bare"))


@query("keyword_in_text", "select id, contains(lower(description), 'the') as found from docs", ("docs",))
def keyword_in_text(spark, sf):
    return docs(spark, sf).select("id", F.contains(F.lower("description"), F.lit("the")).alias("found"))

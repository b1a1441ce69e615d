"""The registered queries of this package, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (chat, decontaminate, filteraudit, htmlcrf, langid, packedids, pii, piecebpe, probminhash, rpforest, toxicity,
                         urlfilter, whitening)
from tagloom.llm.common import held_out, table
from tagloom.session import scratch_path

# A document is rejected from this score on.
TOXIC = 0.3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the ids and of the decoded text of every document."""
    coded = piecebpe.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def toxicity_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()), "toxic")


@query
def op3_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.score("text", toxicity_model(docs, spark, sf_dir)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


@query
def op9_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", decontaminate.hits(F.col("text"), table(spark, sf_dir, "benchmark")).alias("hits"))
    # An outer unfolding: from the plain one Spark infers a filter on the hits, and searches every text once more for it.
    return found.select("doc_id", F.inline_outer("hits")).where("item_id is not null")


@query
def op10_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), langid.predict(F.col("text"), model).alias("p"))
    return scored.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


@query
def op4_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the conversations as read back from their rendering."""
    text = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    done = chat.format_conversations(rows).withColumn("turns", chat.parsed(F.col("formatted")))
    lost = F.array_join(F.transform("loss_spans", lambda x: chat.unescaped(F.col("formatted").substr(x["start"] + 1, x["end"] - x["start"]))), "")
    done = done.withColumn("loss", lost)
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLES["op4_chat_round_trip"] = r"""with rows as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown as (select *, case when contains(r || chr(1) || t, '\') or contains(r || chr(1) || t, '### ')
    or contains(r || chr(1) || t, '</turn>') or contains(r, ': ')
  then replace(replace(replace(replace(r, '\', '\\'), '### ', '##\# '), '</turn>', '<\/turn>'), ': ', ':\ ') || chr(1)
    || replace(replace(replace(t, '\', '\\'), '### ', '##\# '), '</turn>', '<\/turn>')
  else r || chr(1) || t end as s from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, r, t)) as turns_sha256,
  coalesce(sum(length(t)) filter (r = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn nulls first, r, t) filter (r = 'assistant'), '')) as loss_sha256,
  sum(4 + length(s) + 1 + 8)::bigint as formatted_chars
from shown group by conv_id"""


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("pii", lambda x: x["kind"] < len(pii.BASE))

    def count(kind: int):
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{pii.BASE[kind]}")

    return found.select("doc_id", *map(count, range(len(pii.BASE))), F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"))


def pii_sql() -> str:
    names = [k.name for k in pii.KINDS]
    parts = ",\n".join(f"{pii.sql_spans(name, pattern, check, names.index(name))} as {name}" for name, pattern, check in pii.SQL_CHECKS)
    order = "list_sort(list_transform({0}, lambda x: {{'s': x.s, 'k': x.k, 'e': x.e, 'n': x.n}}))"
    show = "array_to_string(list_transform({0}, lambda x: x.n || ':' || x.s || ':' || x.e), ',')"
    base = " || ".join(pii.BASE)
    every = " || ".join(name for name, *_ in pii.SQL_CHECKS)
    return f"""with texts as (select doc_id, coalesce(text, '') as t from documents),
found as (select doc_id, {parts} from texts)
select doc_id, {', '.join(f'len({k})::bigint as n_{k}' for k in pii.BASE)},
  sha256({show.format(order.format(base))}) as base_sha256, {show.format(order.format(every))} as spans
from found"""


# Account codes need an iteration over their letters; none of the given tables holds one, and tests/llm covers them.
ORACLES["op5_pii"] = pii_sql()


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
REJECTED_TERMS = ["ads", "bets", "casino", "pills", "spam"]


@query
def op1_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    judged = urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES, REJECTED_TERMS)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth vector."""
    return rpforest.search(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


@query
def op8_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    done = pages.select("page_id", "url", htmlcrf.extract("html", htmlcrf.fit(pages)).alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))


@query
def op11_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of the ids of every document, read back from packed shards."""
    import public_tokenizers

    path = scratch_path(spark, "token-ids")
    packedids.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    back = packedids.with_checksum(packedids.read(spark, path))
    return back.select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, by source."""
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""with base as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
seen as (select t, min(doc_id) as first from base group by t),
lab as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as bad from labels group by doc_id),
split as (select doc_id, part, t, first, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from base join seen using (t)),
failed as (select doc_id, part, concat(
  case when len(w) < 50 then 'A' else '' end, case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end,
  case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end,
  case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end, case when doc_id > first then 'E' else '' end) as fails from split),
kinds as (select part, fails, count(*) as n, count(*) filter (good = 1) as g, count(*) filter (bad = 1) as x
  from failed left join lab using (doc_id) group by part, fails),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (select concat(a.l, b.l, c.l, d.l, e.l) as filter_order from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l)
  join letters d on d.l not in (a.l, b.l, c.l) join letters e on e.l not in (a.l, b.l, c.l, d.l)),
steps as (select filter_order, cast(s as int) as step, substr(filter_order, s, 1) as f, substr(filter_order, 1, s - 1) as before
  from orders cross join range(1, 6) r(s)),
states as (select *, contains(fails, f) as hit,
  len(list_filter(string_split(fails, ''), lambda c: c <> '' and contains(before, c))) > 0 as gone from kinds cross join steps),
counted as (select part, filter_order, step, f, coalesce(sum(n) filter (not gone and not hit), 0)::bigint as kept,
  coalesce(sum(n) filter (not gone and hit), 0)::bigint as removed, coalesce(sum(n) filter (gone and hit), 0)::bigint as redundant,
  coalesce(sum(n) filter (fails = f), 0)::bigint as unique_fails, coalesce(sum(g) filter (not gone and hit), 0)::bigint as good_lost,
  coalesce(sum(x) filter (not gone and hit), 0)::bigint as toxic_lost from states group by part, filter_order, step, f)
select * exclude (f), sum(removed) over (partition by part, f)::bigint as shapley from counted"""


@query
def op13_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector. A deviation that no long can hold is null; the operator gives it as a decimal."""
    done = whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id")
    return done.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("long").alias("deviation"),
                       "whitened", "explained", "identity_error")

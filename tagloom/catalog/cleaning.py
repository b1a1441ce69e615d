"""Sources, cleaning, merge and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom import fixed
from tagloom.catalog.tables import (WS, cte, docs, override, override_rows, query, raw_records, sql_strip,
                                    sql_words, table)
from tagloom.functions import labels as lb
from tagloom.functions import text as tx
from tagloom.operators import clean, ranking
from tagloom.plans import cleaning as plan
from tagloom.session import names_table, scratch_path, written
from tagloom.sources import conllu, csvfiles, jsonfiles

RECORD = "movie_id, movie_name, description, genre"
# Placeholder patterns spelled for the SQL engine (no \b there that knows all letters).
EDGE_L, EDGE_R = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
SQL_PATTERNS = [p.replace(r"\bTBA\b", f"{EDGE_L}TBA{EDGE_R}").replace(r"\b", EDGE_L)
                for p in fixed.PLACEHOLDER_PATTERNS]
PLACEHOLDER = " or ".join(f"regexp_matches(description, '{p}', 'i')" for p in SQL_PATTERNS)
EXCLUDED = "|".join(fixed.EXCLUDED_LABELS)
SUFFIX_FREE = sql_strip(f"regexp_replace(description, '{fixed.TRUNCATION_SUFFIX}', '')")

cte("kept", f"""select * from raw where movie_id is not null and movie_name is not null and description is not null
  and genre is not null and not regexp_matches(genre, '{EXCLUDED}', 'i')""", "raw")
cte("merged", f"""select movie_id, movie_name, l.labels,
  coalesce(d.description, '{fixed.EMPTY_TEXT}') as description
from (select movie_id, movie_name, string_agg(label, '|' order by label) as labels from (
        select distinct movie_id, movie_name, {sql_strip('part')} as label
        from (select movie_id, movie_name, unnest(string_split(genre, ', ')) as part from kept))
      group by movie_id, movie_name) l
join (select movie_id, movie_name,
        arg_min(description, row(-length(description), description)) filter (where description <> '{fixed.EMPTY_TEXT}') as description
      from kept group by movie_id, movie_name) d using (movie_id, movie_name)""", "kept")
cte("overridden", """select m.movie_id, m.movie_name, m.labels, coalesce(o.description, m.description) as description
from merged m left join override o using (movie_id)""", "merged", "override")
cte("repaired", f"""select movie_id, movie_name, labels, {sql_strip("regexp_replace(x, '—[^\\n]*$', '')")} as description
from (select movie_id, movie_name, labels, {SUFFIX_FREE} as x from overridden where not ({PLACEHOLDER}))""", "overridden")
cte("by_text", """select * exclude (rn) from (
  select *, row_number() over (partition by description order by movie_id, movie_name) as rn from repaired) where rn = 1""",
    "repaired")
cte("cleaned", """select * exclude (rn) from (
  select *, row_number() over (partition by movie_id order by movie_id, movie_name) as rn from by_text) where rn = 1""",
    "by_text")


def joined(df):
    return df.withColumn("labels", F.array_join("labels", "|"))


# --- sources and sinks -----------------------------------------------------------------------

@query("scan_union", """select movie_id, case when starts_with(genre, 'en') then movie_name end as movie_name,
  description, genre from raw""", ("raw",))
def scan_union(spark, sf):
    """Two groups of CSV files with different columns, written from the documents."""
    raw = raw_records(spark, sf)
    base = scratch_path(spark, "raw")
    english = F.startswith("genre", F.lit("en"))
    csvfiles.write_csv_all_quoted(raw.filter(english), f"{base}/english")
    csvfiles.write_csv_all_quoted(raw.filter(~english).select("genre", "movie_id", "description"), f"{base}/other")
    files = csvfiles.list_files(spark, f"{base}/*/*.csv")
    return csvfiles.scan_union(spark, files, csvfiles.RECORD_SCHEMA)


@query("read_override", "select movie_id, description from override", ("override",))
def read_override(spark, sf):
    path = scratch_path(spark, "override")
    rows = override_rows(spark, sf).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    csvfiles.write_csv_all_quoted(rows.select("ids", F.coalesce("plots", F.lit("NaN")).alias("plots")), path)
    return csvfiles.read_override(spark, path)


ROLES = ["assistant", "system", "user"]
cte("turns", f"""select concat('tt', cast(conv_id as varchar)) as movie_id, cast(turn + 1 as int) as sent_no, role,
  regexp_replace({sql_strip('text')}, '[{WS}]+', ' ', 'g') as sentence, {sql_words('text')} as forms from conversations""")


def conversation_files(spark, sf):
    """Conversations written as a CoNLL-U corpus: one record per conversation, a sentence per turn."""
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("tt"), F.col("conv_id").cast("string")).alias("movie_id"),
        (F.col("turn") + 1).cast("int").alias("sent_no"), "role", "text")
    records = turns.groupBy("movie_id").agg(F.collect_set("role").alias("roles")).select(
        "movie_id", lb.encode_labels(F.col("roles"), ROLES).alias("genre"))
    tokens = turns.select("movie_id", "sent_no", F.posexplode(tx.words(F.col("text"))).alias("i", "form")) \
        .select("movie_id", "sent_no", (F.col("i") + 1).alias("tok_no"), "form",
                F.lower("form").alias("lemma"), F.lit("X").alias("upos"))
    path = scratch_path(spark, "conllu")
    conllu.write_conllu(records, turns.select("movie_id", "sent_no", "text"), tokens, path)
    return path


@query("scan_conllu", """select movie_id,
  concat('[', cast(max(cast(role = 'assistant' as int)) as varchar), ' ', cast(max(cast(role = 'system' as int)) as varchar),
         ' ', cast(max(cast(role = 'user' as int)) as varchar), ']') as genre,
  coalesce(string_agg(sentence, ' ' order by sent_no) filter (where len(forms) > 0), '') as description,
  coalesce(string_agg(lower(array_to_string(forms, ' ')), ' ' order by sent_no) filter (where len(forms) > 0), '') as lemmas
from turns group by movie_id""", ("turns",))
def scan_conllu(spark, sf):
    found = conllu.scan_conllu(spark, conversation_files(spark, sf))
    return found.select(
        "movie_id", F.concat(F.lit("["), F.array_join(F.col("genre").cast("array<string>"), " "), F.lit("]")).alias("genre"),
        "description", F.array_join("lemmatized_description", " ").alias("lemmas"))


@query("write_conllu", """select movie_id, cast(sent_rank as int) as sent_no, cast(i as int) as tok_no, forms[i] as form, lower(forms[i]) as lemma
from (select *, unnest(range(1, len(forms) + 1)) as i from (
  select *, row_number() over (partition by movie_id order by sent_no) as sent_rank from turns where len(forms) > 0))""",
       ("turns",))
def write_conllu(spark, sf):
    """The written corpus read back at token grain."""
    return conllu.scan_tokens(spark, conversation_files(spark, sf)).drop("upos")


@query("parse_label_list", "select doc_id as id, concat(lang, '|', source) as labels from documents")
def parse_label_list(spark, sf):
    text = F.concat(F.lit("['"), F.col("lang"), F.lit("' '"), F.col("source"), F.lit("']"))
    return docs(spark, sf).select("id", F.array_join(lb.parse_label_list(text), "|").alias("labels"))


@query("parse_token_list", f"""select doc_id as id, array_to_string({sql_words("regexp_replace(text, '[\\[\\],'']', '', 'g')")}, ' ') as tokens
from documents""")
def parse_token_list(spark, sf):
    """Token lists of all texts written as "['a', 'b']" and parsed again."""
    quoted = F.transform(tx.words(F.regexp_replace("description", r"[\[\],']", "")),
                         lambda w: F.concat(F.lit("'"), w, F.lit("'")))
    text = F.concat(F.lit("["), F.array_join(F.filter(quoted, lambda w: F.length(w) > 2), ", "), F.lit("]"))
    return docs(spark, sf).select("id", lb.parse_token_list(text).alias("tokens"))


@query("write_csv_all_quoted", "select movie_id, movie_name, labels, description from cleaned", ("cleaned",))
def write_csv_all_quoted(spark, sf):
    """Clean records written with all fields quoted, array labels as strings, and read back."""
    path = scratch_path(spark, "clean")
    csvfiles.write_csv_all_quoted(plan.clean_records(raw_records(spark, sf), override(spark, sf)), path)
    back = csvfiles.scan_union(spark, csvfiles.list_files(spark, f"{path}/*.csv"))
    return joined(back.withColumn("labels", lb.parse_label_list(F.col("labels"))))


@query("write_json", "select distinct label from (select unnest(string_split(labels, '|')) as label from repaired)", ("repaired",))
def write_json(spark, sf):
    """The label vocabulary as JSON, read back."""
    path = scratch_path(spark, "vocabulary")
    records = plan.repaired_records(raw_records(spark, sf), override(spark, sf))
    jsonfiles.write_vocabulary(clean.label_vocabulary(records), path)
    names = jsonfiles.read_vocabulary(spark, path)
    return names_table(spark, names)


@query("head_n", f"select {RECORD} from raw order by doc_id limit 100", ("raw",))
def head_n(spark, sf):
    return ranking.head_n(raw_records(spark, sf), 100, ["doc_id"]).drop("doc_id")


@query("sample_every", """select doc_id as id, n_chars from (
  select doc_id, n_chars, row_number() over (order by doc_id) - 1 as pos from documents) where pos % 7 = 0""")
def sample_every(spark, sf):
    """Systematic 1-in-7 sample in id order."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    return ranking.sample_every(d, 7, ["id"])


# --- filters and projections ------------------------------------------------------------------

@query("project_used", f"select {RECORD} from raw", ("raw",))
def project_used(spark, sf):
    return clean.project_used(raw_records(spark, sf))


cte("holed", """select r.movie_id, r.movie_name, case when o.toxic = 1 then null else r.description end as description,
  case when o.quality = 0 then null else r.genre end as genre from raw r left join labels o using (doc_id)""", "raw")


@query("drop_incomplete", f"select {RECORD} from holed where description is not null and genre is not null", ("holed",))
def drop_incomplete(spark, sf):
    marks = table(spark, sf, "labels")
    holed = raw_records(spark, sf).join(marks, "doc_id", "left") \
        .withColumn("description", F.when(F.col("toxic") == 1, None).otherwise(F.col("description"))) \
        .withColumn("genre", F.when(F.col("quality") == 0, None).otherwise(F.col("genre")))
    return clean.drop_incomplete(clean.project_used(holed))


@query("exclude_labels", f"select {RECORD} from raw where not regexp_matches(genre, '{EXCLUDED}', 'i')", ("raw",))
def exclude_labels(spark, sf):
    return clean.exclude_labels(clean.project_used(raw_records(spark, sf)))


@query("drop_placeholders", f"select {RECORD} from raw where not ({PLACEHOLDER})", ("raw",))
def drop_placeholders(spark, sf):
    return clean.drop_placeholders(clean.project_used(raw_records(spark, sf)))


FIRST = "case " + " ".join(f"when regexp_matches(description, '{p}', 'i') then {i}"
                           for i, p in enumerate(SQL_PATTERNS)) + " end"


@query("placeholder_counts", f"""select cast(i as int) as pattern_no, count(first) as removed
from range({len(SQL_PATTERNS)}) t(i) left join (select {FIRST} as first from raw) on first = i group by i
union all select -1, count(*) from raw where {PLACEHOLDER}""", ("raw",))
def placeholder_counts(spark, sf):
    return clean.placeholder_counts(raw_records(spark, sf)).drop("pattern")


@query("strip_truncation_suffix", f"select movie_id, movie_name, {SUFFIX_FREE} as description, genre from raw", ("raw",))
def strip_truncation_suffix(spark, sf):
    return clean.strip_truncation_suffix(clean.project_used(raw_records(spark, sf)))


@query("count_truncation_suffix", f"select count(*) as truncated from raw where regexp_matches(description, '{fixed.TRUNCATION_SUFFIX}')", ("raw",))
def count_truncation_suffix(spark, sf):
    return clean.count_truncation_suffix(raw_records(spark, sf))


@query("strip_signature", f"""select movie_id, movie_name, {sql_strip("regexp_replace(description, '—[^\\n]*$', '')")} as description, genre
from raw""", ("raw",))
def strip_signature(spark, sf):
    return clean.strip_signature(clean.project_used(raw_records(spark, sf)))


@query("prune_by_length", f"""select {RECORD} from raw
where len(string_split(description, ' ')) > {fixed.MIN_WORDS} and len(string_split(description, ' ')) < {fixed.MAX_WORDS}""", ("raw",))
def prune_by_length(spark, sf):
    return clean.prune_by_length(clean.project_used(raw_records(spark, sf)))


@query("drop_meta_text", f"select {RECORD} from raw where not regexp_matches(description, '{'|'.join(fixed.META_PHRASES)}', 'i')", ("raw",))
def drop_meta_text(spark, sf):
    return clean.drop_meta_text(clean.project_used(raw_records(spark, sf)))


@query("clean_lemmas", f"""select doc_id as id, array_to_string(list_filter({sql_words("replace(replace(text, '\" \"', ''), '_', '')")},
  lambda w: length(w) > 1), ' ') as lemmas from documents""")
def clean_lemmas(spark, sf):
    return docs(spark, sf).select("id", tx.clean_lemmas(F.col("description")).alias("lemmas"))


@query("needs_override", """select distinct movie_id from raw
where contains(description, 'See full summary') or contains(description, 'Add a Plot')""", ("raw",))
def needs_override(spark, sf):
    return clean.needs_override(raw_records(spark, sf))


@query("count_truncated", "select count(*) as truncated from raw where contains(description, 'See full summary')", ("raw",))
def count_truncated(spark, sf):
    return clean.count_truncated(raw_records(spark, sf))


@query("drop_label", "select id, source as labels from docs where lang = 'en' union all select id, concat(lang, '|', source) from docs where lang <> 'en'", ("docs",))
def drop_label(spark, sf):
    return joined(clean.drop_label(docs(spark, sf).select("id", "labels"), "en"))


KEEP = ["en", "fr", "src1", "src2"]


@query("keep_labels", """select id, string_agg(label, '|' order by label) as labels from doc_labels
where label in ('en', 'fr', 'src1', 'src2') group by id""", ("doc_labels",))
def keep_labels(spark, sf):
    return joined(clean.keep_labels(docs(spark, sf).select("id", "labels"), KEEP))


@query("label_slice", "select id, cast(lang = 'fr' as int) as y from docs", ("docs",))
def label_slice(spark, sf):
    return clean.label_slice(docs(spark, sf), "fr").select("id", "y")


# --- merge, override, de-duplicate ---------------------------------------------------------------

@query("merge_groups", "select movie_id, movie_name, labels, description from merged", ("merged",))
def merge_groups(spark, sf):
    return joined(plan.merged_records(raw_records(spark, sf)))


@query("longest_text", f"""select movie_id,
  coalesce(arg_min(description, row(-length(description), description)) filter (where description <> '{fixed.EMPTY_TEXT}'),
           '{fixed.EMPTY_TEXT}') as description from raw group by movie_id""", ("raw",))
def longest_text(spark, sf):
    return raw_records(spark, sf).groupBy("movie_id").agg(
        clean.longest_text(F.col("description")).alias("description"))


@query("override_text", "select movie_id, movie_name, labels, description from overridden", ("overridden",))
def override_text(spark, sf):
    return joined(clean.override_text(plan.merged_records(raw_records(spark, sf)), override(spark, sf)))


@query("missing_ids", """select distinct movie_id from raw
where (contains(description, 'See full summary') or contains(description, 'Add a Plot'))
  and movie_id not in (select ids from override_rows where plots is not null)""", ("raw", "override_rows"))
def missing_ids(spark, sf):
    got = override_rows(spark, sf).select(F.col("ids").alias("movie_id"), F.col("plots").alias("description"))
    return clean.missing_ids(clean.needs_override(raw_records(spark, sf)), got)


@query("dedup_by_text", "select movie_id, movie_name, labels, description from by_text", ("by_text",))
def dedup_by_text(spark, sf):
    return joined(clean.dedup_by_text(plan.repaired_records(raw_records(spark, sf), override(spark, sf))))


@query("dedup_by_id", "select movie_id, movie_name, labels, description from cleaned", ("cleaned",))
def dedup_by_id(spark, sf):
    kept = clean.dedup_by_text(plan.repaired_records(raw_records(spark, sf), override(spark, sf)))
    return joined(clean.dedup_by_id(kept))


@query("label_vocabulary", "select distinct label from (select unnest(string_split(labels, '|')) as label from repaired)", ("repaired",))
def label_vocabulary(spark, sf):
    return clean.label_vocabulary(plan.repaired_records(raw_records(spark, sf), override(spark, sf)))


cte("clean_voc", "select label, row_number() over (order by label) as i from (select distinct unnest(string_split(labels, '|')) as label from repaired)", "repaired")


@query("clean_pipeline", """select c.movie_id, c.movie_name, c.labels, c.description,
  (select string_agg(case when list_contains(string_split(c.labels, '|'), v.label) then '1' else '0' end, ' ' order by v.i) from clean_voc v) as encoded
from cleaned c""", ("cleaned", "clean_voc"))
def clean_pipeline(spark, sf):
    """The whole cleaning run, with labels also as a 0/1 vector."""
    repaired = written(plan.repaired_records(raw_records(spark, sf), override(spark, sf)), "repaired")
    names = clean.load_vocabulary(repaired)
    done = plan.unique_records(repaired)
    hot = lb.encode_labels(F.col("labels"), names)
    return joined(done.withColumn("encoded", F.array_join(hot.cast("array<string>"), " ")))


@query("clean_label_distribution", """select label, count(*) as n from (select unnest(string_split(labels, '|')) as label from cleaned)
group by label""", ("cleaned",))
def clean_label_distribution(spark, sf):
    """Cleaning run followed by the label distribution: the flagship query."""
    from tagloom.operators import explore

    return explore.label_distribution(plan.clean_records(raw_records(spark, sf), override(spark, sf)))


@query("union_all", "select movie_id, description from raw union all select movie_id, description from override", ("raw", "override"))
def union_all(spark, sf):
    return raw_records(spark, sf).select("movie_id", "description").unionByName(override(spark, sf))

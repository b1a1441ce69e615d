"""Chat formatting, personal data, main text, neighbours and the pipeline."""

import hashlib
import html
import random
import re
import time
import tracemalloc

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import TABLES, compare
from tagloom.llm import chat, htmlcrf, pii, queries, rpforest

# --- queries with SQL ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    note = compare(queries.QUERIES[name](spark, sf), con, queries.ORACLES[name])
    assert note.startswith("ok") and "TYPES" not in note, note


# --- chat ----------------------------------------------------------------------------------------------------------


def test_every_conversation_reads_back(spark):
    rng = random.Random(1)
    bits = ["### ", "</turn>", "\\", "\n", ": ", "user", "a", "#", "<", "/turn>", "\\#", "### user: x</turn>\n### assistant: y", "é", "😀"]
    rows = []
    for c in range(150):
        for n in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", "", None, "a: b", "x:", "### ", "\\"])
            rows.append((c, rng.choice([n, n, None]), role, rng.choice([None, "".join(rng.choices(bits, k=rng.randint(0, 12)))])))
    rows += [rows[0], (None, 0, "user", "lost"), (999, 0, "assistant", "long \\ " * 30000)]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in got.withColumn("turns", chat.parsed(F.col("formatted"))).collect()}
    assert len(got) == 152
    for c, r in got.items():
        source = sorted((n is not None, n or 0, role or "", text or "") for i, n, role, text in rows if i == c)
        assert r["identical"] and [tuple(t) for t in r["turns"]] == [x[2:] for x in source]
        loss = [re.sub(r"(?s)\\(.)", r"\1", r["formatted"][s["start"] : s["end"]]) for s in r["loss_spans"]]
        assert loss == [x[3] for x in source if x[2] == "assistant"]


def test_plain_turns_are_not_escaped(spark):
    rows = [(1, 0, "user", "a < b # c: d")]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert got["formatted"] == "### user: a < b # c: d</turn>\n"
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_the_probe_conversation(spark, sf):
    text = "\\### Assistant: </turn> ok"
    r = queries.op4_chat_round_trip(spark, sf).where("conv_id = -7").first()
    assert r["n_turns"] == 2 and r["loss_chars"] == len(text)
    assert r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


# --- personal data -------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        twice = int(c) * 2
        total += (twice - 9 if twice > 9 else twice) if i % 2 else int(c)
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", m.group())
            if name == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if name == "card" and not (14 <= len(number) <= 19 and luhn(number)):
                continue
            if name == "phone" and not 10 <= len(number) <= 15:
                continue
            out.append((m.start(), k, name, m.end()))
    return ",".join(f"{n}:{s}:{e}" for s, _, n, e in sorted(out))


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(5)
    bits = ["1", "2", "4", "11", "4111111111111111", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "_", "%", "\n", "é", "😀", "255", "256"]
    texts = ["", "a@b.c-d.e@f.g.h", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 0000001.2.3.255 256.1.1.1", "é 4111 1111 1111 1111 x4111-1111-1111-1111-",
             "+1 (555) 555-5657 +12 3 4567890 +", "4" * 5000, "a." * 20000, "a@" + "b." * 20000, "1." * 20000, "+1" + " " * 30000, "1-" * 10000]
    texts += ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(1500)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, None), (0, "")]
    found = pii.find(spark.createDataFrame(rows, "id int, text string"))
    got = found.select("text", pii.listed(F.filter("pii", lambda x: x["kind"] < 4)).alias("s")).collect()
    assert [r["s"] for r in got] == [base_spans(r["text"] or "") for r in got]


def test_added_kinds_and_masking(spark):
    text = "pay GB82 WEST 1234 5698 7654 32, not DE89370400440532013001. call me: (212) 555-0199; mail a@b.co" + "." * 60 + "212-555-0100"
    r = pii.find(spark.createDataFrame([(text, 1)], "text string, kind int")).withColumn("m", pii.masked(F.col("text"), F.col("pii"))).first()
    assert [x["name"] for x in r["pii"]] == ["iban", "tel", "email"] and all(x["score"] >= 0.5 for x in r["pii"])
    assert r["m"] == "pay [IBAN], not DE89370400440532013001. call me: [TEL]; mail [EMAIL]" + "." * 60 + "212-555-0100"
    assert pii.find(spark.createDataFrame([], "text string")).count() == 0


def test_account_codes_end_where_their_country_says(spark):
    texts = {"IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX": "IBAN [IBAN] BIC COBADEFFXXX", "GB82 WEST 1234 5698 7654 32 I will": "[IBAN] I will",
             "DE89370400440532013000 2024": "[IBAN] 2024", "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32": "[IBAN] [IBAN]",
             "BE12 DE89 3704 0044 0532 0130 00 X": "BE12 [IBAN] X", "é NO93 8601 1117 947, MT84 MALT 0110 0001 2345 MTLC AST0 01S 7": "é [IBAN], [IBAN] 7",
             "DE89 3704 0044 0532 0130 01 BIC": "DE89 3704 0044 0532 0130 01 BIC", "DE89370400440532013000X": "DE89370400440532013000X",
             "XDE89370400440532013000": "XDE89370400440532013000"}
    rows = pii.find(spark.createDataFrame([(t,) for t in texts], "text string")).withColumn("m", pii.masked(F.col("text"), F.col("pii"))).collect()
    assert {r["text"]: r["m"] for r in rows} == texts


# --- main text -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("page,blocks", [
    ('<p title="a<b">Hello there</p>', ["Hello there"]), ('<p>x <img alt="5 < 6"> y</p>', ["x y"]), ('<div data-x="<i>q</i>">z</div>', ["z"]),
    ("<p data='a>b<c'>k</p>", ["k"]), ("<a href=/x/>link</a> after", ["link after"]), ("<p title=don't>text</p> it's <b>ok</b>", ["text", "it's ok"]),
    ('<a href="x>text</a><b class="y">bold</b>', ["textbold"]), ("<p>a <math><mi>x</mi></math> b</p>", ["a x b"]), ("<span/>q", ["q"]),
    ('<p a="x"b="y<z">s</p>', ["s"]), ("a < b and c > d", ["a < b and c > d"]), ('<p x="unclosed>still here', ["still here"])])
def test_attributes_leave_no_markup(page, blocks):
    assert [t for t, _ in htmlcrf.Reader().read(page)] == blocks


def test_a_slash_that_ends_a_value_does_not_end_the_link():
    (_, names), = htmlcrf.Reader().read("<a href=/x/>all of it</a>")
    assert "link=4" in names


def test_many_open_elements_and_quotes_take_linear_time():
    for part in ("<b>x", '<a b="', "<a b='", '<a ="<" ', "<b>x<p>y"):
        start = time.process_time()
        htmlcrf.Reader().read(part * 100_000)
        assert time.process_time() - start < 20


@pytest.fixture(scope="module")
def page_model(spark, sf):
    return htmlcrf.fit(spark.read.parquet(f"{sf}/pages.parquet"))


def test_given_pages(spark, sf, page_model):
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert page_model.main_text(r["html"]) == "\n".join(b for b in blocks if b)


def test_other_layouts(page_model):
    body = "<h1>A title of words</h1><p>First long paragraph of the story, told here.</p><ul><li>An item &amp; more</li></ul><p>Second  one &#233;.</p>"
    wanted = "A title of words\nFirst long paragraph of the story, told here.\nAn item & more\nSecond one é."
    around = ("<header><div class='logo'>Site</div></header><div class='cookie notice'><p>We use cookies here.</p></div><nav><a href='/'>Home</a></nav>",
              "<section class='comments'><h2>Comments</h2><div class='comment'><p>I liked this story very much, thanks.</p></div></section>"
              "<form class='newsletter'><p>Sign up for our letters.</p></form><footer>&copy; Site</footer>")
    for start, stop in (("<article>", "</article>"), ("<main id='main'>", "</main>"), ("<div class='post-content'>", "</div>")):
        page = f"<html><head><title>x</title><script>var a='<p>no</p>';</script></head><body>{around[0]}{start}{body}{stop}{around[1]}</body></html>"
        assert page_model.main_text(page) == wanted


def test_pages_that_leave_tags_out(page_model):
    story = "<p>First long paragraph of the story, told here.</p><p>Second one, with more words in it.</p>"
    wanted = "First long paragraph of the story, told here.\nSecond one, with more words in it."
    for head in ("<head><meta charset=utf-8><title>no</title><script>no</script><style>no</style><link rel=x>", "<head>", "<head><title>no</title></head>"):
        for body, end in (("<body>", "</body>"), ("<body class='x'>", ""), ("", "")):
            assert page_model.main_text(f"<!doctype html><html>{head}\n{body}<article>{story}</article>{end}") == wanted
    assert [t for t, _ in htmlcrf.Reader().read("<html><head><title>no</title>\n Words at once <b>and more</b>")] == ["Words at once and more"]


def test_letters_count_wherever_they_stand():
    assert "letterless" in htmlcrf.text_features("12 " * 200, 0)
    assert "letterless" not in htmlcrf.text_features("12 " * 200 + "and words", 0)


def test_odd_pages(spark, page_model):
    assert page_model.main_text(None) == page_model.main_text("") == ""
    for page in ("<", "<p", "<a b='", "</p></div>", "<!-- x", "<script>", "<p><b>x<p>y", "&#xD800;&copy", "<div>" * 5000, "<a '" * 20000, "<br/><br>", "a<b"):
        page_model.main_text(page)
    assert page_model.main_text("<article><p>" + "word " * 200000 + "</p></article>") == " ".join(["word"] * 200000)
    pages = spark.createDataFrame([(1, None), (2, "")], "page_id long, html string")
    assert [r["t"] for r in pages.select(htmlcrf.extract("html", htmlcrf.fit(pages)).alias("t")).collect()] == ["", ""]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 7))
        scores, start, moves = rng.normal(size=n).tolist(), rng.normal(size=2), rng.normal(size=(2, 2))
        model = htmlcrf.Model({}, tuple(start), tuple(map(tuple, moves)))
        paths = [[(k >> i) & 1 for i in range(n)] for k in range(2**n)]

        def value(p):
            return start[p[0]] + sum(moves[a][b] for a, b in zip(p, p[1:])) + sum(s for s, y in zip(scores, p) if y)

        assert value(model.labels(scores)) == pytest.approx(max(map(value, paths)))


# --- neighbours ----------------------------------------------------------------------------------------------------


def nearest(rows, k, step):
    rows = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q, x in rows.items():
        if q % step == 0:
            score = {i: float((x @ v) / np.sqrt((x @ x) * (v @ v))) for i, v in rows.items() if i != q}
            out[q] = sorted(score, key=lambda i: (-score[i], i))[:k]
    return out


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    wanted = nearest([tuple(r) for r in vectors.select("vec_id", "embedding").collect()], 5, 50)
    got = {}
    for r in queries.op6_projection_forest(spark, "/root/testdata/sf0.01").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(wanted) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[q]) & set(wanted[q])) / 5 for q in wanted]) >= 0.9


def test_ties_nulls_and_small_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (9, [1.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = rpforest.search(vectors, "id % 5 = 0").orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 10), (0, 4, 3), (10, 1, 0), (10, 2, 1), (10, 3, 2), (10, 4, 3)]
    assert [r["score"] for r in got[:4]] == [1.0, 1.0, 1.0, 0.0]
    assert rpforest.search(vectors.where("false"), "id % 5 = 0").count() == 0


def test_crowded_leaf_is_dealt_out(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(300 + i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = rpforest.search(vectors, "id = 150", settings=rpforest.Settings(block=32)).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4]


def test_queries_of_a_crowded_leaf_are_dealt_out(spark):
    index = spark.range(300).selectExpr("id", "cast('' as binary) as v", "0 as tree", "cast(id % 2 as int) as leaf")
    asked = spark.range(1000).selectExpr("id as q", "cast('' as binary) as qv", "0 as tree", "if(id < 990, 0, 1) as leaf")
    index, asked = rpforest.dealt(index, asked, np.array([[150, 150]]), np.array([[990, 10]]), 100)
    for side in (index, asked):
        assert max(r["count"] for r in side.groupBy("tree", "leaf", "block", "part").count().collect()) <= 200
    met = index.join(asked, ["tree", "leaf", "block", "part"]).groupBy("id", "q").count()
    assert met.count() == 150 * 990 + 150 * 10 and met.where("count > 1").count() == 0


def test_many_tied_vectors_are_compared_in_slices():
    def frame(name, v, vectors):
        return pd.DataFrame({name: np.arange(len(vectors)), v: [x.tobytes() for x in vectors]})

    one = np.arange(1.0, 65.0)
    for scale in (np.ones(1500), np.arange(1, 1501)):  # equal vectors, and such as only point the same way
        x = scale[:, None] * one
        tracemalloc.start()
        got = rpforest.compare(frame("id", "v", x), frame("q", "qv", x[:1000]), 5, 64)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200 << 20
        assert len(got) == 5000
        if scale[1] == 1:
            assert got.groupby("q")["id"].apply(list).tolist() == [[i for i in range(6) if i != q][:5] for q in range(1000)]
    assert not len(rpforest.compare(frame("id", "v", x[:1]), frame("q", "qv", x[:1]), 5, 64))
    assert not len(rpforest.compare(frame("id", "v", x[:0]), frame("q", "qv", x[:1]), 5, 64))


# --- pipeline ------------------------------------------------------------------------------------------------------


def test_pipeline_on_the_given_documents(spark, sf):
    """Stage by stage against what each operator says of its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, sf).cache()
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) > 0.5 * len(before)
        if name != "tokens":
            assert docs.columns == names
        if name == "personal_data":
            for i, r in after.items():
                spans = base_spans(before[i]["text"] or "")
                assert (r["text"] == before[i]["text"]) == (not spans) and r["n_chars"] == len(r["text"])
                assert not base_spans(r["text"])
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in after.values())


def test_pipeline_edge_cases(spark, sf):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "some words", "y"), (3, "mail a@b.co now", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    got = docs.collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "3", "None"]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0

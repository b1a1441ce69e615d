"""Toxicity, language, URL filter, decontamination and tokenizer on small fixtures and against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import arrays, decontaminate, langid, piecebpe, queries, toxicity, urlfilter

# --- toxicity ------------------------------------------------------------------------------------------------------


def labelled(spark, n=400):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        words = rng.choices([f"word{k}" for k in range(200)], k=40)
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["Grobian", "LOSERISH!"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_separates_unseen_rows(spark):
    rows = labelled(spark)
    model = toxicity.fit(rows, rows.where("doc_id < 300"), "toxic")
    got = rows.where("doc_id >= 300").withColumn("s", toxicity.score("text", model)).collect()
    assert all((r["s"] >= 0.3) == bool(r["toxic"]) for r in got)
    assert 0 < len(model.coordinates) < 2000


def test_toxicity_edge_cases(spark):
    rows = labelled(spark, 80)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "word1 " * 50000)], "doc_id long, text string")
    model = toxicity.fit(rows.union(rows), rows.select("doc_id", "toxic").union(rows.select("doc_id", "toxic")), "toxic")
    scores = [r["s"] for r in odd.withColumn("s", toxicity.score("text", model)).orderBy("doc_id").collect()]
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores)
    none = toxicity.fit(odd, rows.where("false"), "toxic")
    assert [r["s"] for r in odd.select(toxicity.score("text", none).alias("s")).collect()] == [0.0] * 3
    assert odd.where("false").select(toxicity.score("text", model)).count() == 0


def test_features_do_not_depend_on_slices():
    texts = pa.array(["one two three", "two three", "", "Ünï cödé wörd"], pa.large_string())
    row, at = toxicity.features(texts)
    alone = [toxicity.features(texts.slice(i, 1))[1] for i in range(4)]
    assert all((at[row == i] == alone[i]).all() for i in range(4))


def test_toxicity_query_on_the_given_tables(spark, sf):
    got = queries.op3_ftrl_toxicity(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


# --- language ------------------------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op10_string_kernel_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    right = got.select(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97


def test_language_edge_cases(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "die katze sitzt auf der matte", "de"), (3, None, "de"), (4, "", "en"), (5, "123 !!", "en"),
            (6, "the dog " * 30000, None), (1, "the cat sat on the mat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", langid.predict(F.col("text"), model).alias("p")).collect()}
    assert (got[1]["lang"], got[2]["lang"], got[6]["lang"]) == ("en", "de", "en")
    assert [(got[i]["lang"], got[i]["score"]) for i in (3, 4, 5)] == [("und", 0.0)] * 3
    nothing = langid.fit(docs.where("false"))
    assert {r["p"]["lang"] for r in docs.select(langid.predict(F.col("text"), nothing).alias("p")).collect()} == {"und"}


def test_language_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"the house {i} of the river", "en") for i in range(10, 50)] + [(2, "das haus und der fluss", "de")], "doc_id long, text string, lang string")
    model = langid.fit(docs, settings=langid.Settings(max_rows=60, landmarks=64))
    # Texts that differ in digits only have equal n-grams.
    assert model.landmarks.shape[0] == 41 and len(np.unique(model.landmarks, axis=0)) == 2
    assert langid.fit(docs, settings=langid.Settings(max_rows=8)).landmarks.shape[0] <= 8


def test_kernel_counts_common_ngrams():
    texts = ["abcab", "bca", "xyz"]

    def grams(t):
        return {t[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1)}

    bits = langid.presence(pa.array(texts, pa.large_string()))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert int((bits[i] & bits[j]).sum()) == len(grams(a) & grams(b))


# --- URLs ----------------------------------------------------------------------------------------------------------


def test_rules_host_and_path(spark):
    rules = {"net/": "block", "example.net/en/": "allow", "org/fr/": "allow"}
    urls = ["http://A.Example.NET/en/1?x", "https://example.net/de/#y", "http://notexample.net/en/", "http://x.org/fr/", "http://x.org", "org/fr/", None,
            "ftp://net/a", "http://net", "a://b://c/d"]
    got = urlfilter.judge(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string"), rules, ["bad"]).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"]) for r in got] == [
        ("a.example.net", "/en/1", "example.net/en/"), ("example.net", "/de/", "net/"), ("notexample.net", "/en/", "net/"), ("x.org", "/fr/", "org/fr/"),
        ("x.org", "", None), ("", "", None), ("", "", None), ("net", "/a", "net/"), ("net", "", None), ("b:", "//c/d", None)]
    assert [r["verdict"] for r in got[:4]] == ["allow", "block", "block", "allow"]
    assert {r["verdict"] for r in got} <= {"allow", "block"}


def test_model_blocks_what_looks_like_rejected(spark):
    rng = random.Random(4)
    hosts = [f"www.{a}{b}.com" for a in ("green", "blue", "red", "old") for b in ("house", "garden", "river", "stone")]
    spam = [f"casino-{a}{b}.com" for a in ("win", "luck", "spin") for b in ("777", "888", "now")]
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.randrange(999)}") for i in range(400)] + [(400 + i, f"http://{rng.choice(spam)}/{rng.randrange(999)}") for i in range(100)]
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(spark.createDataFrame(rows, "page_id int, url string"), {}, ["casino"]).collect()}
    assert [got[i] for i in range(400)] == ["allow"] * 400 and [got[400 + i] for i in range(100)] == ["block"] * 100
    # URLs that neither model has counted.
    text = F.regexp_replace("url", "^http://", "")
    model = urlfilter.fit(spark.createDataFrame(rows, "page_id int, url string").select(text.alias("text"), (F.col("page_id") < 400).alias("accepted")))
    unseen = model.score(pa.array(["casinos-winluck.com/5", "www.greenriverside.com/5"], pa.large_string()))
    assert unseen[0] < model.threshold <= unseen[1]


def test_probabilities_sum_to_one():
    counts = np.zeros(32**4)
    _, code = urlfilter.grams(pa.array(["example.com/a", "", "ex.org"], pa.large_string()))
    np.add.at(counts, code, 1)
    assert np.allclose(np.exp(urlfilter.log_probabilities(counts)).reshape(-1, 32).sum(axis=1), 1)


def test_url_query_without_rows(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(empty, {"net/": "block"}, ["bad"]).count() == 0


# --- decontamination -----------------------------------------------------------------------------------------------


def edits(pattern, text):
    """Fewest edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_search_equals_alignment_of_every_window():
    rng = random.Random(6)
    letters = "abcdefgh "
    s = decontaminate.Settings()
    items = [(k, "".join(rng.choices(letters, k=n)).strip()) for k, n in enumerate((81, 120, 150, 260))]
    index = decontaminate.Index(items, s)
    texts = []
    for _ in range(30):
        k, passage = rng.choice(items)
        chars = list(passage)
        for _ in range(rng.choice([0, 2, 5, 8, 11, 14, 20])):
            at = rng.randrange(len(chars))
            kind = rng.randrange(3)
            chars[at : at + 1] = [] if kind == 0 else [rng.choice(letters)] if kind == 1 else [chars[at], rng.choice(letters)]
        texts.append("".join(rng.choices(letters, k=rng.randrange(80))) + "".join(chars) + "".join(rng.choices(letters, k=rng.randrange(80))))
    texts += ["", items[0][1], "x" * 500]
    found = {(r, item): e for r, item, _, _, e in index.search(pa.array(texts, pa.large_string()))}
    wanted = {}
    for r, text in enumerate(texts):
        for w in range(len(index.item)):
            window = "".join(map(chr, index.points[w, : index.length[w]]))
            if (e := edits(window, text)) <= index.most[w]:
                name = (r, int(index.item[w]))
                wanted[name] = min(wanted.get(name, e), e)
    assert found == wanted and wanted


def test_passages_of_long_items_count_wherever_they_begin():
    rng = random.Random(8)
    letters = "abcdefghijklmnop "
    s = decontaminate.Settings()
    item = "".join(rng.choices(letters, k=400))
    index = decontaminate.Index([(1, item), (2, "".join(rng.choices(letters, k=700)))], s)
    texts = []
    for at in range(len(item) - s.window + 1):
        passage = list(item[at : at + s.window])
        for k in range(at % 4):
            passage[20 + 30 * k] = "#"
        texts.append("".join(rng.choices(letters, k=at % 90)) + "".join(passage) + "".join(rng.choices(letters, k=60)))
    found = index.search(pa.array(texts, pa.large_string()))
    assert [(r, item) for r, item, *_ in found] == [(at, 1) for at in range(len(texts))]
    for r, _, start, end, e in found:
        # Some window may save an edit at its edge by reading one character less or more.
        assert e <= r % 4 and abs(start - r % 90) <= 40 and abs(end - r % 90 - s.window) <= 40
    short = [item[at : at + 100] + "#" * 100 for at in range(0, 300, 7)]
    assert index.search(pa.array(short, pa.large_string())) == []


def test_exact_copies_count_at_every_length():
    rng = random.Random(9)
    s = decontaminate.Settings()
    items = [(n, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))) for n in range(s.q, s.window + 1)]
    index = decontaminate.Index(items, s)
    texts = ["0123456789 0123 " + text + " 4567 89012345678" for _, text in items]
    found = index.search(pa.array(texts, pa.large_string()))
    assert [(r + s.q, item, e) for r, item, _, _, e in found] == [(n, n, 0) for n, _ in items]
    # 28 characters may have one edit, as two could leave no q-gram.
    one, two = (items[18][1][:k] + "#" + items[18][1][k + 1 :] for k in (5, 14))
    assert [(r, e) for r, _, _, _, e in index.search(pa.array([one, two[:5] + "#" + two[6:]], pa.large_string()))] == [(0, 1)]


def test_decontamination_column(spark):
    passage = "What is the tallest mountain of the northern island, and which river runs from its glacier to the western sea? Answer briefly."
    bench = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, "short"), (None, passage)], "item_id long, text string")
    other = " ".join(f"filler{i}" for i in range(40))
    rows = [(1, f"{other} {passage.upper()} {other}"), (2, passage.replace("tallest", "highest")), (3, other), (4, None), (5, ""), (6, (other + " ") * 200 + passage), (1, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for s in (decontaminate.Settings(), decontaminate.Settings(max_index_chars=50)):
        got = docs.select("doc_id", F.inline(decontaminate.hits(F.col("text"), bench, settings=s))).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (1, 1), (2, 1), (6, 1)]
    none = decontaminate.hits(F.col("text"), bench.where("false"))
    assert docs.select(F.inline(none)).count() == 0


# --- tokenizer -----------------------------------------------------------------------------------------------------


def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


def odd_texts():
    rng = random.Random(8)
    kinds = ["ab", "abc ", "the ", "tion ing", "  a\n", "éàçñ ß", "▁ x", "日本語 の", "0123456789abcdef", "thhehet", " ", "\t\r\n\x00", "𝕏😀 "]
    made = ["".join(rng.choice(k) for _ in range(rng.randint(0, 300))) for k in kinds for _ in range(40)]
    return ["", " ", "  a", "▁", "▁▁ x ▁", "\n\n", " \n ", "the" * 400, "a" * 700, "x" * 40000, *made]


def test_ids_and_text_equal_the_library():
    sp = library()
    v = piecebpe.vocabulary(queries.piece_model())
    for part in arrays.slices(pa.array(odd_texts()), 20000):
        ids, counts = piecebpe.encode_texts(v, part)
        lists = arrays.list_array(ids, counts, pa.int32())
        assert lists.to_pylist() == [sp.encode(t, add_eos=True) for t in part.to_pylist()]
        assert piecebpe.decode_lists(v, lists).to_pylist() == [sp.decode(x) for x in lists.to_pylist()]


def test_tokenizer_columns(spark):
    sp = library()
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "The cat\nsat. "), (3, "The cat\nsat. ")], "doc_id long, text string")
    got = piecebpe.encode_decode(docs, queries.piece_model()).orderBy("doc_id").collect()
    assert [r["ids"] for r in got] == [[2], [2], *[sp.encode("The cat\nsat. ", add_eos=True)] * 2]
    assert [r["decoded"] for r in got] == ["", "", "The cat\nsat. ", "The cat\nsat. "]
    assert piecebpe.encode_decode(docs.where("false"), queries.piece_model()).count() == 0

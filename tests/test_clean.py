import json

from pyspark.sql import functions as F

from tagloom.functions import labels as lb
from tagloom.operators import clean, explore, ranking
from tagloom.plans import cleaning
from tagloom.sources import conllu, csvfiles, jsonfiles

RECORDS = "movie_id string, movie_name string, description string, genre string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RECORDS)


def test_merge_takes_longest_text_and_all_labels(spark):
    df = raw(spark, [
        ("1", "n", "bbbb", "War, Action"), ("1", "n", "aaaa", "Drama"), ("1", "n", "ccc", "Action"),
        ("2", "n", "Add a Plot", "Drama"), ("2", "n", "Add a Plot", "Drama"),
        ("3", "n", "Add a Plot", "War"), ("3", "n", "x", " War ,War"),
    ])
    got = {r["movie_id"]: (r["labels"], r["description"]) for r in clean.merge_groups(df).collect()}
    assert got["1"] == (["Action", "Drama", "War"], "aaaa")
    assert got["2"] == (["Drama"], "Add a Plot")
    assert got["3"] == (["War", "War ,War"], "x")  # only a comma and a blank separate labels


def test_clean_run_order(spark):
    df = raw(spark, [
        ("1", "a", "first text", "Drama"), ("1", "b", "second text", "Drama"),
        ("2", "a", "first text", "War"), ("3", "a", "Add a Plot", "Music"),
        ("4", "a", "Add a Plot", "Horror"), ("5", "a", "dropped", "Drama, Short"), ("6", "a", None, "Drama"),
    ])
    override = spark.createDataFrame([("4", "given later")], "movie_id string, description string")
    repaired = cleaning.repaired_records(df, override)
    assert clean.load_vocabulary(repaired) == ["Drama", "Horror", "War"]
    got = sorted((r["movie_id"], r["movie_name"], r["description"]) for r in cleaning.clean_records(df, override).collect())
    assert got == [("1", "a", "first text"), ("4", "a", "given later")]


def test_result_does_not_depend_on_input_order_or_partitions(spark, sf):
    from tagloom.catalog.tables import override, raw_records

    df, new = raw_records(spark, sf), override(spark, sf)
    a = cleaning.clean_records(df, new)
    b = cleaning.clean_records(df.orderBy(F.desc("doc_id")).repartition(7), new)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_csv_files_with_different_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('movie_id,movie_name,description,genre\n1,"A, ""b""","line 1\nline 2","Drama, War"\n')
    (tmp_path / "b.csv").write_text("genre,movie_id,year\nWar,2,1999\n")
    files = csvfiles.list_files(spark, str(tmp_path / "*.csv"))
    df = csvfiles.scan_union(spark, files)
    assert sorted(df.columns) == ["description", "genre", "movie_id", "movie_name", "year"]
    rows = {r["movie_id"]: r for r in csvfiles.scan_union(spark, files, csvfiles.RECORD_SCHEMA, order=True).collect()}
    assert rows["1"]["description"] == "line 1\nline 2" and rows["1"]["movie_name"] == 'A, "b"'
    assert rows["2"]["description"] is None and rows["2"]["genre"] == "War"
    assert set(csvfiles.FILE_ORDER) <= set(rows["1"].asDict())


def test_override_keeps_first_complete_row(spark, tmp_path):
    path = tmp_path / "crawl.csv"
    path.write_text("ids,plots\n1,NaN\n1,second\n1,third\n2,NaN\n3,only\n")
    got = {r["movie_id"]: r["description"] for r in csvfiles.read_override(spark, str(path)).collect()}
    assert got == {"1": "second", "3": "only"}


def test_conllu_reading(spark, tmp_path):
    text = (
        "# comment before\n# movie_id = tt1\n# genre = [0 1 0]\n# text = He can't = no\n1\tHe\the\tPRON\n"
        "2-3\tcan't\t_\t_\n2\tca\tcan\tAUX\n3\tn't\tnot\tPART\n\n# text = Second one.\n1\tSecond\tsecond\tADJ\n\n\n"
        "# movie_id = tt2\n# genre = [1 0 0]\n\n"
    )
    (tmp_path / "a.conllu").write_text(text)
    rows = {r["movie_id"]: r for r in conllu.scan_conllu(spark, str(tmp_path)).collect()}
    assert set(rows) == {"tt1", "tt2"}
    assert rows["tt1"]["genre"] == [0, 1, 0]
    assert rows["tt1"]["description"] == "He can't = no Second one."
    assert rows["tt1"]["lemmatized_description"] == ["he", "_", "can", "not", "second"]
    assert rows["tt2"]["description"] == "" and rows["tt2"]["lemmatized_description"] == []
    tokens = conllu.scan_tokens(spark, str(tmp_path)).orderBy("sent_no", "tok_no").collect()
    assert [(r["sent_no"], r["form"]) for r in tokens if r["movie_id"] == "tt1"][-1] == (2, "Second")
    assert [r["movie_id"] for r in conllu.scan_conllu(spark, str(tmp_path), limit=1).collect()] == ["tt1"]


def test_csv_sink_quotes_everything_and_keeps_arrays(spark, tmp_path):
    df = spark.createDataFrame([("1", ["A", "B"], [0, 1])], "id string, labels array<string>, hot array<int>")
    path = str(tmp_path / "out")
    csvfiles.write_csv_all_quoted(df.coalesce(1), path)
    content = next((tmp_path / "out").glob("*.csv")).read_text()
    assert content.splitlines() == ['"id","labels","hot"', "\"1\",\"['A' 'B']\",\"[0 1]\""]
    back = csvfiles.scan_union(spark, csvfiles.list_files(spark, path + "/*.csv"))
    row = back.select(lb.parse_label_list(F.col("labels")).alias("l"), lb.parse_label_list(F.col("hot")).alias("h")).first()
    assert row["l"] == ["A", "B"] and row["h"] == ["0", "1"]


def test_top_words_json(spark, tmp_path):
    df = spark.createDataFrame([("War", 2, "b"), ("War", 1, "z")], "label string, rank int, word string")
    jsonfiles.write_top_words(df, str(tmp_path / "j"))
    lines = [json.loads(x) for f in (tmp_path / "j").glob("*.json") for x in f.read_text().splitlines()]
    assert lines == [{"label": "War", "words": ["z", "b"]}]


def test_encode_decode(spark):
    names = ["A", "B", "C"]
    df = spark.createDataFrame([(["C", "A"],), ([],)], "l array<string>")
    hot = lb.encode_labels(F.col("l"), names)
    rows = df.select(hot.alias("h"), lb.decode_labels(hot, names).alias("d")).collect()
    assert [list(r) for r in rows] == [[[1, 0, 1], ["A", "C"]], [[0, 0, 0], []]]


def test_conflicts_count_null_as_a_value(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), ("b", "x"), (None, "y"), (None, "z")],
                               "k string, v string")
    got = {(r["key"], r["value"]): r["number_different_values"] for r in explore.conflicting_duplicates(df, "k", "v").collect()}
    assert got == {("a", "x"): 2, ("a", None): 2}


def test_cooccurrence_is_symmetric(spark, sf):
    from tagloom.catalog.tables import order_labels, order_vocabulary

    m = {(r["label_a"], r["label_b"]): r["n"] for r in
         explore.cooccurrence(order_labels(spark, sf), order_vocabulary(spark, sf)).collect()}
    assert all(m[a, b] == m[b, a] for a, b in m) and all(m[a, a] == 0 for a, _ in m)


def test_sampling_and_positions(spark):
    df = spark.range(101).repartition(5)
    assert sorted(r["id"] for r in ranking.sample_every(df, 10, ["id"]).collect()) == list(range(0, 101, 10))
    assert ranking.sample_every(df, 0, ["id"]).count() == 101


def test_exact_rank_equals_window_on_a_hot_group(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    df = df.withColumn("b", F.substring("h", 1, 1)).withColumn("len", (F.col("id") % 5).cast("int"))
    from pyspark.sql import Window

    one = ranking.exact_rank(df, ["g"], ["b"], ["h"], "r").withColumn(
        "w", F.row_number().over(Window.partitionBy("g").orderBy("h")))
    assert one.filter("r <> w").isEmpty()
    two = ranking.exact_rank(df, [], ["len", "b"], ["h"], "r").withColumn(
        "w", F.row_number().over(Window.orderBy("len", "h")))
    assert two.filter("r <> w").isEmpty() and two.count() == 3000


def test_equal_count_bins_is_ntile(spark):
    for n in (7, 20, 43):
        df = spark.range(n).withColumn("len", (F.col("id") * 7 % 11).cast("int"))
        sizes = [r["count"] for r in ranking.equal_count_bins(df, "len", "id", 20).groupBy("bin").count().orderBy("bin").collect()]
        assert sizes == [n // 20 + 1] * (n % 20) + [n // 20] * (20 - n % 20 if n >= 20 else 0)


def test_conllu_is_the_same_over_many_splits(spark, sf):
    from tagloom.catalog.cleaning import conversation_files

    path = conversation_files(spark, sf)
    whole = {r["movie_id"]: (r["description"], r["lemmatized_description"]) for r in conllu.scan_conllu(spark, path).collect()}
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, ["3000", "0"]):
            spark.conf.set(n, v)
        df = conllu.scan_conllu(spark, path)
        assert df.rdd.getNumPartitions() > 4
        parts = {r["movie_id"]: (r["description"], r["lemmatized_description"]) for r in df.collect()}
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert parts == whole and len(whole) > 5


def test_split_does_not_depend_on_partitions(spark, sf):
    from tagloom.catalog.tables import order_labels
    from tagloom.operators import split

    df = order_labels(spark, sf)
    a = split.stratified_split(df).select("id", "split", "dev")
    b = split.stratified_split(df.orderBy(F.desc("id")).repartition(3)).select("id", "split", "dev")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

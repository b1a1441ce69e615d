"""Components over awkward graphs, and that nothing else in the library needs this subpackage."""

import random
import re
from pathlib import Path

from tagloom.llm.common import components, fresh

ROOT = Path(__file__).resolve().parents[2]


def roots_of(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(200, i) for i in range(201, 300)]
    loose = [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)]
    links = [(a, b) for a, b in chain + star + loose + star if a != b]
    got = components(spark.createDataFrame(links, "u long, v long"), "test").collect()
    assert {r["id"]: r["root"] for r in got} == roots_of(links) and len(got) == len(roots_of(links))
    assert components(spark.createDataFrame([], "u long, v long"), "test").count() == 0


def test_fresh_name(spark):
    df = spark.createDataFrame([(1, 2)], "Mark int, mark_ int")
    assert fresh(df, "mark") == "mark__"


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tagloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"tagloom\.llm|corpus_pipeline", path.read_text()), path


def test_no_local_checkpoint():
    for path in [*(ROOT / "tagloom" / "llm").glob("*.py"), ROOT / "corpus_pipeline.py"]:
        assert "localCheckpoint" not in path.read_text()

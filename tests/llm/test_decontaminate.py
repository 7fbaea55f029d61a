import random
import re

import pytest

from checks import compare
from creditframe.llm import decontaminate, queries, sql

DOCS = "doc_id long, text string, item_id string, h int, needed string"
ITEMS = "item_id long, text string, doc_id string, fold int"


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        own = shingles(text)
        hit = sorted({i for i, t in items if shingles(t) and 100 * len(shingles(t) & own) >= 80 * len(shingles(t))})
        out.append((doc_id, len(hit), hit))
    return sorted(out)


@pytest.fixture(scope="module")
def made_up():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdéfgh") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(rnd.choice([3, 5, 6, 9, 14, 30, 80])))) for k in range(30)]
    items += [(50, None), (51, ""), (52, "a b c"), (53, items[4][1].upper()), (54, "x x x x x x x x")]
    docs = []
    for k in range(120):
        words = [word() for _ in range(rnd.choice([0, 20, 300]))]
        own = rnd.choice(items)[1] or ""
        part = own.split()
        for _ in range(rnd.randrange(3)):
            if part:
                part[rnd.randrange(len(part))] = word()
        at = rnd.randrange(len(words) + 1)
        docs.append((k, rnd.choice([" ", "\n", "\t "]).join([*words[:at], *part, *words[at:]])))
    docs += [(200, None), (201, ""), (202, "A b\tc"), (203, "a b c d"), (204, "x " * 50000 + items[5][1])]
    return docs, items


@pytest.mark.parametrize("partitions", [1, 6])
def test_equals_brute_force(spark, made_up, partitions):
    docs, items = made_up
    left = spark.createDataFrame([(*r, "x", 1, "y") for r in docs], DOCS).repartition(partitions)
    right = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    got = sorted(map(tuple, decontaminate.contamination(left, right).collect()))
    assert got == brute(docs, items)
    assert sum(bool(r[1]) for r in got) > 20


def test_native(spark, made_up):
    docs, items = made_up
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_repeated_and_empty(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text), (1, text), (2, "x " + text), (3, "no")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text), (7, text), (8, "no")], "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contamination(docs, items).collect()))
    assert got == [(1, 1, [7]), (1, 1, [7]), (2, 1, [7]), (3, 1, [8])]
    assert {r.n_items for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_whole_table_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    left = compare.spark_rows(queries.REGISTRY["op5_decontaminate"](spark, d))
    right = compare.duck_rows(compare.connect(d), sql.ORACLES["op5_decontaminate"])
    assert compare.difference(left, right) is None
    assert any(r[2] != "0" for r in right[1])

import random
import re
from collections import defaultdict

import pytest

from creditframe.llm import near_dedup, queries
from creditframe.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id long, n int, spread string"


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width=4, percent=80):
    """Links by counting shared shingles of all pairs of different sets."""
    sets = [(doc_id, shingles(text, width)) for doc_id, text in rows]
    root = {doc_id: doc_id for doc_id, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def link(a, b):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    by_set = defaultdict(list)
    for doc_id, s in sets:
        if s:
            by_set[s].append(doc_id)
    for ids in by_set.values():
        for i in ids[1:]:
            link(ids[0], i)
    different = list(by_set)
    holders = defaultdict(list)
    for k, s in enumerate(different):
        for x in s:
            holders[x].append(k)
    shared = defaultdict(int)
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(different[a]) + len(different[b]) - n):
            link(by_set[different[a]][0], by_set[different[b]][0])
    return sorted((doc_id, len(s), find(doc_id), find(doc_id) == doc_id) for doc_id, s in sets)


def made_up(seed, groups):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows = []
    for size in groups:
        base = [word() for _ in range(rnd.choice([30, 80, 200]))]
        for _ in range(size):
            own = list(base)
            for _ in range(rnd.randrange(0, 1 + len(own) // 15)):
                own[rnd.randrange(len(own))] = word()
            rows.append((len(rows), rnd.choice([" ", "\n", " \t"]).join(own)))
    return rows


@pytest.mark.parametrize("partitions", [1, 5])
def test_equals_brute_force(spark, partitions):
    rows = made_up(3, [40, 12, 5, 3, 2, 1, 1])
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "One two"), (n + 4, "one TWO"), (n + 5, "two one")]
    rows += [(n + 6, rows[3][1].upper()), (n + 6, rows[3][1].upper()), (n + 7, "x y z w " * 30000), (n + 8, "x y z w " * 20000)]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(partitions)
    got = sorted(map(tuple, near_dedup.near_duplicates(df).collect()))
    assert got == brute(rows)


def test_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rows = made_up(5, [60, 30])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.near_duplicates(df).collect())) == brute(rows)


def test_versions_of_one_document(spark):
    rows = made_up(7, [2, 2])
    df = spark.createDataFrame([(5, rows[0][1]), (5, rows[2][1]), (3, rows[2][1]), (9, rows[0][1])], "doc_id long, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(df).collect()} == {3}


def test_rows_without_id_beside_near_copies(spark):
    rows = made_up(9, [6, 3, 1])
    unnamed = [(None, rows[0][1]), (None, rows[0][1]), (None, None)]
    df = spark.createDataFrame(rows + unnamed, "doc_id long, text string").repartition(2)
    found = [tuple(r) for r in near_dedup.near_duplicates(df).collect()]
    assert sorted(r for r in found if r[0] is not None) == brute(rows)
    n = len(shingles(rows[0][1], 4))
    assert sorted(r[1:] for r in found if r[0] is None) == [(0, None, None), (n, None, None), (n, None, None)]
    kept = [tuple(r) for r in near_dedup.keep_one(df).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [rows[r[0]] for r in brute(rows) if r[3]] + unnamed))


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 199), (5, 5), (200, 199)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {199: 199, 200: 199}


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    assert sorted(map(tuple, queries.REGISTRY["op6_near_dedup"](spark, d).collect())) == brute(rows)

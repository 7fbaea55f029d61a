import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from checks import compare
from creditframe.llm import line_dedup, queries, sql

LINE = "This line is shared by many Documents, and long enough"
SCHEMA = "doc_id long, text string, n_lines string, lost int, salt int, row string"


def brute(rows, min_chars=40, min_docs=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\v\f\r").translate(lower)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def digests(df):
    got = df.select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted((r[0], r[1], r[2], hashlib.sha256((r[3] or "").encode()).hexdigest()) for r in got)


ROWS = [
    *[(i, f"own line of document {i} that nobody else has anywhere\n  {LINE.upper() if i % 2 else LINE}\t\nend") for i in range(8)],
    (20, LINE + "\n" + LINE + "\r\nx\n" + LINE),
    (21, None),
    (22, ""),
    (23, "\n\n"),
    (24, LINE[:39] + "\n" + LINE[:39]),
    *[(30 + i, LINE[:41] + "é") for i in range(4)],
    *[(40 + i, "É" * 40 + "\v") for i in range(5)],
    (50, "É" * 39 + "e"),
    (60, ("word " * 30 + "\n") * 5000),
    *[(70 + i, "word " * 30) for i in range(6)],
]


@pytest.mark.parametrize("partitions", [1, 7])
def test_equals_brute_force(spark, partitions):
    rows = [(*r, "x", 1, 2, None) for r in ROWS]
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "lost", "salt", "row", "n_lines", "n_dropped"]
    assert digests(got) == brute(ROWS)


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, LINE)] * 6 + [(2, LINE + "\nx"), (3, LINE), (4, LINE)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(line_dedup.dedup_lines(df)) == brute(rows)


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filter_loses_nothing():
    hashes = np.random.default_rng(1).integers(0, 2**63, 200_000).astype(np.uint64)
    own = line_dedup.Filter(1 << 14)
    for k in range(0, 100_000, 1000):
        own.add(hashes[k : k + 1000])
    assert own.holds(hashes[:100_000]).all()
    assert own.holds(hashes[100_000:]).mean() < 0.05


def test_false_positives_hide_no_repeated_key(monkeypatch):
    monkeypatch.setattr(line_dedup, "Filter", lambda own=line_dedup.Filter: own(1 << 6))
    hashes = np.random.default_rng(3).integers(-(2**63), 2**63, 100_000)
    batches = [pa.RecordBatch.from_arrays([pa.array(hashes)], names=["hash"])] * 2
    found = np.concatenate([b.column(0).to_numpy() for b in line_dedup._suspect(iter(batches))])
    place = line_dedup.SUSPECT_BITS - 1
    assert np.isin(hashes & place, found & place).all()


def test_whole_table_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    left = compare.spark_rows(queries.REGISTRY["op1_line_dedup"](spark, d))
    right = compare.duck_rows(compare.connect(d), sql.ORACLES["op1_line_dedup"])
    assert compare.difference(left, right) is None

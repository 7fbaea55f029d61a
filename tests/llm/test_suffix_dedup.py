import hashlib
import os
import random
from collections import Counter

import pytest

from creditframe.llm import queries, suffix_dedup

SCHEMA = "doc_id long, text string, n_bytes string, rest int, version string"
L = suffix_dedup.LENGTH


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    often = Counter(b[k : k + L] for _, b in texts for k in range(len(b) - L + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - L + 1):
            if often[b[k : k + L]] > 1:
                gone[k : k + L] = b"\1" * L
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(bool(g) and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def digests(df):
    got = df.select("doc_id", "n_bytes", "n_removed", "n_spans", "text").collect()
    return sorted((r[0], r[1], r[2], r[3], hashlib.sha256(bytes(r[4])).hexdigest()) for r in got)


@pytest.fixture(scope="module")
def made_up():
    rnd = random.Random(9)
    noise = lambda n: "".join(rnd.choice("abcdefé ") for _ in range(n))
    passages = [noise(n) for n in (150, 190, 199, 200, 201, 230, 260, 400, 900)]
    rows = []
    for k in range(90):
        parts = []
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p) // 3)
            parts += [noise(rnd.randrange(300)), p[a:] if rnd.random() < 0.3 else p]
        rows.append((k, "".join(parts) + noise(rnd.randrange(50))))
    rows += [(100, None), (101, ""), (102, "a" * 199), (103, "b" * 200), (104, "c" * 201), (105, "xy" * 700), (106, "b" * 150)]
    rows += [(107, rows[3][1]), (107, rows[3][1]), (108, rows[5][1]), (108, rows[6][1]), (109, noise(3000) * 2)]
    return rows


@pytest.mark.parametrize("partitions", [1, 5])
def test_equals_brute_force(spark, made_up, partitions):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in made_up], SCHEMA).repartition(partitions)
    got = suffix_dedup.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "rest", "version", "n_bytes", "n_removed", "n_spans"]
    assert digests(got) == brute(made_up)


def test_large_buckets_and_small_batches(spark, made_up, monkeypatch):
    df = spark.createDataFrame(made_up, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "LARGE", 3)
    monkeypatch.setattr(suffix_dedup, "BATCH", 500)
    assert digests(suffix_dedup.remove_repeats(df)) == brute(made_up)


def test_bitmaps_that_let_all_through(spark, made_up, monkeypatch):
    df = spark.createDataFrame(made_up, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "BITS", 64)
    monkeypatch.setattr(suffix_dedup, "DOC_BITS", 64)
    assert digests(suffix_dedup.remove_repeats(df)) == brute(made_up)


def shuffled(spark):
    """Sizes of the session's shuffle files by path."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = [os.path.join(at, f) for d in folders for at, _, names in os.walk(d.getPath()) for f in names]
    return {f: os.path.getsize(f) for f in files if os.path.basename(f).startswith("shuffle_") and f.endswith(".data")}


def test_texts_that_lose_nothing_are_not_shuffled(spark):
    rnd = random.Random(4)
    rows = [(k, "".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=20000))) for k in range(200)]
    rows += [(200, rows[0][1][5000:5300])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    df.count()
    before = shuffled(spark)
    got = suffix_dedup.remove_repeats(df)
    removed = {r[0]: r[1] for r in got.select("doc_id", "n_removed").collect() if r[1]}
    written = sum(size for f, size in shuffled(spark).items() if f not in before)
    df.unpersist()
    assert removed == {0: 300, 200: 300}
    assert written < 200 * 20000 / 2


def test_rows_without_id(spark, made_up):
    rnd = random.Random(6)
    a, b = ("".join(rnd.choices("abcdefgh", k=260)) for _ in range(2))
    rows = [(None, a + "x" + b), (5, a + "y"), (7, "z" + b[20:240]), (None, None), (None, "zz"), *made_up[:20]]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert digests(got.fillna({"doc_id": -1})) == brute([(-1 if i is None else i, t) for i, t in rows])


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in queries.table(spark, d, "documents").collect()]
    got = sorted(map(tuple, queries.REGISTRY["op7_suffix_dedup"](spark, d).collect()))
    assert got == brute(rows) and sum(r[2] for r in got) > 10000

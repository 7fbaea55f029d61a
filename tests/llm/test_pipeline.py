import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from creditframe.llm.queries import tokenizer_path

from . import test_decontaminate as leaks_, test_line_dedup as lines_, test_near_dedup as near_, test_quality as quality_

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of documents and after each stage, each written and read again."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    out, columns = [[tuple(r) for r in docs.collect()]], docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, D).write.parquet(path)
        docs = spark.read.parquet(path)
        assert k == 4 or docs.columns == columns
        out.append([tuple(r) for r in docs.collect()])
    return out


def test_quality(stages):
    before, after = stages[:2]
    kept = {r[0] for r, e in zip(before, quality_.brute([(r[0], r[1], r[2], r[3]) for r in before])) if e[-1]}
    assert sorted(after) == sorted(r for r in before if r[0] in kept) and 0 < len(after) < len(before)


def test_lines(stages):
    before, after = stages[1:3]
    want = {r[0]: r[3] for r in lines_.brute([(r[0], r[1]) for r in before])}
    import hashlib

    assert {r[0]: hashlib.sha256((r[1] or "").encode()).hexdigest() for r in after} == want
    assert all(r[4] == len(r[1]) for r in after)


def test_near(stages):
    before, after = stages[2:4]
    want = {r[0] for r in near_.brute([(r[0], r[1]) for r in before], 5) if r[3]}
    assert sorted(r[0] for r in after) == sorted(want) and len(after) < len(before)


def test_leaks(spark, stages):
    before, after = stages[3:5]
    items = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r[0] for r in leaks_.brute([(r[0], r[1]) for r in before], items) if not r[1]}
    assert {r[0] for r in after} == want and len(after) < len(before)


def test_packing(stages):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    texts = {r[0]: r[1] for r in stages[4]}
    pieces, filled = {}, {}
    for doc_id, start, n, crc, total, sequence, offset in stages[5]:
        pieces.setdefault(doc_id, []).append((start, n, crc, total))
        filled.setdefault(sequence, []).append((offset, n))
    assert pieces.keys() == texts.keys()
    for doc_id, parts in pieces.items():
        ids = np.array(own.encode(texts[doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for start, n, crc, total in sorted(parts):
            assert start == at and total == len(ids) and crc == zlib.crc32(ids[start : start + n].tobytes())
            at += n
        assert at == len(ids)
    for parts in filled.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, D)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert sum(r.length for r in got.collect()) == sum(r[2] for r in stages[5])


def test_strange_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, rest int"
    text = " ".join(f"word{k}" for k in range(70))
    rows = [(1, None, None, None, None, None, None), (2, "", "en", "a", 0, None, 1), (3, text, "en", "a", 5, "x", 1)]
    rows += [(3, text, "en", "a", 5, "x", 1), (4, text, None, None, None, None, None)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {3} and sum(r.length for r in got) == got[0].doc_tokens
    empty = os.path.join(folder, "empty")
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_rows_without_id_beside_near_copies(spark, tmp_path):
    words = [f"word{k}" for k in range(300)]
    texts = [" ".join([*words[:299], f"own{i}"]) for i in range(6)]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)] + [(None, t, "en", "a", len(t)) for t in texts[:2]]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
    assert sorted((r.doc_id for r in docs.collect()), key=str) == [0, None, None]
    assert {0} <= {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from creditframe.llm import token_codes
from creditframe.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, start string, n_tokens int"


def brute(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out, start = [], 0
    for doc_id, text, *_ in ordered:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def run(spark, rows, tmp_path, **kw):
    docs = spark.createDataFrame(rows, SCHEMA)
    folder = token_codes.write(docs, str(tmp_path / "codes"), tokenizer_path(), **kw)
    return sorted(token_codes.read(spark, folder).collect(), key=lambda r: r.start)


def test_equal_to_tokenizer_in_id_order(spark, tmp_path):
    rows = [
        (5, "Hello, World! It isn't 4.5 km.", "x", 1),
        (2, None, "x", 1),  # null text: the end id alone
        (9, "", None, None),
        (None, "no id comes last", None, None),
        (3, "héllo wörld ### ünïcode " * 400, None, None),  # long text over several blocks
        (7, "same", None, None),
        (7, "same", None, None),  # repeated row
        (1, "a\tb\nc   d", None, None),
    ]
    got = run(spark, rows, tmp_path, block_tokens=64, partitions=3)
    want = brute(rows)
    assert [tuple(r) for r in got] == want


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_random_access_in_written_blocks(spark, tmp_path):
    rows = [(i, " ".join(f"word{i * j}" for j in range(i % 50)), None, None) for i in range(300)]
    folder = token_codes.write(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "codes"), tokenizer_path(), block_tokens=500, partitions=4)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    every = [t for _, text, *_ in rows for t in tokenizer.encode(text, add_special_tokens=False).ids + [1]]
    blocks = spark.read.parquet(f"{folder}/blocks").join(spark.read.parquet(f"{folder}/shards").select("shard", "base"), "shard").collect()
    assert sum(b.n_tokens for b in blocks) == len(every)
    for b in blocks:
        for i in range(0, b.n_tokens, 7):
            assert token_codes.token_at(i, b.widths, b.chunks, b.bits, b.ranks) == every[b.base + b.first + i]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=2000))
@settings(max_examples=60, deadline=None)
def test_codes_round_trip(values):
    ids = np.array(values, np.uint32)
    widths = token_codes.best_widths(ids)
    assert sum(widths) >= (int(ids.max()).bit_length() if len(ids) else 1)
    chunks, bits, ranks = token_codes.encode(ids, widths)
    assert (token_codes.decode(len(ids), widths, chunks, bits) == ids).all()
    for i in range(0, len(ids), 13):
        assert token_codes.token_at(i, widths, chunks, bits, ranks) == ids[i]

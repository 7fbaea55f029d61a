import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditframe.llm import _text, packing
from creditframe.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, start string, length int"


@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([32, 64]))
@settings(max_examples=60, deadline=None)
def test_pieces_fill_every_sequence(lengths, capacity):
    rows = packing.place(lengths, capacity, 1.0, 1 / capacity)
    seen = {}
    filled = {}
    for doc, start, n, s, offset in rows:
        seen.setdefault(doc, []).append((start, n))
        filled.setdefault(s, []).append((offset, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, part in sorted(seen[doc]):
            assert start == at
            at += part
        assert at == n
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == capacity or at & (at - 1) == 0


def test_costs_are_balanced():
    lengths = [1000] * 10 + [100] * 100
    cost = {}
    for _, _, n, s, _ in packing.place(lengths, 2048, 1.0, 1 / 2048):
        cost[s] = cost.get(s, 0) + n + n * n / 2048
    full = sorted(cost.values())[-9:]
    assert full[-1] < 2 * full[0]


TEXTS = [
    "It's a test, isn't it?  1234 ###$$ l'été",
    "Ein  Ünit test é \x1c x\x0by İstanbul ΣΑΣ",
    "<|endoftext|> <|startoftext|>a</w>",
    "",
    None,
    "   \n\t ",
    "x" * 5000,
    "don't we'll 're\n's 日本語 テスト 🎉👍",
]


def test_ids_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS * 2)] + [(0, TEXTS[0], "y", 2)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = packing.pack(df, tokenizer_path(), keep_ids=True).collect()
    whole = {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.length == len(r.ids)
        whole.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    for i, t, *_ in rows[1 : len(TEXTS) * 2]:
        expected = own.encode(t or "", add_special_tokens=False).ids + [1]
        parts = sorted(whole[i, len(expected)])
        assert [x for _, ids in parts for x in ids] == expected
    assert sum(r.start == 0 for r in got if r.doc_id == 0) == 2


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).count() == 0


@pytest.mark.parametrize("size", [1, 7, 1 << 21])
def test_pieces_keep_all_rows(size):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS)], names=["text"])
    got = []
    for rows, data, offsets in _text.pieces([batch.slice(1)], "text", size):
        raw = data.tobytes()
        got += [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [t or "" for t in TEXTS[1:]]

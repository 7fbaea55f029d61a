import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditframe.llm import queries, toxicity

SCHEMA = "doc_id long, text string, toxic string, id int, score string"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    evidence, steps = rng.normal(size=9), rng.normal(size=(2, 2))
    chains = np.array([0, 4, 5])
    p, moves = toxicity.forward_backward(evidence, chains, steps)
    expected, expected_moves = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(chains, [*chains[1:], 9]):
        total, ones, moved = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(b - a)):
            w = sum(evidence[a + i] for i, s in enumerate(states) if s)
            w = np.exp(w + sum(steps[x, y] for x, y in zip(states, states[1:])))
            total += w
            ones += w * np.array(states)
            for x, y in zip(states, states[1:]):
                moved[x, y] += w
        expected[a:b] = ones / total
        expected_moves += moved / total
    assert np.allclose(p, expected) and np.allclose(moves, expected_moves)


def test_chains_are_sentences_in_parts():
    import pyarrow as pa

    from creditframe.llm import _text

    data, offsets = _text.flat(pa.array(["one two. three", "four", None, "w " * 150]))
    starts, ends, first, chains = toxicity.tokens(data, offsets)
    assert first.tolist() == [0, 3, 4, 4, 154]
    assert chains.tolist() == [0, 2, 3, 4, 68, 132]


@pytest.fixture(scope="module")
def made_up(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 8)))
    docs, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        if i % 4 == 0:
            for at, bad in zip(rnd.sample(range(60), 3), ("grobble", "zonkwit", "zonkish")):
                words[at] = bad
        docs.append((i, " ".join(words) + ".", None, 1, "x"))
        if i < 300:
            labels.append((i, int(i % 4 == 0)))
    docs += [(1000, None, None, 1, None), (1001, "", None, 1, None), (1002, "Grobble é zonkwit a zonkish", None, 1, None)]
    docs += [(1003, "lorem " * 50000 + "grobble. zonkwit, zonkish", None, 1, None), (1003, "lorem", None, 1, None)]
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")


def test_made_up_words(made_up):
    docs, labels = made_up
    got = toxicity.score_documents(docs, labels, F.lit(True)).collect()
    assert len(got) == 405
    assert all((r.score >= 0.7) == (r.doc_id % 4 == 0) == bool(r.predicted) for r in got if r.doc_id < 1000)
    rest = sorted((r for r in got if r.doc_id >= 1000), key=lambda r: (r.doc_id, r.score))
    assert [r.score for r in rest[:2]] == [0.0, 0.0] and rest[3].predicted == 0 and rest[4].predicted == 1
    assert [(s.start, s.end) for s in rest[2].spans] == [(0, 7), (10, 17), (20, 27)]


def test_one_toxic_word_has_its_span(spark, monkeypatch):
    sure = toxicity.Field({"wgrobble": 40.0}, -10.0, np.zeros((2, 2)), rate=0.5)
    monkeypatch.setattr(toxicity, "train", lambda *_: sure)
    rows = [(1, "lorem"), (2, None), (3, "é grobble ipsum"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels, F.lit(True)).collect()}
    assert got[3].score < 0.5 and [(s.start, s.end) for s in got[3].spans] == [(2, 9)]
    assert not any(got[k].spans for k in (1, 2, 4))


def test_nothing_to_learn(spark, made_up):
    docs, labels = made_up
    for own in (labels.limit(0), labels.where("toxic = 0")):
        assert {r.score for r in toxicity.score_documents(docs, own, F.lit(True)).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), labels, F.lit(True)).count() == 0


def test_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    labels = queries.table(spark, d, "labels").select("doc_id", "toxic")
    got = queries.REGISTRY["op4_toxicity"](spark, d).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in got if r.toxic == 1]
    clean = [r for r in got if r.toxic == 0]
    assert len(toxic) > 20 and sum(r.predicted for r in toxic) >= 0.85 * len(toxic)  # some labels are wrong
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)

import re

import pytest

from creditframe.llm import licenses, queries

SCHEMA = "doc_id long, text string, labels string, spans int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    """The base columns by plain search."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        own = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "All rights reserved. Some text. ALL RIGHTS RESERVED, (cc) by me; cc by cc by",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License.",
    "licensed under the apache license version 2 0 é all rights",
    "reserved",
    "",
    None,
    "...",
    "all rights reserved " * 30000,
    "Permission is hereby granted without any cost, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction",
    "released under the mit license, " * 20000,
    "the software is in use and the terms of the work are free of a copy",
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, None, 1) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows + rows[:2], SCHEMA)
    out = licenses.scan(df).collect()
    assert len(out) == len(TEXTS) + 2 and len(set(map(str, out))) == len(TEXTS)
    return {r.doc_id: r for r in out}


def test_base_columns_equal_plain_search(found):
    for i, text in enumerate(TEXTS):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)


def test_labels_of_the_method(found):
    labels = [found[i].labels for i in range(len(TEXTS))]
    assert labels[1] == "cc-by,cc-by-nc-4.0" and labels[2] == "gpl,gpl-3.0" and labels[3] == "mit"
    assert labels[4] == "apache-2.0" and labels[10] == "mit"
    assert labels[5] == labels[6] == labels[7] == labels[8] == labels[12] == ""
    assert all(found[i].score == 0 for i in (5, 6, 7, 8, 12)) and 0.8 <= found[10].score < 1
    assert len(found[11].spans) == 20000
    assert [(s.start, s.end) for s in found[3].spans] == [(0, 5)]


def test_matching_statistics_equal_plain_search():
    scanner = licenses.Scanner([("x", "a b c a b d"), ("y", "b c e")], {}, 0.8, 2)
    words = dict(zip("abcde", range(5)))
    import numpy as np

    from creditframe.llm import _text
    import pyarrow as pa

    data, offsets = _text.flat(pa.array(["b c a b c e a b d z a b"]))
    starts, ends, first = _text.words(data, offsets, _text.ALPHANUMERIC)
    numbers = scanner.numbers(_text.word_hashes(data, starts, ends))
    hits = scanner.candidates(numbers, np.zeros(len(numbers), int))
    runs = [(int(p[0]), int(p[-1]) + 1) for p in np.split(hits, np.flatnonzero(np.diff(hits) != 1) + 1)]
    got = {(at, n) for _, _, at, n in scanner.matches(numbers.tolist(), runs)}
    text, templates = "bcabceabdzab", ["abcabd", "bce"]
    expected = set()
    for i in range(len(text)):
        for j in range(i + 2, len(text) + 1):
            inside = lambda a, b: any(text[a:b] in t for t in templates) and 0 <= a and b <= len(text)
            if inside(i, j) and not (j < len(text) and inside(i, j + 1)) and not (i and inside(i - 1, j)):
                expected.add((i, j - i))
    assert got >= expected and words


def test_whole_table_equals_plain_search(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in queries.table(spark, d, "documents").collect()}
    got = queries.REGISTRY["op8_license_scan"](spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
    assert any(r.labels for r in got)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from creditframe.llm import quality, queries

SCHEMA = "doc_id long, text string, lang string, source string, kept string, g int, n_words string"


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines),
    )


def brute(rows, min_rows=100):
    """The same estimates with numpy, group by group."""
    out, groups = {}, defaultdict(list)
    for k, (_, text, lang, source) in enumerate(rows):
        n, chars, symbols, dup, rep, lines = brute_counts(text)
        failed = n < 50 or 100 * rep > 50 * n
        w, c = max(n, 1), max(chars, 1)
        x = [np.log1p(n), np.log(c / w), np.log1p(100 * symbols / c), np.sqrt(dup / max(lines, 1)), np.sqrt(rep / w)]
        out[k] = [n, chars, symbols, dup, rep, failed, not failed]
        if not failed:
            groups[lang, source].append((k, x))
    pooled = defaultdict(list)
    for key, own in groups.items():
        pooled[key if len(own) >= min_rows else None] += own
    edge = lambda v, share, scale: (np.sort(np.floor(v * scale))[int(np.ceil(share * len(v))) - 1] + 1) / scale
    floors = np.diag(quality.FLOORS)
    for own in pooled.values():
        if len(own) < min_rows:
            continue
        x = np.array([v for _, v in own])
        best = None
        med = np.array([edge(c, 0.5, 64) for c in x.T])
        mad = np.array([edge(np.abs(c - m), 0.5, 64) for c, m in zip(x.T, med)])
        for mean, cov in ((med, np.diag((1.4826 * mad) ** 2) + floors), (x.mean(0), np.cov(x.T, bias=True) + floors)):
            for _ in range(quality.STEPS):
                d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
                log = np.log2(d + 1e-3)
                near = x[log < edge(log, quality.HALF, 32)]
                mean, cov = near.mean(0), quality.CONSISTENCY * np.cov(near.T, bias=True) + floors
            det = np.linalg.slogdet(cov)[1]
            if best is None or det < best[0] - 1e-9:
                best = det, np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        for (k, _), d in zip(own, best[1]):
            out[k][-1] = bool(d <= quality.CUT)
    return [tuple(out[k]) for k in range(len(rows))]


@pytest.fixture(scope="module")
def made_up():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdéfgh") for _ in range(rnd.randint(2, 8)))
    rows = []
    for k in range(420):
        words = [word() for _ in range(int(50 * 2 ** rnd.uniform(0, 4)))]
        if k % 20 == 0:
            words = [w + "###" for w in words]
        if k % 23 == 0:
            words = words[:60] + words[:25]
        if k % 29 == 0:
            words = ["supercalifragilistic" * 3 for _ in words[:30]] + words[:60]
        lines = [" ".join(words[i : i + 10]) for i in range(0, len(words), 10)]
        if k % 31 == 0:
            lines += lines[:2]
        rows.append((k, "\n".join(lines), ["en", "de"][k % 2] if k % 50 else None, "a" if k % 3 else "b"))
    rows += [(500, None, "en", "a"), (501, "", None, None), (502, "one two three " * 40000, "en", "a"), (503, "\n \n\t", "en", "a")]
    rows += [(504, "x y z\nx y z\n x y z", "en", "a"), (505, "a b c d a b c", "en", "a")]
    return rows


def test_equals_brute_force(spark, made_up):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in made_up], SCHEMA)
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    expected = brute(made_up)
    assert len(got) == len(made_up)
    for row, want in zip(made_up, expected):
        r = got[row[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == want, row[0]
    rejected = [e for e in expected if not e[6] and not e[5]]
    assert 10 < len(rejected) < 80


def test_kept_rows_keep_their_columns(spark, made_up):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in made_up[:150] + made_up[:1]], SCHEMA)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    want = {r.doc_id for r in quality.judge(df).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_native(spark, made_up):
    df = spark.createDataFrame(made_up, "doc_id long, text string, lang string, source string")
    plan = quality.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "w " * 60, "en", "a"), (1, "w " * 60, "en", "a"), (2, " ".join(map(str, range(60))), None, None)], "doc_id long, text string, lang string, source string")
    assert sorted((r.doc_id, r.kept) for r in quality.judge(df).collect()) == [(1, False), (1, False), (2, True)]
    assert quality.judge(df.limit(0)).count() == 0


def test_whole_table_counts(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in queries.table(spark, d, "documents").collect()}
    got = queries.REGISTRY["op9_quality_rules"](spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id])[:5]

import random

from pyspark.sql import functions as F

from creditframe.llm import language_id as li
from creditframe.llm import queries

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def brute_phrases(sample: str, text: str) -> int:
    """Longest-match parsing with plain substring search, in blocks."""
    total = 0
    for block in range(0, len(text), li.BLOCK):
        part, at = text[block : block + li.BLOCK], 0
        while at < len(part):
            n = 0
            while at + n < len(part) and part[at : at + n + 1] in sample:
                n += 1
            at += max(n, 1)
            total += 1
    return total


def test_phrases_equal_plain_search():
    rnd = random.Random(5)
    samples = {x: ["".join(rnd.choice(letters) for _ in range(400))] for x, letters in (("a", "abc "), ("b", "bcd "))}
    model = li.fit(samples, 800)
    texts = ["".join(rnd.choice("abcdz ") for _ in range(n)) for n in (1, 7, 300, li.BLOCK, li.BLOCK + 1, 3 * li.BLOCK + 5)]
    texts = [" ".join(t.split()) or "a" for t in texts]
    got = li.phrases(model, [li.symbols_of(model, t) for t in texts])
    cut = {x: " ".join(samples[x][0].split())[: min(map(lambda y: len(" ".join(y[0].split())), samples.values()))] for x in samples}
    for text, row in zip(texts, got.tolist()):
        # A known letter cannot follow an unknown one in a phrase, and the last block's phrase is always counted.
        for lang, n in zip(model.langs, row):
            assert abs(n - brute_phrases(cut[lang], text)) <= 1 + len(text) // li.BLOCK + 0.02 * n


def test_edge_cases(spark):
    rows = [(i, "the cat and the hat sat on that mat " * 3, "en", "x", "y") for i in range(20)]
    rows += [(100 + i, "der hund und die katze sind nicht hier " * 3, "de", "x", "y") for i in range(20)]
    rows += [(200, None, "en", None, None), (201, "", None, None, None), (202, "123 !!", "de", None, None)]
    rows += [(203, "日本語", None, None, None), (204, "THE HAT AND THE CAT" * 20000, None, None, None), (5, "der und die katze", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.lang_pred): r.score for r in li.identify(df, F.col("doc_id") < 1000).collect()}
    assert len(got) == 46
    assert all((i, "en") in got for i in range(20)) and all((100 + i, "de") in got for i in range(20))
    assert got[200, "und"] == got[201, "und"] == got[202, "und"] == 0.0
    assert (204, "en") in got and (5, "de") in got
    assert all(0 <= s <= 1 for s in got.values())


def test_rare_languages_leave_the_others_their_text(spark):
    rnd = random.Random(8)
    vocabularies = {x: ["".join(rnd.choice("aeinorstl") for _ in range(rnd.randint(3, 7))) for _ in range(80)] for x in ("aa", "bb")}
    rows = [(200 * k + i, " ".join(rnd.choices(v, k=30)), x, None, None) for k, (x, v) in enumerate(vocabularies.items()) for i in range(60)]
    rows += [(1000, "e", "r1", None, None), (1001, "tan sol", "r2", None, None), (1002, "12345", "r3", None, None), (1003, "日本語 日本", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    learnable = (F.col("doc_id") % 3 != 1) | (F.col("doc_id") >= 1000)
    got = {r.doc_id: r for r in li.identify(df, learnable).collect()}
    held_out = [r for r in rows if r[0] % 3 == 1 and r[0] < 1000]
    assert len(held_out) == 40 and all(got[r[0]].lang_pred == r[2] for r in held_out)
    assert (got[1003].lang_pred, got[1003].score) == ("aa", 0.2)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None, None, None)], SCHEMA)
    assert [r.lang_pred for r in li.identify(df, F.lit(True)).collect()] == ["und"]
    assert li.identify(df.limit(0), F.lit(True)).count() == 0


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = queries.REGISTRY["op3_language_id"](spark, d).join(truth, "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97

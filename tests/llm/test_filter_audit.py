import re
from itertools import permutations

from creditframe.llm import filter_audit

DOCS = "doc_id long, text string, source string, A int, digest string"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute(docs, labels):
    """Every order and step by a plain loop over documents."""
    marks = {}
    for doc_id, quality, toxic, _ in labels:
        if doc_id is not None:
            good, bad = marks.get(doc_id, (0, 0))
            marks[doc_id] = (max(good, int(quality == 1)), max(bad, int(toxic == 1)))
    first = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            t = text or ""
            first[t] = min(first.get(t, doc_id), doc_id)
    rows = []
    for doc_id, text, source, *_ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": doc_id is not None and first[t] < doc_id,
        }
        good, bad = marks.get(doc_id, (0, 0)) if doc_id is not None else (0, 0)
        rows.append((source or "", fails, good, bad))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order):
                before = order[:step]
                removed = [r for r in mine if r[1][f] and not any(r[1][g] for g in before)]
                out[(part, order, step + 1)] = (
                    sum(1 for r in mine if not any(r[1][g] for g in order[: step + 1])),
                    len(removed),
                    sum(1 for r in mine if r[1][f] and any(r[1][g] for g in before)),
                    sum(1 for r in mine if r[1][f] and not any(r[1][g] for g in "ABCDE" if g != f)),
                    sum(r[2] for r in removed),
                    sum(r[3] for r in removed),
                )
    for part in {r[0] for r in rows}:
        for f in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == f)
            for (p, o, s), v in list(out.items()):
                if p == part and o[s - 1] == f:
                    out[(p, o, s)] = (*v, total)
    return out


def run(spark, docs, labels):
    found = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}


def test_equal_to_brute_force_with_edge_cases(spark):
    long_text = " ".join(f"w{i % 150}" for i in range(300))
    docs = [
        (1, long_text, "a", 9, "x"),
        (2, long_text, "a", 9, "x"),  # copy of a smaller id: fails E
        (3, "SHOUTING $ here", "a", None, None),
        (None, long_text, "a", None, None),  # no id: never fails E
        (4, None, None, None, None),  # null text and source
        (5, "", "", None, None),  # empty text, same part as null source
        (5, "", "", None, None),  # repeated row
        (6, " ".join(["same"] * 250), "b", None, None),
        (7, " ".join(f"u{i}" for i in range(260)) + " |", "b", None, None),
    ]
    labels = [(1, 1, 0, "z"), (2, 1, 1, "z"), (2, 0, 0, "z"), (3, 0, 1, None), (None, 1, 1, None), (6, None, None, None)]
    got = run(spark, docs, labels)
    assert len(got) == 3 * 600
    assert got == brute(docs, labels)


def test_counts_add_up(spark):
    docs = [(i, " ".join(["x"] * (i * 40)), "s", None, None) for i in range(1, 9)]
    got = run(spark, docs, [])
    for (part, order, step), (kept, removed, *_rest) in got.items():
        before = got[(part, order, step - 1)][0] if step > 1 else 8
        assert kept == before - removed


def test_empty_table(spark):
    assert run(spark, [], []) == {}

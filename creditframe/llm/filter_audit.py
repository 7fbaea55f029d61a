"""How five document filters interact: counts of every filter at every step of every order.

Each document gets five fail bits, and each part (a source) a contingency tensor of shape 2x2x2x2x2:
the number of its documents with each pattern of fails, and beside it the same tensor counting only
documents labelled good and only those labelled toxic. The tensors come from one grouping with partial
aggregation, so a hot source costs no more than its share of map-side work, and a part holds at most 32
cells. A step's counts are then contractions of the tensor: along each filter's axis ``einsum`` takes the
pass cell, the fail cell or both, according to whether that filter came before the step, is the step's
own or comes later.

Filters (words are maximal runs of bytes other than ASCII white space, case-sensitive; a null text is
empty):

- A: under 200 words;
- B: 100 * distinct words < 50 * words;
- C: 100 * characters A-Z > 2 * code points;
- D: holds any of ``#$%&*|``;
- E: the text equals that of a smaller ``doc_id`` anywhere in the table, whether that one is removed or
  not. Texts are compared by their SHA-256.

Edge cases: a row without ``doc_id`` never fails E and makes no other row fail it; its label is unknown,
so it counts as neither good nor toxic. A null source is the part ``''``. Repeated rows are all counted
(the later ones of equal id do not fail E, their id not being smaller). ``labels`` rows of one id are
folded, any 1 winning. Extra columns of either table are ignored, whatever their names. An empty table
gives no rows; every part present gives all 600 rows, zeros included.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)

#: Along one axis of the tensor: index 0 is pass, 1 is fail.
_PASS, _FAIL, _ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
_SPEC = "abcde,a,b,c,d,e->"


def fail_bits(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id``, ``part`` and the fail bits ``A`` to ``E`` (ints 0 or 1) of every document row."""
    docs = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    digest = F.sha2("text", 256)
    # The smallest id of each text, by partial aggregation: a hot text is folded map-side.
    first = docs.where(F.col("doc_id").isNotNull()).groupBy(digest.alias("digest")).agg(F.min("doc_id").alias("first_id"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    upper = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))
    counted = docs.select(
        "doc_id",
        "part",
        digest.alias("digest"),
        F.size(words).alias("n_words"),
        F.size(F.array_distinct(words)).alias("n_distinct"),
        upper.alias("n_upper"),
        F.length("text").alias("n_chars"),
        F.col("text").rlike(r"[#$%&*|]").alias("symbol"),
    )
    joined = counted.join(first, "digest", "left")
    bit = lambda condition: F.coalesce(condition, F.lit(False)).cast("int")
    return joined.select(
        "doc_id",
        "part",
        bit(F.col("n_words") < 200).alias("A"),
        bit(100 * F.col("n_distinct") < 50 * F.col("n_words")).alias("B"),
        bit(100 * F.col("n_upper") > 2 * F.col("n_chars")).alias("C"),
        bit(F.col("symbol")).alias("D"),
        bit(F.col("first_id") < F.col("doc_id")).alias("E"),
    )


def tensors(bits: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part and pattern of fails: its documents, and those labelled good and toxic."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"), F.col("toxic").alias("t"))
    marks = marks.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("q") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("t") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    labelled = bits.join(marks, "doc_id", "left")
    return labelled.groupBy("part", *FILTERS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic"),
    )


def _selectors(order: str, step: int) -> list[np.ndarray]:
    """Per filter: pass before the step, fail at it, anything after."""
    at = {f: i for i, f in enumerate(order)}
    return [_PASS if at[f] < step else _FAIL if at[f] == step else _ALL for f in FILTERS]


def contract(cells: pd.DataFrame) -> pd.DataFrame:
    """The 600 rows of one part from its cells (at most 32 rows)."""
    tensor = {w: np.zeros((2,) * 5, np.int64) for w in ("n", "good", "toxic")}
    for row in cells.itertuples(index=False):
        at = tuple(int(getattr(row, f)) for f in FILTERS)
        for w in tensor:
            tensor[w][at] += int(getattr(row, w))
    n = tensor["n"]
    fails = {f: int(np.einsum(_SPEC, n, *[_FAIL if g == f else _ALL for g in FILTERS])) for f in FILTERS}
    unique = {f: int(np.einsum(_SPEC, n, *[_FAIL if g == f else _PASS for g in FILTERS])) for f in FILTERS}
    rows = []
    for order in ORDERS:
        for step, f in enumerate(order):
            chosen = _selectors(order, step)
            removed = int(np.einsum(_SPEC, n, *chosen))
            kept = int(np.einsum(_SPEC, n, *[_PASS if order.index(g) <= step else _ALL for g in FILTERS]))
            rows.append(
                (order, step + 1, f, kept, removed, fails[f] - removed, unique[f],
                 int(np.einsum(_SPEC, tensor["good"], *chosen)), int(np.einsum(_SPEC, tensor["toxic"], *chosen)))
            )
    out = pd.DataFrame(rows, columns=["filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"])
    out["shapley"] = out.groupby("filter")["removed"].transform("sum")
    out.insert(0, "part", cells["part"].iloc[0])
    return out.drop(columns="filter")


def audit(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique fails, good and toxic lost, Shapley total.

    ``shapley`` is the step's filter's removed count summed over all 120 orders, at whatever step it stands.
    """
    cells = tensors(fail_bits(documents, id_col=id_col, text_col=text_col, part_col=part_col), labels)
    return cells.groupBy("part").applyInPandas(contract, SCHEMA)

"""Benchmark decontamination by size-partitioned MinHash containment search, in built-in functions only.

A document is contaminated by a benchmark item if it holds ``percent`` % of the item's shingles (runs of
``width`` words, A-Z in lower case) or more, however long it is.

1. An item's sketch has its shingles of the least hashes. Items are partitioned by size, since the number
   of shingles that may be missing, and so the sketch, grows with it: with ``m`` that may be missing, the
   sketch has ``2 m + 1``, of which any contaminated document holds ``m + 1`` at least. So no link is lost.
2. Hashes of the sketches, folded to ``FOLD`` values, are broadcast: a table of that size at most, however
   large the benchmark. Only shingles of documents that pass it are shuffled, to meet the sketches.
3. Documents that hold enough of a sketch are candidates; they are read again and their whole shingles,
   as text, are intersected with the item's.

Filters on what arrays give stand above an aggregate or a join, and arrays are exploded as outer ones: else
the optimizer would move a condition, with the arrays' definitions in it, to where it is computed anew for
every element.

Words are runs of anything but ASCII white space. Edge cases: a text of fewer words is one shingle, its
whole sequence; null texts and those without words are linked with nothing; repeated items are linked
alike; rows of equal document id are one document, linked with what any of them holds; empty tables give
no links, and no rows where there are no documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditframe.llm import _rows

FOLD = 1 << 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _UPPER + "\t\n\v\f\r", _LOWER + "     ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _runs(words: str, width: int, of: str) -> Column:
    """``of`` applied to every run of words: the array column ``words`` is cut with ``slice`` by place."""
    return F.expr(
        f"CASE WHEN size({words}) = 0 THEN array() "
        f"ELSE transform(sequence(1, greatest(size({words}) - {width - 1}, 1)), k -> {of}) END"
    )


def shingle_hashes(df: DataFrame, text: str, width: int, *keys: str) -> DataFrame:
    """The keys and ``hashes``, one for each run of words, repeated ones too.

    Words are hashed first, and runs from the hashes of their words, so that no run is ever built as text.
    """
    hashed = df.select(*keys, F.transform(_words(F.col(text)), lambda w: F.xxhash64(w)).alias("w"))
    parts = ", ".join(f"try_element_at(w, k + {i})" for i in range(width))
    return hashed.select(*keys, _runs("w", width, f"xxhash64({parts})").alias("hashes"))


def _shingles(words: Column, width: int) -> Column:
    """The different runs of words as text."""
    n = F.greatest(F.size(words) - (width - 1), F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), n), lambda k: F.concat_ws(" ", F.slice(words, k, width)))
    return F.when(F.size(words) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _missing(n: Column, percent: int) -> Column:
    """How many of n shingles a contaminated document may lack."""
    return n - F.ceil(n * percent / F.lit(100))


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shingles`` of the item and ``n_shared`` of every link."""
    docs = documents.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").where("doc_id is not null")
    items = benchmark.selectExpr(f"cast(`{item_col}` as long) item_id", f"`{item_text_col}` text").distinct()

    hashes = shingle_hashes(items, "text", width, "item_id", "text")
    hashes = hashes.select("item_id", "text", F.array_sort(F.array_distinct("hashes")).alias("hashes"))
    n = F.size("hashes")
    size = F.least(n, 2 * _missing(n, percent) + 1)
    sketch = hashes.select(
        "item_id",
        "text",
        (size - _missing(n, percent)).alias("needed"),
        F.explode_outer(F.slice("hashes", F.lit(1), size.cast("int"))).alias("h"),
    )
    folded = sketch.select(F.pmod("h", F.lit(FOLD)).alias("fold")).distinct()

    found = shingle_hashes(docs, "text", width, "doc_id").select("doc_id", F.explode_outer("hashes").alias("h"))
    found = found.withColumn("fold", F.pmod("h", F.lit(FOLD))).join(F.broadcast(folded), "fold", "left_semi")
    met = _rows.hot_join(found.select("doc_id", "h"), sketch, ["h"])
    candidates = met.groupBy("doc_id", "item_id", "text", "needed").agg(F.countDistinct("h").alias("n"))
    candidates = candidates.where("n >= needed").select("doc_id", "item_id", F.col("text").alias("item_text"))

    both = docs.join(candidates, "doc_id")
    both = both.select("doc_id", "item_id", _words(F.col("text")).alias("dw"), _words(F.col("item_text")).alias("iw"))
    own = both.select(
        "doc_id", "item_id", _shingles(F.col("dw"), width).alias("ds"), _shingles(F.col("iw"), width).alias("its")
    )
    counted = own.select(
        "doc_id", "item_id", F.size("its").alias("n_shingles"), F.size(F.array_intersect("ds", "its")).alias("n_shared")
    )
    links = counted.groupBy("doc_id", "item_id").agg(
        F.max("n_shingles").cast("long").alias("n_shingles"), F.max("n_shared").cast("long").alias("n_shared")
    )
    return links.where(100 * F.col("n_shared") >= percent * F.col("n_shingles"))


def contamination(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per row of documents: ``doc_id``, ``n_items`` and the sorted ``item_ids`` it is contaminated by."""
    links = find_leaks(documents, benchmark, **options)
    items = links.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    ids = documents.select(F.col(options.get("id_col", "doc_id")).cast("long").alias("doc_id"))
    out = ids.join(items, "doc_id", "left")
    return out.select(
        "doc_id",
        F.when(F.col("item_ids").isNull(), 0).otherwise(F.size("item_ids")).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
    )


def remove_leaks(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    leaks = find_leaks(documents, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("leaking")).distinct()
    return documents.join(leaks, F.col(f"`{id_col}`").cast("long") == F.col("leaking"), "left_anti")

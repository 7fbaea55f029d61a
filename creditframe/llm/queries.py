"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditframe.llm import centroids, decontaminate, token_codes, filter_audit, html_extract, language_id, licenses, line_dedup, near_dedup, packing, quality, suffix_dedup, toxicity

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary the packing contract names; the file stays where the box has it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def remainder(id_col: str, n: int):
    """crc32 of the id as text, modulo ``n``: what parts the rows to learn from and the held-out ones."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


@register
def op1_line_dedup(spark, d):
    kept = line_dedup.dedup_lines(table(spark, d, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


@register
def op2_html_extract(spark, d):
    found = html_extract.extract_pages(table(spark, d, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@register
def op3_language_id(spark, d):
    docs = table(spark, d, "documents")
    found = language_id.identify(docs, remainder("doc_id", 4) != 2)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@register
def op4_toxicity(spark, d):
    labels = table(spark, d, "labels")
    found = toxicity.score_documents(table(spark, d, "documents"), labels, remainder("doc_id", 3) != 1)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@register
def op5_decontaminate(spark, d):
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "n_items", F.concat_ws(",", F.col("item_ids").cast("array<string>")).alias("item_ids"))


@register
def op6_near_dedup(spark, d):
    return near_dedup.near_duplicates(table(spark, d, "documents"))


@register
def op7_suffix_dedup(spark, d):
    kept = suffix_dedup.remove_repeats(table(spark, d, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


@register
def op8_license_scan(spark, d):
    return licenses.scan(table(spark, d, "documents")).drop("spans")


@register
def op9_quality_rules(spark, d):
    return quality.judge(table(spark, d, "documents")).drop("text_hash")


@register
def op10_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), tokenizer_path())


@register
def op11_token_codes(spark, d):
    folder = token_codes.write(table(spark, d, "documents"), token_codes.scratch_folder(spark), tokenizer_path())
    return token_codes.read(spark, folder)


@register
def op12_centroids(spark, d):
    assigned, centres = centroids.cluster(table(spark, d, "embeddings"), k=40, rounds=5)
    return centroids.with_inertia(assigned, centres)


@register
def op13_filter_audit(spark, d):
    return filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))


def oracle_sql() -> dict[str, str]:
    from creditframe.llm import sql

    return dict(sql.ORACLES)

"""Quality rules with robust multivariate outliers, in built-in functions only.

Base rules look at a text alone: too few words, or too many words in runs of three that repeat. Texts that
pass are compared with those of the same language and source: five transformed statistics (length, word
length, symbols, repeated lines, repeated runs) and their minimum-covariance-determinant estimates give a
Mahalanobis distance, and texts beyond the cut are rejected.

Estimates start from coordinate-wise medians and, as a second start, from plain moments. Each
concentration step keeps the ``HALF`` of a group's texts that are nearest and takes their moments anew; of
both starts the one of the smaller determinant wins. The diagonal is raised by fixed variances, so that a
group whose texts have, say, no symbols at all doesn't reject the first one that has some.

Texts are read once, into a table of their statistics, written to the checkpoint folder. Steps work on
that: quantiles come from counts in fixed bins, moments from sums, both added up in each task before
anything is shuffled, so a group of a third of all texts is like any other. Groups of fewer than
``min_rows`` texts are pooled; where the pool has too few itself, the base rules decide.

Edge cases: null texts have no words and fail the base rules; null languages and sources are groups like
others; repeated rows count as often as they occur; texts of one document id are judged one by one; an
empty table gives no rows. No filter stands on columns made from arrays before they are written, since the
optimizer would compute the arrays again for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditframe.llm import _rows
from creditframe.session import ensure_checkpoint_dir

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
DIMENSIONS = ("words", "word_length", "symbols", "dup_lines", "repeats")
#: Variances added to those of the dimensions.
FLOORS = (0.5**2, 0.1**2, 0.35**2, 0.15**2, 0.15**2)
HALF = 0.75
#: 0.75 / P(chi2 of 7 <= the 0.75 quantile of chi2 of 5): makes the trimmed variance that of normal data.
CONSISTENCY = 1.4127
#: The 0.99999 quantile of chi2 of 5.
CUT = 30.856
STEPS = 3
_P = range(len(DIMENSIONS))
_PAIRS = [(i, j) for i in _P for j in range(i + 1)]


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def statistics(documents: DataFrame, text: str, *keys: Column) -> DataFrame:
    """The keys and a text's counts: words, characters in words, symbols, lines, repeated lines, words in repeats."""
    text_col = F.coalesce(F.col(text), F.lit(""))
    df = documents.select(*keys, text_col.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    hashes = F.transform(
        F.filter(F.split(F.translate("t", SPACES, " " * len(SPACES)), " "), lambda w: w != ""), lambda w: F.xxhash64(w)
    )
    names = [c for c in df.columns if c != "t"]
    df = df.select(
        *names,
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).alias("n_symbols"),
        lines.alias("lines"),
        hashes.alias("w"),
    )
    names += ["word_chars", "n_symbols"]
    run = "struct(xxhash64(try_element_at(w, k), try_element_at(w, k + 1), try_element_at(w, k + 2)) as h, k as k)"
    df = df.select(
        *names,
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("w").cast("long").alias("n_words"),
        F.expr(f"CASE WHEN size(w) > 2 THEN sort_array(transform(sequence(1, size(w) - 2), k -> {run})) END").alias("runs"),
    )
    names += ["n_lines", "n_dup_lines", "n_words"]
    # Neighbours in the order of hashes are equal runs: their places, in order, and the words they cover.
    df = df.select(
        *names,
        F.expr(
            "sort_array(array_distinct(flatten(filter(zip_with(runs, slice(runs, 2, size(runs)), "
            "(a, b) -> IF(a.h = b.h, array(a.k, b.k), NULL)), p -> p IS NOT NULL))))"
        ).alias("places"),
    )
    covered = (
        "aggregate(zip_with(places, slice(places, 2, size(places)), (a, b) -> least(3, coalesce(b - a, 3))), "
        "0L, (sum, n) -> sum + n)"
    )
    return df.select(*names, F.coalesce(F.expr(f"CASE WHEN size(places) > 0 THEN {covered} END"), F.lit(0)).cast("long").alias("n_repeat_words"))


def _vector() -> list[Column]:
    """The transformed statistics."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [
        F.log1p(F.col("n_words").cast("double")),
        F.log(chars / words),
        F.log1p(100.0 * F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _quantile(df: DataFrame, keys: list[str], value: Column, share: float, scale: int, name: str) -> DataFrame:
    """The upper edge of the bin, ``1 / scale`` wide, at which that share of each group's values is reached."""
    bins = df.groupBy(*keys, F.floor(value * scale).alias("bin")).agg(F.count("*").alias("n"))
    group = Window.partitionBy(*keys)  # as many rows as a group has bins, not texts
    found = bins.withColumn("up_to", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    return found.where(F.col("up_to") >= share * F.col("all")).groupBy(*keys).agg(((F.min("bin") + 1) / scale).alias(name))


def _whitened(df: DataFrame, keys: list[str]) -> DataFrame:
    """From means m* and covariances c*_*: means, the inverse w*_* of the Cholesky factor, and the log determinant."""
    for i, j in _PAIRS:
        rest = sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
        c = F.col(f"c{i}_{j}") - rest
        df = df.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(c, F.lit(1e-12))) if i == j else c / F.col(f"l{j}_{j}"))
    for j in _P:
        for i in range(j, len(DIMENSIONS)):
            if i == j:
                value = 1 / F.col(f"l{i}_{i}")
            else:
                value = -sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}_{i}")
            df = df.withColumn(f"w{i}_{j}", value)
    det = sum((2 * F.log(f"l{i}_{i}") for i in _P), F.lit(0.0)).alias("log_det")
    return df.select(*keys, *[f"m{i}" for i in _P], *[f"w{i}_{j}" for i, j in _PAIRS], det)


def _distance() -> Column:
    """The squared Mahalanobis distance of a row's vector x* under the estimates beside it."""
    parts = []
    for i in _P:
        z = sum((F.col(f"w{i}_{j}") * (F.col(f"x{j}") - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0))
        parts.append(z * z)
    return sum(parts, F.lit(0.0))


def _moments(df: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Means and covariances of each group, the variances raised."""
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in _P],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}_{j}") for i, j in _PAIRS],
    )
    mean = {i: F.col(f"s{i}") / F.col("n") for i in _P}
    cov = [
        (factor * (F.col(f"q{i}_{j}") / F.col("n") - mean[i] * mean[j]) + F.lit(FLOORS[i] if i == j else 0.0)).alias(f"c{i}_{j}")
        for i, j in _PAIRS
    ]
    return sums.select(*keys, *[mean[i].alias(f"m{i}") for i in _P], *cov)


def _by_medians(rows: DataFrame) -> DataFrame:
    """Medians and, as variances, squared median deviations."""
    long = rows.select("g", F.posexplode(F.array(*[f"x{i}" for i in _P])).alias("i", "x"))
    middle = _quantile(long, ["g", "i"], F.col("x"), 0.5, 64, "m")
    spread = _quantile(
        _rows.hot_join(long, middle, ["g", "i"]).withColumn("d", F.abs(F.col("x") - F.col("m"))), ["g", "i"], F.col("d"), 0.5, 64, "s"
    )
    both = middle.join(spread, ["g", "i"])
    at = lambda name, i: F.max(F.when(F.col("i") == i, F.col(name)))
    wide = both.groupBy("g").agg(*[at("m", i).alias(f"m{i}") for i in _P], *[at("s", i).alias(f"s{i}") for i in _P])
    cov = [((1.4826 * F.col(f"s{i}")) ** 2 + FLOORS[i] if i == j else F.lit(0.0)).alias(f"c{i}_{j}") for i, j in _PAIRS]
    return wide.select("g", *[f"m{i}" for i in _P], *cov)


def estimates(rows: DataFrame) -> DataFrame:
    """The minimum-covariance-determinant estimates of each group ``g`` of the vectors x0 to x4."""
    starts = [_by_medians(rows), _moments(rows, ["g"], 1.0)]
    found = starts[0].withColumn("start", F.lit(0)).unionByName(starts[1].withColumn("start", F.lit(1)))
    found = _whitened(found, ["g", "start"]).checkpoint()
    keys = ["g", "start"]
    for _ in range(STEPS):
        placed = _rows.hot_join(rows, found, ["g"]).select(*keys, *[f"x{i}" for i in _P], _distance().alias("d"))
        near = _quantile(placed, keys, F.log2(F.col("d") + 1e-3), HALF, 32, "edge")
        kept = _rows.hot_join(placed, near, keys).where(F.log2(F.col("d") + 1e-3) < F.col("edge"))
        found = _whitened(_moments(kept, keys, CONSISTENCY), keys).checkpoint()
    order = Window.partitionBy("g").orderBy("log_det", "start")
    return found.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r", "start")


def judge(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    min_rows: int = 100,
    cut: float = CUT,
) -> DataFrame:
    """One row per text: ``doc_id``, ``text_hash``, the counts, ``base_failed``, ``distance`` and ``kept``."""
    ensure_checkpoint_dir(documents.sparkSession)
    keys = [
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
    ]
    counts = statistics(documents, text_col, *keys)
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < min_words) | (100 * repeats > max_repeat_percent * words)
    counts = counts.withColumn("base_failed", failed).select("*", *[x.alias(f"x{i}") for i, x in enumerate(_vector())])
    counts = counts.checkpoint()

    # The group of each language and source: its name, or 0 for the pool; none where the pool is too small.
    passed = counts.where(~F.col("base_failed"))
    named = F.xxhash64(F.coalesce("lang", F.lit("\0")), F.coalesce("source", F.lit("\0")), F.lit("group"))
    sizes = passed.groupBy(named.alias("name")).agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") >= min_rows).select("name", F.col("name").alias("large"))
    counts = _rows.hot_join(counts.withColumn("name", named), large, ["name"], "left").withColumn("g", F.coalesce("large", F.lit(0)))
    rows = counts.where(~F.col("base_failed")).select("g", *[f"x{i}" for i in _P])
    enough = rows.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows).select("g")
    model = estimates(rows).join(enough, "g", "left_semi")

    judged = _rows.hot_join(counts, model, ["g"], "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)
    return judged.select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "distance", kept.alias("kept"),
    )


def keep_good(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are kept, with all their columns."""
    judged = judge(documents, id_col=id_col, text_col=text_col, **options)
    rejected = judged.where(~F.col("kept")).select("doc_id", "text_hash").distinct()
    rows = _rows.apart(documents, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    same = (rows["doc_id"].eqNullSafe(rejected["doc_id"])) & (rows["text_hash"] == rejected["text_hash"])
    return _rows.together(rows.join(rejected, same, "left_anti"), documents.columns, text_col, {})

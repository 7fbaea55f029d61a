"""Near-duplicate documents by MinHash with tensored banding, each link confirmed on full shingle sets.

A document's set has its different runs of ``width`` words, as 64-bit hashes. Documents of equal sets are
one class and are represented by one of them from here on.

Tables keyed by four minhashes would take four hash functions each. Instead two collections of ``HALF``
sub-keys, of two minhashes each, are made, and every pair of one from either collection keys a table: 64
tables from 32 hash functions. A pair of similarity 0.8 shares a table with probability 0.9994.

1. Sub-keys that only one class has are set aside before keys are paired.
2. In every bucket each class is compared with the smallest, and links are joined to components.
3. Buckets that still hold several components are cut into blocks of ``BLOCK`` classes, and pairs of
   different components are compared block by block, each pair in the first table that it shares only.
   Groups of copies are one component by then, so their pairs are never listed.

Compared are first sizes and sketches (the least hash of each of ``BINS`` ranges, one byte each): pairs
whose estimated similarity is more than four deviations below the threshold go no further. The rest are
confirmed: ``100 * intersection >= percent * union`` on the full sets, made anew from the texts of those
documents alone. A bitmap of fixed size tells the scan which texts those are.

Edge cases: a text of fewer words is one shingle, its whole sequence; a null text or one without words has
an empty set, no links and itself as component; rows without an id have no links, component or ``kept``;
rows of equal id are versions of one document, linked with each other; an empty table gives no rows; very long texts are sets like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditframe.llm import _rows, _text
from creditframe.llm.components import connected_components
from creditframe.session import ensure_checkpoint_dir

HALF = 8
BINS = 512
BLOCK = 2048
ID_BITS = 1 << 26

_RANDOM = np.random.default_rng(20240607)
_FACTOR = _RANDOM.integers(1, 2**63, 4 * HALF, dtype=np.uint64) | np.uint64(1)
_OFFSET = _RANDOM.integers(0, 2**63, 4 * HALF, dtype=np.uint64)
#: Where the ranges of a sketch part.
_EDGES = np.arange(1, BINS, dtype=np.uint64) << np.uint64(64 - (BINS - 1).bit_length())


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted different shingles of each text."""
    data = _text.lower(data)
    starts, ends, first = _text.words(data, offsets, _text.NOT_SPACE)
    found, at = _text.shingles(_text.word_hashes(data, starts, ends), first, width)
    return [np.unique(found[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def sub_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Two collections of sub-keys for each set, none of which may be empty."""
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(x) for x in sets[:-1]])
    least = np.stack([np.minimum.reduceat(flat * a + b, at) for a, b in zip(_FACTOR, _OFFSET)], 1)
    return _text.mix(least[:, 0::2] * np.uint64(3) + _text.mix(least[:, 1::2]))


def sketch(own: np.ndarray) -> bytes:
    """Which ranges of hashes have a shingle, as bits, and a byte of the least one of each that has."""
    at = np.concatenate(([0], np.searchsorted(own, _EDGES), [len(own)]))
    filled = at[:-1] < at[1:]
    values = own[at[:-1][filled]] % np.uint64(255) + np.uint64(1)
    return np.packbits(filled).tobytes() + values.astype(np.uint8).tobytes()


def unpacked(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of bytes, 0 where a range has no shingle."""
    head = BINS // 8
    filled = np.unpackbits(np.frombuffer(b"".join(x[:head] for x in sketches), np.uint8).reshape(-1, head), axis=1) > 0
    out = np.zeros(filled.shape, np.uint8)
    out[filled] = np.frombuffer(b"".join(x[head:] for x in sketches), np.uint8)
    return out


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sketches may belong to sets of at least that similarity; sizes alone can rule it out."""
    least = percent / 100
    fits = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    same = ((a == b) & (a > 0)).sum(1)
    used = ((a > 0) | (b > 0)).sum(1)
    # The ranges sample ``used`` of the union's elements without putting any back.
    union = (n_a + n_b) / (1 + least)
    deviation = np.sqrt(least * (1 - least) / np.maximum(used, 1) * np.maximum(1 - used / np.maximum(union, 1), 0.02))
    return fits & (same >= (least - 4 * deviation - 0.005) * used)


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _text.pieces(batches, "text"):
            sets = shingle_sets(data, offsets, width)
            full = [k for k, x in enumerate(sets) if len(x)]
            keys, subs, sketches = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                for k, sub in zip(full, sub_keys([sets[k] for k in full]).view(np.int64)):
                    keys[k] = xxhash.xxh3_128_digest(sets[k].tobytes())
                    subs[k] = sub
                    sketches[k] = sketch(sets[k])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(subs, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_key", "sub", "sketch"],
            )

    return run


def _star_filter(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1 << 14):
                r = batch.slice(first, 1 << 14)
                keep = likely(
                    unpacked(r.column(2).to_pylist()), unpacked(r.column(3).to_pylist()),
                    r.column(4).to_numpy(), r.column(5).to_numpy(), percent,
                )
                yield r.select([0, 1]).filter(pa.array(keep))

    return run


def _cross_pairs(percent: int):
    """Pairs of different components within each block, or between two blocks, of a bucket.

    Rows come sorted by bucket and blocks; columns are key, b1, b2, own block, table, head, id, n, component, sub, sketch.
    """

    def pairs_of(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs within consecutive groups of the given sizes, some hundred thousand at a time."""
        starts = np.cumsum(sizes) - sizes
        left = np.repeat(starts + sizes, sizes) - np.arange(sizes.sum()) - 1  # partners after each row
        edges = np.cumsum(left)
        first = 0
        while first < len(left):
            last = max(int(np.searchsorted(edges, (edges[first - 1] if first else 0) + (1 << 18), "right")), first + 1)
            n = left[first:last]
            a = np.repeat(np.arange(first, last), n)
            b = a + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield a, b
            first = last

    def compare(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        b1, b2, own, table, head, ids, sizes, comps = (rows.column(k).to_numpy() for k in range(1, 9))
        keys = rows.column(0).to_numpy()
        sub = rows.column(9).flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * HALF)
        sketches = unpacked(rows.column(10).to_pylist())
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (b1[1:] != b1[:-1]) | (b2[1:] != b2[:-1])))
        at = np.flatnonzero(new)
        for a, b in pairs_of(np.diff(np.append(at, len(keys)))):
            keep = (comps[a] != comps[b]) & (ids[a] != head[a]) & (ids[b] != head[b])
            keep &= (b1[a] == b2[a]) | (own[a] != own[b])
            keep &= 100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b])
            a, b = a[keep], b[keep]
            same = sub[a] == sub[b]
            here = same[:, :HALF].argmax(1) * HALF + same[:, HALF:].argmax(1) == table[a]
            a, b = a[here], b[here]
            good = likely(sketches[a], sketches[b], sizes[a], sizes[b], percent)
            if good.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[a[good]]), pa.array(ids[b[good]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for first in range(0, batch.num_rows, 1 << 14):
                rows = batch.slice(first, 1 << 14)
                if held is not None:
                    rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
                keys, b1, b2 = (rows.column(k).to_numpy() for k in range(3))
                last = (keys == keys[-1]) & (b1 == b1[-1]) & (b2 == b2[-1])
                cut = len(keys) - int(last[::-1].argmin()) if not last.all() else 0
                if cut:
                    yield from compare(rows.slice(0, cut))
                held = rows.slice(cut)
        if held is not None:
            yield from compare(held)

    return run


def _confirmed(documents: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    spark = documents.sparkSession
    pairs = pairs.checkpoint()
    shared = spark.sparkContext.broadcast(_rows.bitmap(pairs.select("a").union(pairs.select("b")), ID_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        chosen = (b.filter(pa.array(_rows.marked(wanted, b.column(0).to_numpy()))) for b in batches if b.num_rows)
        for rows, data, offsets in _text.pieces(chosen, "text"):
            sets = shingle_sets(data, offsets, width)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["id", "set"]
            )

    sets = documents.where("doc_id is not null").mapInArrow(run, "id long, set array<long>")
    joined = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return joined.where((both > 0) & (100 * both >= percent * either)).select("a", "b").distinct()


def near_duplicates(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest id it is linked with) and ``kept`` of every row."""
    ensure_checkpoint_dir(documents.sparkSession)
    texts = documents.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    schema = "doc_id long, n_shingles long, set_key binary, sub array<long>, sketch binary"
    features = texts.mapInArrow(_features(width), schema).checkpoint()

    # Equal sets are one class, named by its smallest id.
    filled = features.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("set_key").agg(F.min("doc_id").alias("id"))
    member = _rows.hot_join(filled.select("doc_id", "set_key"), classes, ["set_key"]).select("doc_id", "id", "set_key")
    member = member.checkpoint()
    reps = filled.join(classes.withColumnRenamed("id", "doc_id"), ["set_key", "doc_id"]).dropDuplicates(["set_key", "doc_id"])
    reps = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sub", "sketch").checkpoint()

    # Classes that share a sub-key of either collection with another one.
    parts = reps.select("id", F.posexplode("sub").alias("i", "v"))
    shared = parts.groupBy("i", "v").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    alive = _rows.hot_join(parts, shared, ["i", "v"]).groupBy("id").agg(F.collect_set("i").alias("alive"))
    alive = alive.where(F.exists("alive", lambda i: i < HALF) & F.exists("alive", lambda i: i >= HALF))
    reps = reps.join(alive, "id").checkpoint()

    # The buckets of two classes or more, with their sizes and smallest members.
    table = F.expr(
        f"explode(flatten(transform(filter(alive, i -> i < {HALF}), i -> transform(filter(alive, j -> j >= {HALF}), "
        f"j -> struct(i * {HALF} + j - {HALF} as t, xxhash64(i, j, sub[i], sub[j]) as key)))))"
    )
    rows = reps.select("id", table.alias("at")).select("id", "at.t", "at.key")
    sizes = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("id").alias("head")).where("members > 1")
    rows = _rows.hot_join(rows, sizes, ["key"]).checkpoint()

    # Each class against the smallest of its bucket.
    stars = rows.where("id != head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    slim = reps.select("id", "n", "sketch")
    stars = stars.join(slim.toDF("a", "n_a", "sketch_a"), "a").join(slim.toDF("b", "n_b", "sketch_b"), "b")
    stars = stars.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(_star_filter(percent), "a long, b long")
    versions = member.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a != b").select("a", "b")
    links = _confirmed(texts, stars, width, percent).union(versions).checkpoint()
    found = connected_components(links, "a", "b").checkpoint()

    # What is left: buckets of several components, block by block.
    named = reps.join(found.toDF("id", "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = rows.join(named.select("id", "component"), "id")
    open_keys = rows.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 != c2")
    rows = _rows.hot_join(rows.drop("component"), open_keys.select("key"), ["key"])
    blocks = F.ceil(F.col("members") / BLOCK)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", F.lit("block")), blocks))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.select(
        "key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "t", "head", "id"
    )
    short = F.transform("sub", lambda x: F.pmod(x, F.lit(2**31 - 1)).cast("int")).alias("sub")  # enough within a bucket
    rows = rows.join(named.select("id", "n", "component", short, "sketch"), "id")
    rows = rows.select("key", "b1", "b2", "own", F.col("t").cast("long").alias("t"), "head", "id", "n", "component", "sub", "sketch")
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "key", "b1", "b2").sortWithinPartitions("key", "b1", "b2")
    crossed = rows.mapInArrow(_cross_pairs(percent), "a long, b long")
    more = _confirmed(texts, crossed, width, percent)
    names = found.toDF("id", "component")
    for side in ("a", "b"):
        more = more.join(names.withColumnRenamed("id", side), side, "left")
        more = more.withColumn(side, F.coalesce("component", side)).drop("component")
    joined = connected_components(more, "a", "b").toDF("component", "joined")

    # Back to the documents.
    member = _rows.hot_join(member.select("doc_id", "id").distinct(), names, ["id"], "left")
    member = member.withColumn("component", F.coalesce("component", "id"))
    member = _rows.hot_join(member, joined, ["component"], "left")
    member = member.groupBy("doc_id").agg(F.min(F.coalesce("joined", "component")).alias("component_id"))
    out = features.select("doc_id", "n_shingles").join(member, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def keep_one(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id, with all its columns.

    Of rows of equal id one stays; rows without an id stay as they are.
    """
    found = near_duplicates(documents, id_col=id_col, text_col=text_col, **options)
    dropped = found.where(~F.col("kept")).select("doc_id").distinct()
    rows = _rows.apart(documents, id_col, text_col).join(dropped, "doc_id", "left_anti")
    unnamed = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("unnamed")
    rows = rows.select("*", unnamed).dropDuplicates(["doc_id", "unnamed"])
    return _rows.together(rows, documents.columns, text_col, {})

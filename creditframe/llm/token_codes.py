"""Token ids stored as directly addressable codes (DACs), readable at any token without decoding a block.

An id is cut into chunks of ``w_0, w_1, ...`` bits, lowest first. Level ``l`` holds, bit-packed, the
``l``-th chunk of every id that has one, in token order, and a bitmap saying which of those ids go on
to the next level. A rank directory (the count of set bits before every 256 bits) turns a position on
level ``l`` into one on level ``l + 1`` in constant time: an id at token ``i`` is its level-0 chunk at
``i``, then, while the bitmap says so, the next chunk at ``rank1(bitmap, position)``. The widths of a
block are the ones of least total size for its ids (a dynamic program over bit lengths, at most
``MAX_LEVELS`` levels), so frequent small ids take one short chunk.

File format (a folder, written by Spark's Parquet writer so it works on any shared store):

- ``blocks``: one row per block of consecutive documents, ``shard, block, first`` (tokens of the shard
  before it), ``n_tokens``, ``doc_ids array<long>``, ``doc_tokens array<long>``, ``widths array<int>``,
  and per level ``chunks``, ``bits``, ``ranks`` (arrays of binary, little-endian);
- ``shards``: one row per shard, ``shard, base`` (tokens of all shards before it), ``n_tokens``.

Documents are in ascending ``doc_id`` order: rows are range-partitioned (one shuffle of ids and texts)
and sorted within partitions; shard ``s`` holds the ``s``-th range. A block closes once it holds
``block_tokens`` tokens, so a task keeps one block in memory (or one longer document).

Edge cases: a null or empty text has the end id alone; rows without ``doc_id`` come after all others;
rows of equal id are ordered by a hash of their text and then by their place in the input, so repeated
rows are all written, and a hot id is still cut into ranges. An empty table writes no blocks and reads
back no rows. Columns other than the two named are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditframe.llm import _text
from creditframe.llm.packing import word_tokenizer

MAX_LEVELS = 6
RANK_BITS = 256
BLOCK_SCHEMA = (
    "shard int, block int, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "widths array<int>, chunks array<binary>, bits array<binary>, ranks array<binary>"
)


def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of least total bits (chunks, and one bitmap bit on every level but the last)."""
    lengths = np.zeros(33, np.int64)
    sizes = np.where(ids > 0, np.floor(np.log2(np.maximum(ids, 1).astype(np.float64))).astype(np.int64) + 1, 1)
    np.add.at(lengths, sizes, 1)
    top = int(sizes.max()) if len(ids) else 1
    longer = lengths[::-1].cumsum()[::-1]  # longer[b]: ids of at least b bits
    # cost[b][j]: least bits for the first b bits of every id, with j levels
    inf = float("inf")
    cost = [[inf] * (MAX_LEVELS + 1) for _ in range(top + 1)]
    came = [[0] * (MAX_LEVELS + 1) for _ in range(top + 1)]
    cost[0][0] = 0
    for b in range(1, top + 1):
        for j in range(1, MAX_LEVELS + 1):
            for a in range(b):
                if cost[a][j - 1] == inf:
                    continue
                n = int(longer[a + 1]) if a else len(ids)
                c = cost[a][j - 1] + n * ((b - a) + (1 if b < top else 0))
                if c < cost[b][j]:
                    cost[b][j], came[b][j] = c, a
    j = min(range(1, MAX_LEVELS + 1), key=lambda j: cost[top][j])
    widths, b = [], top
    while b:
        a = came[b][j]
        widths.append(b - a)
        b, j = a, j - 1
    return widths[::-1]


def _pack(values: np.ndarray, width: int) -> bytes:
    bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def _unpack(raw: bytes, width: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: n * width].reshape(n, width)
    return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1)


def encode(ids: np.ndarray, widths: list[int]) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of each level."""
    rest = ids.astype(np.uint64)
    chunks, bits, ranks = [], [], []
    for level, width in enumerate(widths):
        chunks.append(_pack(rest & np.uint64((1 << width) - 1), width))
        rest = rest >> np.uint64(width)
        if level == len(widths) - 1:
            break
        more = rest > 0
        bits.append(np.packbits(more, bitorder="little").tobytes())
        blocks = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), RANK_BITS)) if len(more) else np.zeros(0, np.uint32)
        ranks.append((np.cumsum(blocks) - blocks).astype("<u4").tobytes())
        rest = rest[more]
    return chunks, bits, ranks


def decode(n: int, widths: list[int], chunks: list[bytes], bits: list[bytes]) -> np.ndarray:
    """All ids of a block."""
    values = _unpack(chunks[0], widths[0], n)
    where = np.arange(n)
    shift = widths[0]
    for level in range(1, len(widths)):
        more = np.unpackbits(np.frombuffer(bits[level - 1], np.uint8), bitorder="little")[: len(where)].astype(bool)
        where = where[more]
        values[where] |= _unpack(chunks[level], widths[level], len(where)) << np.uint64(shift)
        shift += widths[level]
    return values.astype(np.uint32)


def token_at(i: int, widths: list[int], chunks: list[bytes], bits: list[bytes], ranks: list[bytes]) -> int:
    """The id at token ``i`` of a block, reading one chunk a level and one rank a level."""
    value, shift, at = 0, 0, i
    for level, width in enumerate(widths):
        raw = chunks[level]
        for k in range(width):
            bit = at * width + k
            value |= ((raw[bit >> 3] >> (bit & 7)) & 1) << (shift + k)
        if level == len(widths) - 1:
            break
        bitmap = bits[level]
        if not (bitmap[at >> 3] >> (at & 7)) & 1:
            break
        block = at // RANK_BITS
        base = int.from_bytes(ranks[level][4 * block : 4 * block + 4], "little")
        inside = sum(bin(byte).count("1") for byte in bitmap[block * RANK_BITS // 8 : at >> 3])
        at = base + inside + bin(bitmap[at >> 3] & ((1 << (at & 7)) - 1)).count("1")
        shift += width
    return value


def _blocks(tokenizer_path: str, end_id: int, block_tokens: int):
    def close(shard, block, first, doc_ids, pieces):
        ids = np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)
        widths = best_widths(ids)
        chunks, bits, ranks = encode(ids, widths)
        row = {
            "shard": [shard], "block": [block], "first": [first], "n_tokens": [len(ids)], "doc_ids": [doc_ids],
            "doc_tokens": [[len(p) for p in pieces]], "widths": [widths], "chunks": [chunks], "bits": [bits], "ranks": [ranks],
        }
        return pa.RecordBatch.from_pydict(row, schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        shard = TaskContext.get().partitionId()
        block, first, held, doc_ids, pieces = 0, 0, 0, [], []
        for rows, data, offsets in _text.pieces(batches, "text"):
            found, starts = tokenizer.encode(data, offsets)
            for doc_id, a, b in zip(rows.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                ids = np.append(found[a:b], np.uint32(end_id)).astype(np.uint32)
                doc_ids.append(doc_id)
                pieces.append(ids)
                held += len(ids)
                if held >= block_tokens:
                    yield close(shard, block, first, doc_ids, pieces)
                    block, first, held, doc_ids, pieces = block + 1, first + held, 0, [], []
        if pieces:
            yield close(shard, block, first, doc_ids, pieces)

    return run


_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("widths", pa.list_(pa.int32())),
        ("chunks", pa.list_(pa.binary())), ("bits", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
    ]
)


def write(documents: DataFrame, folder: str, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = 1, block_tokens: int = 1 << 20, partitions: int | None = None) -> str:
    """Encodes and writes all documents under ``folder`` (a shared one); returns it."""
    spark = documents.sparkSession
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("place")]
    docs = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    )
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(_blocks(tokenizer_path, end_id, block_tokens), BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).collect()
    base, rows = 0, []
    for row in sorted(totals, key=lambda r: r.shard):  # one row per shard: bounded by the partitions
        rows.append((row.shard, base, row.n_tokens))
        base += row.n_tokens
    spark.createDataFrame(rows, "shard int, base long, n_tokens long").coalesce(1).write.parquet(f"{folder}/shards")
    return folder


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode(row["n_tokens"], row["widths"], row["chunks"], row["bits"])
            ends = np.cumsum(row["doc_tokens"])
            starts = ends - np.array(row["doc_tokens"], np.int64)
            crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": row["doc_ids"], "start": (row["base"] + row["first"] + starts).tolist(),
                 "n_tokens": row["doc_tokens"], "ids_crc32": crcs},
                schema=pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]),
            )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the files: ``doc_id, start`` (tokens of all documents before it), ``n_tokens, ids_crc32``."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "base")
    located = blocks.join(F.broadcast(shards), "shard")  # one row per shard, bounded by the partitions
    return located.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def scratch_folder(spark: SparkSession) -> str:
    from creditframe.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark)}/token-codes-{uuid.uuid4().hex}"

"""Removal of lines that many documents share, behind a Bloom filter.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of enough
characters that occur in enough documents lose all their lines except in the document of the largest id.

1. Each task sends the 64-bit hashes of its keys, each at most twice, to tasks that split the hashes among
   them. There every hash passes a Bloom filter of the hashes met before. What it already holds is suspected
   and marked in the bitmap below; a false positive only marks more.
2. The suspected hashes are folded into one bitmap of fixed size, which is the only thing that is
   collected and broadcast. More repeats than it was made for only let more lines through to step 3; it
   never loses one.
3. Only lines that the bitmap suspects are shuffled, by their whole key, to confirm the number of documents
   and find the largest id. A task counts each key of its documents before anything moves, so a line found
   in a third of all documents is one row per task.
4. The repeated keys return to their documents, as 128-bit digests per document, and the lines go.

The filter grows with the corpus, as hashes are split over tasks; it is never held whole.

Edge cases: a null or empty text is one empty line and stays as it is; a key repeated within a document
counts once; rows of equal id are one document, whose lines go or stay together; an empty table gives no
rows; all other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditframe.llm import _rows
from creditframe.session import ensure_checkpoint_dir

WHITE = " \t\n\v\f\r"
FILTER_BITS = 1 << 22
PROBES = 4
SUSPECT_BITS = 1 << 26
SALTS = 32


def keys_of(text: str, min_chars: int) -> list[str | None]:
    """The key of each line, None for lines that are too short to count."""
    if len(text) < min_chars:
        return [None] * (text.count("\n") + 1)
    keys = []
    for line in text.split("\n"):
        key = line.strip(WHITE)
        if len(key) < min_chars:
            keys.append(None)
        else:  # bytes know no letters but A-Z
            keys.append(key.lower() if key.isascii() else key.encode().lower().decode())
    return keys


class Filter:
    """A Bloom filter that is extended by a part of twice the size whenever it fills up."""

    def __init__(self, bits: int = FILTER_BITS):
        self._parts = [np.zeros(bits >> 3, np.uint8)]
        self._held = 0

    @staticmethod
    def _places(hashes: np.ndarray, part: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            at = (hashes + np.uint64(k) * step) & np.uint64(8 * len(part) - 1)
            yield at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        for part in self._parts:
            here = np.ones(len(hashes), bool)
            for byte, bit in self._places(hashes, part):
                here &= (part[byte] & bit) != 0
            out |= here
        return out

    def add(self, hashes: np.ndarray) -> None:
        if self._held + len(hashes) > len(self._parts[-1]) // 2:  # 16 bits for each hash
            self._parts.append(np.zeros(2 * len(self._parts[-1]), np.uint8))
            self._held = 0
        for byte, bit in self._places(hashes, self._parts[-1]):
            np.bitwise_or.at(self._parts[-1], byte, bit)
        self._held += len(hashes)


def _hashes(texts: list[str | None], min_chars: int) -> np.ndarray:
    """Hashes of the different keys of each text."""
    found = [xxhash.xxh3_64_intdigest(k) for t in texts if t for k in {k for k in keys_of(t, min_chars) if k is not None}]
    return np.array(found, np.uint64)


def _spread(min_chars: int):
    """Per task, the hashes of its documents' keys, those of several documents twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            different, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((different, different[counts > 1])).view(np.int64))], names=["hash"]
            )

        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                found = _hashes(batch.column(0).slice(first, 512).to_pylist(), min_chars)
                held.append(found)
                size += len(found)
            if size > 1 << 20:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes met at least twice; left out is only what has its place of the bitmap marked by a task's earlier one."""
    once, sent = Filter(), np.zeros(SUSPECT_BITS // 64, np.uint64)
    for batch in batches:
        hashes = batch.column(0).to_numpy().view(np.uint64)
        for first in range(0, len(hashes), 1 << 16):
            different, counts = np.unique(hashes[first : first + (1 << 16)], return_counts=True)
            met = once.holds(different)
            once.add(different[~met])
            again = different[met | (counts > 1)]
            again = again[~_rows.marked(sent, again)]
            at = again & np.uint64(SUSPECT_BITS - 1)
            np.bitwise_or.at(sent, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(again.view(np.int64))], names=["hash"])


def suspects(documents: DataFrame, text_col: str, min_chars: int) -> np.ndarray:
    """The bitmap of keys that may occur in two documents or more."""
    spread = documents.select(F.col(text_col).alias("text")).mapInArrow(_spread(min_chars), "hash long")
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = spread.repartition(n, "hash").mapInArrow(_suspect, "hash long")
    return _rows.bitmap(found, SUSPECT_BITS)


def repeated_lines(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """``doc_id`` and the digests of the keys it loses, as one array per document that loses any."""
    spark = documents.sparkSession
    ensure_checkpoint_dir(spark)
    shared = spark.sparkContext.broadcast(suspects(documents, text_col, min_chars))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                rows = batch.slice(first, 512)
                ids, keys = [], []
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    if text:
                        own = {k for k in keys_of(text, min_chars) if k is not None}
                        ids += [doc_id] * len(own)
                        keys += own
                if not ids:
                    continue
                hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
                mask = pa.array(_rows.marked(bitmap, hashes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()).filter(mask), pa.array(keys, pa.string()).filter(mask)], names=["doc_id", "key"]
                )

    needed = documents.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").where("doc_id is not null")
    lines = needed.mapInArrow(candidates, "doc_id long, key string")
    lines = lines.groupBy("key", "doc_id").agg(F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    lines = lines.checkpoint()  # read twice below
    counted = lines.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    repeated = counted.where(F.col("n") >= min_docs).select("key", "keeper")
    lost = lines.join(_rows.salted(repeated, SALTS), ["key", "salt"]).where("doc_id != keeper")
    return lost.groupBy("doc_id").agg(F.collect_set(F.unhex(F.md5("key"))).alias("lost"))


def _without(min_chars: int):
    """Texts without the lines whose keys are lost, and their numbers of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                rows = batch.slice(first, 512)
                texts, before, dropped = [], [], []
                for text, lost in zip(rows.column(0).to_pylist(), rows.column(2).to_pylist()):
                    lines = (text or "").split("\n")
                    before.append(len(lines))
                    if lost:
                        gone = set(lost)
                        keys = keys_of(text, min_chars)
                        lines = [x for x, k in zip(lines, keys) if k is None or md5(k.encode()).digest() not in gone]
                        text = "\n".join(lines)
                    texts.append(text)
                    dropped.append(before[-1] - len(lines))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), rows.column(1), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                    names=["text", "rest", "n_lines", "n_dropped"],
                )

    return run


def dedup_lines(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """The documents with the lines that stay, and ``n_lines`` before and ``n_dropped`` beside them."""
    lost = repeated_lines(documents, id_col=id_col, text_col=text_col, min_chars=min_chars, min_docs=min_docs)
    rows = _rows.apart(documents, id_col, text_col)
    rest = rows.schema["rest"].dataType.simpleString()
    joined = rows.join(lost, "doc_id", "left").select("text", "rest", "lost")
    kept = joined.mapInArrow(_without(min_chars), f"text string, rest {rest}, n_lines long, n_dropped long")
    return _rows.together(kept, documents.columns, text_col, {c: F.col(c) for c in ("n_lines", "n_dropped")})

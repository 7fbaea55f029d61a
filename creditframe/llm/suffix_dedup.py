"""Removal of repeated byte strings by blockwise suffix sorting with a cover sample.

Every byte that lies in a string of ``LENGTH`` bytes that starts anywhere else too, in any document, is
removed. Strings never cross documents.

1. Suffixes are dealt into buckets by content: each string of ``LENGTH`` bytes has an anchor, the run of
   ``GRAM`` bytes in it of the least hash, and equal strings have equal anchors at equal places. Strings
   that start one after another and share an anchor are one run, so that only about one row for fifty bytes
   is ever shuffled, and no row at all for anchors that a bitmap of fixed size knows to occur once.
2. Runs of equal content are one class, counted before anything moves. Classes of several runs are repeated
   as a whole.
3. Of anchors with several classes, one run of each is sent as text, picked by another bitmap where the
   texts lie; a run more that it lets through is a true place and never changes what is repeated. A bucket's
   suffixes are sorted, one batch of whole buckets at a time. Ranks of the strings at the places of a
   difference cover are computed first; a suffix is then placed by its few bytes before the next such place,
   that place's rank, and its few bytes after. Suffixes of a bucket that are equal to that depth are repeated
   strings.
   Buckets of more than ``LARGE`` runs are counted by digests of their strings instead, spread over tasks.
4. A document's repeated starts are merged into intervals of bytes. Only documents that a bitmap knows to
   lose bytes are shuffled to meet their intervals; the others stay where they are.

Memory is bounded by a batch of buckets, or one document.

Edge cases: null is the empty text; texts shorter than ``LENGTH`` have no such string; overlapping repeats
count; rows of equal id and text are two documents that repeat each other, rows of equal id and different
texts are kept apart; an empty table gives no rows; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditframe.llm import _rows, _text
from creditframe.session import ensure_checkpoint_dir

LENGTH = 200
GRAM = 100
#: Bits of the bitmaps of anchors and runs, and of documents, at most; they are folded as long as few are set.
BITS = 1 << 29
DOC_BITS = 1 << 27
#: The second place of a hash in a bitmap is told by its bits from this one on.
SHIFT = 29
#: Starts times this odd number lie far apart in a bitmap; the product of a start below 2**31 is a long.
SPREAD = 0x9E3779B1
#: Texts whose runs are found at once: hashes of so few bytes stay in a core's cache.
PIECE_BYTES = 1 << 17
LARGE = 1 << 15
BATCH = 1 << 20
#: A difference cover modulo 13: any two places have a common distance to places of these residues.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Distance from each residue to the next one of the cover.
_NEXT = np.array([min((c - r) % MODULUS for c in COVER) for r in range(MODULUS)])
HEAD = int(_NEXT.max())
_PLACE_BITS = np.uint64(28)
_PLACES = np.uint64((1 << 28) - 1)

_RANDOM = np.random.default_rng(20240811)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(1, 2**63)) | 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``GRAM`` and of the 128 bytes from each place on, by doubling; shorter at the end."""
    padded = np.concatenate((_BYTE[data], np.zeros(256, np.uint64)))
    by_size = {1: padded}
    size = 1
    while size < 128:
        h = by_size[size]
        longer = h.copy()
        longer[:-size] += h[size:] * _power(size)
        by_size[2 * size] = longer
        if size not in (4, 32, 64):
            del by_size[size]
        size *= 2
    n = len(data)
    gram = by_size[64][:n] + by_size[32][64 : 64 + n] * _power(64) + by_size[4][96 : 96 + n] * _power(96)
    return _text.mix(gram), by_size[128]


def _window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row."""
    n = len(keys) - width + 1
    fill = -len(keys) % width
    blocks = np.concatenate((keys, np.full(fill, np.iinfo(np.uint64).max))).reshape(-1, width)
    before = np.minimum.accumulate(blocks, 1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray, offsets: np.ndarray):
    """Of all runs: text, start within it, strings, place of the anchor after the start, anchor's hash, content's hash."""
    if len(data) < LENGTH:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing, nothing, nothing
    gram, long = _grams(data)
    at = np.arange(len(gram), dtype=np.uint64)
    keys = (gram >> _PLACE_BITS << _PLACE_BITS) | at
    anchors = (_window_min(keys[: len(data) - GRAM + 1], LENGTH - GRAM + 1) & _PLACES).astype(np.int64)
    sizes = np.diff(offsets)
    valid = np.zeros(len(data) + 1, np.int32)
    full = sizes >= LENGTH
    np.add.at(valid, offsets[:-1][full], 1)
    np.add.at(valid, offsets[1:][full] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    anchor = anchors[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin, own = starts[first], anchor[first]
    end = begin + count + LENGTH - 1
    content = long[begin] + _text.mix(long[(begin + end) // 2 - 64]) + _text.mix(_text.mix(long[end - 128]) + count.astype(np.uint64))
    text = np.searchsorted(offsets, begin, "right") - 1
    return text, begin - offsets[text], count, own - begin, gram[own].view(np.int64), _text.mix(content).view(np.int64)


def _bitmap(rows: DataFrame, key: Column, other: Column, bits: int):
    """A shared bitmap folded while at most one bit of 16 is set.

    Each row sets the place of its key and one more of the same word, told by the low bits of ``other``.
    """
    places = F.array(key, key.bitwiseXOR(other.bitwiseAND(63)))
    words = _rows.bitmap(rows.select(F.explode(places).alias("key")), bits)
    while len(words) > 64 and int(np.bitwise_count(words).sum()) <= 2 * len(words):
        words = words[: len(words) // 2] | words[len(words) // 2 :]
    return rows.sparkSession.sparkContext.broadcast(words)


def _marked(shared, key: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which keys have both places set."""
    return _rows.marked(shared.value, key) & _rows.marked(shared.value, key ^ (other & 63))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, data, offsets in _text.pieces(batches, "text", PIECE_BYTES):
        different, counts = np.unique(runs_of(data, offsets)[4], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(different), pa.array(counts)], names=["gram", "n"])


_RUNS = "doc_id long, version int, start int, n int, rel int, gram long, content long"


def _suspected_runs(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _text.pieces(batches, "text", PIECE_BYTES):
            text, start, n, rel, gram, content = runs_of(data, offsets)
            keep = _marked(shared, gram, gram >> SHIFT)
            who = pa.array(text[keep])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(who), rows.column(1).take(who), *[pa.array(x[keep].astype(np.int32)) for x in (start, n, rel)],
                 pa.array(gram[keep]), pa.array(content[keep])],
                names=["doc_id", "version", "start", "n", "rel", "gram", "content"],
            )

    return run


def repeated_strings(rows: list[tuple[int, int, int, bytes]]) -> np.ndarray:
    """Which strings of all rows' spans occur in two rows of the same bucket; one entry for each string.

    A row has its bucket, its number of strings, the place of the anchor in its span, and the span.
    """
    # Anchors stand at places of one residue, so that equal strings, which have their anchor at the same
    # distance, also have the cover's places at the same distances.
    pads = [(-rel) % MODULUS for _, _, rel, _ in rows]
    places, size = [], 0
    for (_, _, _, span), pad in zip(rows, pads):
        size += (pad - size) % MODULUS
        places.append(size)
        size += len(span)
    text = np.zeros(size + LENGTH + MODULUS, np.uint8)
    for (_, _, _, span), place in zip(rows, places):
        text[place : place + len(span)] = np.frombuffer(span, np.uint8)
    counts = np.array([n for _, n, _, _ in rows], np.int64)
    before = np.cumsum(counts) - counts
    inner = np.arange(counts.sum()) - np.repeat(before, counts)
    at = np.repeat(np.array(places, np.int64), counts) + inner
    distance = inner - np.repeat(np.array([rel for _, _, rel, _ in rows], np.int64), counts)
    depth = LENGTH - HEAD
    # Ranks of the cover's places that any string needs, by their whole depth.
    sample = at + _NEXT[at % MODULUS]
    needed, which = np.unique(sample, return_inverse=True)
    strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, depth)[needed])
    rank = np.unique(strings.view(f"V{depth}").ravel(), return_inverse=True)[1].astype(np.int64)[which]
    # The bytes around: those before the place and those after its string, HEAD together.
    head = sample - at
    column = np.arange(HEAD)
    around = text[at[:, None] + np.where(column[None, :] < head[:, None], column[None, :], column[None, :] + depth)]
    key = np.zeros(len(at), [("bucket", "<i8"), ("distance", "<i4"), ("rank", "<i4"), ("around", f"V{HEAD}")])
    key["bucket"] = np.repeat(np.array([b for b, _, _, _ in rows], np.int64), counts)
    key["distance"], key["rank"] = distance, rank
    key["around"] = np.ascontiguousarray(around).view(f"V{HEAD}").ravel()
    _, group, times = np.unique(key.view(f"V{key.dtype.itemsize}"), return_inverse=True, return_counts=True)
    return times[group] > 1


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of repeated strings; rows come sorted by bucket, and whole buckets are sorted together."""

    def work(held: list[tuple]) -> pa.RecordBatch:
        again = repeated_strings([(r[0], r[4], r[5], r[6]) for r in held])
        out, at = [], 0
        for r in held:
            own = np.concatenate(([False], again[at : at + r[4]], [False]))
            at += r[4]
            edges = np.flatnonzero(own[1:] != own[:-1])
            out += [(r[1], r[2], r[3] + int(a), int(b - a)) for a, b in zip(edges[0::2], edges[1::2])]
        columns = list(zip(*out)) or [[], [], [], []]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "version", "start", "n"]
        )

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= BATCH and row[0] != held[-1][0]:
                yield work(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        yield work(held)


def _spans(shared):
    """The bytes of the runs that the bitmap has by their document's key, start and anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _text.pieces(batches, "text", PIECE_BYTES):
            text, start, n, rel, gram, _ = runs_of(data, offsets)
            keep = _marked(shared, rows.column(3).to_numpy()[text] ^ start * SPREAD, gram)
            text, start, n = text[keep], start[keep], n[keep]
            raw, begin, who = data.tobytes(), offsets[text] + start, pa.array(text)
            spans = [raw[a:b] for a, b in zip(begin.tolist(), (begin + n + LENGTH - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[keep]), rows.column(0).take(who), rows.column(1).take(who),
                 *[pa.array(x.astype(np.int32)) for x in (start, n, rel[keep])], pa.array(spans, pa.binary())],
                names=["gram", "doc_id", "version", "start", "n", "rel", "span"],
            )

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of a run by a digest of 128 bits."""
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            doc_id, version, start, n, span = row
            digests = [blake2b(span[k : k + LENGTH], digest_size=16).digest() for k in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id] * n, pa.int64()), pa.array([version] * n, pa.int32()), pa.array(range(start, start + n), pa.int32()),
                 pa.array(digests, pa.binary())],
                names=["doc_id", "version", "start", "digest"],
            )


def repeats(texts: DataFrame) -> DataFrame:
    """Intervals ``start``, ``n`` of starts of repeated strings; ``texts`` has doc_id, version and text."""
    spark = texts.sparkSession
    grams = texts.select("text").mapInArrow(_anchors, "gram long, n long")
    several = grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    shared = _bitmap(several, F.col("gram"), F.shiftright("gram", SHIFT), BITS)
    found = texts.mapInArrow(_suspected_runs(shared), _RUNS).checkpoint()
    shared.destroy()

    same = ["gram", "rel", "n", "content"]
    classes = found.groupBy(*same).agg(F.count("*").alias("runs"), F.min(F.struct("doc_id", "version", "start")).alias("one"))
    classes = classes.checkpoint()
    whole = _rows.hot_join(found, classes.where("runs > 1").select(*same), same).select("doc_id", "version", "start", "n")

    # One run of each class of the anchors that have several.
    mixed = classes.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1")
    key = F.xxhash64("one.doc_id", "one.version").bitwiseXOR(F.col("one.start").cast("long") * F.lit(SPREAD))
    shared = _bitmap(_rows.hot_join(classes, mixed, ["gram"]), key, F.col("gram"), BITS)
    keyed = texts.select("doc_id", "version", "text", F.xxhash64("doc_id", "version").alias("key"))
    schema = "gram long, doc_id long, version int, start int, n int, rel int, span binary"
    spans = keyed.mapInArrow(_spans(shared), schema).checkpoint()
    shared.destroy()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # At most one anchor for every LARGE runs.
    large = F.broadcast(spans.groupBy("gram").agg(F.count("*").alias("k")).where(F.col("k") > LARGE).select("gram"))
    small = spans.join(large, "gram", "left_anti").repartition(n, "gram").sortWithinPartitions("gram")
    pieces = "doc_id long, version int, start int, n int"
    partly = small.mapInArrow(_sorted_buckets, pieces)

    strings = spans.join(large, "gram", "left_semi").select("doc_id", "version", "start", "n", "span")
    strings = strings.mapInArrow(_digests, "doc_id long, version int, start int, digest binary")
    often = strings.groupBy("digest").agg(F.count("*").alias("times")).where("times > 1").select("digest")
    others = _rows.hot_join(strings, often, ["digest"]).select("doc_id", "version", "start", F.lit(1).alias("n"))
    return whole.union(partly).union(others)


_FOUND = "array<struct<start:int,n:int>>"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents' repeated starts as the intervals of bytes they cover, in order, those that touch as one."""
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy()
        start, n = (x.to_numpy().astype(np.int64) for x in batch.column(2).flatten().flatten())
        # Documents follow each other at distances that no text is long enough to bridge.
        start = start + (np.repeat(np.arange(len(sizes)), sizes) << 32)
        order = np.argsort(start, kind="stable")
        start, end = start[order], np.maximum.accumulate((start + n + LENGTH - 1)[order])
        first = np.flatnonzero(np.concatenate((np.ones(min(len(start), 1), bool), start[1:] > end[:-1])))
        begin, size = start[first], end[np.append(first[1:], len(start)) - 1] - start[first]
        ends = np.searchsorted(begin, np.arange(len(sizes) + 1) << 32).astype(np.int32)
        struct = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (begin & 0xFFFFFFFF, size)], ["start", "n"])
        found = pa.ListArray.from_arrays(pa.array(ends), struct)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["doc_id", "version", "found"])


def _losing(shared, wanted: bool):
    """The rows whose key, the last column, is in the bitmap or is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = batch.column(batch.num_columns - 1).to_numpy()
                yield batch.filter(pa.array(_marked(shared, key, key >> SHIFT) == wanted))

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts' remaining bytes, and numbers of bytes before, of those removed and of removed runs."""
    for rows, data, offsets in _text.pieces(batches, "text"):
        raw, kept, counts = data.tobytes(), [], []
        for k, found in enumerate(rows.column(2).to_pylist()):
            own = raw[offsets[k] : offsets[k + 1]]
            size, removed, spans = len(own), 0, 0
            if found:
                change = np.zeros(size + 1, np.int64)
                starts = np.array([x["start"] for x in found])
                np.add.at(change, starts, 1)
                np.add.at(change, starts + np.array([x["n"] for x in found]), -1)
                gone = np.cumsum(change[:-1]) > 0
                removed = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                own = np.frombuffer(own, np.uint8)[~gone].tobytes()
            kept.append(own)
            counts.append((size, removed, spans))
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.binary()), rows.column(1), *[pa.array(c, pa.int64()) for c in zip(*counts)]],
            names=["kept", "rest", "n_bytes", "n_removed", "n_spans"],
        )


def remove_repeats(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their remaining bytes as text column, for cuts may fall within a character.

    ``n_bytes``, ``n_removed`` and ``n_spans`` stand beside them.
    """
    ensure_checkpoint_dir(documents.sparkSession)
    rows = _rows.apart(documents, id_col, text_col).withColumn("version", F.hash("text"))
    found = repeats(rows.select("doc_id", "version", "text"))
    found = found.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    found = found.mapInArrow(_merged, f"doc_id long, version int, found {_FOUND}").checkpoint()
    key = F.xxhash64("doc_id", "version")
    shared = _bitmap(found, key, F.shiftright(key, SHIFT), DOC_BITS)

    losing = rows.select("doc_id", "version", "text", "rest", key.alias("key"))
    losing = losing.mapInArrow(_losing(shared, True), losing.schema)
    same = losing["doc_id"].eqNullSafe(found["doc_id"]) & (losing["version"] == found["version"])
    joined = losing.join(found, same, "left").select("text", "rest", "found")
    rest = rows.schema["rest"].dataType.simpleString()
    schema = f"kept binary, rest {rest}, n_bytes long, n_removed long, n_spans long"
    whole = rows.select("text", "rest", F.lit(None).cast(_FOUND).alias("found"), key.alias("key"))
    whole = whole.mapInArrow(lambda batches: _removed(_losing(shared, False)(batches)), schema)
    kept = joined.mapInArrow(_removed, schema).union(whole).withColumnRenamed("kept", "text")
    return _rows.together(kept, documents.columns, text_col, {c: F.col(c) for c in ("n_bytes", "n_removed", "n_spans")})

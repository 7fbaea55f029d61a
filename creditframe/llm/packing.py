"""Cost-balanced packing of documents into token sequences of fixed capacity.

A document's tokens are its text's ids and one closing id. Each task tokenizes its documents, gathers
them in blocks of a few million tokens and packs a block at a time, so no row is shuffled and memory
is bounded by one block (or one longer document).

Within a block the sequences are fixed beforehand: as many of the full capacity as the tokens fill and,
for the rest, one for each power of two in it, which needs no padding either. Documents go, longest
first, to the sequence of the lowest estimated attention cost (``linear * n + quadratic * n ** 2``,
summed over the pieces in a sequence) that has room for the whole of them; where none has, a document is
cut at the room that is left and its rest takes its place in the order. So every sequence ends exactly
full.

Edge cases: a null or empty text has the closing id alone; repeated rows are packed as often as they
occur; an empty table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from creditframe.llm import _text

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
BLOCK_TOKENS = 1 << 21
CACHED_WORDS = 1 << 21


#: Bytes between which no tokenizer of the kind below merges: ASCII letters and digits on one side, ASCII
#: punctuation but the apostrophe on the other. Punctuation of a tokenizer's special tokens is left out.
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not _ALNUM[b] and b != 0x27]] = True
_PROBE = ["It", "isn't", ",", "4", ".", "5", "a", ".", "b", "###", "x"]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for all tasks of a worker process, so that words are learned once."""
    return WordTokenizer(path)


class WordTokenizer:
    """Token ids of texts, computed once for each different word.

    Right for tokenizers that never join or look across ASCII white space, or between an ASCII letter or
    digit and punctuation, as those that split words before merging do; a probe refuses others. The cache
    starts anew when it holds ``CACHED_WORDS`` words.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        normalizer = self._tokenizer.normalizer
        self._folds = normalizer is not None and normalizer.normalize_str("AbZ") == "abz"
        whole, *parts = [e.ids for e in self._tokenizer.encode_batch_fast(["It isn't,4.5 a.b ###x", *_PROBE], add_special_tokens=False)]
        if whole != [i for part in parts for i in part]:
            raise ValueError("this tokenizer looks across words")
        special = "".join(t.content for t in self._tokenizer.get_added_tokens_decoder().values())
        self._mark = _MARK.copy()
        self._mark[[ord(c) for c in special if ord(c) < 128]] = False
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)
        self._starts = np.zeros(0, np.int64)
        self._lengths = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        found = [np.array(e.ids, np.uint32) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        starts = len(self._ids) + np.cumsum(lengths) - lengths
        self._ids = np.concatenate((self._ids, *found))
        hashes = np.concatenate((self._hashes, hashes))
        order = np.argsort(hashes, kind="stable")
        self._hashes = hashes[order]
        self._starts = np.concatenate((self._starts, starts))[order]
        self._lengths = np.concatenate((self._lengths, lengths))[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and where each text's begin (one more at the end)."""
        if self._folds:
            data = _text.lower(data)
        alnum, mark = _ALNUM[data], self._mark[data]
        breaks = np.zeros(len(data) + 1, bool)
        if len(data):
            breaks[1:-1] = (alnum[:-1] & mark[1:]) | (mark[:-1] & alnum[1:])
        starts, ends, first = _text.words(data, offsets, _text.NOT_SPACE, breaks)
        different, example, which = np.unique(_text.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._hashes) + len(different) > CACHED_WORDS:
            self._forget()
        at = np.minimum(np.searchsorted(self._hashes, different), max(len(self._hashes) - 1, 0))
        new = self._hashes[at] != different if len(self._hashes) else np.ones(len(different), bool)
        if new.any():
            raw = data.tobytes()
            self._learn(different[new], [raw[starts[i] : ends[i]].decode() for i in example[new]])
        if not len(different):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        at = np.searchsorted(self._hashes, different)[which]
        lengths = self._lengths[at]
        before = np.concatenate(([0], np.cumsum(lengths)))
        ids = self._ids[np.repeat(self._starts[at] - before[:-1], lengths) + np.arange(before[-1])]
        return ids, before[first]


def place(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the pieces that fill all sequences of a block.

    Ties are broken by the order of documents and sequences, so equal blocks are packed alike.
    """
    total = sum(lengths)
    rest = total % capacity
    rooms = [capacity] * (total // capacity) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    waiting = []
    for doc, n in enumerate(lengths):
        for start in range(0, n, capacity):
            waiting.append((-min(capacity, n - start), doc, start))
    heapq.heapify(waiting)
    cost = [0.0] * len(rooms)
    left = list(rooms)
    ready = [(0.0, s) for s in range(len(rooms))]
    narrow: list[tuple[int, int]] = []  # sequences without room for the current document, widest first
    placed = []
    while waiting:
        n, doc, start = heapq.heappop(waiting)
        n = -n
        while narrow and -narrow[0][0] >= n:
            s = heapq.heappop(narrow)[1]
            heapq.heappush(ready, (cost[s], s))
        while ready and left[ready[0][1]] < n:
            s = heapq.heappop(ready)[1]
            heapq.heappush(narrow, (-left[s], s))
        if ready:
            s, part = heapq.heappop(ready)[1], n
        else:
            s = heapq.heappop(narrow)[1]
            part = left[s]
            heapq.heappush(waiting, (part - n, doc, start + part))
        placed.append((doc, start, part, s, rooms[s] - left[s]))
        left[s] -= part
        cost[s] += linear * part + quadratic * part * part
        if left[s]:
            heapq.heappush(ready, (cost[s], s))
    return placed


def _packed(ids: list[np.ndarray], doc_ids: list, first_sequence: int, capacity: int, linear: float, quadratic: float, keep_ids: bool):
    rows = place([len(x) for x in ids], capacity, linear, quadratic)
    cut = [ids[doc][start : start + n] for doc, start, n, _, _ in rows]
    columns = [
        pa.array([doc_ids[r[0]] for r in rows], pa.int64()),
        pa.array([r[1] for r in rows], pa.int64()),
        pa.array([r[2] for r in rows], pa.int64()),
        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in cut], pa.int64()),
        pa.array([len(ids[r[0]]) for r in rows], pa.int64()),
        pa.array([first_sequence + r[3] for r in rows], pa.int64()),
        pa.array([r[4] for r in rows], pa.int64()),
    ]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if keep_ids:
        columns.append(pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names), 1 + max(r[3] for r in rows)


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it was cut and where it lies in its sequence.

    ``sequence_id`` is unique over all tasks. ``keep_ids`` adds the piece's token ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 40
        ids, doc_ids, held = [], [], 0
        for rows, data, offsets in _text.pieces(batches, "text"):
            found, first = tokenizer.encode(data, offsets)
            closed = np.insert(found, first[1:], end_id)
            first = first + np.arange(len(first))
            for doc_id, a, b in zip(rows.column(0).to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                ids.append(closed[a:b])
                doc_ids.append(doc_id)
                held += b - a
            if held >= BLOCK_TOKENS:
                batch, n = _packed(ids, doc_ids, sequence, capacity, linear, quadratic, keep_ids)
                yield batch
                sequence += n
                ids, doc_ids, held = [], [], 0
        if ids:
            yield _packed(ids, doc_ids, sequence, capacity, linear, quadratic, keep_ids)[0]

    needed = documents.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return needed.mapInArrow(run, SCHEMA + (", ids array<int>" if keep_ids else ""))

"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are of documents, so tokens are labelled first: forms and beginnings of words that many different
toxic documents of the sample have and others practically never are taken for toxic (a likelihood-ratio
test on document frequencies), and their words in toxic documents get label 1. On these the field is
trained: two states, weights for a word's form, beginnings and ends, and for the step from word to word.

To score a text its words are tagged by forward-backward over chains (a sentence, in parts of at most
``CHAIN`` words). ``score`` is ``1 - exp(-rate * s)``, where s sums the marginals of ``LEAST`` and more; the
rate is the lowest of ``RATES`` under which 97 % of the sample's toxic documents with tagged words reach
``FLAG``, so that as little as possible is taken for toxic by itself. Spans are runs of words of marginals of 0.5 and more.

The labelled sample is the only thing that reaches the driver: at most ``rows_per_class`` rows of either
label, chosen by a hash of their id, and ``chars_per_row`` characters of each; near copies in it count once.

Edge cases: a null or empty text has score 0 and no spans; without rows of both labels all scores are 0;
null labels teach nothing; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditframe.llm import _text

CHAIN = 64
LEAST = 0.2
RATES = (0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 3.0)
FLAG = 0.7
CACHED_WORDS = 1 << 20

#: Words: ASCII letters and characters beyond ASCII.
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True


def features(word: str) -> list[str]:
    """What the field knows of a word: its form, its beginnings of 4 to 8 and its ends of 4 characters."""
    n = len(word)
    return ["w" + word, *["p" + word[:k] for k in (4, 5, 6, 7, 8) if n > k], *(["s" + word[-4:]] if n > 4 else [])]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in lower-cased bytes, each text's first word, and where chains begin."""
    starts, ends, first = _text.words(data, offsets, _LETTERS)
    if not len(starts):
        return starts, ends, first, np.zeros(0, np.int64)
    stops = np.cumsum(_STOPS[data])
    new = np.zeros(len(starts), bool)
    new[0] = True
    new[1:] = stops[starts[1:]] != stops[starts[:-1]]
    new[first[:-1][first[:-1] < len(starts)]] = True
    begin = np.flatnonzero(new)
    lengths = np.diff(np.append(begin, len(starts)))
    parts = -(-lengths // CHAIN)
    inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return starts, ends, first, np.repeat(begin, parts) + CHAIN * inner


@dataclass
class Field:
    """Weights of features for state 1, and of steps between states 0 and 1."""

    weights: dict[str, float]
    bias: float
    steps: np.ndarray
    rate: float = 1.0

    def evidence(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


def forward_backward(evidence: np.ndarray, chains: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's probability of state 1, and the expected numbers of steps between states."""
    if not len(evidence):
        return np.zeros(0), np.zeros((2, 2))
    lengths = np.diff(np.append(chains, len(evidence)))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = chains[order], lengths[order]
    n, longest = len(starts), int(lengths[0])
    going = n - np.searchsorted(lengths[::-1], np.arange(1, longest + 1), "left")
    grid = np.zeros((longest, n))
    for t, k in enumerate(going.tolist()):
        grid[t, :k] = evidence[starts[:k] + t]
    a0, a1 = np.zeros((longest, n)), np.zeros((longest, n))
    a1[0] = grid[0]
    for t in range(1, longest):
        k = going[t]
        x, y = a0[t - 1, :k], a1[t - 1, :k]
        a0[t, :k] = np.logaddexp(x + steps[0, 0], y + steps[1, 0])
        a1[t, :k] = np.logaddexp(x + steps[0, 1], y + steps[1, 1]) + grid[t, :k]
    b0, b1 = np.zeros((longest, n)), np.zeros((longest, n))
    for t in range(longest - 2, -1, -1):
        k = going[t + 1]
        x, y = b0[t + 1, :k], b1[t + 1, :k] + grid[t + 1, :k]
        b0[t, :k] = np.logaddexp(x + steps[0, 0], y + steps[0, 1])
        b1[t, :k] = np.logaddexp(x + steps[1, 0], y + steps[1, 1])
    total = np.logaddexp(a0[0] + b0[0], a1[0] + b1[0])
    out = np.zeros(len(evidence))
    moves = np.zeros((2, 2))
    for t, k in enumerate(going.tolist()):
        out[starts[:k] + t] = np.exp(a1[t, :k] + b1[t, :k] - total[:k])
        if t:
            for i, before in enumerate((a0[t - 1, :k], a1[t - 1, :k])):
                moves[i, 0] += np.exp(before + steps[i, 0] + b0[t, :k] - total[:k]).sum()
                moves[i, 1] += np.exp(before + steps[i, 1] + grid[t, :k] + b1[t, :k] - total[:k]).sum()
    return out, moves


def different(texts: list[str]) -> list[list[list[str]]]:
    """The texts as sentences of words, without those that share much with an earlier one."""
    seen: set[tuple] = set()
    out = []
    for text in texts:
        sentences = [re.findall(r"[^\W\d_]+", s) for s in re.split(r"[.!?\n]", text.encode().lower().decode())]
        words = [w for s in sentences for w in s]
        own = {tuple(words[i : i + 5]) for i in range(0, max(len(words) - 4, 1))}
        if len(own & seen) <= 0.3 * len(own):
            out.append([s[i : i + CHAIN] for s in sentences for i in range(0, len(s), CHAIN)])
        seen |= own
    return out


def toxic_features(toxic: list[list[list[str]]], others: list[list[list[str]]], least: float = 25.0) -> set[str]:
    """Forms and beginnings that tell toxic documents: seen there far beyond chance and hardly elsewhere."""
    counts = []
    for docs in (toxic, others):
        counts.append(Counter(f for d in docs for f in {f for s in d for w in s for f in features(w) if f[0] != "s"}))
    n1, n0 = len(toxic), len(others)
    found = set()
    for feature, c1 in counts[0].items():
        c0 = counts[1][feature]
        share = (c1 + c0) / (n1 + n0)
        ratio = 2 * (c1 * np.log(c1 / (n1 * share)) + (c0 * np.log(c0 / (n0 * share)) if c0 else 0.0))
        if ratio >= least and c1 * n0 >= 20 * c0 * n1:
            found.add(feature)
    return found


def train(toxic: list[str], others: list[str], rounds: int = 60, penalty: float = 0.02, seed: int = 7) -> Field | None:
    """The field of a labelled sample of texts, None where it has nothing to tell toxic ones by."""
    toxic_docs, other_docs = different(toxic), different(others)
    telling = toxic_features(toxic_docs, other_docs) if toxic_docs and other_docs else set()
    if not telling:
        return None
    marked = lambda w: not telling.isdisjoint(features(w))
    labelled = [(s, [marked(w) for w in s]) for d in toxic_docs for s in d if s]
    positive = [x for x in labelled if any(x[1])]
    rest = [x for x in labelled if not any(x[1])] + [(s, [False] * len(s)) for d in other_docs for s in d if s]
    # Of the rest, first what resembles the marked words, then others.
    like = {f for s, own in positive for w, v in zip(s, own) if v for f in features(w)}
    near = np.array([any(not like.isdisjoint(features(w)) for w in s) for s, _ in rest], bool)
    mixed = np.random.default_rng(seed).permutation(len(rest))
    chosen = np.concatenate((mixed[near[mixed]][: 6 * len(positive)], mixed[~near[mixed]][: 2 * len(positive) + 1000]))
    chains = positive + [rest[k] for k in np.sort(chosen).tolist()]
    y = np.array([v for _, own in chains for v in own], float)
    begins = np.cumsum([0] + [len(s) for s, _ in chains[:-1]])
    counts = Counter(f for s, _ in chains for w in s for f in features(w))
    names = {f: k for k, f in enumerate(sorted(f for f, n in counts.items() if n >= 3))}
    pairs = [(t, names[f]) for t, w in enumerate(w for s, _ in chains for w in s) for f in features(w) if f in names]
    token, feature = np.array(pairs, np.int64).reshape(-1, 2).T
    inner = np.ones(len(y), bool)
    inner[begins] = False
    before, after = y[np.flatnonzero(inner) - 1].astype(int), y[inner].astype(int)
    moved = np.bincount(2 * before + after, minlength=4).reshape(2, 2)
    # Adam on the penalised likelihood; the last five values are the bias and the steps.
    x = np.zeros(len(names) + 5)
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        evidence = np.bincount(token, x[feature], len(y)) + x[-5]
        p, moves = forward_backward(evidence, begins, x[-4:].reshape(2, 2))
        slope = np.concatenate((np.bincount(feature, (y - p)[token], len(names)), [(y - p).sum()], (moved - moves).ravel()))
        slope -= penalty * x
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        x += 0.25 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = {f: float(x[k]) for f, k in names.items() if abs(x[k]) > 1e-3}
    field = Field(weights, float(x[-5]), x[-4:].reshape(2, 2).copy())
    sums, _ = Tagger(field).sums(*_text.flat(pa.array(toxic, pa.string())))
    reached = [rate for rate in RATES if np.mean(1 - np.exp(-rate * sums[sums >= 0.5]) >= FLAG) >= 0.97]
    field.rate = reached[0] if reached else RATES[-1]
    return field


class Tagger:
    """A field with the evidence of the words it has met, each looked at once."""

    def __init__(self, field: Field):
        self._field = field
        self._hashes, self._values = np.zeros(0, np.uint64), np.zeros(0)

    def _evidence(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        words, example, which = np.unique(_text.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._hashes) + len(words) > CACHED_WORDS:
            self._hashes, self._values = np.zeros(0, np.uint64), np.zeros(0)
        new = ~np.isin(words, self._hashes, assume_unique=True)
        if new.any():
            raw = data.tobytes()
            found = [self._field.evidence(raw[starts[k] : ends[k]].decode("utf-8", "replace")) for k in example[new].tolist()]
            hashes = np.concatenate((self._hashes, words[new]))
            order = np.argsort(hashes)
            self._hashes, self._values = hashes[order], np.concatenate((self._values, found))[order]
        return self._values[np.searchsorted(self._hashes, words)][which]

    def tag(self, data: np.ndarray, offsets: np.ndarray):
        """Marginals with the words' starts, ends and each text's first word."""
        data = _text.lower(data)
        starts, ends, first, chains = tokens(data, offsets)
        if not len(starts):
            return np.zeros(0), starts, ends, first
        p, _ = forward_backward(self._evidence(data, starts, ends), chains, self._field.steps)
        return p, starts, ends, first

    def sums(self, data: np.ndarray, offsets: np.ndarray):
        """Each text's sum of noticeable marginals, and its tagged words."""
        tagged = self.tag(data, offsets)
        p, _, _, first = tagged
        sums = np.concatenate(([0.0], np.cumsum(np.where(p >= LEAST, p, 0.0))))
        return sums[first[1:]] - sums[first[:-1]], tagged


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def _spans(raw: bytes, base: int, p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Runs of toxic words of one text, in code points."""
    at = np.flatnonzero(p >= 0.5)
    if not len(at):
        return []
    chars = lambda byte: len(raw[base:byte].decode("utf-8", "replace"))
    return [
        {"start": chars(int(starts[r[0]])), "end": chars(int(ends[r[-1]])), "p": float(p[r].max())}
        for r in np.split(at, np.flatnonzero(np.diff(at) != 1) + 1)
    ]


def labelled_sample(
    documents: DataFrame, labels: DataFrame, learnable: Column, id_col: str, text_col: str, label_col: str, rows_per_class: int,
    chars_per_row: int,
) -> tuple[list[str], list[str]]:
    """Texts of label 1 and of label 0; two bounded collects."""
    draw = F.xxhash64(F.col("id").cast("string"), F.lit("toxicity sample"))
    out = []
    for label in (1, 0):
        rows = labels.where(learnable & (F.col(label_col) == label)).select(F.col(id_col).cast("long").alias("id")).distinct()
        chosen = F.broadcast(rows.orderBy(draw, "id").limit(rows_per_class))  # of a stated size
        texts = documents.select(F.col(id_col).cast("long").alias("id"), F.substring(text_col, 1, chars_per_row).alias("text"))
        out.append([r.text for r in sorted(texts.join(chosen, "id").where("text != ''").distinct().collect())])
    return out[0], out[1]


def score_documents(
    documents: DataFrame,
    labels: DataFrame,
    learnable: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_class: int = 2000,
    chars_per_row: int = 12000,
) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and toxic ``spans`` of every text; ``learnable`` is over ``labels``."""
    spark = documents.sparkSession
    field = train(
        *labelled_sample(documents, labels, learnable, id_col, text_col, label_col, rows_per_class, chars_per_row)
    )
    shared = spark.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value else None
        for rows, data, offsets in _text.pieces(batches, "text"):
            n = rows.num_rows
            scores, spans = np.zeros(n), [[] for _ in range(n)]
            if tagger:
                sums, (p, starts, ends, first) = tagger.sums(data, offsets)
                scores = 1 - np.exp(-shared.value.rate * sums)
                raw = data.tobytes()
                for k in np.unique(np.searchsorted(first, np.flatnonzero(p >= 0.5), "right") - 1).tolist():
                    own = slice(first[k], first[k + 1])
                    spans[k] = _spans(raw, int(offsets[k]), p[own], starts[own], ends[own])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.clip(scores, 0, 1)), pa.array((scores >= FLAG).astype(np.int32)), pa.array(spans, _SPANS)],
                names=["doc_id", "score", "predicted", "spans"],
            )

    needed = documents.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return needed.mapInArrow(
        run, "doc_id long, score double, predicted int, spans array<struct<start:long,end:long,p:double>>"
    )

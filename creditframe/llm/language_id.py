"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text is built. A text is parsed
against it from left to right into the longest phrases that occur in the sample; the fewer phrases, the
closer the language. The language with the fewest phrases, normalised by the size of its sample, wins.

Only letters tell languages apart here: case is folded, and any run of other characters counts as one
space, in the sample as in the texts.

Parsing runs in blocks of ``BLOCK`` characters, each opening a new phrase, so that the blocks of many
texts advance side by side through dense transition tables; a text of any length is parsed as a whole
number of such blocks and its phrases are summed.

The labelled sample is the only thing that reaches the driver, and its bound is ``total_chars``, shared
equally by the languages: about ``rows_per_lang`` rows of each are chosen by a hash of their id, and of
these at most the characters its share allows; a language that has fewer shortens no other's. Every text is then predicted from its characters alone.

Edge cases: a null text or one without a letter gets ``und`` and score 0; without any labelled row all
texts get ``und``; ties go to the language that sorts first; repeated rows are predicted alike; an empty
table gives no rows. Learned rows with a null or empty text, or a null language, teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditframe.llm import _automaton, _text

BLOCK = 1024
SYMBOLS = 96
UNKNOWN = "und"
_OTHERS = re.compile(r"[\W\d_]+")
_TARGET = np.int32((1 << 29) - 1)


@dataclass
class Model:
    """Transition tables of all languages, one below the other, over a common alphabet.

    Symbol 0 fills blocks up and changes nothing, symbol 1 stands for all letters outside the alphabet
    and symbol 2 for a run of anything but letters. An entry holds the next state and, above bit 28, the phrases that end on the way.
    """

    langs: list[str]
    classes: np.ndarray  # symbol of each code point
    table: np.ndarray  # states x symbols
    roots: np.ndarray
    bits: np.ndarray  # of a phrase: log2 of the sample's size and the symbols, for it is found in the one or spelt with the others

    @property
    def width(self) -> int:
        return self.table.shape[1]


def fit(samples: dict[str, list[str]], total_chars: int) -> Model:
    """The model of the given texts; each language uses its share of the characters at most, a shorter one all it has."""
    langs = sorted(samples)
    cleaned = {x: _OTHERS.sub(" ", " ".join(samples[x]).lower()) for x in langs}
    share = total_chars // max(len(langs), 1)
    texts = {x: cleaned[x][:share] for x in langs}
    points, counts = np.unique(np.array([ord(c) for x in langs for c in texts[x] if c != " "], np.int64), return_counts=True)
    alphabet = np.sort(points[np.argsort(-counts, kind="stable")[: SYMBOLS - 3]])
    classes = np.array([1 if chr(point).isalpha() else 2 for point in range(0x110000)], np.uint8)
    classes[alphabet] = 3 + np.arange(len(alphabet))
    for point in alphabet.tolist():
        upper = chr(point).upper()
        if len(upper) == 1:
            classes[ord(upper)] = classes[point]
    width = 3 + len(alphabet)
    tables, roots, bits, base = [], [], [], 0
    for lang in langs:
        steps = _automaton.build(classes[[ord(c) for c in texts[lang]]].tolist()).step
        own = np.full((len(steps), width), -1, np.int64)
        for state, step in enumerate(steps):
            own[state, list(step)] = list(step.values())
        root = own[0].copy()
        # Where a phrase can't go on it ends, and the character begins the next; an unknown one is a phrase itself.
        fallback = np.where(root >= 0, base + root + (1 << 29), base + (2 << 29))
        own = np.where(own >= 0, own + base, fallback[None, :])
        own[0] = np.where(root >= 0, base + root, base + (1 << 29))
        own[:, 0] = base + np.arange(len(steps))
        tables.append(own.astype(np.int32) if base + len(steps) < 1 << 29 else own)
        roots.append(base)
        bits.append(np.log2(len(texts[lang]) + width))
        base += len(steps)
    table = np.concatenate(tables) if tables else np.zeros((0, width), np.int32)
    return Model(langs, classes, table, np.array(roots, np.int64), np.array(bits))


def symbols_of(model: Model, text: str) -> np.ndarray:
    """The symbols of a text, each run of anything but letters as one."""
    found = model.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = found != 2
    keep[1:] |= found[:-1] != 2
    return found[keep]


def phrases(model: Model, symbols: list[np.ndarray]) -> np.ndarray:
    """Phrases of each text by language, texts x languages."""
    lengths = np.array([len(x) for x in symbols], np.int64)
    blocks = -(-lengths // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    grid = np.zeros(int(first[-1]) * BLOCK, np.uint8)
    for text, at, n in zip(symbols, first.tolist(), lengths.tolist()):
        grid[at * BLOCK : at * BLOCK + n] = text
    # Fullest blocks first, so that each step only touches the blocks that go on.
    grid = grid.reshape(-1, BLOCK)
    sizes = np.full(len(grid), BLOCK, np.int64)
    ends = first[1:][blocks > 0] - 1
    sizes[ends] = (lengths - (blocks - 1) * BLOCK)[blocks > 0]
    order = np.argsort(-sizes, kind="stable")
    columns = np.ascontiguousarray(grid[order].T).astype(np.int32)
    going = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(int(sizes.max()) if len(sizes) else 0), "right")
    flat, width = model.table.ravel(), np.int64(model.width)
    counts = np.zeros((len(model.langs), len(grid)), np.int32)
    for k, root in enumerate(model.roots):
        state = np.full(len(grid), root, np.int64)
        count = counts[k]
        for step, n in enumerate(going.tolist()):
            found = flat[state[:n] * width + columns[step, :n]]
            state[:n] = found & _TARGET
            count[:n] += found >> 29
        count += 1  # the phrase that the block's end leaves open
    out = np.zeros((len(symbols), len(model.langs)))
    if len(grid):
        unsorted = np.zeros_like(counts)
        unsorted[:, order] = counts
        sums = np.concatenate((np.zeros((len(model.langs), 1), np.int64), np.cumsum(unsorted, 1)), 1)
        out = (sums[:, first[1:]] - sums[:, first[:-1]]).T.astype(float)
    return out


def predict(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    """The language of each text and how far it is ahead: its part of the evidence, 0 to 1."""
    if not model.langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    symbols = [symbols_of(model, t) for t in texts]
    letters = [bool((x != 2).any()) for x in symbols]
    lengths = np.array([max(len(x), 1) for x in symbols], float)
    counts = phrases(model, symbols)
    even = (counts == counts[:, :1]).all(1, keepdims=True)  # a smaller sample is no evidence by itself
    entropy = counts * np.where(even, model.bits.max(), model.bits) / lengths[:, None]  # bits a character
    best = entropy.argmin(1)
    ahead = np.exp2(-8 * (entropy - entropy.min(1, keepdims=True)))
    scores = 1 / ahead.sum(1)
    return (
        [model.langs[b] if has else UNKNOWN for b, has in zip(best.tolist(), letters)],
        [s if has else 0.0 for s, has in zip(scores.tolist(), letters)],
    )


def labelled_sample(
    documents: DataFrame, id_col: str, text_col: str, lang_col: str, learnable: Column, rows_per_lang: int, chars_per_row: int
) -> dict[str, list[str]]:
    """About ``rows_per_lang`` texts of each language, chosen by a hash of the id; a bounded collect."""
    chosen = documents.where(learnable & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    sizes = chosen.groupBy(lang_col).count().collect()
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("language sample")), F.lit(1 << 30))
    bounds = F.lit(0)
    for row in sizes:
        bound = min(1 << 30, (rows_per_lang << 30) // max(row["count"], 1) + 1)
        bounds = F.when(F.col(lang_col) == row[0], bound).otherwise(bounds)
    rows = chosen.where(draw < bounds).select(lang_col, draw.alias("draw"), F.substring(text_col, 1, chars_per_row).alias("text"))
    samples: dict[str, list[str]] = {row[0]: [] for row in sizes}
    for lang, _, text in sorted(map(tuple, rows.collect())):
        samples[lang].append(text)
    return {lang: texts for lang, texts in samples.items() if texts}


def identify(
    documents: DataFrame,
    learnable: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    total_chars: int = 1 << 17,
    rows_per_lang: int = 256,
    chars_per_row: int = 4096,
) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every text, learned from the labelled rows that are ``learnable``."""
    spark = documents.sparkSession
    samples = labelled_sample(documents, id_col, text_col, lang_col, learnable, rows_per_lang, chars_per_row)
    shared = spark.sparkContext.broadcast(fit(samples, total_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows, data, offsets in _text.pieces(batches, "text"):
            raw = data.tobytes()
            bounds = offsets.tolist()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])]
            langs, scores = predict(model, texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    needed = documents.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return needed.mapInArrow(run, "doc_id long, lang_pred string, score double")

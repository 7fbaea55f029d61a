"""Boosted trees of Spark's ``GBTClassifier``, grown by tasks that stay alive for all trees.

The trees are those of Spark's classifier: the same candidate splits, row and feature draws, sums and gains.
Spark starts two stages for each level of each tree, and at 400 trees their start is nearly all of the time.
Here one barrier stage holds the binned rows in memory, a share of them in each task. For each level every
task writes the sums of its rows by node, feature and bin to the shared checkpoint folder; the first task adds
them up and writes the chosen splits, which the others read. A level costs a few milliseconds besides the sums.

What moves for a level is one table of sums a task (nodes x features x bins x 4 numbers), however many rows
there are. Files are removed once read. A lost task restarts the stage in a folder of its own attempt.
"""

from __future__ import annotations

import pickle
import time
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from creditframe.session import ensure_checkpoint_dir

#: Least rows that Spark draws to find candidate splits.
SPLIT_SAMPLE = 10_000
#: Sums of a node's bin: weight, weighted label, weighted squared label, rows.
STATS = 4
#: Random numbers are drawn in stretches of 2 to this power.
STRETCH = 7
#: Up to so many partitions in a task, their sums are added in the order of all partitions, as Spark does on one
#: machine, so that rounding is the same; more are added up where they are.
PIECES = 4
#: Seconds that a task waits for the others' sums; a level takes far less, and a lost task ends the stage at once.
PATIENCE = 3600.0
EPSILON = np.finfo(np.float64).eps
MASK = (1 << 64) - 1


@dataclass
class Settings:
    """Parameters of the fit, named as in Spark."""

    trees: int
    seed: int
    depth: int = 5
    step: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    min_rows: int = 5
    bins: int = 64


# --- Spark's random numbers -------------------------------------------------------------------


def _murmur(words: tuple[int, int], seed: int) -> int:
    def rotated(x, r):
        return ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF

    h = seed
    for k in words:
        h ^= rotated(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (rotated(h, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    h = (h ^ (h >> 16)) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ (h >> 16)


def _start(seed: int) -> int:
    """State that Spark's ``XORShiftRandom`` starts from."""
    data = (seed & MASK).to_bytes(8, "big")
    words = (int.from_bytes(data[:4], "little"), int.from_bytes(data[4:], "little"))
    low = _murmur(words, 0x3C074A61)
    return (_murmur(words, low) << 32) | low


def _next(state: int) -> int:
    state ^= state << 21 & MASK
    state ^= state >> 35
    return state ^ (state << 4 & MASK)


def _first_int(seed: int) -> int:
    value = _next(_start(seed)) & 0xFFFFFFFF
    return value - (1 << 32) if value >> 31 else value


def _jumps(n: int) -> list[np.ndarray]:
    """Tables that carry a state 1, 2, 4, ... steps on (a linear map of its bits), up to ``n`` steps."""
    images = np.array([_next(1 << bit) for bit in range(64)], np.uint64)
    tables = []
    while not tables or 1 << len(tables) < n:
        table = np.zeros((8, 256), np.uint64)
        for byte in range(8):
            for bit in range(8):
                table[byte, 1 << bit : 2 << bit] = table[byte, : 1 << bit] ^ images[8 * byte + bit]
        tables.append(table)
        images = _jumped(images, table)
    return tables


def _jumped(states: np.ndarray, table: np.ndarray) -> np.ndarray:
    columns = states.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = table[0][columns[:, 0]]
    for byte in range(1, 8):
        out ^= table[byte][columns[:, byte]]
    return out


def uniforms(seed: int, n: int, jumps: list[np.ndarray]) -> np.ndarray:
    """The first ``n`` doubles of ``XORShiftRandom(seed)``; ``jumps`` reach ``2 n`` states.

    Stretches of the sequence start from jumps and are then stepped side by side.
    """
    starts = np.array([_next(_start(seed))], np.uint64)
    for table in jumps[STRETCH:]:
        if len(starts) << STRETCH >= 2 * n:
            break
        starts = np.concatenate([starts, _jumped(starts, table)])
    states = np.empty((1 << STRETCH, len(starts)), np.uint64)
    states[0] = starts
    for k in range(1, len(states)):
        x = states[k - 1] ^ (states[k - 1] << np.uint64(21))
        x ^= x >> np.uint64(35)
        states[k] = x ^ (x << np.uint64(4))
    states = states.T.ravel()
    high, low = states[0 : 2 * n : 2] & np.uint64((1 << 26) - 1), states[1 : 2 * n : 2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(np.float64) * 2.0**-53


class _Seeds:
    """``nextLong`` of Java's ``Random``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _int(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        value = self.state >> 16
        return value - (1 << 32) if value >> 31 else value

    def long(self) -> int:
        return ((self._int() << 32) + self._int()) & MASK


def _subset(features: int, k: int, seed: int) -> list[int]:
    """Spark's reservoir sample of ``k`` features, in its order."""
    chosen, state = list(range(min(k, features))), _start(seed)
    for item in range(k, features):
        high = _next(state)
        state = _next(high)
        at = int((((high & ((1 << 26) - 1)) << 27) + (state & ((1 << 27) - 1))) * 2.0**-53 * (item + 1))
        if at < k:
            chosen[at] = item
    return chosen


# --- candidate splits -------------------------------------------------------------------------


def _thresholds(values: np.ndarray, weights: np.ndarray, rows: int, expected: float, splits: int) -> np.ndarray:
    """Candidate thresholds of one feature from its distinct non-zero sampled values and their weights.

    ``expected`` is the sample's expected weight: what the non-zero values leave of it counts as zeros.
    """
    if not len(values):
        return np.array([], np.float64)
    rest = expected - weights.sum()
    if rest > EPSILON * rows * 100:
        values, weights = np.append(values, 0.0), np.append(weights, rest)
    order = np.argsort(values)
    values, weights = values[order], weights[order]
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= splits:
        return middles
    stride = expected / (splits + 1)
    chosen, seen, target = [], weights[0], stride
    for middle, weight in zip(middles, weights[1:]):
        before, seen = seen, seen + weight
        if abs(before - target) < abs(seen - target):
            chosen.append(middle)
            target += stride
    return np.array(chosen, np.float64)


def candidates(rows: DataFrame, numbers: list[str], settings: Settings, n: int) -> list[np.ndarray]:
    """Candidate thresholds of each numeric feature, from the rows that Spark would draw for them."""
    spark = rows.sparkSession
    bins = min(settings.bins, n)
    wanted = max(bins * bins, SPLIT_SAMPLE)
    share = wanted / n if wanted < n else 1.0
    expected = share * rows.agg(F.sum("weight")).first()[0]
    sampled = rows.select("weight", *numbers)
    if share < 1:
        drawn = sampled._jdf.toJavaRDD().sample(False, share, _first_int(settings.seed))
        sampled = DataFrame(spark._jsparkSession.createDataFrame(drawn, sampled._jdf.schema()), spark)
    entries = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("x")) for i, c in enumerate(numbers)])
    counts = sampled.select("weight", F.inline(entries)).where("x != 0").groupBy("f", "x").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    found = counts.toPandas()  # distinct values of a sample of bounded size
    parts = [found[found["f"] == i] for i in range(len(numbers))]
    return [_thresholds(p["x"].to_numpy(np.float64), p["w"].to_numpy(np.float64), int(p["n"].sum()), expected, bins - 1) for p in parts]


# --- trees ------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Fitted trees, every path drawn out to the full depth.

    ``feature`` and ``right`` are by tree, node (breadth first) and, for ``right``, bin of the node's feature;
    ``value`` is by tree and path. ``arity`` is the number of categories of each coded feature.
    """

    columns: list[str]
    thresholds: list[np.ndarray]
    arity: list[int]
    feature: np.ndarray
    right: np.ndarray
    value: np.ndarray
    step: float

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(t) + 1 for t in self.thresholds] + self.arity, np.int64)

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bins by feature and row."""
        kind = np.uint8 if self.sizes.max() <= 256 else np.int32
        found = [np.searchsorted(t, x, side="left") for t, x in zip(self.thresholds, columns)]
        return np.stack([x.astype(kind) for x in [*found, *columns[len(self.thresholds) :]]])

    def margins(self, bins: np.ndarray) -> np.ndarray:
        rows, features = bins.shape[1], bins.shape[0]
        flat, start = np.ascontiguousarray(bins.T).ravel(), np.arange(rows, dtype=np.int64) * features
        total, wide = np.zeros(rows), self.right.shape[2]
        inner = self.feature.shape[1]
        for t in range(len(self.feature)):
            feature, right, node = self.feature[t], self.right[t].ravel(), np.zeros(rows, np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + right[node * wide + flat[start + feature[node]]]
            total += self.value[t][node - inner] * (self.step if t else 1.0)
        return total

    def probability(self) -> Column:
        """Probability of the positive class from the columns of the fit."""

        @F.pandas_udf(DoubleType())
        def scored(*columns: pd.Series) -> pd.Series:
            margins = self.margins(self.binned([c.to_numpy(np.float64) for c in columns]))
            return pd.Series(1.0 - 1.0 / (1.0 + np.exp(2.0 * margins)))

        return scored(*[F.col(c).cast("double") for c in self.columns])


def _impurity(w, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(w == 0, 0.0, (q - s * s / w) / w)


class _Grower:
    """One tree as its levels' sums come in: chosen splits, and which nodes are open."""

    def __init__(self, sizes: np.ndarray, coded: int, settings: Settings, number: int):
        self.sizes, self.numeric, self.settings = sizes, len(sizes) - coded, settings
        self.random = _Seeds(settings.seed + number)
        self.inner, self.wide = (1 << settings.depth) - 1, int(sizes.max())
        self.feature, self.right = np.zeros(self.inner, np.int64), np.zeros((self.inner, self.wide), np.uint8)
        self.value = np.zeros(self.inner + 1)
        self.open, self.parents = [0], [None]  # in Spark's order of nodes
        self._draw()

    def _draw(self):
        k = int(np.ceil(self.settings.feature_share * len(self.sizes)))
        self.subsets = [_subset(len(self.sizes), k, self.random.long()) if k < len(self.sizes) else list(range(k)) for _ in self.open]

    def _leaf(self, node: int, stats):
        level = (node + 1).bit_length() - 1
        path = (node + 1 << (self.settings.depth - level)) - 1 - self.inner
        self.value[path] = stats[1] / stats[0] if stats[0] else 0.0

    def take(self, sums: np.ndarray) -> None:
        """Choose the splits of the open nodes from ``sums`` (feature, pair of stats, node, bin, stat)."""
        features, _, nodes = sums.shape[:3]
        sums = sums.transpose(2, 0, 1, 4, 3).reshape(nodes, features, STATS, self.wide)
        order = np.broadcast_to(np.arange(self.wide), (nodes, features, self.wide)).copy()
        if self.numeric < features:
            w, s = sums[:, self.numeric :, 0], sums[:, self.numeric :, 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                centre = np.where(w == 0, np.finfo(np.float64).max, s / w)
            centre[np.broadcast_to(np.arange(self.wide) >= self.sizes[self.numeric :, None], centre.shape)] = np.inf
            order[:, self.numeric :] = np.argsort(centre, axis=2, kind="stable")
            sums = np.take_along_axis(sums, order[:, :, None, :], axis=3)
        below = np.cumsum(sums, axis=3)
        left = below[..., :-1]
        rest = below[..., -1:] - left
        lw, ls, lq, ln = (left[:, :, i] for i in range(STATS))
        rw, rs, rq, rn = (rest[:, :, i] for i in range(STATS))
        parents = []
        for i, parent in enumerate(self.parents):
            if parent is None:  # the root's sums are those of its first split
                first = next((f for f in self.subsets[i] if self.sizes[f] > 1), None)
                parent = left[i, first, :, 0] + rest[i, first, :, 0] if first is not None else below[i, 0, :, -1]
            parents.append(parent)
        stats = np.array(parents)
        impurity = _impurity(stats[:, 0], stats[:, 1], stats[:, 2])
        total = lw + rw
        with np.errstate(divide="ignore", invalid="ignore"):
            li, ri = _impurity(lw, ls, lq), _impurity(rw, rs, rq)
            gain = impurity[:, None, None] - lw / total * li - rw / total * ri
        least = self.settings.min_rows
        valid = (ln >= least) & (rn >= least) & (np.arange(self.wide - 1) < self.sizes[:, None] - 1) & (gain >= 0)
        gain = np.where(valid, gain, -np.inf)
        at = gain.argmax(axis=2) if self.wide > 1 else np.zeros((nodes, features), np.int64)
        opened, grown = [], []
        for i, node in enumerate(self.open):
            subset = self.subsets[i]
            best = [gain[i, f, at[i, f]] for f in subset] if self.wide > 1 else [-np.inf]
            f = subset[int(np.argmax(best))]
            split = at[i, f]
            if not max(best) > 0:
                self._leaf(node, stats[i])
                continue
            self.feature[node] = f
            self.right[node, order[i, f, split + 1 : self.sizes[f]]] = 1
            for child, sides, impure in ((2 * node + 1, left, li), (2 * node + 2, rest, ri)):
                own = sides[i, f, :, split]
                if child >= self.inner or abs(impure[i, f, split]) < EPSILON:
                    self._leaf(child, own)
                else:
                    opened.append(child)
                    grown.append(own)
        # Spark keeps open nodes on a stack.
        self.open, self.parents = opened[::-1], grown[::-1]
        self._draw()


# --- the stage --------------------------------------------------------------------------------


class _Folder:
    """Arrays handed between tasks as files, each renamed when whole and removed when read by all."""

    def __init__(self, uri: str):
        self.fs, self.path = _opened(uri)
        self.fs.create_dir(self.path, recursive=True)

    def put(self, name: str, content) -> None:
        with self.fs.open_output_stream(f"{self.path}/{name}.part") as f:
            f.write(pickle.dumps(content, protocol=5))
        self.fs.move(f"{self.path}/{name}.part", f"{self.path}/{name}")

    def get(self, name: str):
        until, wait = time.monotonic() + PATIENCE, 0.0002
        while self.fs.get_file_info(f"{self.path}/{name}").type == pafs.FileType.NotFound:
            if time.monotonic() > until:
                raise TimeoutError(f"no {name} after {PATIENCE:.0f} s")
            time.sleep(wait)
            wait = min(1.1 * wait, 0.02)
        with self.fs.open_input_file(f"{self.path}/{name}") as f:
            return pickle.loads(f.read())

    def drop(self, name: str) -> None:
        self.fs.delete_file(f"{self.path}/{name}")


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parsed.path)
    return pafs.FileSystem.from_uri(uri)


def _grown(fit: Trees, settings: Settings, folder: str):
    """Per task of the barrier stage: read the rows, then grow all trees together with the other tasks."""

    def run(batches):
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        me, tasks = context.partitionId(), len(context.getTaskInfos())
        # A stage that starts again must not read what its first attempt left.
        shared = _Folder(f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}")
        read = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), fit.binned([np.zeros(0)] * len(fit.columns)))]
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("_part", "label", "weight", *fit.columns)]
            read.append((*columns[:3], fit.binned(columns[3:])))
        part, label, weight, bins = (np.concatenate(x, axis=-1) for x in zip(*read))
        del read
        order = np.argsort(part, kind="stable")
        part, label, weight, bins = part[order], label[order] * 2.0 - 1.0, weight[order], np.ascontiguousarray(bins[:, order])
        ids, begin = np.unique(part, return_index=True)
        pieces = [slice(a, b) for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(part)])]
        firsts = [[int(i) for i in x.split(",") if i] for x in context.allGather(",".join(map(str, ids if len(ids) <= PIECES else ids[:1])))]
        jumps = _jumps(2 * max([1, *[p.stop - p.start for p in pieces]]))
        sizes, features, rows = fit.sizes, len(bins), len(part)
        flat, start = np.ascontiguousarray(bins.T).ravel(), np.arange(rows, dtype=np.int64) * features
        wide, inner = int(sizes.max()), (1 << settings.depth) - 1
        margin, target, grown = np.zeros(rows), label, []
        for number in range(settings.trees):
            drawn = [np.flatnonzero(uniforms(settings.seed + number + int(i) + 1, p.stop - p.start, jumps) < settings.row_share) + p.start for i, p in zip(ids, pieces)]
            chosen = np.concatenate(drawn) if drawn else np.zeros(0, np.int64)
            ends = np.cumsum([len(d) for d in drawn]).tolist()
            cuts = [slice(a, b) for a, b in zip([0, *ends[:-1]], ends)]
            cuts = cuts if len(cuts) <= PIECES else [slice(0, len(chosen))]
            own, w = bins[:, chosen], weight[chosen]
            ws = w * target[chosen]
            # Two sums at a time, as the parts of a complex number.
            pairs = [w + 1j * ws, ws * target[chosen] + 1j]
            tree = _Grower(sizes, len(fit.arity), settings, number)
            node = np.zeros(rows, np.int64)
            used, slot_of = np.arange(features), np.zeros(inner, np.int64)
            slots, level = 1, 0
            while slots:
                # Rows of nodes that are not open are summed up in a place of their own, which is left out.
                base = slot_of[node[chosen]] * wide
                sums = np.zeros((len(cuts), len(used), len(pairs), (slots + 1) * wide), np.complex128)
                for i, f in enumerate(used):
                    code = base + own[f]
                    for k, cut in enumerate(cuts):
                        for j, pair in enumerate(pairs):
                            np.add.at(sums[k, i, j], code[cut], pair[cut])
                sums = sums[..., : slots * wide]
                name = f"{number}-{level}"
                if me:
                    shared.put(f"{name}-{me}", sums)
                    plan = shared.get(name)
                else:
                    parts = dict(zip(firsts[0], sums))
                    for other in range(1, tasks):
                        parts |= zip(firsts[other], shared.get(f"{name}-{other}"))
                        shared.drop(f"{name}-{other}")
                    every = np.zeros((features, len(pairs), slots * wide), np.complex128)
                    for part in sorted(parts):
                        every[used] += parts[part]
                    tree.take(every.view(np.float64).reshape(features, len(pairs), slots, wide, 2))
                    last = np.array(sorted({f for s in tree.subsets for f in s}), np.int64)
                    plan = {"feature": tree.feature, "right": tree.right, "open": np.array(tree.open, np.int64), "used": last}
                    if not tree.open:
                        plan["value"] = tree.value
                    if tasks > 1:
                        shared.put(name, plan)
                        if before := _before(number, level, grown):
                            shared.drop(before)
                # Every row goes one level down; below a leaf it keeps to the left.
                right = plan["right"].ravel()
                node = 2 * node + 1 + right[node * wide + flat[start + plan["feature"][node]]]
                used, slots, level = plan["used"], len(plan["open"]), level + 1
                slot_of = np.full(2 * inner + 1, slots, np.int64)
                slot_of[plan["open"]] = np.arange(slots)
            for _ in range(level, settings.depth):
                node = 2 * node + 1 + right[node * wide + flat[start + plan["feature"][node]]]
            margin += plan["value"][node - inner] * (settings.step if number else 1.0)
            target = 4.0 * label / (1.0 + np.exp(2.0 * label * margin))
            grown.append((plan["feature"], plan["right"], plan["value"], level))
        if not me:
            out = [np.stack([g[i] for g in grown]).tobytes() for i in range(3)]
            yield pa.RecordBatch.from_pydict({name: pa.array([x], pa.binary()) for name, x in zip(("feature", "right", "value"), out)})

    return run


def _before(number: int, level: int, grown: list) -> str | None:
    """The plan before this one, which all have read since they sent sums for this one."""
    if level:
        return f"{number}-{level - 1}"
    return f"{number - 1}-{grown[-1][3] - 1}" if number else None


def slots(spark) -> int:
    """Tasks that can run at once."""
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def possible(spark) -> bool:
    """Whether Python can open the checkpoint folder and barrier stages can run."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true" or slots(spark) < 1:
        return False
    try:
        _opened(ensure_checkpoint_dir(spark))
    except (OSError, ValueError, NotImplementedError, ImportError):
        return False
    return True


def fit(rows: DataFrame, numbers: list[str], coded: dict[str, int], settings: Settings, n: int, share: int = 1) -> Trees:
    """Boosted trees on ``label`` (0 or 1) and ``weight`` from the numeric columns and the coded ones.

    ``coded`` has the number of categories of each coded column, whose values are 0, 1, ... ``n`` is the number
    of rows. ``share`` fits that run at the same time leave each other room. Rows are drawn by their place in
    the partitions of ``rows``, as Spark draws them, so those are what decides the trees, not the tasks here.
    """
    spark = rows.sparkSession
    if n == 0 or max(coded.values(), default=0) > min(settings.bins, n):
        raise ValueError(f"{n} rows are too few for {max(coded.values(), default=0)} categories")
    thresholds = candidates(rows, numbers, settings, n)
    columns = [*numbers, *coded]
    blank = Trees(columns, thresholds, list(coded.values()), np.zeros((0, 0)), np.zeros((0, 0, 0)), np.zeros((0, 0)), settings.step)
    tasks = max(1, slots(spark) // share)
    held = rows.select(F.spark_partition_id().cast("long").alias("_part"), F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"), *[F.col(c).cast("double").alias(c) for c in columns])
    # A barrier stage takes its partitions as they are stored.
    held = (held.coalesce(tasks) if rows.rdd.getNumPartitions() > tasks else held).checkpoint()
    uri = f"{ensure_checkpoint_dir(spark)}/boosting-{uuid.uuid4().hex}"
    try:
        found = held.mapInArrow(_grown(blank, settings, uri), "feature binary, right binary, value binary", barrier=True).collect()[0]
    finally:
        fs, path = _opened(uri)
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)
    inner, wide = (1 << settings.depth) - 1, int(blank.sizes.max())
    blank.feature = np.frombuffer(found["feature"], np.int64).reshape(settings.trees, inner)
    blank.right = np.frombuffer(found["right"], np.uint8).reshape(settings.trees, inner, wide)
    blank.value = np.frombuffer(found["value"], np.float64).reshape(settings.trees, inner + 1)
    return blank

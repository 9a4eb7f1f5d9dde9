"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. For an anchor at
angle a and rows at angles [l, h] to one direction, the angle between them
lies between max(0, a - h, l - a) and the reflected sum of a and l..h; over
all directions the intervals intersect, and their cosines times the norms
bound the integer scores, rounded outwards by more than floating point can be
off. Rows lie in strips of similar label, nearest direction and angle; only a
strip whose bounds reach an anchor's current window is scored, exactly, in
integers.

First pass: an anchor's best rows of its own label. Second pass: for each of
these positives the best rows of other labels inside its score window. Both
passes meet blocks of packed rows with blocks of packed anchors (a stated
query set), each pair of blocks once; a task keeps only the best few per
anchor of the block it works on, and one ranked window joins the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maillens.llm.common import release, staged, tidy

DIRECTIONS = 16            # reference directions
SAMPLE = 4096              # rows, by hash, that the directions are chosen from
BLOCK = 16_384             # rows of one packed block
WAVE = 2048                # anchors of one packed block
STRIP = 128                # rows that share one bound
GROUP_ROWS = 1 << 18       # rows that meet one copy of the anchors, at large sizes

_SLACK = 1e-6              # radians; arccos is off by less than 3e-8 even near 0
_MIN, _MAX = np.iinfo(np.int64).min, np.iinfo(np.int64).max


# --- directions and angles ---------------------------------------------------------

def _matrix(vectors: list[list[int]]) -> np.ndarray:
    """Rows as int64, shorter ones padded with zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1.0)[:, None], norm


def directions(sample: DataFrame, n: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors of rows far from each other (farthest first), from the
    ``SAMPLE`` rows with the smallest hash."""
    rows = sample.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(SAMPLE).select("vector").collect()
    unit, norm = _units(_matrix([r[0] for r in rows]))
    unit = unit[norm > 0]
    picked: list[int] = []
    near = np.full(len(unit), -2.0)
    while len(picked) < min(n, len(unit)):
        picked.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[picked[-1]])
    return unit[picked]


def angles(x: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(angle of every row to every direction, norm); a zero row: angle 0."""
    unit, norm = _units(x)
    wide = max(unit.shape[1], refs.shape[1])
    pad = lambda m: np.pad(m, ((0, 0), (0, wide - m.shape[1])))
    return np.arccos(np.clip(pad(unit) @ pad(refs).T, -1.0, 1.0)), norm


# --- packed blocks -------------------------------------------------------------------

@dataclass
class Rows:
    """Rows of one block, in the order of their strips."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    angle: np.ndarray      # (rows, directions)
    norm: np.ndarray

    @classmethod
    def of(cls, ids: list[int], labels: list[int], vectors: list[list[int]], refs: np.ndarray) -> Rows:
        x = _matrix(vectors)
        angle, norm = angles(x, refs)
        near = angle.argmin(axis=1) if angle.shape[1] else np.zeros(len(x), np.int64)
        own = angle[np.arange(len(x)), near] if angle.shape[1] else np.zeros(len(x))
        order = np.lexsort((own, near, labels))
        return cls(np.array(ids, np.int64)[order], np.array(labels, np.int64)[order], x[order], angle[order],
                   norm[order])

    def pack(self) -> dict[str, bytes | int]:
        most = int(np.abs(self.x.astype(object)).max()) if self.x.size else 0
        kind = next((k for k in (np.int8, np.int16, np.int32) if most <= np.iinfo(k).max), np.int64)
        return {"n": len(self.ids), "ids": self.ids.tobytes(), "labels": self.labels.tobytes(),
                "kind": np.dtype(kind).str, "x": self.x.astype(kind).tobytes(),
                "angle": self.angle.tobytes(), "norm": self.norm.tobytes()}

    @classmethod
    def unpack(cls, row: dict) -> Rows:
        n = row["n"]
        get = lambda name, kind: np.frombuffer(row[name], kind)
        return cls(get("ids", np.int64), get("labels", np.int64),
                   get("x", row["kind"]).reshape(n, -1) if row["x"] else np.zeros((n, 0), np.int64),
                   get("angle", np.float64).reshape(n, -1) if row["angle"] else np.zeros((n, 0)),
                   get("norm", np.float64))


_PACKED = [("n", "int"), ("ids", "binary"), ("labels", "binary"), ("kind", "string"), ("x", "binary"),
           ("angle", "binary"), ("norm", "binary")]
_ARROW = {"int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "long": pa.int64()}


def _pack(size: int, refs: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, vector) rows to blocks of ``size`` rows."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []

    def block(n: int) -> Iterator[pa.RecordBatch]:
        nonlocal held, number
        whole = pa.Table.from_batches(held)
        for a in range(0, n, size):
            part = whole.slice(a, min(size, n - a))
            packed = Rows.of(*(part.column(c).to_pylist() for c in ("vec_id", "label", "vector")), refs).pack()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64())] + [pa.array([packed[k]], _ARROW[t]) for k, t in _PACKED],
                names=["block", *[k for k, _ in _PACKED]])
            number += 1
        rest = whole.slice(n)
        held = rest.to_batches() if rest.num_rows else []

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        full = sum(b.num_rows for b in held) // size * size
        if full:
            yield from block(full)
    if held:
        yield from block(sum(b.num_rows for b in held))
    tidy()


def packed(df: DataFrame, size: int, refs: np.ndarray) -> DataFrame:
    return df.select("vec_id", "label", "vector").mapInArrow(
        partial(_pack, size, refs), ", ".join(["block long", *[f"{k} {t}" for k, t in _PACKED]]))


# --- bounds and exact scores ------------------------------------------------------------

class Strips:
    """Angle, norm and label intervals of a block's strips."""

    def __init__(self, rows: Rows):
        first = np.arange(0, len(rows.ids), STRIP)
        low = lambda v: np.minimum.reduceat(v, first, axis=0)
        high = lambda v: np.maximum.reduceat(v, first, axis=0)
        self.first = first
        self.angle = low(rows.angle), high(rows.angle)
        self.norm = low(rows.norm), high(rows.norm)
        self.label = low(rows.labels), high(rows.labels)

    def bounds(self, anchors: Rows) -> tuple[np.ndarray, np.ndarray]:
        """(least, largest) possible score of every anchor with any row of
        every strip."""
        shape = (len(anchors.ids), len(self.first))
        near, far = np.zeros(shape), np.full(shape, math.pi)
        for k in range(anchors.angle.shape[1]):
            a, lo, hi = anchors.angle[:, k:k + 1], self.angle[0][None, :, k], self.angle[1][None, :, k]
            np.maximum(near, np.maximum(a - hi, lo - a), out=near)
            np.minimum(far, np.where(a + hi <= math.pi, a + hi, np.where(a + lo >= math.pi, 2 * math.pi - a - lo,
                                                                        math.pi)), out=far)
        top = np.cos(np.clip(near - _SLACK, 0.0, math.pi))
        low = np.cos(np.clip(far + _SLACK, 0.0, math.pi))
        na, (n0, n1) = anchors.norm[:, None], self.norm
        slack = 1.0 + 1e-9 * na * n1[None, :]
        return (na * np.where(low >= 0, low * n0, low * n1) - slack,
                na * np.where(top >= 0, top * n1, top * n0) + slack)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; exact, and beyond a long's range
    the end of that range. Floating point only while it holds every sum."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = lambda m: int(np.abs(m.astype(np.float64)).max()) + 1 if m.size else 0
    bound = width * most(a) * most(b)
    if bound < 1 << 52:
        kind = np.float32 if bound < 1 << 23 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, _MIN, _MAX).astype(np.int64)


class Best:
    """The ``k`` best (score, id) of a number of slots, higher scores and
    then smaller ids first."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, _MIN)         # a score below cannot enter

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.zeros(len(self.least), bool)
        touched[slot] = True
        old = touched[self.slot]
        s, v, i = (np.concatenate((x[old], y)) for x, y in
                   ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, ~v, s))            # ~v falls as v rises, without overflow
        s, v, i = s[order], v[order], i[order]
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        rank = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
        keep = rank < self.k
        last = rank == self.k - 1
        self.least[s[last]] = v[last]
        self.slot, self.score, self.id = (np.concatenate((x[~old], y[keep])) for x, y in
                                          ((self.slot, s), (self.score, v), (self.id, i)))


def _positives(best: Best, anchors: Rows, rows: Rows) -> None:
    strips = Strips(rows)
    _, top = strips.bounds(anchors)
    fits = (strips.label[0] <= anchors.labels[:, None]) & (anchors.labels[:, None] <= strips.label[1])
    for s in np.argsort(-np.where(fits, top, -np.inf).max(axis=0), kind="stable").tolist():
        use = np.flatnonzero(fits[:, s] & (top[:, s] >= best.least))
        if not len(use):
            continue
        part = slice(int(strips.first[s]), int(strips.first[s]) + STRIP)
        got = scores(anchors.x[use], rows.x[part])
        good = ((rows.labels[part] == anchors.labels[use, None]) & (rows.ids[part] != anchors.ids[use, None])
                & (got >= best.least[use, None]))
        i, j = np.nonzero(good)
        best.add(use[i], got[i, j], rows.ids[part][j])


def _negatives(best: Best, anchors: Rows, rows: Rows, owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Slots are an anchor's windows: ``owner`` is its anchor's index."""
    strips = Strips(rows)
    bottom, top = strips.bounds(anchors)
    other = (strips.label[0] != anchors.labels[:, None]) | (strips.label[1] != anchors.labels[:, None])
    for s in range(len(strips.first)):
        meets = (other[owner, s] & (top[owner, s] >= np.maximum(low, best.least)) & (bottom[owner, s] <= high))
        slot = np.flatnonzero(meets)
        if not len(slot):
            continue
        part = slice(int(strips.first[s]), int(strips.first[s]) + STRIP)
        use, back = np.unique(owner[slot], return_inverse=True)
        got = scores(anchors.x[use], rows.x[part])[back]
        good = ((got >= np.maximum(low, best.least)[slot, None]) & (got <= high[slot, None])
                & (rows.labels[part] != anchors.labels[owner[slot], None]))
        i, j = np.nonzero(good)
        best.add(slot[i], got[i, j], rows.ids[part][j])


# --- the two passes over pairs of blocks ---------------------------------------------------

_BLOCK_COLUMNS = ["block", *[k for k, _ in _PACKED]]


def _meet(batches: Iterator[pa.RecordBatch], start, step, finish) -> Iterator[pa.RecordBatch]:
    """Rows hold an anchor block and a row block; neighbours mostly share the
    anchor block, whose state then goes on. One row at a time is unpacked."""
    wave, anchors, state = None, None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["wave"] != wave:
                if state is not None:
                    yield from finish(wave, anchors, state)
                wave = row["wave"]
                anchors = Rows.unpack({k: row[f"a_{k}"] for k, _ in _PACKED})
                state = start(row, anchors)
            step(state, anchors, Rows.unpack(row))
    if state is not None:
        yield from finish(wave, anchors, state)
    tidy()


def _first_pass(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def finish(wave: int, anchors: Rows, best: Best) -> Iterator[pa.RecordBatch]:
        if len(best.slot):
            yield pa.RecordBatch.from_pydict({
                "wave": np.full(len(best.slot), wave), "place": best.slot, "anchor_id": anchors.ids[best.slot],
                "score": best.score, "id": best.id})

    yield from _meet(batches, lambda row, a: Best(len(a.ids), k), _positives, finish)


def _second_pass(k: int, low: int, high: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def start(row: dict, anchors: Rows):
        won = row["won"]
        scores_ = [w["score"] for w in won]
        edge = lambda v: np.array([max(_MIN, min(_MAX, x)) for x in v], np.int64)
        return (Best(len(won), k), np.array([w["place"] for w in won], np.int64),
                edge([-(-low * s // 100) for s in scores_]), edge([high * s // 100 for s in scores_]), won)

    def step(state, anchors: Rows, rows: Rows) -> None:
        best, owner, lo, hi, _ = state
        _negatives(best, anchors, rows, owner, lo, hi)

    def finish(wave: int, anchors: Rows, state) -> Iterator[pa.RecordBatch]:
        best, owner, _, _, won = state
        if len(best.slot):
            yield pa.RecordBatch.from_pydict({
                "wave": np.full(len(best.slot), wave), "slot": best.slot,
                "anchor_id": anchors.ids[owner[best.slot]],
                "positive_id": np.array([w["id"] for w in won], np.int64)[best.slot],
                "positive_score": np.array([w["score"] for w in won], np.int64)[best.slot],
                "negative_score": best.score, "negative_id": best.id})

    yield from _meet(batches, start, step, finish)


def _pairs(waves: DataFrame, blocks: DataFrame, groups: int) -> DataFrame:
    """Every anchor block beside every row block: row blocks are dealt into
    ``groups``, and each group gets a copy of the anchor blocks."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = waves.select("wave", *[c for c in waves.columns if c == "won"],
                        *[F.col(k).alias(f"a_{k}") for k, _ in _PACKED],
                        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    return (left.repartition(parts, "group").hint("merge").join(right.repartition(parts, "group"), "group")
            .drop("group"))


def mine(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95) -> DataFrame:
    """Hard negatives of ``df(vec_id long, label int, vector array<long>)``.

    For every anchor row and each of its ``positives`` best-scored other rows
    of the same label: the ``negatives`` best-scored rows of other labels with
    ``low * positive_score <= 100 * score <= high * positive_score``, as
    (anchor_id, positive_id, rank from 1, negative_id, positive_score,
    negative_score). Scores are integer inner products, ties go to the smaller
    vec_id. Other rows are rows of another vec_id; a row that repeats counts
    as often as it stands. Rows without vec_id, label or vector, or with a
    null component, take no part; shorter vectors count as padded with zeros,
    a score beyond a long's range as the end of the range; an anchor without
    positives, and a positive without negatives in its window, gives no row,
    an empty table an empty result. Other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select("vec_id", "label", "vector", is_anchor.alias("anchor")).where(
        "vec_id is not null and label is not null and vector is not null and not exists(vector, x -> x is null)")
    refs = directions(rows)
    blocks, block_path = staged(packed(rows, BLOCK, refs), "vectors")
    waves, wave_path = staged(packed(rows.where("anchor"), WAVE, refs).withColumnRenamed("block", "wave"), "anchors")
    many, n = blocks.agg(F.count("*"), F.sum("n")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(many, max(parts, -(-(n or 0) // GROUP_ROWS))))
    ranked = lambda keys, score, i: Window.partitionBy(*keys).orderBy(F.col(score).desc(), i)
    found = _pairs(waves, blocks, groups).mapInArrow(
        partial(_first_pass, positives), "wave long, place long, anchor_id long, score long, id long")
    best, best_path = staged(
        found.withColumn("k", F.row_number().over(ranked(["wave", "place"], "score", "id"))).where(f"k <= {positives}")
        .groupBy("wave").agg(F.sort_array(F.collect_list(F.struct("place", "k", "score", "id"))).alias("won")),
        "positives")                                      # at most WAVE * positives entries in a row
    hard = _pairs(waves.join(best, "wave"), blocks, groups).mapInArrow(
        partial(_second_pass, negatives, low, high),
        "wave long, slot long, anchor_id long, positive_id long, positive_score long, negative_score long, "
        "negative_id long")
    out, _ = staged(
        hard.withColumn("rank", F.row_number().over(ranked(["wave", "slot"], "negative_score", "negative_id")))
        .where(f"rank <= {negatives}")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    release(spark, block_path, wave_path, best_path)
    return out

"""Hard negatives for contrastive training, from Hilbert-ordered blocks with zone maps.

Rows are ordered along a Hilbert curve through the ``CURVE_DIMS`` dimensions of
greatest variance, cut into Parquet blocks of ``BLOCK_ROWS`` rows, and each block
carries a zone map: the least and greatest integer of every dimension and its
labels.  Interval arithmetic over a zone map bounds the inner product of an
anchor with every row of the block: the sum of max(a*lo, a*hi) from above, of
min(a*lo, a*hi) from below.  An anchor reads a block

* for its positives, if the block has its label and the upper bound reaches the
  score that the anchor's own block already offers;
* for a window [30 %, 90 %] of a positive's score, if the block has another
  label and its two bounds leave room for a score inside the window.

Zone maps are dealt to tasks, each with all groups of anchors, and give the
list of (group, block) to read; the blocks on it are joined in by number and
dealt by (group, deal) again.  A task goes through its blocks from the highest
upper bound down and stops reading for a window once its first places can't be
beaten.  It returns at most the wanted number of rows per anchor or window, so
nothing quadratic is shuffled; the first places of all tasks are merged by rank.
No task holds more than a deal of blocks and a group of anchors, and the table's
size shows in the number of tasks only.  Nothing is sampled, all bounds are sound.

Components are floor(256 * x), x as double; scores are exact 64-bit integers.

Defined cases: a row without id or label, with a null vector, or with a null, NaN
or infinite component takes no part, nor one whose vector's length is not that
of the least id's; rows with the same id are one row, the least (label, vector);
components beyond +-2**15 count as that bound; equal scores are ordered by id; an
anchor without another row of its label gives no rows, nor does a positive with
a negative score, as its window is empty; an empty input gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantframe.llm._scratch import written
from plantframe.llm.vector_codes import SCALE, usable

POSITIVES, NEGATIVES = 5, 10
#: A negative's score in percent of the positive's.
LEAST_SHARE, MOST_SHARE = 30, 90
ANCHOR_STEP, NOISY_STEP, LABELS = 100, 7, 10
BOUND = float(1 << 15)
CURVE_DIMS, CURVE_BITS = 8, 7
BLOCK_ROWS, BLOCKS_PER_DEAL, ANCHORS_PER_GROUP, ROWS_PER_PARTITION = 256, 32, 1024, 1 << 16
#: Every score is above this.
NONE = -(1 << 62)

ROWS = "id long, label long, v array<double>"
BLOCK = "block long, deal long, lo binary, hi binary, ids binary, labels binary, vectors binary"
ANCHOR = "block long, id long, label long, vector binary, least long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (row of coordinates below 2**bits) on the Hilbert curve, by Gray-code rotation from the top bit down."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(n):
            set_ = (x[i] >> bit) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn = np.where((x[n - 1] >> bit) & 1 == 1, turn ^ ((1 << bit) - 1), turn)
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


def scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; through floating point where every partial sum is an integer below 2**53."""
    if not anchors.size or not vectors.size:
        return np.zeros((len(anchors), len(vectors)), np.int64)
    if int(np.abs(anchors).max()) * int(np.abs(vectors).max()) * anchors.shape[1] < 1 << 53:
        return (anchors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return anchors @ vectors.T


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner product of each anchor with the rows of each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return scores(up, lo) + scores(down, hi), scores(up, hi) + scores(down, lo)


def integers(column: pa.ListArray, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(flat, -BOUND, BOUND) * SCALE).astype(np.int64).reshape(-1, dims)


def _packed(x: np.ndarray, kind: str = "<i4") -> bytes:
    return x.astype(kind).tobytes()


def _rows(raw: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").astype(np.int64).reshape(-1, dims)


def spread(dims: int):
    """Sums and sums of squares per dimension, one row per task and dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square, n, marked = np.zeros(dims), np.zeros(dims), 0, 0
        for batch in batches:
            x = integers(batch.column("v"), dims).astype(np.float64)
            total, square, n = total + x.sum(axis=0), square + (x * x).sum(axis=0), n + len(x)
            marked += int((batch.column("id").to_numpy() % ANCHOR_STEP == 0).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(total), pa.array(square), pa.array(np.full(dims, n)), pa.array(np.full(dims, marked))],
                                         names=["dim", "total", "square", "n", "marked"])

    return run


def placed(dims: int, axes: list[int], low: list[float], step: list[float]):
    """Rows with their place on the curve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column("v"), dims)
            cells = np.clip((x[:, axes] - np.array(low)) / np.array(step), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hilbert(cells, CURVE_BITS)), batch.column("id"), batch.column("label"), pa.array([_packed(v) for v in x], pa.binary())],
                                             names=["place", "id", "label", "vector"])

    return run


def blocks(dims: int, deals: int):
    """Ordered rows as blocks with zone maps; the block number rises along the curve."""
    def pack(part: int, n: int, ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        x = _rows(b"".join(vectors), dims)
        one = [[(part << 31) + n], [((part << 31) + n) * 0x9E3779B1 % 0x7FFFFFFF % deals], [_packed(x.min(axis=0))], [_packed(x.max(axis=0))],
               [_packed(np.array(ids), "<i8")], [_packed(np.array(labels), "<i8")], [b"".join(vectors)]]
        kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(one, kinds)], names=[c.split()[0] for c in BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], []]
        n, part = 0, 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for have, name in zip(held, ("id", "label", "vector")):
                have.extend(batch.column(name).to_pylist())
            while len(held[0]) >= BLOCK_ROWS:
                yield pack(part, n, *(have[:BLOCK_ROWS] for have in held))
                held, n = [have[BLOCK_ROWS:] for have in held], n + 1
        if held[0]:
            yield pack(part, n, *held)

    return run


def best(slot: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each slot: highest score, then least id."""
    order = np.lexsort((ids, -score, slot))
    s = slot[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if s.size else np.zeros(0, np.int64)
    rank = np.arange(s.size) - np.repeat(first, np.diff(np.append(first, s.size)))
    return order[rank < n]


def own_block(dims: int, positives: int):
    """Anchors with the score that their own block's rows already offer for the last positive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, x = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), _rows(row["vectors"], dims)
                at = np.flatnonzero(ids % ANCHOR_STEP == 0)
                if not at.size:
                    continue
                found = np.where((labels[at, None] == labels[None, :]) & (ids[at, None] != ids[None, :]), scores(x[at], x), NONE)
                least = np.sort(found, axis=1)[:, -positives] if found.shape[1] >= positives else np.full(at.size, NONE)
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * at.size, pa.int64()), pa.array(ids[at]), pa.array(labels[at]), pa.array([_packed(v) for v in x[at]], pa.binary()), pa.array(least)],
                                                 names=["block", "id", "label", "vector", "least"])

    return run


class Wanted:
    """Anchors of a group as arrays.  A slot is an anchor (for positives) or a window of an anchor (for negatives)."""

    def __init__(self, table: pa.Table, dims: int, windows: bool):
        self.ids, self.labels = table["id"].to_numpy(), table["label"].to_numpy()
        self.x = _rows(b"".join(table["vector"].to_pylist()), dims)
        self.windows = windows
        if windows:
            lists = table["positives"].to_pylist()
            self.anchor = np.repeat(np.arange(len(lists)), [len(p) for p in lists])
            self.positive = np.array([p["positive"] for ps in lists for p in ps], np.int64)
            self.score = np.array([p["score"] for ps in lists for p in ps], np.int64)
            self.low, self.high = -(-LEAST_SHARE * self.score // 100), MOST_SHARE * self.score // 100
        else:
            self.anchor = np.arange(self.ids.size)
            self.low, self.high = table["least"].to_numpy().astype(np.int64), np.full(self.ids.size, -NONE)

    def asks(self, lo: np.ndarray, hi: np.ndarray, labels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Slots (rows) that must read the blocks (columns), and the upper bounds."""
        least, most = bounds(self.x, lo, hi)
        fits = [(self.labels != b[0]) | (b.size > 1) if self.windows else np.isin(self.labels, b) for b in labels]
        right = np.array(fits, bool).reshape(len(labels), self.labels.size).T
        least, most, right = least[self.anchor], most[self.anchor], right[self.anchor]
        return right & (most >= self.low[:, None]) & (least <= self.high[:, None]) & (self.low <= self.high)[:, None], most

    def read(self, table: pa.Table, dims: int, n: int) -> pa.Table:
        """The first ``n`` rows of each slot in the given blocks."""
        rows = table.to_pylist()
        ids, labels = [np.frombuffer(r["ids"], "<i8") for r in rows], [np.frombuffer(r["labels"], "<i8") for r in rows]
        ask, most = self.asks(_rows(b"".join(r["lo"] for r in rows), dims), _rows(b"".join(r["hi"] for r in rows), dims), [np.unique(b) for b in labels])
        floor = self.low.copy()
        slot, score, other = (np.zeros(0, np.int64) for _ in range(3))
        for b in np.argsort(-most.max(axis=0, initial=NONE), kind="stable"):
            slots = np.flatnonzero(ask[:, b] & (most[:, b] >= floor))
            if not slots.size:
                continue
            anchors, at = np.unique(self.anchor[slots], return_inverse=True)
            s = scores(self.x[anchors], _rows(rows[b]["vectors"], dims))[at]
            same = self.labels[self.anchor[slots], None] == labels[b][None, :]
            fits = (~same if self.windows else same & (self.ids[self.anchor[slots], None] != ids[b][None, :])) & (s >= floor[slots, None]) & (s <= self.high[slots, None])
            i, j = np.nonzero(fits)
            if not i.size:
                continue
            slot, score, other = np.concatenate([slot, slots[i]]), np.concatenate([score, s[i, j]]), np.concatenate([other, ids[b][j]])
            keep = best(slot, score, other, n)
            slot, score, other = slot[keep], score[keep], other[keep]
            last = np.flatnonzero(np.append(slot[1:] != slot[:-1], True))
            full = last[np.diff(np.append(-1, last)) == n]
            floor[slot[full]] = score[full]
        out = {"id": self.ids[self.anchor[slot]]}
        if self.windows:
            out |= {"positive": self.positive[slot], "positive_score": self.score[slot]}
        return pa.table(out | {"other": other, "score": score})


def _ask(dims: int, windows: bool):
    def run(anchors: pa.Table, zones: pa.Table) -> pa.Table:
        out = pa.table({"grp": pa.array([], pa.int64()), "block": pa.array([], pa.int64())})
        if not anchors.num_rows or not zones.num_rows:
            return out
        wanted = Wanted(anchors, dims, windows)
        ask, _ = wanted.asks(_rows(b"".join(zones["lo"].to_pylist()), dims), _rows(b"".join(zones["hi"].to_pylist()), dims), [np.unique(np.frombuffer(b, "<i8")) for b in zones["labels"].to_pylist()])
        block = zones["block"].to_numpy()[ask.any(axis=0)]
        return pa.table({"grp": pa.array([anchors["grp"][0].as_py()] * block.size, pa.int64()), "block": pa.array(block, pa.int64())})

    return run


def _read(dims: int, windows: bool, n: int):
    def run(anchors: pa.Table, found: pa.Table) -> pa.Table:
        return Wanted(anchors, dims, windows).read(found, dims, n)

    return run


def _first(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "other"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= n)


def _search(anchors: DataFrame, table: DataFrame, dims: int, deals: int, groups: int, windows: bool, n: int) -> DataFrame:
    """The first ``n`` rows of each slot: ask the zone maps which blocks to read, then read them."""
    dealt = anchors.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
    all_groups = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    zones = table.select("block", "deal", "lo", "hi", "labels").withColumn("grp", all_groups)
    asked = dealt.groupBy("grp", "deal").cogroup(zones.groupBy("grp", "deal")).applyInArrow(_ask(dims, windows), "grp long, block long")
    to_read = asked.join(table, "block")
    shape = "id long, positive long, positive_score long, other long, score long" if windows else "id long, other long, score long"
    found = dealt.groupBy("grp", "deal").cogroup(to_read.groupBy("grp", "deal")).applyInArrow(_read(dims, windows, n), shape)
    return _first(found, ["id", "positive", "positive_score"] if windows else ["id"], n)


def noisy_label(key: Column, label: Column) -> Column:
    """Every seventh label is wrong on purpose: the next one."""
    return F.when(key % NOISY_STEP == 0, F.try_add(label, F.lit(1)) % LABELS).otherwise(label)


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the first negatives of each anchor and positive."""
    spark = rows.sparkSession
    k, tag, v = (F.col(f"`{c}`") for c in (key, label, vector))
    fine = rows.where(k.isNotNull() & tag.isNotNull() & usable(v)).select(k.cast("long").alias("id"), noisy_label(k, tag.cast("long")).alias("label"), v.cast("array<double>").alias("v")).where("label is not null")
    fine = fine.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    out = "id long, positive long, positive_score long, rank int, other long, score long"
    least = fine.agg(F.min_by(F.size("v"), "id")).first()[0]
    found = spark.createDataFrame([], out)
    if least:
        fine = fine.where(F.size("v") == least)
        found = _mined(fine, least, positives, negatives)
    return found.select(F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _mined(fine: DataFrame, dims: int, positives: int, negatives: int) -> DataFrame:
    sums = fine.select("id", "v").mapInArrow(spread(dims), "dim long, total double, square double, n long, marked long").groupBy("dim").agg(*(F.sum(c).alias(c) for c in ("total", "square", "n", "marked"))).collect()
    n, marked = sums[0]["n"], sums[0]["marked"]
    spread_of = {r["dim"]: max(r["square"] / n - (r["total"] / n) ** 2, 0.0) ** 0.5 for r in sums}  # a number per dimension
    axes = sorted(spread_of, key=lambda d: (-spread_of[d], d))[:CURVE_DIMS]
    mean = {r["dim"]: r["total"] / n for r in sums}
    low = [mean[d] - 3 * spread_of[d] for d in axes]
    step = [max(6 * spread_of[d] / (1 << CURVE_BITS), 1e-9) for d in axes]

    deals, groups = -(-n // (BLOCK_ROWS * BLOCKS_PER_DEAL)), max(-(-marked // ANCHORS_PER_GROUP), 1)
    parts = max(-(-n // ROWS_PER_PARTITION), 2)
    ordered = fine.mapInArrow(placed(dims, axes, low, step), "place long, id long, label long, vector binary").repartitionByRange(parts, "place", "id").sortWithinPartitions("place", "id")
    table = written(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(blocks(dims, deals), BLOCK), "negative-blocks")
    homes = table.mapInArrow(own_block(dims, positives), ANCHOR)
    anchors = written(homes.repartitionByRange(groups, "block", "id").withColumn("grp", F.spark_partition_id().cast("long") % groups), "negative-anchors")

    friends = _search(anchors, table, dims, deals, groups, False, positives).groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.col("other").alias("positive"), "score"))).alias("positives"))
    return _search(anchors.join(friends, "id"), table, dims, deals, groups, True, negatives)

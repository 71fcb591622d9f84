"""Hard negatives: exact integer scores by Strassen's multiplication of tiles, kept in mergeable heaps.

Rows (id, label, vector of integers) are dealt by label and packed into tiles of up to ``TILE`` rows.
Anchors, the query set, get tiles of their own. A cell is one anchor tile with a run of ``RUN``
candidate tiles; the scores of two tiles are one matrix product on 64-bit integers by Strassen's
seven products, on sides padded with zeros. Two passes go over cells:

* positives, for cells that share a label: the best rows of the anchor's own label;
* windows, for all cells: for each positive, the best rows of other labels whose score lies in the
  window that the positive's score sets.

A cell returns its heaps, at most a few entries per anchor, and heaps of several cells are merged by
Spark. A frequent label fills many tiles, so no task holds it whole, and every cell is of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import stage, trimmed

#: Rows and numbers of a tile at most, and candidate tiles in a cell.
TILE, TILE_NUMBERS, RUN = 512, 1 << 18, 16
#: Sides at or under this are multiplied plainly.
LEAF = 32
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_TILE = "pid int, seq long, labels array<long>, n int, width int, label binary, id binary, unknown binary, row binary, vector binary"


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component, as long; limits of a long where it is beyond them."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * 256))


def whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` on int64 by Strassen's recursion; sums wrap at 64 bits, so what fits is exact."""
    m, k = a.shape
    n = b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return product(a, b)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = product(a11 + a22, b11 + b22)
    p2 = product(a21 + a22, b11)
    p3 = product(a11, b12 - b22)
    p4 = product(a22, b21 - b11)
    p5 = product(a11 + a12, b22)
    p6 = product(a21 - a11, b11 + b12)
    p7 = product(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """For each slot its ``keep`` best entries: higher score, then known ids, then smaller id."""

    def __init__(self, slots: int, keep: int):
        self._keep = keep
        #: The score an entry of the slot needs at least.
        self.floor = np.full(slots, _LEAST)
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.unknown = np.zeros(0, bool)

    def push(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray, unknown: np.ndarray) -> None:
        enough = score >= self.floor[slot]
        if not enough.any():
            return
        slot = np.concatenate([self.slot, slot[enough]])
        score = np.concatenate([self.score, score[enough]])
        id_ = np.concatenate([self.id, id_[enough]])
        unknown = np.concatenate([self.unknown, unknown[enough]])
        order = np.lexsort((id_, unknown, ~score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order = order[place < self._keep]
        self.slot, self.score, self.id, self.unknown = slot[place < self._keep], score[order], id_[order], unknown[order]
        last = place[place < self._keep] == self._keep - 1
        self.floor[self.slot[last]] = self.score[last]


class _Tile:
    def __init__(self, row: dict):
        self.labels, self.n, self.width = row["labels"], row["n"], row["width"]
        self.label, self.id, self.row = (np.frombuffer(row[c], np.int64) for c in ("label", "id", "row"))
        self.unknown = np.frombuffer(row["unknown"], bool)
        self.vector = np.frombuffer(row["vector"], np.int64).reshape(self.n, self.width)

    def scores(self, other: _Tile) -> np.ndarray:
        width = max(self.width, other.width)
        a, b = (np.pad(t.vector, ((0, 0), (0, width - t.width))) for t in (self, other))
        return product(a, b.T)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pid, seq, names = TaskContext.get().partitionId(), 0, ["label", "id", "row", "vector"]
    waiting: list[tuple] = []
    longest = 0

    def tile() -> pa.RecordBatch:
        vectors = np.zeros((len(waiting), longest), np.int64)
        for k, (_, _, _, v) in enumerate(waiting):
            vectors[k, : len(v)] = v
        label = np.array([w[0] for w in waiting], np.int64)
        unknown = np.array([w[1] is None for w in waiting])
        packed = [
            [label.tobytes()], [np.array([w[1] or 0 for w in waiting], np.int64).tobytes()], [unknown.tobytes()],
            [np.array([w[2] for w in waiting], np.int64).tobytes()], [vectors.tobytes()],
        ]
        head = [pa.array([pid], pa.int32()), pa.array([seq]), pa.array([np.unique(label).tolist()], pa.list_(pa.int64()))]
        head += [pa.array([len(waiting)], pa.int32()), pa.array([longest], pa.int32())]
        columns = head + [pa.array(p, pa.binary()) for p in packed]
        return pa.RecordBatch.from_arrays(columns, ["pid", "seq", "labels", "n", "width", "label", "id", "unknown", "row", "vector"])

    for batch in batches:
        lists = batch.column("vector")
        numbers, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *lists.value_lengths().to_pylist()])
        vectors = [numbers[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for label, id_, row, vector in zip(*(batch.column(c).to_pylist() for c in names[:3]), vectors, strict=True):
            wide = max(longest, len(vector))
            if waiting and (len(waiting) >= TILE or (len(waiting) + 1) * wide > TILE_NUMBERS):
                yield tile()
                seq += 1
                waiting.clear()
                wide = len(vector)
            waiting.append((label, id_, row, vector))
            longest = wide
    if waiting:
        yield tile()


def _tiles(rows: DataFrame, written) -> DataFrame:
    """``rows`` packed into tiles, numbered 0, 1, … in column ``tile``."""
    packed = written.write(rows.mapInArrow(trimmed(_pack), _TILE))
    # One row for each partition that made tiles, so the window is over a short list.
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = packed.groupBy("pid").agg(F.count(F.lit(1)).alias("tiles"))
    starts = counts.select("pid", F.coalesce(F.sum("tiles").over(before), F.lit(0)).alias("start"))
    starts = written.write(starts)
    return packed.join(F.broadcast(starts), "pid").withColumn("tile", F.col("start") + F.col("seq")).drop("pid", "seq", "start")


def _positives(keep: int):
    def run(key: tuple, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        for row in anchors.to_pylist():
            a = _Tile(row)
            heaps = Heaps(a.n, keep)
            for other in candidates.to_pylist():
                if not set(a.labels) & set(other["labels"]):
                    continue
                c = _Tile(other)
                s = a.scores(c)
                fits = (a.label[:, None] == c.label) & (a.row[:, None] != c.row) & (s >= heaps.floor[:, None])
                i, j = np.nonzero(fits)
                heaps.push(i, s[i, j], c.id[j], c.unknown[j])
            found.append(_entries(row["tile"], a, heaps.slot, heaps, {}))
        return pa.concat_tables(found)

    return run


def _negatives(keep: int, low: int, high: int):
    def run(key: tuple, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        for row in anchors.to_pylist():
            a = _Tile(row)
            windows = row["windows"]
            at = np.array([w["pos"] for w in windows], np.int64)
            # Whole numbers of any length; the bounds themselves lie within the scores' range.
            least = np.array([-(-low * w["score"] // 100) for w in windows], np.int64)
            most = np.array([high * w["score"] // 100 for w in windows], np.int64)
            lowest, highest = np.full(a.n, _MOST), np.full(a.n, _LEAST)
            np.minimum.at(lowest, at, least)
            np.maximum.at(highest, at, most)
            # The windows of an anchor, by its rank.
            by_rank: dict[int, list[int]] = {}
            for k, w in enumerate(windows):
                by_rank.setdefault(w["rank"], []).append(k)
            heaps = Heaps(len(windows), keep)
            for other in candidates.to_pylist():
                c = _Tile(other)
                if len(set(a.labels) | set(c.labels)) == 1:
                    continue
                s = a.scores(c)
                i, j = np.nonzero((s >= lowest[:, None]) & (s <= highest[:, None]) & (a.label[:, None] != c.label))
                score = s[i, j]
                for ks in by_rank.values():
                    slot_of = np.full(a.n, -1)
                    slot_of[at[ks]] = ks
                    slot = slot_of[i]
                    ok = slot >= 0
                    ok[ok] = (score[ok] >= least[slot[ok]]) & (score[ok] <= most[slot[ok]])
                    heaps.push(slot[ok], score[ok], c.id[j[ok]], c.unknown[j[ok]])
            w = [windows[k] for k in heaps.slot.tolist()]
            own = {name: [x[name] for x in w] for name in ("rank", "positive_id")} | {"positive_score": [x["score"] for x in w]}
            found.append(_entries(row["tile"], a, at[heaps.slot], heaps, own))
        return pa.concat_tables(found)

    return run


_ENTRY = "tile long, pos int, anchor_id long, id long, score long"
_WINDOW = "rank int, positive_id long, positive_score long"


def _entries(tile: int, a: _Tile, pos: np.ndarray, heaps: Heaps, own: dict[str, list]) -> pa.Table:
    columns = {
        "tile": pa.array(np.full(len(pos), tile), pa.int64()),
        "pos": pa.array(pos, pa.int32()),
        "anchor_id": pa.array(a.id[pos]),
        "id": pa.array(heaps.id, mask=heaps.unknown),
        "score": pa.array(heaps.score),
    }
    kinds = {"rank": pa.int32()}
    return pa.table(columns | {name: pa.array(values, kinds.get(name, pa.int64())) for name, values in own.items()})


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _best(entries: DataFrame, slot: list[str], keep: int, name: str) -> DataFrame:
    """The heaps of all cells merged: the ``keep`` best entries of each slot, with their place from 1."""
    order = Window.partitionBy(*slot).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return entries.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= keep)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``id`` (long), ``label`` (long) and ``vector`` (array<long>); ``is_anchor`` picks the
    query set by columns of ``rows``. Of each anchor the first ``positives`` other rows of its label
    are taken, and for each of these the first ``negatives`` rows of other labels whose score is from
    ``low`` to ``high`` percent of the positive's.

    Scores are inner products of integers: exact as far as they fit in a long, wrapped at 64 bits
    beyond. Shorter vectors count as padded with zeros. Rows without label or vector take no part;
    rows without id are never anchors and come after equal scores with an id. Repeated rows are rows
    of their own, also as anchors. Empty tables, and tables without anchors, give no rows.
    """
    written = stage(rows.sparkSession)
    known = rows.filter("label is not null and vector is not null")
    known = known.select("id", "label", "vector", (is_anchor & F.col("id").isNotNull()).alias("anchor"))
    # The row number splits a label, also one of rows without ids.
    numbered = known.withColumn("row", F.monotonically_increasing_id())
    dealt = written.write(numbered.repartitionByRange("label", "id", "row").sortWithinPartitions("label", "id", "row"))
    dealt_anchors = written.write(dealt.filter("anchor").repartitionByRange("label", "row").sortWithinPartitions("label", "row"))
    columns = ["label", "id", "row", "vector"]
    candidates = _tiles(dealt.select(*columns), written).withColumn("run", F.floor(F.col("tile") / RUN))
    anchors = _tiles(dealt_anchors.select(*columns), written)
    n_anchors, n_runs = anchors.count(), -(-candidates.count() // RUN)
    if not n_anchors:
        return rows.sparkSession.createDataFrame([], f"anchor_id long, {_WINDOW}, negative_id long, negative_score long").select(*_OUT)

    # Cells of a common label; a frequent label makes as many cells as there is work for.
    shared = candidates.select("run", F.explode("labels").alias("label")).distinct()
    cells = anchors.select("tile", F.explode("labels").alias("label")).join(shared, "label").select("tile", "run").distinct()
    cells = written.write(cells)
    left = anchors.join(cells, "tile")
    right = candidates.join(cells.withColumnRenamed("tile", "anchor_tile"), "run")
    entries = (
        left.groupBy("tile", "run").cogroup(right.groupBy("anchor_tile", "run")).applyInArrow(_positives(positives), _ENTRY)
    )
    first = written.write(_best(entries, ["tile", "pos"], positives, "rank"))

    # At most ``positives`` entries for each row of a tile.
    entry = F.struct("pos", "rank", "score", F.col("id").alias("positive_id"))
    windows = first.groupBy("tile").agg(F.collect_list(entry).alias("windows"))
    left = anchors.join(windows, "tile").withColumn("run", F.explode(F.sequence(_long(0), _long(n_runs - 1))))
    right = candidates.withColumn("anchor_tile", F.explode(F.sequence(_long(0), _long(n_anchors - 1))))
    right = right.join(windows.select(F.col("tile").alias("anchor_tile")), "anchor_tile", "left_semi")
    entries = (
        left.groupBy("tile", "run").cogroup(right.groupBy("anchor_tile", "run"))
        .applyInArrow(_negatives(negatives, low, high), f"{_ENTRY}, {_WINDOW}")
    )
    found = _best(entries.withColumnRenamed("rank", "place"), ["tile", "pos", "place"], negatives, "rank")
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


_OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """``mine`` on ``embeddings`` (vec_id, embedding, label), anchors at every 50th id.

    Rows with a null label, a null vector or a component that is null or not finite take no part.
    Where the id is divisible by 7 the label is the next one modulo 10.
    """
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    good = embeddings.filter(F.col("label").isNotNull() & whole(F.col("embedding")))
    rows = good.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), quantised(F.col("embedding")).alias("vector"))
    return mine(rows, F.col("id") % 50 == 0)

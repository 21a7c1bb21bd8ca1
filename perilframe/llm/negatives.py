"""Hard-negative mining with bounds along a spanning tree of the anchors.

Components are quantised to floor(256 * x); a row's score for an anchor is their integer inner product. Anchors are taken in
waves of about WAVE, and a wave's in blocks of at most BLOCK, whose minimum spanning tree (by the distance of the quantised
vectors) is walked from its root for every batch of candidates. By Cauchy and Schwarz a candidate's score for a child differs from that
for its parent by at most the edge's length times the candidate's norm. So each candidate has an interval of possible scores,
exact at the root and wherever it was scored; only candidates whose interval overlaps the window that is wanted are scored again.

1. Positives: of the rows of the anchor's label, the window is from the score of the worst of the best so far upwards.
2. Negatives: of the rows of other labels, the windows are those of the anchor's positives: NUM_LOW * p <= 100 * s <= NUM_HIGH * p,
   without what lies below the worst of a full list.

Both are searches of a stated query set, the anchors, against all rows. A task keeps the best of each list; the lists of
all tasks are merged in two steps. A pass over a share of the rows (one of SHARE, by hash) comes before each whole pass: what is
worse than the best of the share can't be among the best of all, so the lists that tasks hand on don't grow with
their number. A wave's anchors, positives and thresholds are what is broadcast: their number is bounded by WAVE.

Rows with a null vec_id, label or vector, or with a null or non-finite component take no part; a vector shorter than others counts as
filled up with zeros. Other rows are those of another vec_id; rows of one vec_id with equal scores count once. Anchors that
are equal in all columns are one. Fewer rows than wanted give fewer; an empty table none. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.llm.common import mapped, written

EVERY, POSITIVES, NEGATIVES, NUM_LOW, NUM_HIGH = 100, 5, 10, 30, 90
WAVE, BLOCK, ROWS, SHARE, SALTS = 4096, 1024, 4096, 64, 64
_EXACT = 2.0**52


def relabelled(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vec) with the labels of every seventh vec_id moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")


def quantised(ids: np.ndarray, labels: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, matrix of floor(256 * x)) of the rows whose components are all finite; null components come as NaN."""
    sizes = np.diff(ends)
    width, row = int(sizes.max(initial=0)), np.repeat(np.arange(len(ids)), sizes)
    with np.errstate(over="ignore"):
        q = np.floor(256.0 * flat)
    fine = np.ones(len(ids), bool)
    fine[row[~np.isfinite(flat)]] = False
    out = np.zeros((len(ids), width))
    out[row, np.arange(len(flat)) - np.repeat(ends[:-1], sizes)] = q
    return ids[fine], labels[fine], out[fine]


def _of_batch(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vec = b.column(2)
    ends = vec.offsets.to_numpy().astype(np.int64)
    flat = vec.flatten().to_numpy(zero_copy_only=False).astype(float)
    return quantised(b.column(0).to_numpy(), b.column(1).to_numpy(), flat, ends - ends[0])


def products(q: np.ndarray, a: np.ndarray, most: float) -> np.ndarray:
    """Inner products of rows with a vector as whole numbers. ``most`` bounds their size; what a double can't hold is
    computed with Python's numbers, and a score beyond a long is the largest or least one."""
    width = min(q.shape[1], len(a))
    q, a = q[:, :width], a[:width]
    if most < _EXACT:
        return (q @ a).astype(np.int64)
    if not np.isfinite(q).all() or not np.isfinite(a).all():
        raise ValueError("a component is too large: 256 times it isn't finite")
    right, top = [int(x) for x in a], 2**63 - 1
    return np.array([max(-top - 1, min(top, sum(int(x) * y for x, y in zip(r, right)))) for r in q.tolist()], np.int64)


def spanning_tree(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): the minimum spanning tree of the rows, parents before children; the root has parent -1."""
    n = len(q)
    parent, edge, order = np.full(n, -1), np.full(n, np.inf), []
    left, at = np.ones(n, bool), 0
    for _ in range(n):
        left[at] = False
        order.append(at)
        away = np.sqrt(((q - q[at]) ** 2).sum(1))
        closer = left & (away < edge)
        edge[closer], parent[closer] = away[closer], at
        at = int(np.argmin(np.where(left, edge, np.inf)))
    edge[0] = 0.0
    return np.array(order, int), parent, edge


class Block:
    """Anchors with their tree; ``first`` is the number of the first one in its wave."""

    def __init__(self, first: int, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        self.first, self.ids, self.labels, self.q = first, ids, labels, q
        self.norms = np.sqrt((q**2).sum(1))
        self.order, self.parent, self.edge = spanning_tree(q)

    def scored(self, ids: np.ndarray, q: np.ndarray, wanted):
        """Yields (anchor, rows, scores) of the candidates that ``wanted(anchor, low, high)``, a mask, holds to be possible."""
        norms = np.sqrt((q**2).sum(1))
        low, high = np.empty((len(self.ids), len(ids))), np.empty((len(self.ids), len(ids)))
        largest = norms.max(initial=0)
        for a in self.order.tolist():
            p, most = self.parent[a], float(self.norms[a] * largest)
            if p < 0:
                low[a] = high[a] = products(q, self.q[a], most)
            else:
                slack = self.edge[a] * norms * (1 + 1e-9) + 1 + most * 1e-12
                low[a], high[a] = low[p] - slack, high[p] + slack
            rows = np.flatnonzero(wanted(a, low[a], high[a]) & (ids != self.ids[a]))
            if len(rows):
                s = products(q[rows], self.q[a], most)
                low[a, rows] = high[a, rows] = s
                yield a, rows, s


class Lists:
    """The ``k`` best (score, id) of each of a number of lists, highest score first, then least id; equal ones count once. ``floor`` is the
    score that an entry must reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor, self.parts = k, floor.copy(), []
        self.list = self.score = self.id = np.empty(0, np.int64)

    def add(self, number, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((np.full(len(ids), number, np.int64), score, ids))

    def trim(self) -> None:
        if not self.parts:
            return
        number, score, ids = (np.concatenate(x) for x in zip((self.list, self.score, self.id), *self.parts))
        self.parts = []
        keep = score >= self.floor[number]
        number, score, ids = number[keep], score[keep], ids[keep]
        order = np.lexsort((ids, -score, number))
        number, score, ids = number[order], score[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (number[1:] != number[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        number, score, ids = number[new], score[new], ids[new]
        first = np.searchsorted(number, np.arange(len(self.floor)))
        keep = np.arange(len(number)) - first[number] < self.k
        self.list, self.score, self.id = number[keep], score[keep], ids[keep]
        full = np.flatnonzero(np.bincount(self.list, minlength=len(self.floor)) == self.k)
        self.floor[full] = self.score[np.searchsorted(self.list, full, "right") - 1]


def _merged(rows: DataFrame, k: int) -> DataFrame:
    """(list, id, score, rank): the ``k`` best of each list out of those of all tasks."""
    rows, order = rows.withColumn("task", F.pmod(F.spark_partition_id(), F.lit(SALTS))), (F.desc("score"), F.asc("id"))
    for parts in (("list", "task"), ("list",)):
        place = Window.partitionBy(*parts).orderBy(*order)
        rows = rows.withColumn("rank", F.dense_rank().over(place)).where(F.col("rank") <= k)
        rows = rows.dropDuplicates([*parts, "score", "id"])
    return rows.select("list", "id", "score", "rank")


def _searched(rows: DataFrame, blocks, floors: np.ndarray, k: int, own_label: bool, windows=None) -> DataFrame:
    """The best of each list in every task. blocks: broadcast. Lists are the anchors of the wave with rows of their own label, or, with
    other labels, the windows (anchor, low, high) of a broadcast array, sorted by anchor."""

    def run(batches):
        lists = Lists(floors, k)
        for b in batches:
            ids, labels, q = _of_batch(b)
            for block in blocks.value:

                def wanted(a, low, high):
                    same = labels == block.labels[a]
                    if own_label:
                        return same & (high >= lists.floor[block.first + a])
                    mine = spans(block.first + a)
                    if mine[0] == mine[1]:
                        return np.zeros(len(ids), bool)
                    span = slice(*mine)
                    return ~same & (high >= np.maximum(windows.value[span, 1], lists.floor[span]).min()) & (low <= windows.value[span, 2].max())

                def spans(anchor):
                    return np.searchsorted(windows.value[:, 0], [anchor, anchor + 1])

                for a, at, s in block.scored(ids, q, wanted):
                    if own_label:
                        lists.add(block.first + a, s, ids[at])
                        continue
                    for n in range(*spans(block.first + a)):
                        fits = (s >= max(windows.value[n, 1], lists.floor[n])) & (s <= windows.value[n, 2])
                        if fits.any():
                            lists.add(n, s[fits], ids[at[fits]])
                lists.trim()
        yield pa.RecordBatch.from_arrays([pa.array(lists.list), pa.array(lists.id), pa.array(lists.score)], names=["list", "id", "score"])

    return mapped(rows, run, "list long, id long, score long", ROWS)


def _best(rows: DataFrame, lists: int, k: int, *args) -> DataFrame:
    """The best of all tasks: first of a share of the rows, whose worst entries are thresholds of the whole pass."""
    floors = np.full(lists, -(2**63), np.int64)
    share = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(SHARE)) == 0)
    seed = _merged(_searched(share, args[0], floors, k, *args[1:]), k).where(F.col("rank") == k)
    for r in seed.select("list", "score").collect():  # one row for a list of the wave at most
        floors[r[0]] = r[1]
    return _merged(_searched(rows, args[0], floors, k, *args[1:]), k)


def _wave(anchors: DataFrame) -> list[Block]:
    """Blocks of a wave's anchors, those of a label side by side."""
    held = anchors.orderBy("label", "vec_id").collect()
    sizes = [len(r[2]) for r in held]
    flat = np.array([np.nan if x is None else x for r in held for x in r[2]], float)
    ids, labels, q = quantised(np.array([r[0] for r in held], np.int64), np.array([r[1] for r in held], np.int64), flat, np.cumsum([0, *sizes]))
    return [Block(i, ids[i : i + BLOCK], labels[i : i + BLOCK], q[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]


def windows_of(positives: list[tuple[int, int, int, int]]) -> np.ndarray:
    """(anchor, low, high) rows: the scores s with NUM_LOW * p <= 100 * s <= NUM_HIGH * p for positives (anchor, id, score, rank)."""
    return np.array([(a, -(-NUM_LOW * p // 100), NUM_HIGH * p // 100) for a, _, p, _ in positives], np.int64).reshape(-1, 3)


def mined(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark, rows, found = embeddings.sparkSession, relabelled(embeddings), []
    anchors = rows.where(F.col("vec_id") % EVERY == 0).distinct()
    waves = -(-anchors.count() // WAVE)
    for wave in range(waves):
        blocks = _wave(anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave))
        if not blocks:
            continue
        sent, number = spark.sparkContext.broadcast(blocks), blocks[-1].first + len(blocks[-1].ids)
        best = _best(rows, number, POSITIVES, sent, True).collect()  # POSITIVES rows for an anchor of the wave at most
        best = sorted((r[0], r[1], r[2], r[3]) for r in best)
        windows = windows_of(best)
        names = np.concatenate([b.ids for b in blocks])
        lists = [(n, int(names[a]), i, p) for n, (a, i, p, _) in enumerate(best)]
        lists = spark.createDataFrame(lists, "list long, anchor_id long, positive_id long, positive_score long")
        rows_of = _best(rows, len(windows), NEGATIVES, sent, False, spark.sparkContext.broadcast(windows))
        out = rows_of.join(F.broadcast(lists), "list")  # as many lists as positives of the wave
        out = out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        found.append(written(out, "negatives"))
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, found) if found else empty


SQL = f"""WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {NUM_LOW} * positive_score <= 100 * score AND 100 * score <= {NUM_HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= {NEGATIVES}"""

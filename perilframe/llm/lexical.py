"""Ranked lexical search, reversed: the items are the index and the documents are streamed through it.

An inverted index over the items' terms is broadcast. Every document is cut into terms once; the counts of those that the
index holds are written to the shared folder, and document frequencies, the number of documents and their mean length come from
there. The counts are then streamed through the index: a task keeps a bounded heap of the best documents of each
item, and the heaps of all tasks are merged in two steps. The index covers a block of items: at most ITEMS of them and, if they
are more than one, at most ITEM_BYTES of text, which bounds what is broadcast; every block is a pass over all documents.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. N is the number of
documents with a term, L that of all their terms, n a document's, df the number of documents that hold a term, tf its
occurrences in the document:

    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))        m = 100 - 25 + (25 * n * N) div L
    score = sum over the item's terms, repeats included, of w * ((1000000000 * tf) div (1000 * tf + 12 * m))

Only scores above 0 count; equal scores stand in the order of doc_id, a null one first. Null texts have no terms. Every row of the
documents is a document, repeated ones too; equal rows (item_id, text) of the items are one item, rows of one item_id with
different texts are ranked apart. Items without terms, and tables without rows, give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.llm.common import mapped, slices, whole_text, written

BEST, ITEMS, ITEM_BYTES = 20, 2000, 4_000_000
PIECE, CELLS, SALTS = 4_000_000, 2_000_000, 64
_NO_ID = -(2**63)
#: Letters, digits and bytes of characters beyond ASCII stand, A-Z lower-cased; all others part terms.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, in order, as lists of at most about PIECE bytes, so that few are objects at a time."""
    data, start = (text or "").encode().translate(TABLE), 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class Index:
    """Inverted index of a block of items: for each term the items that hold it and how often."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids, self.terms, lists = [i for i, _ in items], {}, []
        for k, (_, text) in enumerate(items):
            for term, times in Counter(t for piece in terms(text) for t in piece).items():
                at = self.terms.setdefault(term, len(self.terms))
                if at == len(lists):
                    lists.append([])
                lists[at].append((k, times))
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.items = np.array([k for x in lists for k, _ in x], np.int64)
        self.times = np.array([n for x in lists for _, n in x], np.int64)

    def weights(self, df: dict[int, int], count: int) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(self.terms))], np.int64)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """Distinct (item_id, text) rows in blocks; the driver holds one block at a time."""
    block, held = [], 0
    for r in items.select(F.col("item_id").cast("long"), whole_text().alias("text")).distinct().toLocalIterator():
        if block and (len(block) == ITEMS or held + len(r[1]) > ITEM_BYTES):
            yield block
            block, held = [], 0
        block.append((r[0], r[1]))
        held += len(r[1])
    if block:
        yield block


def counted(docs: DataFrame, index) -> DataFrame:
    """(doc_id, n, term, tf): a document's number of terms, and the number in ``index`` (a broadcast one) and the occurrences of each
    term that the index holds. Documents without terms are left out."""

    def run(batches):
        find = index.value.terms.get
        for b in (s for batch in batches for s in slices(batch)):
            n, at, tf, ends, keep = [], [], [], [0], []
            for t in b.column(1):
                have, found = 0, Counter()
                for piece in terms(t.as_py()):
                    have += len(piece)
                    found.update(map(find, piece))
                keep.append(have > 0)
                if have:
                    found.pop(None, None)
                    n.append(have)
                    at.extend(found.keys())
                    tf.extend(found.values())
                    ends.append(len(at))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((at, pa.int32()), (tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep, pa.bool_())), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "term", "tf"])

    return mapped(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, "doc_id long, n long, term array<int>, tf array<long>")


class Heaps:
    """The ``k`` best documents of each of a number of items: highest score first, then least doc_id. ``floor`` is the score that a
    document must reach to enter."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))

    def push(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.floor)))
        order = order[np.arange(len(order)) - first[item[order]] < self.k]
        self.item, self.score, self.doc = item[order], score[order], doc[order]
        full = np.flatnonzero(np.bincount(self.item, minlength=len(self.floor)) == self.k)
        self.floor[full] = self.score[np.searchsorted(self.item, full, "right") - 1]


def scores(index: Index, w: np.ndarray, m: np.ndarray, lengths: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """(documents, items) scores; lengths: of each document's part of ``term`` and ``tf``; m: the documents'."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    part = w[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
    size = index.sizes[term]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - index.starts[term], size)
    out = np.zeros((len(lengths), len(index.ids)), np.int64)
    np.add.at(out.reshape(-1), np.repeat(row, size) * len(index.ids) + index.items[at], np.repeat(part, size) * index.times[at])
    return out


def _batches(index: Index, lengths: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most CELLS scores and additions each, or one document alone."""
    ends = np.cumsum(lengths)
    work = np.concatenate([[0], np.cumsum(index.sizes[term])])[ends] + len(index.ids) * np.arange(1, len(lengths) + 1)
    start = 0
    while start < len(lengths):
        end = max(start + 1, int(np.searchsorted(work, (work[start - 1] if start else 0) + CELLS, "right")))
        yield start, end
        start = end


def best_of_tasks(counts: DataFrame, index, weights, total: int, all_terms: int, k: int) -> DataFrame:
    """(item, item_id, doc_id, score, task): the heaps of all tasks. index, weights: broadcast; counts: as from ``counted``."""

    def run(batches):
        own, w = index.value, weights.value
        heaps = Heaps(len(own.ids), k)
        for b in batches:
            doc, n = b.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            ends = b.column(2).offsets.to_numpy().astype(np.int64)
            term, tf = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
            ends, m = ends - ends[0], 75 + 25 * n * total // all_terms
            for i, j in _batches(own, np.diff(ends), term):
                got = scores(own, w, m[i:j], np.diff(ends[i : j + 1]), term[ends[i] : ends[j]], tf[ends[i] : ends[j]])
                row, item = np.nonzero(got >= heaps.floor)
                heaps.push(item, got[row, item], doc[i:j][row])
        ids = [own.ids[i] for i in heaps.item.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(heaps.item), pa.array(ids, pa.int64()), pa.array(heaps.doc), pa.array(heaps.score)], names=["item", "item_id", "doc_id", "score"])

    return mapped(counts, run, "item long, item_id long, doc_id long, score long").withColumn("task", F.spark_partition_id())


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of the highest scores for each item."""
    spark, found = docs.sparkSession, []
    for block in item_blocks(items):
        index = spark.sparkContext.broadcast(Index(block))
        counts = written(counted(docs, index), "term-counts")
        total, all_terms = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not total:
            continue
        df = dict(counts.select(F.explode("term").alias("term")).groupBy("term").count().collect())  # one row for a term of the block
        weights = spark.sparkContext.broadcast(index.value.weights(df, total))
        order = (F.desc("score"), F.asc("doc_id"))
        rows = best_of_tasks(counts, index, weights, total, all_terms, k)
        for parts in (("item", F.pmod("task", F.lit(SALTS))), ("item",)):
            rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*parts).orderBy(*order))).where(F.col("rank") <= k)
        found.append(written(rows.select("item_id", "rank", F.nullif("doc_id", F.lit(_NO_ID)).alias("doc_id"), "score"), "ranked"))
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found) if found else empty


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents), i AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL), n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
    FROM i JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), total GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {BEST}"""

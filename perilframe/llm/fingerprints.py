"""Document fingerprints: one-permutation MinHash.

Each word shingle is hashed once; the hash's low part picks a bin, its high part is the value, and a bin keeps its least
value. Empty bins are filled by optimal densification: bin i walks its own fixed pseudo-random order of the bins to the
first one that isn't empty and copies it, so a fill depends on the set of filled bins only. Of each bin the low bits are
stored, packed; the likeness of two fingerprints corrects for the chance that low bits agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.llm.common import mapped, pieces, whole_text, written

WORDS, BINS, BITS = 5, 256, 4
_EMPTY = np.uint64(2**64 - 1)
_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers (wrap-around arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _walks() -> np.ndarray:
    """For each bin the order in which it looks for a filled one."""
    keys = _mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(1)).reshape(BINS, BINS)
    return np.argsort(keys, axis=1, kind="stable")


WALKS = _walks()
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        inverse = pow(int(_PRIME), -1, 2**64)
        for k, base in enumerate((int(_PRIME), inverse)):
            x = np.full(2 * n, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0][:n], _POWERS[1][:n]


def shingle_hashes(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of all texts, and the index of each one's text.

    Words are split at space and 9 to 13. A text with fewer words has one shingle, all its words; one without, none.
    """
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], space]).view(np.int8))
    start, end = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    power, inverse = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)])
    word = _mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), start, side="right")
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    shingles = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    of = np.repeat(np.arange(len(texts)), shingles)
    at = np.arange(len(of)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first[of]
    left = np.minimum(count[of], words)
    h = np.zeros(len(of), np.uint64)
    for k in range(words):  # order matters: each step mixes
        there = k < left
        h = np.where(there, _mix(h * _PRIME + word[np.minimum(at + k, len(word) - 1)]), h)
    return h, of


def fingerprints(texts: list[str], words: int = WORDS) -> np.ndarray:
    """Packed fingerprints, one row of BINS * BITS / 8 bytes for each text. A text without words has zeros only."""
    h, of = shingle_hashes(texts, words)
    least = np.full(len(texts) * BINS, _EMPTY, np.uint64)
    np.minimum.at(least, of * BINS + (h & np.uint64(BINS - 1)).astype(np.int64), h >> np.uint64(8))
    least = least.reshape(-1, BINS)
    filled = least != _EMPTY
    some = filled.any(1)
    row, col = np.nonzero(~filled & some[:, None])
    for step in range(BINS):
        if not len(row):
            break
        seek = WALKS[col, step]
        ok = filled[row, seek]
        least[row[ok], col[ok]] = least[row[ok], seek[ok]]
        row, col = row[~ok], col[~ok]
    low = (_mix(least) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    low[~some] = 0
    return low[:, ::2] << 4 | low[:, 1::2]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness (0 to 1) of rows of packed fingerprints, corrected for chance agreement of low bits.

    Two texts without words have likeness 1; one with and one without words have 0.
    """
    same = ((a ^ b) & 15 == 0).sum(1) + ((a ^ b) >> 4 == 0).sum(1)
    chance = 1 / (1 << BITS)
    raw = np.clip((same / BINS - chance) / (1 - chance), 0, 1)
    return np.where(a.any(1) == b.any(1), raw, 0.0)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ENDS = SCHEMA + ", text string, place string"


def _described(ids: list, texts: list[str], following: list[str], keep: bool = True) -> list:
    """Columns of SCHEMA for texts and the text that follows each."""
    edited = [t[: len(t) - len(t) // 4] + f[: len(t) // 4] for t, f in zip(texts, following)]
    own, new, nxt = fingerprints(texts), fingerprints(edited), fingerprints(following[-1:])
    after = np.concatenate([own[1:], nxt]) if keep else fingerprints(following)
    return [ids, [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited], [x.tobytes().hex() for x in own], [x.tobytes().hex() for x in new], likeness(own, new).tolist(), likeness(own, after).tolist()]


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _rows(columns: list, texts: list, places: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, _KINDS)), pa.array(texts, pa.string()), pa.array(places, pa.string())], names=[*NAMES, "text", "place"])


def _within(batches):
    """Describes sorted rows by the row after each; a partition's last row waits, and its first row is told for the one before."""
    held = None
    first = True
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        if not ids:
            continue
        if first:
            yield _rows([[ids[0]], *([None] for _ in range(6))], [texts[0]], ["first"])
            first = False
        if held:
            ids, texts = [held[0], *ids], [held[1], *texts]
        for x, y in pieces(texts[:-1], 1_000_000):
            yield _rows(_described(ids[x:y], texts[x:y], texts[x + 1 : y + 1]), [None] * (y - x), ["inside"] * (y - x))
        held = (ids[-1], texts[-1])
    if held:
        yield _rows([[held[0]], *([None] for _ in range(6))], [held[1]], ["last"])


def _across(batches):
    for b in batches:
        ids, texts, following = (c.to_pylist() for c in b.columns)
        if ids:
            columns = _described(ids, texts, following, keep=False)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=NAMES)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited form (columns as in ``SCHEMA``).

    The edited form's last quarter of code points comes from the start of the next document by doc_id (then by text;
    after the last: the first). A null text counts as empty; a null doc_id comes before all others. Repeated rows follow
    one another. One range shuffle of the texts sorts them; rows at a partition's end meet the next partition's first row
    in a join of at most two rows a partition.
    """
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    table = written(mapped(ordered, _within, _ENDS), "op3")
    inside = table.where("place = 'inside'").select(*NAMES)
    return inside.union(_described_ends(table.where("place <> 'inside'")))


def _described_ends(ends: DataFrame) -> DataFrame:
    """Describes the last row of each partition by the first row of the next partition that has rows.

    Partitions are ranges of doc_id, so in the order of ids each partition's first row and last row are followed by the next
    one's; that order is a window over two numbers a partition, no text.
    """
    key = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    order = Window.orderBy("_key", "place")  # ids of two rows a partition; "first" comes before "last"
    ids = ends.select(key.alias("_key"), "place").withColumn("_next", F.coalesce(F.lead("_key").over(order), F.min("_key").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    ids = ids.where("place = 'last'").select("_key", "_next")
    last = ends.where("place = 'last'").select(key.alias("_key"), "doc_id", "text").join(ids, "_key")
    first = ends.where("place = 'first'").select(key.alias("_next"), F.col("text").alias("following"))
    return mapped(last.join(first, "_next").select("doc_id", "text", "following"), _across, SCHEMA)

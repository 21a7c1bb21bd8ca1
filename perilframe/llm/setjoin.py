"""Join of documents by the Jaccard similarity of their shingle sets: partitions of the universe and the pigeonhole.

Sets of similarity num / den have sizes s <= n <= s * den / num, and differ in at most H = floor((s + n) * (den - num) / (den + num))
shingles. Sizes are cut into bands, a factor of 4/3 each; a pair belongs to the band of its smaller set, and H is the band's
largest. In a band a hash deals all shingles to ``m`` segments, and each segment of a set, a subset of it, is one key. A segment gets
``units``: 0 is not indexed, 1 is indexed by its key, which finds partners with no difference there, 2 also by the
keys of its one-deletion neighbourhood, its subsets with one shingle less, which find partners with one difference. A segment that
doesn't match holds at least as many differences as its units, so with H + 1 units in all one segment of a pair matches.

Empty segments would be keys that very many sets share. There are E units more instead: a set whose empty segments have at most E / 2
units, nearly every one, doesn't emit them, and a pair still shares a key. (If both leave them out, at most E units match by
them; if one does, what isn't found lies in its own empty segments.) A set with more emits all.

Units are 1 unless the costs say otherwise (``allocation``): on a bounded sample of the texts (SAMPLE in expectation, by hash) a band's segments
are charged for the keys that they make and, scaled to all rows, for the pairs that ``settled`` compares, which grow with a list's
members and not with their square; so the share of the keys of neighbourhoods doesn't grow with the table. The dearest segments, those of a passage
that many documents hold, then lose their unit to the cheapest neighbourhoods. Any allocation of the same sum is exact.

Lists of keys are settled in rounds (``shingles.settled``): every link between different sets is found or lies in
a component that is complete already. ``links`` gives the links themselves. All are verified on whole texts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import mapped, only, slices, whole_text, written
from perilframe.llm.shingles import ROUNDS, lists_of, parity_bitmap, settled, several, shingle_set, texts_of, verified

WORDS, NUM, DEN, SAMPLE = 3, 90, 100, 4000
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(33))) * _B
    return x ^ (x >> np.uint64(33))


def starts(most: int) -> list[int]:
    """The least size of each band, up to the one that holds ``most``."""
    out = [1]
    while out[-1] * 4 // 3 <= most or out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * 4 // 3))
    return out


@lru_cache(100_000)
def band_of(n: int) -> int:
    return int(np.searchsorted(starts(n), n, "right")) - 1


class Band:
    """Differences H of a band's pairs, segments m and spare units E."""

    def __init__(self, number: int, num: int, den: int):
        least = 1
        for _ in range(number):
            least = max(least + 1, least * 4 // 3)
        most = max(least + 1, least * 4 // 3) - 1
        self.number, self.least, self.most = number, least, most
        self.differences = (most + most * den // num) * (den - num) // (den + num)
        # E / 2: three standard deviations above the mean number of empty segments of the smallest sets, were there H + 1 in all
        empty = (self.differences + 1) * np.exp(-least / (self.differences + 1))
        self.spare = 2 * int(np.ceil(empty + 3 * np.sqrt(empty))) if self.differences else 0
        self.segments = self.differences + 1 + self.spare

    def keys(self, h: np.ndarray, units: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, segments, leads) of a set of hashes: keys of whole segments lead, those of neighbourhoods don't."""
        value = _mixed(h + np.uint64(self.number * 2 + 1))
        segment = (value % np.uint64(self.segments)).astype(np.int64)
        order, sizes = np.argsort(segment, kind="stable"), np.bincount(segment, minlength=self.segments)
        segment, value = segment[order], value[order]
        held, free = np.flatnonzero(sizes), np.flatnonzero(sizes == 0)
        total = np.add.reduceat(value, (np.cumsum(sizes) - sizes)[held])
        plain = units is None
        at, sums = [held if plain else held[units[held] > 0]], [total if plain else total[units[held] > 0]]
        if (len(free) if plain else units[free].sum()) * 2 > self.spare:
            free = free if plain else free[units[free] > 0]
            at, sums = [*at, free], [*sums, np.zeros(len(free), np.uint64)]
        lead = sum(map(len, at))
        if not plain:
            near = units[segment] > 1
            at.append(segment[near])
            sums.append((np.repeat(total, sizes[held]) - value)[near])
        at, sums = np.concatenate(at), np.concatenate(sums)
        return _mixed(sums ^ _mixed(at.astype(np.uint64) * np.uint64(1 << 16) + np.uint64(self.number))), at, np.arange(len(at)) < lead


class Bands:
    """Bands by number, made when first asked for; ``units`` by number where they aren't all 1."""

    def __init__(self, num: int = NUM, den: int = DEN, units: dict[int, np.ndarray] | None = None):
        self.num, self.den, self.units, self.made = num, den, units or {}, {}

    def of(self, n: int) -> list[Band]:
        """The bands of a set of size n: its own, and those that hold smaller partners."""
        numbers = range(band_of(-(-n * self.num // self.den)), band_of(n) + 1)
        for k in numbers:
            if k not in self.made:
                self.made[k] = Band(k, self.num, self.den)
        return [self.made[k] for k in numbers]

    def keys(self, h: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(band, keys, segments, leads) of a set for each of its bands."""
        return [(b.number, *b.keys(h, self.units.get(b.number))) for b in self.of(len(h))] if len(h) else []


def allocation(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, pair_cost: float = 20.0) -> dict[int, np.ndarray]:
    """Units of each band's segments where the costs aren't least with 1 each. A pair costs as much as ``pair_cost`` keys."""
    texts = docs.select(whole_text().alias("text"))
    share = max(1, texts.count() // SAMPLE)
    every = Bands(num, den)

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            rows = []
            for t in b.column(0).to_pylist():
                h = shingle_set(t, words)
                for band in every.of(len(h)) if len(h) else []:
                    rows.append((band.number, *band.keys(h, np.full(band.segments, 2))))
            sizes = [len(r[1]) for r in rows]
            bands = np.repeat(np.array([r[0] for r in rows], np.int32), sizes)
            columns = [np.concatenate([np.empty(0, kind), *(r[i] for r in rows)]).astype(kind) for i, kind in ((1, np.uint64), (2, np.int64), (3, bool))]
            yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(columns[1].astype(np.int32)), pa.array(columns[0].view(np.int64)), pa.array(columns[2])], names=["band", "segment", "key", "leads"])

    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).distinct()
    lists = mapped(some, run, "band int, segment int, key long, leads boolean").groupBy("band", "segment", "key").agg(F.count_if("leads").alias("e"), F.count_if(~F.col("leads")).alias("d"))
    # a list of all rows is ``share`` times as long; its pairs are never more than those with the leaders of its rounds
    pairs = F.least(F.expr("e * (e - 1) / 2") * share, F.when(F.col("e") > 1, F.col("e") * ROUNDS).otherwise(0))
    others = F.least(F.expr("CAST(e * d AS DOUBLE)") * share, F.when((F.col("e") > 0) & (F.col("d") > 0), (F.col("e") + F.col("d")) * ROUNDS).otherwise(0))
    sums = lists.groupBy("band", "segment").agg(F.sum("e"), F.sum("d"), F.sum(pairs), F.sum(others))
    costs: dict[int, list] = {}
    for r in sums.collect():  # a row for each segment of each band: as many as a few times the largest set at most
        costs.setdefault(r[0], []).append(r[1:])
    out = {}
    for number, rows in costs.items():
        band = Band(number, num, den)
        one, two = np.zeros(band.segments), np.zeros(band.segments)
        for segment, keys, near, pairs, others in rows:
            one[segment] = keys + pair_cost * pairs
            two[segment] = one[segment] + near + pair_cost * others
        units, dear, cheap = np.ones(band.segments, np.int64), np.argsort(-one, kind="stable"), np.argsort(two - one, kind="stable")
        for i, j in zip(dear.tolist(), cheap.tolist()):
            if i == j or units[i] != 1 or units[j] != 1 or one[i] <= two[j] - one[j]:
                break
            units[i], units[j] = 0, 2
        if (units != 1).any():
            out[number] = units
    return out


def indexed(docs: DataFrame, bands: Bands, words: int = WORDS) -> DataFrame:
    """(doc_id, th, g, n, bits, leading, near): of each document the hash of its text, hash, size and bitmap of its set, keys of
    its segments and of their neighbourhoods."""

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            g, size, bits, leading, near = [], [], [], [], []
            for t in b.column(2).to_pylist():
                h = shingle_set(t, words)
                g.append(xxhash.xxh64_intdigest(h.tobytes()))
                size.append(len(h))
                bits.append(parity_bitmap(h))
                found = bands.keys(h)
                for out, own in ((leading, True), (near, False)):
                    out.append(np.concatenate([np.empty(0, np.uint64), *(k[leads == own] for _, k, _, leads in found)]).view(np.int64))
            columns = [b.column(0), b.column(1), pa.array(np.array(g, np.uint64).view(np.int64)), pa.array(size, pa.int32()), *map(lists_of, (bits, leading, near))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "g", "n", "bits", "leading", "near"])

    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("th"), text.alias("text"))
    return mapped(rows, run, "doc_id long, th long, g long, n int, bits array<long>, leading array<long>, near array<long>")


def _lists(docs: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, sets, listed): documents, distinct sets and the rows of their lists, as ``settled`` takes them."""
    rows = written(indexed(docs, Bands(num, den, allocation(docs, words, num, den)), words), "sets")
    sets = rows.where("n > 0").select("g", "th", "n", "bits").dropDuplicates(["g"]).withColumn("hub", F.lit(0))
    keys = rows.where("n > 0").select("doc_id", "th", "g", "leading", "near").dropDuplicates(["g"])
    whole, near = (keys.select("g", F.lit(lead).alias("leads"), F.explode(c).alias("token")) for lead, c in ((True, "leading"), (False, "near")))
    return rows.select("doc_id", "th", "g", "n"), written(sets, "distinct-sets"), whole.unionByName(near)


def links(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """(a, b): every link between different sets once, each set by its hash ``g``; it doesn't repeat for copies. As many rows as there
    are links: for tables without large groups of near copies."""
    _, sets, listed = _lists(docs, words, num, den)
    rows = several(listed)
    x, y = rows.alias("x"), rows.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.g") < F.col("y.g")) & (F.col("x.leads") | F.col("y.leads")))
    pairs = written(pairs.select(F.col("x.g").alias("a"), F.col("y.g").alias("b")).distinct(), "pairs")
    return verified(pairs, texts_of(docs, sets, pairs), words, num, den)


def joined(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``: the smallest doc_id that its links reach, its own included.

    Null texts count as empty; a text without words has an empty set and is linked with nothing, not even its like. Equal sets are linked.
    Repeated rows give repeated rows. A null doc_id takes part with the least id, shown as null where it is the smallest. Other
    columns are not looked at; an empty table gives none.
    """

    def members() -> DataFrame:
        base, sets, listed = _lists(docs, words, num, den)
        none = docs.sparkSession.createDataFrame([], "a long, b long")
        found = settled(docs, sets, listed, none, words, num, den).withColumnRenamed("a", "g")
        return base.join(found, "g", "left").withColumn("c", F.coalesce("b", "g")).select("doc_id", "n", "c")

    rows = only(members, "components")
    least = F.lit(-(2**63)).cast("long")
    first = rows.where("n > 0").groupBy("c").agg(F.min(F.coalesce("doc_id", least)).alias("first"))
    alone = rows.where("n = 0").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(first, "c").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.nullif("first", least).alias("component_id")).unionByName(alone)


SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
both_hold AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM both_hold JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE {DEN} * k >= {NUM} * (x.n + y.n - k)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, v FROM reach r JOIN links ON u = r.other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY ALL"""

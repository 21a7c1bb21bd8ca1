"""SimHash near-dedup with a byte-position inverted index.

A fingerprint has 64 bits, hence 8 positional bytes. Two fingerprints that differ in at most 3 bits differ in at most 3
bytes, so they share at least 5 of the 8: the count filter. Lists of a single positional byte would hold a 256th of all
fingerprints each, and their pairs grow with the square of the corpus. The filter itself gives finer lists that lose
nothing: of 5 shared bytes at least 3 lie in one half of the fingerprint, so the index is kept on (half, three bytes of
it), 8 postings a fingerprint. In a list that is still long, the same argument gives two more shared bytes among the
other five, and the list is split by those (10 postings a member). What is left of a list then shares five bytes; if it
is very long, a member meets others by equality only: its three free bytes, with up to three bits turned, are looked up.
Candidates of a list have their shared positional bytes tallied; pairs with 5 or more are verified on bits (which implies
the tally: it is the cheaper test before it).

``near_duplicates`` is for corpora: SimHash of 5-word shingles finds most near copies and an exact check on shingle sets
verifies them; as fingerprints of texts that are 4/5 alike can differ in more bits than any such index covers, the links
that they miss are then found by prefixes of the sets (``shingles``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.llm import shingles
from perilframe.llm.common import dropped, mapped, of_hashes, only, slices, whole_text, written
from perilframe.network import components

BITS, LONG_LIST, HUGE_LIST = 3, 64, 8192
#: Three bytes with up to three bits set: what can differ between members of a list that share five bytes.
TURNS = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(24), n)]


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash over word shingles, repeats included; 0 for a text without words."""
    w = text.encode().lower().split()  # bytes: lowers A-Z and splits at space and 9 to 13 only
    if not w:
        return 0
    one = xxhash.xxh64_intdigest
    join = b" ".join
    h = np.array([one(join(s), seed) for s in zip(*(w[i:] for i in range(words)))] or [one(join(w), seed)], ">u8")
    return of_hashes(h)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed long; a null text counts as empty."""

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            fp = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return mapped(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, "doc_id long, fp long")


def _byte(x, i: int):
    return F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255))


def postings(fps: DataFrame) -> DataFrame:
    """(fp, key, rest, count): the lists (half, three bytes of it) that hold each fingerprint, the other five bytes, and the
    list's length; lists of one have no pair and are left out."""
    fp = F.col("fp")
    halves = [fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)]
    found = []
    for half in (0, 1):
        for d in range(4):
            key = halves[half].bitwiseAND(F.lit(0xFFFFFFFF ^ (255 << 8 * d))).bitwiseOR(F.lit((half * 4 + d) << 32))
            rest = halves[1 - half].bitwiseOR(F.shiftleft(_byte(halves[half], d), 32))
            found.append(F.struct(key.alias("key"), rest.alias("rest")))
    listed = fps.select("fp", F.inline(F.array(*found)))
    sizes = listed.groupBy("key").count().where(F.col("count") > 1)
    return listed.join(sizes, "key")


def led(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b), a < b: pairs of a list's least fingerprint with its members, if they differ in at most ``bits`` bits. As many as
    there are postings at most, so a group of near copies gives no pairs by the square; other pairs of ``links`` may be left out."""
    rows = postings(fps).withColumn("a", F.min("fp").over(Window.partitionBy("key")))
    return rows.where("a < fp").where(F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= bits).select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints in column ``fp`` that differ in at most ``bits`` (up to 3) bits."""
    if bits > 3:
        raise ValueError("the index guarantees pairs of at most 3 differing bits")
    listed, rest = postings(fps), F.col("rest")

    def split(c, i, j):
        k, m, n = (x for x in range(5) if x not in (i, j))
        shared = F.lit(c << 16).bitwiseOR(F.shiftleft(_byte(rest, i), 8)).bitwiseOR(_byte(rest, j))
        free = F.shiftleft(_byte(rest, k), 16).bitwiseOR(F.shiftleft(_byte(rest, m), 8)).bitwiseOR(_byte(rest, n))
        return F.struct(shared.alias("split"), free.alias("free"))

    whole = F.array(F.struct(F.lit(-1).cast("long").alias("split"), F.lit(0).cast("long").alias("free")))
    splits = F.array(*(split(c, i, j) for c, (i, j) in enumerate(combinations(range(5), 2))))
    short = listed.where(F.col("count") <= LONG_LIST).select("fp", "key", F.inline(whole))
    long = listed.where(F.col("count") > LONG_LIST).select("fp", "key", F.inline(splits))
    huge = long.groupBy("key", "split").count().where(F.col("count") > HUGE_LIST).select("key", "split")
    out = _within(short.unionByName(long.join(huge, ["key", "split"], "left_anti")), bits)
    return out.unionByName(_turned(long.join(huge, ["key", "split"]), bits)).distinct()


def _within(listed: DataFrame, bits: int) -> DataFrame:
    """Links among the members of each list (key, split)."""
    x, y = listed.alias("x"), listed.alias("y")
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    tally = sum(((_byte(differ, i) == 0).cast("int") for i in range(8)), F.lit(0))
    found = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.split") == F.col("y.split")) & (F.col("x.fp") < F.col("y.fp")) & (tally >= 8 - bits) & (F.bit_count(differ) <= bits))
    return found.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def _turned(listed: DataFrame, bits: int) -> DataFrame:
    """The same by equality: every member looks up its free bytes with up to ``bits`` of their bits turned."""
    turns = F.array(*(F.lit(t).cast("long") for t in TURNS if t.bit_count() <= bits))
    looks = listed.select(F.col("fp").alias("a"), "key", "split", F.explode(F.transform(turns, lambda t: t.bitwiseXOR(F.col("free")))).alias("free"))
    return looks.join(listed.withColumnRenamed("fp", "b"), ["key", "split", "free"]).where("a < b").select("a", "b")


def clusters(docs: DataFrame, words: int = 3, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id): every row's fingerprint and the smallest doc_id that its links reach.

    Null text: empty. Texts without words have fingerprint 0 and link like any other. A null doc_id takes part with the
    least id, shown as null where it is the smallest. Repeated rows give repeated rows. Other columns are not looked at.
    """
    least = F.lit(-(2**63)).cast("long")
    fps = written(fingerprints(docs, words), "fps")
    groups = written(fps.groupBy("fp").agg(F.min(F.coalesce("doc_id", least)).alias("rep")), "groups")
    linked = links(groups.select("fp"), bits)
    ids = groups.select(F.col("fp").alias("a"), F.col("rep").alias("u"))
    edges = linked.join(ids, "a").select("u", F.col("b").alias("a")).join(ids.withColumnRenamed("u", "v"), "a").select("u", "v")
    found = components(edges).select(F.col("node").alias("rep"), "component")
    named = groups.join(found, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", F.nullif("component_id", least).alias("component_id"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row of ``docs``."""
    return clusters(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, words: int = 3, bits: int = BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id. Of fully repeated rows one stays."""
    first = clusters(docs, words, bits).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi").dropDuplicates(["doc_id", "text"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document, that of the smallest doc_id, of each component of links of 5-word Jaccard similarity of at
    least 4/5, all of them found. Texts without words are one component; of fully repeated rows one stays; nulls count as empty."""
    return shingles.one_of_each(docs, only(lambda: _near_clusters(docs), "near-clusters"))


def _near_clusters(docs: DataFrame) -> DataFrame:
    full = written(shingles.prefixes(docs), "shingle-sets")
    distinct = written(full.select("g", "fp", "th", "n", "hub", "bits", "tokens").dropDuplicates(["g"]), "distinct-sets")
    # bitmaps and prefixes are most of these tables: they go once the documents have their ids, and prefixes once lists are made of them
    base = written(full.select("doc_id", "th", "g"), "set-ids")
    dropped(full)
    sets, tokens = written(distinct.drop("tokens"), "set-marks"), written(distinct.select("g", "tokens"), "set-prefixes")
    dropped(distinct)
    groups = written(sets.groupBy("fp").agg(F.min("g").alias("rep")), "groups")
    reps = groups.select(F.col("fp").alias("a"), F.col("rep").alias("u"))
    pairs = led(groups.select("fp")).join(reps, "a").select("u", F.col("b").alias("a")).join(reps.withColumnRenamed("u", "v"), "a").select("u", "v")
    same = sets.select("g", "fp").join(groups, "fp").where("g != rep").select(F.col("rep").alias("u"), F.col("g").alias("v"))
    likely = written(pairs.unionByName(same).toDF("a", "b"), "simhash-pairs")
    found = only(lambda: shingles.verified(likely, shingles.texts_of(docs, sets, likely)), "links")
    return shingles.completed(docs, base, sets, tokens, found)

"""Links between documents by the exact Jaccard similarity of their sets of word shingles.

An index gives lists of sets that may be alike: here a prefix filter over 5-word shingles for links of at least 4/5, in ``setjoin``
a partition of the universe. As components are wanted, not pairs, ``settled`` never joins a list with itself at first: in rounds, every
list that still holds several components has its members compared with one leader, which then leaves the list, as all its
pairs are known. Pairs of different components that are left when lists are short, or after ROUNDS rounds, are joined, under a bitmap filter: a set's bitmap has for
each of its bits the parity of the number of shingles there, so two bitmaps differ in at most as many bits as the sets
in shingles, and what differs in more than the similarity allows isn't a pair. No filter loses a link; every link is verified on whole texts.

Prefix filter: in any one order of all shingles, two sets of similarity s share a shingle among the first
n - ceil(s * n) + 1 of each. The order here is by count in a sample of the documents, then by hash, so that what many
documents share comes last; a poor sample costs candidates, never links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import dropped, mapped, of_hashes, only, slices, whole_text, written
from perilframe.network import components

WORDS, NUM, DEN = 5, 4, 5
SAMPLE, MOST_COMMON = 16, 50_000
BUCKETS = 1 << 20
ROUNDS, SHORT_LIST, BITMAP = 4, 16, 1024


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, a text without words has none."""
    w = text.encode().lower().split()  # bytes: lowers A-Z and splits at space and 9 to 13 only
    if not w:
        return np.empty(0, np.uint64)
    one, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.array([one(join(s)) for s in zip(*(w[i:] for i in range(words)))] or [one(join(w))], np.uint64))


def parity_bitmap(h: np.ndarray) -> np.ndarray:
    """BITMAP bits as longs: the parity of the number of hashes that fall on each."""
    odd = np.bincount((h % np.uint64(BITMAP)).astype(np.int64), minlength=BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of shingles seen in several of a sample of the distinct texts; at most MOST_COMMON."""
    texts = docs.select(whole_text().alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t).view(np.int64))], names=["h"])

    seen = mapped(texts.distinct(), run, "h long").groupBy("h").count().where(F.col("count") > 1)
    rows = seen.orderBy(F.desc("count"), "h").limit(MOST_COMMON).collect()
    h, n = np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrays of longs as an Arrow column."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def prefixes(docs: DataFrame) -> DataFrame:
    """(doc_id, th, g, fp, n, hub, bits, tokens): hash of the text, hash, SimHash and size of its shingle set, thousandths of common
    shingles, bitmap, prefix."""
    common, counts = common_shingles(docs)

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            g, fp, size, hub, bits, tokens = [], [], [], [], [], []
            for t in b.column(2).to_pylist():
                h = shingle_set(t)
                n, c = len(h), np.zeros(len(h), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                    c = np.where(common[at] == h, counts[at], 0)
                first = n - -(-NUM * n // DEN) + 1 if n else 0
                g.append(xxhash.xxh64_intdigest(h.tobytes()))
                fp.append(of_hashes(h.astype(">u8")) if n else 0)
                size.append(n)
                hub.append(int(1000 * (c > 0).mean()) if n else 0)
                bits.append(parity_bitmap(h))
                tokens.append(h[np.lexsort((h, c))][:first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (g, fp)), pa.array(size, pa.int32()), pa.array(hub, pa.int32()), lists_of(bits), lists_of(tokens)],
                names=["doc_id", "th", "g", "fp", "n", "hub", "bits", "tokens"],
            )

    text = whole_text()
    return mapped(docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("th"), text.alias("text")), run, "doc_id long, th long, g long, fp long, n int, hub int, bits array<long>, tokens array<long>")


def within_prefixes(x: str, y: str):
    """Whether two sets that share a shingle at ``pos`` of each can reach the similarity by what can follow."""
    nx, ny, i, j = (F.col(f"{side}.{c}") for c in ("n", "pos") for side in (x, y))
    most = F.least(i, j) + 1 + F.least(nx - i - 1, ny - j - 1)
    return most * (NUM + DEN) >= (nx + ny) * NUM


def _bucket(th: str):
    return F.pmod(F.col(th), F.lit(BUCKETS)).cast("int").alias("bucket")


def texts_of(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(g, text) for the sets in ``pairs``. Texts in no wanted bucket of hashes are left behind before the others are dealt out."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("g")).distinct()
    wanted = written(sets.select("g", "th").join(ids, "g"), "wanted")
    full = docs.select(F.xxhash64(whole_text()).alias("th"), whole_text().alias("text")).withColumn("bucket", _bucket("th"))
    near = full.join(F.broadcast(wanted.select(_bucket("th")).distinct()), "bucket", "left_semi")
    return written(near.join(wanted, "th").select("g", "text").dropDuplicates(["g"]), "texts")


def verified(pairs: DataFrame, texts: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Those of the pairs (a, b) whose texts have a Jaccard similarity of at least num / den. texts: g, text."""

    def run(batches):
        for b in (s for batch in batches for s in slices(batch)):
            sets, (x, y) = {}, (b.column(0), b.column(1))
            for ids, at in ((x, 2), (y, 3)):
                for g, t in zip(ids.to_pylist(), b.column(at)):
                    if g not in sets:
                        sets[g] = shingle_set(t.as_py(), words)
            both = [(sets[p], sets[q]) for p, q in zip(x.to_pylist(), y.to_pylist())]
            keep = [len(np.intersect1d(p, q, assume_unique=True)) * (num + den) >= (len(p) + len(q)) * num for p, q in both]
            yield pa.RecordBatch.from_arrays([x, y], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.join(texts.select(F.col("g").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("g").alias("b"), F.col("text").alias("tb")), "b")
    return mapped(rows.select("a", "b", "ta", "tb"), run, "a long, b long")


def parts(links: DataFrame) -> DataFrame:
    """(a, b): each linked set with the component it is in; as links, they keep the components and are one for a set."""
    return only(lambda: components(links, "a", "b").where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")), "parts")


def several(listed: DataFrame) -> DataFrame:
    """The rows of lists with several members, of which one may lead."""
    kept = listed.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.max("leads").alias("led")).where("members > 1 AND led").select("token")
    return written(listed.join(kept, "token"), "lists")


def _open(listed: DataFrame, part: DataFrame) -> DataFrame:
    """Lists with members of several components, c being a member's component."""
    rows = written(listed.join(part.withColumnRenamed("a", "g"), "g", "left").withColumn("c", F.coalesce("b", "g")).drop("b"), "members")
    kept = rows.groupBy("token").agg(F.min("c").alias("_first"), F.max("c").alias("_last"), F.max("leads").alias("_led")).where("_first != _last AND _led").select("token")
    return rows.join(kept, "token")


def settled(docs: DataFrame, sets: DataFrame, listed: DataFrame, links: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, possible=None, spent: DataFrame | None = None) -> DataFrame:
    """(a, b): every set that is linked with another, and its component.

    sets: g, th, n, bits, hub (leaders have a large one); listed: token, g, leads (boolean) and what ``possible`` looks at, a row for a set
    in a list; of two linked sets at least one leads in a list that holds both. links (a, b): verified ones that are known.
    possible(x, y): a further condition on two members of a list. spent: a written table that ``listed`` alone is read from, deleted once that is done.
    """
    if not possible:
        def possible(x, y):
            return F.lit(True)

    extra = [c for c in listed.columns if c not in ("token", "g", "leads")]
    kept = several(listed)
    if spent is not None:
        dropped(spent)
    listed = written(kept.join(sets.select("g", "n", "hub"), "g"), "sized-lists")
    dropped(kept)
    member = ["g", "n", *extra, "c"]

    def sizes(x, y):
        return F.least(f"{x}.n", f"{y}.n") * den >= F.greatest(f"{x}.n", f"{y}.n") * num

    def bitmaps(x, y):
        differ = sum((F.bit_count(F.col(f"{x}.bits")[i].bitwiseXOR(F.col(f"{y}.bits")[i])) for i in range(BITMAP // 64)), F.lit(0))
        return differ * (num + den) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (den - num)

    def checked(pairs: DataFrame) -> DataFrame:
        return only(lambda: verified(pairs, texts_of(docs, sets, pairs), words, num, den), "verified")

    def with_leaders(rows: DataFrame, part: DataFrame | None) -> DataFrame:
        rows = _open(rows, part) if part is not None else rows
        lead = rows.where("leads").groupBy("token").agg(F.min(F.struct((-F.col("hub")).alias("hub"), *member)).alias("x"))
        return rows.join(lead, "token").join(rows.groupBy("token").agg(F.count(F.lit(1)).alias("members")), "token")

    def joined_to(links: DataFrame, pairs: DataFrame) -> DataFrame:
        more = checked(pairs)
        out = parts(links.union(more))
        dropped(links, more)
        return out

    tried, marks = None, sets.select("g", "n", "bits")
    links = parts(links)
    rows, held, part = listed, listed, links
    for k in range(ROUNDS):
        rows = only(lambda rows=rows, part=part: with_leaders(rows, part), "led")
        dropped(held)
        held, part = rows, None
        if rows.where(F.col("members") > (SHORT_LIST if k else 0)).isEmpty():
            break
        star = rows.select("x", F.struct(*member).alias("y")).where(F.col("x.c") != F.col("y.c")).where(sizes("x", "y") & possible("x", "y"))
        star = star.select(F.least("x.g", "y.g").alias("a"), F.greatest("x.g", "y.g").alias("b")).distinct()
        star = star if tried is None else star.join(tried, ["a", "b"], "left_anti")
        near = star.join(marks.select(F.col("g").alias("a"), F.struct("n", "bits").alias("x")), "a").join(marks.select(F.col("g").alias("b"), F.struct("n", "bits").alias("y")), "b")
        near = written(near.where(bitmaps("x", "y")).select("a", "b"), "near")
        tried = near if tried is None else tried.unionByName(near)
        rows = rows.where("g != x.g").drop("x", "members")
        if not near.isEmpty():
            links = part = joined_to(links, near)
            rows = rows.drop("c")

    rest = only(lambda: (rows if part is None else _open(rows, part)).join(sets.select("g", "bits"), "g"), "open-lists")
    dropped(held)
    if rest.isEmpty():
        return links
    x, y = rest.alias("x"), rest.alias("y")
    meets = (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.leads") | F.col("y.leads")) & sizes("x", "y") & possible("x", "y") & bitmaps("x", "y")
    found = x.join(y, meets).select(F.least("x.g", "y.g").alias("a"), F.greatest("x.g", "y.g").alias("b")).distinct()
    pairs = written(found if tried is None else found.join(tried, ["a", "b"], "left_anti"), "open-pairs")
    dropped(rest)
    return links if pairs.isEmpty() else joined_to(links, pairs)


def completed(docs: DataFrame, base: DataFrame, sets: DataFrame, tokens: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, th, cluster): for every row the hash of its text and the component that links of at least 4/5 reach.

    base: doc_id, th, g of ``prefixes``; sets, tokens: its distinct sets without and with their prefixes, the latter deleted once lists are made of them;
    links (a, b): verified ones that are known. Equal sets are one node. Texts without words are one cluster.
    """
    listed = tokens.select("g", F.lit(True).alias("leads"), F.posexplode("tokens").alias("pos", "token"))
    final = settled(docs, sets, listed, links, possible=within_prefixes, spent=tokens).withColumnRenamed("a", "g")
    return base.select("doc_id", "th", "g").join(final, "g", "left").select("doc_id", "th", F.coalesce("b", "g").alias("cluster"))


def one_of_each(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """``docs`` with one document of each cluster: the one with the smallest doc_id. Of fully repeated rows one stays."""
    rows = written(clusters.groupBy("cluster", "doc_id", "th").agg(F.count(F.lit(1)).alias("n")), "clustered")
    first = rows.groupBy("cluster").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    rows = rows.join(first, "cluster").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))
    rows = written(rows.select("doc_id", "th", "kept", "n"), "kept")
    # buckets of hashes without a row to drop keep all of theirs, so that their texts need not be dealt out
    touched = F.broadcast(written(rows.where("NOT kept OR n > 1").select(_bucket("th")).distinct(), "touched"))
    all_rows = docs.withColumn("_th", F.xxhash64(whole_text())).withColumn("bucket", _bucket("_th"))
    keep = rows.where("kept").select(F.col("doc_id").alias("_id"), "th")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("th"))
    dealt = all_rows.join(touched, "bucket", "left_semi").join(keep, same, "left_semi").dropDuplicates(["doc_id", "_th"])
    return all_rows.join(touched, "bucket", "left_anti").select(docs.columns).unionByName(dealt.select(docs.columns))

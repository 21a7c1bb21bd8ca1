"""The set join, hard negatives and reversed search against brute force, with odd rows in every column."""

import math
import os
import random
import re
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from perilframe.llm import lexical, negatives, setjoin, shingles

DIR = "/root/testdata/sf0.01"


def components_by_brute_force(rows, words=3, num=90, den=100):
    """[(doc_id, set size, component)] in the order of the rows, and the links between different sets."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(b" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset())
    distinct, up = sorted(set(sets) - {frozenset()}, key=sorted), {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    links = 0
    for a, b in combinations(distinct, 2):
        shared = len(a & b)
        if shared and den * shared >= num * (len(a) + len(b) - shared):
            links += 1
            up[top(a)] = top(b)
    ids = {}
    for (i, _), s in zip(rows, sets):
        ids.setdefault(top(s), []).append(-math.inf if i is None else i)
    out = [(i, len(s), (min(ids[top(s)]) if s else i)) for (i, _), s in zip(rows, sets)]
    return [(i, n, None if c == -math.inf else c) for i, n, c in out], links


def odd_documents(seed=7):
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Ü ü"), (8, "ü Ü"), (None, "one two"), (9, "x\x1cy z"), (9, "x\x1cy z"), (10, "ab " * 20000), (11, "ab " * 3)]
    for i in range(120):  # near copies, some of 90 in 100, many of less
        w = list(base)
        for k in draw.sample(range(150), draw.randint(0, 5)):
            w[k] = f"x{draw.randint(0, 9)}"
        rows.append((100 + i, " ".join(w)))
    rows += [(300 + i, " ".join(f"y{i}_{k}" for k in range(draw.randint(1, 40))) + " " + " ".join(base[: draw.randint(2, 90)])) for i in range(100)]
    rows += [(500 + i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 25)))) for i in range(100)]
    return rows


@pytest.mark.parametrize("rounds, short", [(4, 16), (1, 0), (0, 16)])
def test_set_join_by_brute_force(spark, monkeypatch, rounds, short):
    """However many rounds lists go through, the rest of the pairs is joined."""
    monkeypatch.setattr(shingles, "ROUNDS", rounds)
    monkeypatch.setattr(shingles, "SHORT_LIST", short)
    rows = odd_documents()
    want, links = components_by_brute_force(rows)
    docs = spark.createDataFrame([(i, t, "extra", 1, 0) for i, t in rows], "doc_id long, text string, g string, n int, component_id int")
    got = [tuple(r) for r in setjoin.joined(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and links > 100
    assert setjoin.joined(docs.limit(0)).isEmpty()


def test_all_links_and_other_similarities(spark):
    rows = [r for r in odd_documents(8) if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for words, num, den in ((3, 90, 100), (5, 4, 5), (2, 19, 20)):
        want, links = components_by_brute_force(rows, words, num, den)
        assert setjoin.links(docs, words, num, den).count() == links
        assert sorted(map(tuple, setjoin.joined(docs, words, num, den).collect()), key=str) == sorted(want, key=str)


def test_any_allocation_of_units_keeps_every_pair():
    """Pairs of sets of all sizes share a key, a leading one on one side, with ones everywhere and with units moved about."""
    draw, odd = np.random.default_rng(3), np.random.default_rng(4)
    assert all(setjoin.band_of(n) == max(k for k, s in enumerate(setjoin.starts(n)) if s <= n) for n in range(1, 3000))
    for trial in range(600):
        n = int(draw.integers(1, 60)) if trial % 3 else int(draw.integers(60, 1500))
        big = draw.integers(0, 2**64, n, np.uint64)
        fewest = -(-9 * n // 10)
        less = draw.permutation(big)[: int(draw.integers(fewest, n + 1))]  # a subset of 90 in 100 at least
        bands = setjoin.Bands()
        shared = {b.number for b in bands.of(len(less))} & {b.number for b in bands.of(n)}
        assert setjoin.band_of(len(less)) in shared
        for moved in (False, True):
            if moved:
                for b in bands.made.values():
                    units = np.ones(b.segments, np.int64)
                    half = odd.permutation(b.segments)[: b.segments // 2 * 2].reshape(2, -1)
                    units[half[0]], units[half[1]] = 0, 2
                    bands.units[b.number] = units
            held = [{(band, k): lead for band, keys, _, leads in bands.keys(np.sort(x)) for k, lead in sorted(zip(keys.tolist(), leads.tolist()))} for x in (big, less)]
            assert any(held[0][k] or held[1][k] for k in held[0].keys() & held[1].keys())


def test_bitmaps_differ_in_at_most_as_many_bits_as_sets():
    draw = np.random.default_rng(5)
    for _ in range(300):
        x = np.unique(draw.integers(0, 2**64, int(draw.integers(1, 3000)), np.uint64))
        y = np.union1d(draw.permutation(x)[: int(draw.integers(0, len(x) + 1))], draw.integers(0, 2**64, int(draw.integers(0, 400)), np.uint64))
        bits = int(np.bitwise_count((shingles.parity_bitmap(x) ^ shingles.parity_bitmap(y)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(x, y))


def test_set_join_by_sql(spark):
    if not os.path.isdir(DIR):
        pytest.skip("tables are not there")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    assert sorted(map(tuple, setjoin.joined(spark.read.parquet(f"{DIR}/documents.parquet")).collect())) == sorted(con.sql(setjoin.SQL).fetchall())


def negatives_by_brute_force(rows):
    kept = {}
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        kept.setdefault((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in vec)), None)
    out = []
    for a in kept:
        if a[0] % 100:
            continue
        by_score = sorted({(-sum(x * y for x, y in zip(a[2], c[2])), c[0], c[1] == a[1]) for c in kept if c[0] != a[0]})
        for p, i, _ in [x for x in by_score if x[2]][:5]:
            fit = [x for x in by_score if not x[2] and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out += [(a[0], i, k + 1, j, -p, -s) for k, (s, j, _) in enumerate(fit)]
    return sorted(out)


EMBEDDINGS = "vec_id long, embedding array<float>, label int, score string"


@pytest.mark.parametrize("wave, block, share", [(4096, 1024, 64), (3, 2, 2)])
def test_hard_negatives_by_brute_force(spark, monkeypatch, wave, block, share):
    for name, value in (("WAVE", wave), ("BLOCK", block), ("SHARE", share), ("ROWS", 100)):
        monkeypatch.setattr(negatives, name, value)
    draw = random.Random(11)
    centres = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = []
    for i in range(700):
        near = centres[i % 4]
        rows.append((i * (1 if i % 3 else 50), [float(np.float32(x + draw.gauss(0, 0.3))) for x in near], draw.randint(0, 3)))
    rows += [(100_000 + i, rows[5][1], 1) for i in range(40)]  # equal vectors: ties go by vec_id
    rows += [rows[8], rows[0], rows[0], (100, rows[3][1], 2), (200, [0.0] * 8, 1), (300, [1.0, 2.0], 1), (700, [-x for x in rows[1][1]], 0)]
    rows += [(None, rows[1][1], 1), (400, None, 1), (500, [None] * 8, 1), (600, [math.nan] + [0.5] * 7, 1), (800, [math.inf] * 8, 2), (900, rows[1][1], None), (1000, [], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], EMBEDDINGS)
    got = sorted(map(tuple, negatives.mined(table).collect()))
    want = negatives_by_brute_force(rows)
    assert got == want and len(want) > 100
    assert negatives.mined(table.limit(0)).isEmpty() and negatives.mined(table.where("vec_id % 100 = 1")).isEmpty()


def test_tree_bounds_hold_and_leave_rows_out():
    """Of clustered anchors most candidates aren't scored; none that can be wanted is left out."""
    draw = np.random.default_rng(2)
    centre = np.round(draw.normal(0, 100, 16))
    block = negatives.Block(0, np.arange(50), np.zeros(50, int), centre + np.round(draw.normal(0, 1, (50, 16))))
    q, ids = np.round(draw.normal(0, 60, (2000, 16))), np.arange(1000, 3000)
    every = q @ block.q.T
    least, scored = np.sort(every, axis=0)[-5], 0
    for a, rows, s in block.scored(ids, q, lambda a, low, high: high >= least[a]):
        assert (s == every[rows, a]).all() and set(np.flatnonzero(every[:, a] >= least[a])) <= set(rows)
        scored += len(rows) if a else 0
    assert 49 * 5 <= scored < 49 * 400
    tree = negatives.Block(0, np.arange(1), np.zeros(1, int), np.zeros((1, 3)))
    assert tree.parent.tolist() == [-1] and tree.edge.tolist() == [0.0]


def test_products_beyond_doubles():
    big = np.array([[2.0**40, 3.0, -(2.0**40)], [2.0**41, 2.0**41, 0.0]])
    assert negatives.products(big, np.array([2.0**20 + 1, 7.0, 2.0**20]), 2.0**62).tolist() == [2**40 + 21, 2**41 * (2**20 + 1) + 7 * 2**41]
    assert negatives.products(big[1:], np.array([2.0**40, 0.0, 0.0]), 2.0**90).tolist() == [2**63 - 1]


def ranks_by_brute_force(docs, items, k=20):
    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(i, c) for i, t in docs if (c := Counter(cut(t)))]
    total, words, df = len(held), sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scores = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * total // words
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in cut(text) if t in c)
            if s > 0:
                scores.append((-s, -math.inf if i is None else i))
        out += [(item, r + 1, None if i == -math.inf else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("items, piece, cells", [(2000, 4_000_000, 2_000_000), (2, 20, 30)])
def test_ranked_search_by_brute_force(spark, monkeypatch, items, piece, cells):
    """In one block and in many, with texts cut in pieces and scores in small batches."""
    for name, value in (("ITEMS", items), ("PIECE", piece), ("CELLS", cells)):
        monkeypatch.setattr(lexical, name, value)
    draw = random.Random(4)
    words = ["alpha", "Beta", "BETA", "gamma7", "naïve", "ÜBER", "über", "中文", "don't", "x_y", "é", "é"]
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, "!?"), (4, "alpha " * 3000), (5, "alpha"), (6, "Alpha"), (6, "Alpha"), (7, "ZZ")]
    docs += [(10 + i, " ".join(draw.choice(words) for _ in range(draw.randint(1, 60)))) for i in range(150)]
    asked = [(1, "alpha beta beta"), (1, "alpha beta beta"), (1, "gamma7"), (2, None), (3, "nowhere"), (None, "中文 über"), (4, " ".join(words * 3)), (5, "...")]
    d = spark.createDataFrame([(i, t, 1, 1, "x") for i, t in docs], "doc_id long, text string, n int, score int, term string")
    b = spark.createDataFrame([(i, t, 1, 1) for i, t in asked], "item_id long, text string, rank int, doc_id int")
    got = [tuple(r) for r in lexical.ranked(d, b).collect()]
    assert sorted(got, key=str) == ranks_by_brute_force(docs, asked)
    for x, y in ((d.limit(0), b), (d, b.limit(0)), (d.where("doc_id IN (1, 2, 3)"), b)):
        assert lexical.ranked(x, y).isEmpty()


def test_heaps_keep_the_best_with_ties():
    draw, heaps, every = np.random.default_rng(1), lexical.Heaps(3, 4), []
    for _ in range(50):
        item, score, doc = draw.integers(0, 3, 20), draw.integers(1, 9, 20), draw.integers(0, 1000, 20)
        every += zip(item.tolist(), (-score).tolist(), doc.tolist())
        heaps.push(item, score, doc)
    want = [x for i in range(3) for x in sorted(e for e in every if e[0] == i)[:4]]
    assert list(zip(heaps.item.tolist(), (-heaps.score).tolist(), heaps.doc.tolist())) == want
    assert heaps.floor.tolist() == [-want[4 * i + 3][1] for i in range(3)]


def test_hard_negatives_and_search_by_sql(spark):
    if not os.path.isdir(DIR):
        pytest.skip("tables are not there")
    con = duckdb.connect()
    docs, items, vectors = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "benchmark", "embeddings"))
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    assert sorted(map(tuple, negatives.mined(vectors).collect())) == sorted(con.sql(negatives.SQL).fetchall())
    clash = docs.withColumn("term", F.lit("x")).withColumn("tf", F.lit(1))
    assert sorted(map(tuple, lexical.ranked(clash, items).collect())) == sorted(con.sql(lexical.SQL).fetchall())

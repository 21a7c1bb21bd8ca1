"""The corpus pipeline: each stage's decisions take effect on its own input."""

import os

import pytest

import __spark_entry__
import corpus_pipeline
from perilframe import io
from perilframe.llm import shingles, simhash
from perilframe.llm.common import written

DIR = "/root/testdata/sf0.01"  # the smallest tables have too few toxic labels
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="tables are not there")


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], DIR), f"test-{name}"))
    before, clean, single, secret, mix, tokens = seen
    assert all(set(x.columns) == set(docs.columns) for x in seen[:-1])
    assert clean.count() < before.count() and single.count() < clean.count() and secret.count() == single.count()
    assert single.select("text").distinct().count() == single.count()
    assert secret.where("text RLIKE '[0-9a-f]{16}'").isEmpty() and mix.select("doc_id").distinct().count() == secret.count()
    assert tokens.count() == mix.count() and tokens.where("n_tokens = 0").isEmpty()
    assert "pipeline" in __spark_entry__.queries()


def shingles_of(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept_by_brute_force(rows):
    """Smallest doc_id of each component of links of 5-word Jaccard similarity of at least 4/5, and the number of links."""
    sets, lists, up, links = {i: shingles_of(t or "") for i, t in rows}, {}, {i: i for i, _ in rows}, 0

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    def link(i, j):
        up[max(top(i), top(j))] = min(top(i), top(j))

    empty = sorted(i for i, s in sets.items() if not s)
    for i in empty:
        link(empty[0], i)
    for i, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(i)
    for i, s in sets.items():
        shared = {}
        for x in s:
            for j in lists[x]:
                if j > i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                link(i, j)
                links += 1
    return {i for i in up if top(i) == i}, links


def test_near_duplicates_by_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    want, links = kept_by_brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = [r.doc_id for r in corpus_pipeline.near_duplicates_out(spark, docs, DIR).select("doc_id").collect()]
    assert links > 0 and sorted(got) == sorted(want)


def test_near_duplicates_of_one_large_group(spark):
    import random

    draw = random.Random(3)
    base, rows = [f"w{i}" for i in range(120)], [(5000, ""), (5001, None), (5002, "\n"), (5003, "one two"), (5004, "One  two")]
    for i in range(300):  # copies with up to 6 words changed: some links reach 4/5, many do not
        w = list(base)
        for k in draw.sample(range(120), draw.randint(0, 6)):
            w[k] = f"x{draw.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"y{i}_{k}" for k in range(40)) + " " + " ".join(base[:30])) for i in range(100)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want, links = kept_by_brute_force(rows)
    got = [r.doc_id for r in corpus_pipeline.near_duplicates_out(spark, docs, DIR).select("doc_id").collect()]
    assert links > 300 and 100 < len(want) < 400 and sorted(got) == sorted(want)


def test_near_duplicates_keep_no_spent_tables(spark, monkeypatch):
    left, completed = [], shingles.completed

    def names():
        return {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in io._MADE}

    def seen(run):
        return lambda *args, **more: left.append((run.__name__, names())) or run(*args, **more)

    io.cleanup(spark)
    monkeypatch.setattr(shingles, "completed", seen(completed))
    rows = [(i, " ".join(f"w{i // 3}x{j + (i % 3) * (j == 40)}" for j in range(80))) for i in range(30)]
    assert {r.doc_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == set(range(0, 30, 3))
    assert left and all(not {"shingle-sets", "distinct-sets"} & tables for _, tables in left)
    assert "set-prefixes" not in names()

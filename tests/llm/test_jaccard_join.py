"""The Jaccard join against all pairs, and its SQL twin."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adjudica.llm import common, jaccard_join
from adjudica.llm.queries import llm_oracles, llm_queries


def shingle_set(text, words):
    found = (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ")
    found = [w for w in found if w]
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def expected(rows, words, percent):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=repr)


def corpus():
    """Copies, chains of near copies, one shared passage, and many near copies of one text."""
    random.seed(5)
    fresh = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    passage, base, rows = fresh(40), fresh(60), []
    rows += [(i, " ".join(fresh(random.randint(1, 80)) + passage)) for i in range(30)]
    for i in range(40, 120):
        text = base[:]
        for _ in range(random.randint(0, 5)):
            text[random.randrange(60)] = random.choice(fresh(1))
        rows.append((i, " ".join(text)))
    drifting = fresh(50)
    for i in range(150, 190):
        drifting = drifting[:]
        drifting[random.randrange(50)] = "drift" + str(i)
        rows.append((i, "  ".join(drifting)))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "One two"), (204, "one TWO"), (205, "two one"), (206, "É x y z"), (207, "é x y z")]
    rows += [(208, "same id"), (208, "same id"), (209, " ".join(base)), (209, "another text of the same id here"), (210, "another text of the same id here")]
    rows += [(None, "One two"), (None, None), (211, " ".join(fresh(3000))), (212, "a b c d e"), (213, "one two")]
    return rows


@pytest.mark.parametrize("words, percent, frequent", [(4, 85, 50), (5, 80, 3), (2, 60, 3)])
def test_against_all_pairs(spark, monkeypatch, words, percent, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)  # the way for shared shingles, or the way for rare ones
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, component_id string")
    found = jaccard_join.near_duplicates(df, words, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == expected(rows, words, percent)


def test_sending_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SENT", 2)  # beyond what is sent to the tasks
    rows = corpus()[:140]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.near_duplicates(df, 4, 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == expected(rows, 4, 85)


def test_empty(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_sql(spark, name):
    folder, duck = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = duck.execute(llm_oracles()[name])
    columns = sorted(c[0] for c in result.description)
    rows = [dict(zip([c[0] for c in result.description], r)) for r in result.fetchall()]
    df = llm_queries()[name](spark, folder)
    assert sorted(df.columns) == columns
    key = lambda r: tuple(repr(r[c]) for c in columns)
    assert sorted(key(r.asDict()) for r in df.collect()) == sorted(map(key, rows))


def test_python_gets_small_batches(spark):
    """The operator bounds the bytes of a batch by itself, whoever calls it."""
    wide = spark.range(3000).select(F.repeat(F.lit("some words "), 1000).alias("text")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    spark.conf.unset(common.BATCHES)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard_join.near_duplicates(docs).collect()) == [(1, 2, 1), (2, 2, 1)]
    assert max(r.n for r in wide.mapInArrow(sizes, "n long").collect()) < 1.1 * common.BATCH_BYTES
    spark.conf.unset(common.BATCHES)

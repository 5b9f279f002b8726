"""Collocations against counts of every phrase, and their SQL twin."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.llm import collocations as c
from adjudica.llm.queries import llm_oracles, llm_queries

SCHEMA = "doc_id long, lang string, text string"


def pieces(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def expected(rows, least, most, kept):
    f, n = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = lang if lang is not None else "und"
        for words in pieces(text):
            n[lang] += len(words)
            for i in range(len(words)):
                for size in range(1, most + 1):
                    if i + size <= len(words):
                        f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        good = [(p, a) for p, a in counts.items() if len(p) > 1 and a >= least]
        dropped = {p[i:j] for p, a in good for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and counts[p[i:j]] <= a}
        scored = []
        for p, a in good:
            if p not in dropped:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:kept])]
    return sorted(out)


def corpus():
    random.seed(4)
    vocab = [f"w{i}" for i in range(30)] + ["Été", "ÉTÉ", "É", "the", "THE", "日本", "x\u0000", " ", "a-b", "ℌ"]
    rows = []
    for i in range(150):
        words = []
        while len(words) < random.randint(1, 60):
            words += random.choice([["big", "old", "Tree", "house"], ["on", "the", "other", "hand", "side", "now"], [random.choice(vocab)], ["ha"] * random.randint(1, 6)])
            if random.random() < 0.2:
                words.append(random.choice([".", ",", "\n", "!?", ";:", "\r\n", "\x0b", "\x0c"]))
        rows.append((i, random.choice(["en", "fr", None, "en"]), random.choice([" ", "\t ", "  "]).join(words)))
    rows += [(200, "en", None), (201, None, ""), (202, "xx", " .,; "), (203, "xx", "one"), (204, "en", "big old tree house " * 3000), (204, "en", "again and again"), (None, "en", "ha ha ha")]
    return rows


@pytest.mark.parametrize("least, most, kept, shard_words, bits", [(5, 5, 2000, 1 << 21, c.BITS), (3, 5, 40, 300, 1 << 15), (3, 5, 40, 300, 1 << 22), (2, 3, 10, 900, 1 << 18), (4, 2, 50, 50, 1 << 16)])
def test_against_every_phrase(spark, least, most, kept, shard_words, bits):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], SCHEMA + ", phrase string, n int").repartition(4)
    got = c.collocations(frame, least, most, kept, shard_words, bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == expected(rows, least, most, kept)


def test_products_beyond_64_bits(spark):
    """The score of the largest counts, by the expression of the operator."""
    a, n, left, right = 99999999999, 99999999999999, 99999999999, 100000000000
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in dict(a=a, n=n, l=left, r=right).items()])
    assert row.select(F.expr(c.SCORE)).first()[0] == 1000 * a * n // (left * right)


def test_index_against_all_places():
    random.seed(1)
    text = np.array([0] + [random.randint(0, 4) for _ in range(500)] + [0])
    text = text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]
    index = c.Index.of(text, 6)
    for names, count, left, right in index.phrases(5, lambda names: np.ones(len(names), bool)):
        size = names.shape[1]
        places = defaultdict(list)
        for i in range(len(text) - size + 1):
            if (text[i : i + size] > 0).all():
                places[tuple(text[i : i + size].tolist())].append(i)
        assert len(names) == len(places)
        for name, n, lw, rw in zip(map(tuple, names.tolist()), count, left, right):
            at = places[name]
            before, after = {text[i - 1] for i in at}, {text[i + size] for i in at}
            assert (n, lw, rw) == (len(at), before.pop() if len(before) == 1 else 0, after.pop() if len(after) == 1 else 0)


def test_marks_follow_spark(spark):
    keys = [("en", b"the"), ("und", "é日".encode()), ("", b"x"), ("en", b"")]
    frame = spark.createDataFrame(keys, "lang string, phrase binary").select(c._number("lang", "phrase").alias("mark"))
    bits = c._bitmap(frame, 1 << 17)
    marks = lambda lang, words: (c._numbers(lang, words) & np.uint64((1 << c.MARK_BITS) - 1)).view(np.int64)
    assert [r["mark"] for r in frame.collect()] == [int(marks(lang, [p])[0]) for lang, p in keys]
    assert all(c._marked(bits, marks(lang, [p])).all() for lang, p in keys) and np.unpackbits(bits).sum() == 4
    assert not c._marked(bits, marks("en", [b"a", b"b"])).any()


def test_packed_counts():
    rng = np.random.default_rng(0)
    for size in (0, 1, 5000):
        marks = np.unique(rng.integers(0, 1 << c.MARK_BITS, size))
        count = rng.integers(1, 1 << 31, len(marks))
        got = c._unpacked_counts(c._packed_counts(marks, count))
        assert (got[0] == marks).all() and (got[1] == count).all()


def test_nothing_frequent_and_empty(spark):
    assert c.collocations(spark.createDataFrame([(1, "en", "a b c")], SCHEMA)).count() == 0
    assert c.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql_twin(spark, tmp_path):
    rows = corpus()
    rows += [(300 + i, "en", "Big old tree house by the river. ha ha ha") for i in range(120)] + [(500 + i, "fr", "le la le la le") for i in range(110)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = llm_queries()["op13_collocations"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == expected(rows, 100, 5, 2000)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = duck.execute(llm_oracles()["op13_collocations"])
    columns = [x[0] for x in result.description]
    assert sorted(tuple(r) for r in got.select(columns).collect()) == sorted(result.fetchall())

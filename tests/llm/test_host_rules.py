"""Host rules against plain counts and exact fractions, and their SQL twin."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb

from adjudica.llm import host_rules
from adjudica.llm.queries import llm_oracles, llm_queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_of(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    held = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    return len(words), len("".join(words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held), len(lines)


def fails(c):
    n, chars, symbols, dup, held, lines = c
    return [n < 50, 100 * held > 50 * n, chars < 3 * n or chars > 10 * n, 100 * symbols > 10 * n, 100 * dup > 30 * lines]


def expected(rows):
    counted = [(i, h, counts_of(t)) for i, h, t in rows]
    hosts = defaultdict(list)
    for _, h, c in counted:
        if h is not None:
            hosts[h].append(fails(c))
    rejected = set()
    for rule in range(5):
        sums = {h: (len(f), sum(x[rule] for x in f)) for h, f in hosts.items()}
        several = [(n, x) for n, x in sums.values() if n > 1]
        if several:
            m1 = Fraction(sum(x * 10**9 // n for n, x in several), len(several) * 10**9)
            m2 = Fraction(sum(x * (x - 1) * 10**9 // (n * (n - 1)) for n, x in several), len(several) * 10**9)
        for h, (n, x) in sums.items():
            if not several:
                rate = Fraction(1 + x, 2 + n)
            elif m2 > m1 * m1:
                weight = (m1 - m2) / (m2 - m1 * m1)
                rate = (m1 * weight + x) / (weight + n)
            else:
                rate = m1
            if rate > Fraction(1, 2):
                rejected.add(h)
    out = []
    for i, h, c in counted:
        base = fails(c)[0] or fails(c)[1]
        out.append((i, h, *c[:5], base, h in rejected, not base and h not in rejected))
    return sorted(out, key=repr), rejected


def corpus():
    random.seed(8)
    fresh = lambda n: " ".join("w" + "x" * random.randint(0, 6) + str(random.randint(0, 10**5)) for _ in range(n))
    rows = []
    for i in range(400):
        host = "hot" if i % 3 == 0 else f"h{i % 17}"
        bad = {"hot": 0.1, "h1": 0.9, "h2": 0.8, "h3": 0.55}.get(host, 0.15)
        if random.random() < bad:
            text = fresh(20) if host in ("h1", "h2", "h3") else random.choice(["same three words " * 40, fresh(60).replace("w", "$#"), "\n".join([fresh(9)] * 3 + [fresh(30)] * 3), "supercalifragilistic " * 20 + fresh(60).replace(" ", "x")])
        else:
            text = fresh(random.randint(50, 200))
        rows.append((i, host, text))
    rows += [(500, "one", fresh(10)), (501, None, fresh(70)), (502, None, None), (503, "h5", ""), (504, "h5", " \n\t\v "), (505, "", fresh(80))]
    rows += [(506, "h6", "a b c a b c d"), (507, "h6", "a a a a"), (508, "h6", "a b c d a b c e a b c"), (508, "h6", "a b c d a b c e a b c"), (None, "h7", fresh(60))]
    rows += [(509, "h8", "日本 𝔘𝔘 " * 40 + fresh(100)), (510, "h8", "x\n\nx\n x\nx \n" + fresh(60)), (511, "h9", fresh(30000)), (512, "h9", ("loop " * 30000).strip())]
    return rows


SCHEMA = "doc_id long, source string, text string"


def test_against_plain_counts(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n_words int, host string").repartition(6)
    got = host_rules.host_rules(frame)
    want, rejected = expected(rows)
    assert got.columns == ["doc_id", "host", *host_rules.COUNTS, "base_failed", "host_rejected", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {"h1", "h2"} <= rejected and not {"hot", "h4", "h5", "h10"} & rejected


def test_priors_without_spread(spark):
    """Hosts of one document, hosts that all agree, and a table of one host."""
    short, fine = "too short", " ".join(f"word{i}" for i in range(60))
    for rows in ([(1, "a", short), (2, "b", fine)], [(1, "a", fine), (2, "a", fine), (3, "b", fine), (4, "b", fine)], [(1, "a", short), (2, "a", short), (3, "a", fine)]):
        got = host_rules.host_rules(spark.createDataFrame(rows, SCHEMA))
        assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)[0]


def test_empty_table(spark):
    assert host_rules.host_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_on_executors(spark):
    plan = host_rules.document_counts(spark.createDataFrame(corpus()[:5], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sql_twin(spark, tmp_path):
    rows = [(i, h, t) for i, h, t in corpus() if i is not None and i != 508]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = llm_queries()["op12_host_rules"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = duck.execute(llm_oracles()["op12_host_rules"])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(columns).collect()) == sorted(result.fetchall())

"""Packing against a step-by-step deficit round-robin."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from adjudica.llm import packing

VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def round_robin(totals, credits, quantum):
    """(source, place in its queue) of every token in the order served."""
    names = sorted(totals)
    at, deficit, order = dict.fromkeys(names, 0), dict.fromkeys(names, 0), []
    while any(at[s] < totals[s] for s in names):
        for s, credit in zip(names, credits):
            deficit[s] += credit
            while at[s] < totals[s]:
                packet = min(quantum, totals[s] - at[s])
                if packet << packing.POINT > deficit[s]:
                    break
                deficit[s] -= packet << packing.POINT
                order += [(s, at[s] + i) for i in range(packet)]
                at[s] += packet
    return order


def test_closed_form_is_round_robin():
    random.seed(2)
    for mixture in (None, {"a": 0.5, "c": 0.1}, {"b": 3.0}):
        totals = {"a": 913, "b": 77, "c": 2050, "d": 1, "e": 128}
        plan = packing.schedule(totals, mixture, window=64, quantum=16)
        order = round_robin(totals, plan.credits.tolist(), 16)
        places = {token: n for n, token in enumerate(order)}
        assert len(order) == sum(totals.values())
        for q, s in enumerate(plan.sources):
            k = np.arange(-(-totals[s] // 16))
            found = plan.position(np.full(len(k), q), k)
            assert found.tolist() == [places[(s, int(i) * 16)] for i in k]


def test_many_sources():
    random.seed(5)
    totals = {f"s{i:05d}": random.randint(1, 90) for i in range(5000)}
    plan = packing.schedule(totals, window=1 << 17, quantum=32)
    order = round_robin(totals, plan.credits.tolist(), 32)
    places = {token: n for n, token in enumerate(order)}
    queue = np.repeat(np.arange(5000), [-(-totals[s] // 32) for s in plan.sources])
    k = np.concatenate([np.arange(-(-totals[s] // 32)) for s in plan.sources])
    assert plan.position(queue, k).tolist() == [places[(plan.sources[q], int(i) * 32)] for q, i in zip(queue, k)]


def test_windows_follow_the_mixture():
    totals = {"a": 60_000, "b": 30_000, "c": 10_000}
    plan = packing.schedule(totals, {"a": 0.2, "b": 0.2, "c": 0.6}, window=1024, quantum=128)
    order = [s for s, _ in round_robin(totals, plan.credits.tolist(), 128)]
    for at in range(0, 15_000, 1024):  # until c runs dry
        assert abs(order[: at + 1024].count("c") - 0.6 * (at + 1024)) <= 3 * 128


def test_whole_operator(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    random.seed(3)
    words = ["and", "the", "été", "\n", " ", "  ", "x1", "<|endoftext|>", "don't", "日本", "\n \n", "A.B", "\t"]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 400))), random.choice(["hot", "hot", "b", None])) for i in range(300)]
    rows += [(1000, None, "b"), (1001, "", "b"), (1002, "word " * 20_000, "b"), (1002, "word " * 20_000, "b"), (None, "no id", "hot"), (1003, "sp ace \n x  ", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumnRenamed("source", "source").repartition(5)
    pieces = packing.pack(df, VOCABULARY, RANKS).collect()
    assert packing.pack(df.limit(0), VOCABULARY, RANKS).count() == 0
    windows: dict = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.offset + p.length <= packing.WINDOW
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(windows) == list(range(len(windows)))
    for n, parts in windows.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == packing.WINDOW or n == len(windows) - 1
    texts = {(i, t): tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t, _ in rows}
    for doc, text in texts:
        if doc in (1002, None):
            continue
        mine = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in mine) == np.array(texts[(doc, text)], "<u4").tobytes()
        assert [p.start for p in mine] == np.cumsum([0] + [p.length for p in mine])[:-1].tolist()
    assert sum(p.length for p in pieces) == sum(len(texts[(i, t)]) for i, t, _ in rows)
    whole = packing.sequences(spark.createDataFrame(pieces, packing.PIECES)).collect()
    assert sum(len(w.ids) for w in whole) == 4 * sum(p.length for p in pieces)
    assert zlib.crc32(b"") == 0


def test_encoder_equals_the_tokenizer():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    encode = packing.Encoder(open(VOCABULARY, "rb").read(), open(RANKS, "rb").read())
    random.seed(4)
    for _ in range(3000):
        text = "".join(random.choices(["a", "Bc", " ", " ", "\n", "\t", "é", "'s", "9", ".", "\u00a0", "\u3000", "\x1c", "\r"], k=random.randint(0, 12)))
        assert np.frombuffer(encode(text), encode.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_the_tokenizer_is_built_for_special_texts_only():
    vocabulary, ranks = open(VOCABULARY, "rb").read(), open(RANKS, "rb").read()
    whole = Tokenizer.from_str(vocabulary.decode())
    encode, plain = packing.Encoder(vocabulary, ranks), packing.Encoder(vocabulary, None)
    for text in ("", "Some plain words.", "two\n\nlines  é"):
        assert encode(text) == plain(text) == np.array(whole.encode(text, add_special_tokens=False).ids, encode.kind).tobytes()
    assert "whole" not in vars(encode)
    special = f"before{encode.special[0]} after"
    assert encode(special) == plain(special) and "whole" in vars(encode)
    assert encode.special == [t.content for t in whole.get_added_tokens_decoder().values()]
    assert encode.wide == plain.wide == (whole.get_vocab_size() > 1 << 16)

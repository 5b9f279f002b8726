"""Ids, offsets and decoded texts against the library, also with a character map."""

from __future__ import annotations

import struct

import public_tokenizers
import pytest

from adjudica.llm.pieces import SPACE, Model, _fields, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a", "  a  b ", "a\n b", "日本 語 𝔘", f"{SPACE} a{SPACE}b", "x\u0000y", "Straße  und\tmehr", "ﬁne ＡＢ e\u0301t\u00a0e\u0301", "\u00a0\u00a0", "q" * 5000]


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(fields):
    out = b""
    for number, value in fields:
        out += varint(number << 3 | 2) + varint(len(value)) + value if isinstance(value, bytes) else varint(number << 3) + varint(value)
    return out


def compiled(entries):
    """A character map: double-array trie of the keys, then the replacements."""
    strings, values = b"", {}
    for key, text in entries.items():
        values[key] = len(strings)
        strings += text + b"\0"
    units, used = [0] * 8192, {0}

    def place(prefix, at):
        children = sorted({k[len(prefix)] for k in values if k.startswith(prefix) and len(k) > len(prefix)})
        labels = ([0] if prefix in values else []) + children
        base = next(b for b in range(1, 7000) if all((b ^ c) not in used for c in labels))
        used.update(base ^ c for c in labels)
        units[at] |= (base ^ at) << 10
        if prefix in values:
            units[at] |= 1 << 8
            units[base] = 1 << 31 | values[prefix]
        for c in children:
            units[base ^ c] = c
            place(prefix + bytes([c]), base ^ c)

    place(b"", 0)
    trie = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(trie)) + trie + strings


def with_normaliser(**settings):
    raw = open(PATH, "rb").read()
    fields = []
    at = 0
    for number, value in _fields(raw):
        fields.append((number, value))
        at += 1
    spec = message([(1, b"own"), (2, settings.get("map", b"")), (3, settings.get("dummy", 1)), (4, settings.get("extra", 0)), (5, 1)])
    return message([(n, spec if n == 3 else v) for n, v in fields])


MAP = compiled({k.encode(): v.encode() for k, v in {"ﬁ": "fi", "Ａ": "A", "e\u0301": "é", "e\u0301t": "ÉT", "\u00a0": " ", "\t": " ", "\u0000": ""}.items()})


@pytest.mark.parametrize("settings", [{}, {"map": MAP}, {"map": MAP, "extra": 1}, {"extra": 1}, {"map": MAP, "dummy": 0}])
def test_equals_library(settings):
    model = Model(with_normaliser(**settings) if settings else open(PATH, "rb").read())
    for text in TEXTS:
        ids, start, ends = model.encode(text)
        assert ids.tolist() == model.processor.encode(text), text
        assert model.decode(ids.tolist()) == model.processor.decode(ids.tolist())
        normal, source = model.normalise(text)
        if settings:
            assert normal.decode().replace(SPACE, " ") == model.processor.normalize(text).replace(SPACE, " "), text
        if len(ids):
            assert source == model.alignment(text).tolist()
            assert sorted(ends.tolist()) == ends.tolist() and ends[-1] <= len(text.encode()) and start >= 0


def test_offsets_cover_what_was_replaced():
    model = Model(with_normaliser(map=MAP))
    text = "ﬁ e\u0301t"
    normal, source = model.normalise(text)
    assert normal.decode() == f"{SPACE}fi{SPACE}ÉT"
    assert source == [0, 0, 0, 0, 0, 3, 3, 3, 4, 4, 4, len(text.encode())]  # fi: bytes 0-2; ÉT, the longest entry: bytes 4-7


def test_spans_are_the_pieces():
    model = Model(open(PATH, "rb").read())
    for text in TEXTS:
        data = text.encode()
        ids, at, ends = model.encode(text)
        for n, (i, end) in enumerate(zip(ids.tolist(), ends.tolist())):
            piece = model.bytes_of[i]
            assert data[at:end].replace(SPACE.encode(), b" ") in ([piece, piece[1:]] if n == 0 else [piece])
            at = end
        assert at == len(data) or not text


def test_rows(spark):
    rows = [(1, "a b", "i"), (2, None, "i"), (3, "", "i"), (1, "a b", "i"), (None, "c", "i"), (4, "wort " * 60_000, "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = {(r.doc_id, r.decoded): r for r in encode(df, PATH).collect()}
    assert encode(df, PATH).count() == 6 and set(found) == {(1, "a b"), (2, ""), (3, ""), (None, "c"), (4, "wort " * 60_000)}
    assert list(found[(2, "")].ids) == [] and found[(4, "wort " * 60_000)].ends[-1] == 300_000
    assert encode(df.limit(0), PATH).count() == 0

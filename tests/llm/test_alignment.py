"""Alignment against the libraries and a plain merge of each document's tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
import tokenizers

from adjudica.llm import alignment
from adjudica.llm.alignment import ByteTokens, PieceTokens, possible_pairs, token_alignment

A, B, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
ODD = [
    None, "", " ", "  a  b ", "a\n b\r\n\tc", "日本 語 𝔘 😀", "▁ written", "a▁b", "x\u0000y", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "Straße  und\tmehr", "ét é ᾳ ꙮ", "q" * 5000, " " * 3000 + "x", "one", "one", "it's we'll ’s", "ß" * 900,
]


PRINTED = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
PRINTED |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(PRINTED.values())))}


def spaced(token):
    return bytes(PRINTED[c] for c in token)


def plain(texts):
    """n_a, n_b, groups and links of every text, by the libraries on whole texts."""
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    out = []
    for text in texts:
        if not text:
            out.append((0, 0, [], []))
            continue
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xs = [spaced(a.id_to_token(i)) for i in x]
        ys = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in y)]
        if not b"".join(xs) == b"".join(ys) == (" " + text).encode():
            out.append((0, 0, [], []))
            continue
        ends = [np.cumsum([len(t) for t in s]).tolist() for s in (xs, ys)]
        after = [{end: k + 1 for k, end in enumerate(side)} for side in ends]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = after[0][end], after[1][end]
            groups.append((x[i:p], y[j:q]))
            i, j = p, q
        links = [(g[0][-1], g[1][-1]) for g in groups]
        out.append((len(x), len(y), groups, links))
    return out


def expected(rows):
    found = plain([t for _, t in rows])
    counts = Counter(link for _, _, _, links in found for link in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(rows, found):
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, len(groups), len(links), digest, sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)))
    return sorted(out, key=repr)


def corpus():
    random.seed(3)
    letters = "aeiourstln éüç"
    texts = [" ".join("".join(random.choices(letters, k=random.randint(1, 9))) for _ in range(random.randint(1, 120))) for _ in range(80)]
    texts.append(" ".join(random.choice(["the", "of", "Zürich,", "1999", "naïve"]) for _ in range(20000)))
    return list(enumerate(ODD + texts)) + [(5, "again"), (None, "no id"), (None, None)]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def test_against_the_libraries(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, links string, n_a int, pair int").repartition(5)
    want = expected(rows)
    for ranks in (RANKS, None):
        got = token_alignment(frame, A, B, ranks)
        assert got.columns == COLUMNS
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_short_stretches_and_parts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "STRETCH", 7)
    monkeypatch.setattr(alignment, "LOOK", 3)
    aligner = alignment.Aligner(*(made := [ByteTokens(open(A, "rb").read()), PieceTokens(open(B, "rb").read())]), possible_pairs(*(t.bytes_of for t in made)))
    texts = [t for _, t in corpus()]
    columns = aligner(texts, detail=True)
    for (n_a, n_b, groups, links), *got in zip(plain(texts), *(c.to_pylist() for c in columns)):
        assert got[:4] == [n_a, n_b, len(groups), len(links)]
        assert got[6] == [i for g in groups for i in g[0]] and got[7] == [i for g in groups for i in g[1]]
        keys = aligner.pairs[got[5]].tolist() if links else []
        assert keys == [a * len(aligner.b.bytes_of) + b for a, b in links]
        if groups:
            sizes = [sum(len(aligner.a.bytes_of[i]) for i in g[0]) for g in groups]
            assert got[8] == np.cumsum(sizes).tolist()


def test_possible_pairs():
    a, b = [b"the", b"e", b"he", b"x"], [b"e", b"t", b"athe", b"e", b"he"]
    want = sorted(i * 5 + j for i, x in enumerate(a) for j, y in enumerate(b) if x.endswith(y) or y.endswith(x))
    assert possible_pairs(a, b).tolist() == want


def test_empty_table(spark):
    got = token_alignment(spark.createDataFrame([], "doc_id long, text string"), A, B, RANKS)
    assert got.columns == COLUMNS and got.count() == 0
    nothing = token_alignment(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B, RANKS)
    assert sorted(map(tuple, nothing.collect())) == [(i, 0, 0, 0, 0, "", 0, 0) for i in (1, 2)]

"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B
(SentencePiece) the text, whose dummy prefix is that space, so both cut the same
bytes. Byte offsets where a token of A and one of B both end cut the tokens into
groups; the two tokens that end there are linked.

The tokens are merged in lockstep: one pair of pointers for each document of a
batch, all held in two NumPy vectors. A step compares the ends of all pairs at
once, emits a link and a cut where they are equal, moves the pointers that are
behind, and drops the documents that are finished. Long documents enter as several
stretches between offsets where both tokenizers end, so the vectors stay wide.

Two linked tokens end together, so the bytes of the shorter one end those of the
longer one. The pairs that can occur follow from the two vocabularies alone
(``possible_pairs``): counts by pair have a size that no corpus exceeds. They are
added up in dense vectors by the tasks, summed by Spark, and sent to the tasks
that rate the links.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import staged, texts
from adjudica.llm.packing import PATTERN

SPACE = "▁"  # SentencePiece writes a space so
STRETCH = 512  # tokens after which a document is cut at the next common end
LOOK = 64  # tokens in which that end is looked for
CHARS, ROWS = 1 << 20, 512  # characters and documents merged at once
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>"
DETAIL = ", a_ids array<int>, b_ids array<int>, ends array<long>"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")
#: Letters on which the two libraries of tokenizer A could differ by Unicode version, and long blanks.
_UNUSUAL = re.compile("[^\u0000-ɏ -⁯]|\\s{1000}")


def _byte_characters() -> dict[str, int]:
    """The character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """Tokenizer A: ids and the bytes of each id; special tokens in a text are plain text.

    ``ranks``, the same vocabulary for the faster library, is used for texts in
    usual characters.
    """

    def __init__(self, vocabulary: bytes, ranks: bytes | None = None):
        self.whole = tokenizers.Tokenizer.from_str(vocabulary.decode())
        self.whole.encode_special_tokens = True
        byte = _byte_characters()
        added = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        names = sorted(self.whole.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.bytes_of = [n.encode() if n in added else bytes(map(byte.__getitem__, n)) for n, _ in names]
        self.fast = None
        if ranks is not None:
            vocabulary = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
            self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or _UNUSUAL.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokens:
    """Tokenizer B: ids and the bytes of each id."""

    def __init__(self, model: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_of = []
        for i in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(i)
            byte = _BYTE_PIECE.match(piece) if self.processor.is_byte(i) else None
            self.bytes_of.append(bytes([int(byte[1], 16)]) if byte else b"" if self.processor.is_control(i) else piece.replace(SPACE, " ").encode())

    def __call__(self, text: str) -> list[int]:
        return self.processor.encode(text, num_threads=1)


def possible_pairs(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """Sorted ``a * len(b_bytes) + b`` of all id pairs of which one's bytes end the other's."""
    by_bytes = defaultdict(list)
    for b, data in enumerate(b_bytes):
        by_bytes[data].append(b)
    a_of = defaultdict(list)
    found = []
    for a, data in enumerate(a_bytes):
        a_of[data].append(a)
        found += [a * len(b_bytes) + b for cut in range(len(data)) for b in by_bytes.get(data[cut:], ())]
    for b, data in enumerate(b_bytes):
        found += [a * len(b_bytes) + b for cut in range(1, len(data)) for a in a_of.get(data[cut:], ())]
    return np.unique(np.array(found, np.int64))


def _stretches(a_end: np.ndarray, b_end: np.ndarray, a_off: np.ndarray, b_off: np.ndarray) -> list[np.ndarray]:
    """First and last + 1 token of A and of B for every stretch.

    Ends are byte offsets in all documents joined, so they rise throughout.
    """
    a_cuts, b_cuts = [a_off], [b_off]
    sizes = np.diff(a_off)
    long = np.flatnonzero(sizes > STRETCH + LOOK)
    if len(long):
        starts = np.concatenate([np.arange(a_off[d] + STRETCH, a_off[d + 1] - LOOK, STRETCH) for d in long])
        near = starts[:, None] + np.arange(LOOK)
        at = np.minimum(np.searchsorted(b_end, a_end[near]), len(b_end) - 1)
        both = b_end[at] == a_end[near]
        has = both.any(axis=1)
        first = both.argmax(axis=1)[has]
        rows = np.flatnonzero(has)
        a_cuts.append(near[rows, first] + 1)
        b_cuts.append(at[rows, first] + 1)
    a_cuts, b_cuts = np.unique(np.concatenate(a_cuts)), np.unique(np.concatenate(b_cuts))
    return [a_cuts[:-1], a_cuts[1:], b_cuts[:-1], b_cuts[1:]]


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_at: np.ndarray, a_stop: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of the tokens that end together, in order.

    Each sequence has its tokens of A from ``a_at`` to ``a_stop`` and those of B
    from ``b_at`` on, over the same bytes.
    """
    a_links, b_links = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    i, j = a_at, b_at
    while len(i):
        a, b = a_end[i], b_end[j]
        met = a == b
        if met.any():
            a_links.append(i[met])
            b_links.append(j[met])
        i, j = i + (a <= b), j + (b <= a)
        unfinished = i < a_stop
        if not unfinished.all():
            i, j, a_stop = i[unfinished], j[unfinished], a_stop[unfinished]
    return np.sort(np.concatenate(a_links)), np.sort(np.concatenate(b_links))


def _decimals(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 to count - 1, left-justified in rows with one place more, and their number."""
    written = np.array([str(n) for n in range(count)], "S")
    table = np.zeros((count, written.itemsize + 1), np.uint8)
    table[:, :-1] = written.view(np.uint8).reshape(count, -1)
    return table, (table != 0).sum(axis=1)


class Aligner:
    """Aligns batches of texts; its tables are made once in a task."""

    def __init__(self, a: ByteTokens, b: PieceTokens, pairs: np.ndarray):
        self.a, self.b, self.pairs = a, b, pairs
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (a, b))
        self.digits, self.places = _decimals(max(len(a.bytes_of), len(b.bytes_of)))

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both; none where their bytes are not those of a space and the text."""
        if not text or SPACE in text:
            return [], []  # a written space sign comes back as a space of another size
        whole = " " + text
        a, b = self.a(whole), self.b(text)
        data = whole.encode()
        if b"".join(map(self.a.bytes_of.__getitem__, a)) != data or b"".join(map(self.b.bytes_of.__getitem__, b)) != data:
            return [], []
        return a, b

    def __call__(self, batch: list[str | None], detail: bool = False) -> list:
        """Columns of ALIGNED but the first (and of DETAIL) for some texts."""
        found = [self.tokens(t) for t in batch]
        a_ids, b_ids = (np.fromiter((i for f in found for i in f[side]), np.int64) for side in (0, 1))
        n_a, n_b = (np.array([len(f[side]) for f in found], np.int64) for side in (0, 1))
        a_off, b_off = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        a_end, b_end = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        if len(a_ids):
            a_at, a_stop, b_at, _ = _stretches(a_end, b_end, a_off, b_off)
            a_last, b_last = lockstep(a_end, b_end, a_at, a_stop, b_at)
        else:
            a_last = b_last = np.empty(0, np.int64)
        of_doc = np.searchsorted(a_last, a_off)  # groups before each document
        n = np.diff(of_doc)
        keys = a_ids[a_last] * len(self.b_sizes) + b_ids[b_last]
        links = np.searchsorted(self.pairs, keys)
        if len(keys) and (self.pairs[np.minimum(links, len(self.pairs) - 1)] != keys).any():
            raise ValueError("tokens that end together without a common ending")
        columns = [
            pa.array(n_a), pa.array(n_b), pa.array(n), pa.array(n),
            pa.array(self._digests(a_ids, b_ids, a_last, b_last, of_doc), pa.string()),
            pa.ListArray.from_arrays(pa.array(of_doc, pa.int32()), pa.array(links, pa.int32())),
        ]
        if detail:
            base = np.concatenate([[0], a_end])[a_off[:-1]]
            columns += [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32())) for off, ids in ((a_off, a_ids), (b_off, b_ids))]
            columns.append(pa.ListArray.from_arrays(pa.array(of_doc, pa.int32()), pa.array(a_end[a_last] - np.repeat(base, n), pa.int64())))
        return columns

    def _digests(self, a_ids: np.ndarray, b_ids: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, of_doc: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups, ``a1,a2|b1;a3|b2,b3``."""
        a_size, b_size = (np.diff(np.concatenate([[-1], last])) for last in (a_last, b_last))
        # Tokens in the order in which they are written: each group's of A, then its of B.
        group = np.arange(len(a_last))
        a_place = np.arange(len(a_ids)) + np.repeat(np.cumsum(b_size) - b_size, a_size)
        b_place = np.arange(len(b_ids)) + np.repeat(np.cumsum(a_size), b_size)
        ids = np.empty(len(a_ids) + len(b_ids), np.int64)
        ids[a_place], ids[b_place] = a_ids, b_ids
        after = np.full(len(ids), ord(","), np.uint8)
        after[a_place[a_last]], after[b_place[b_last]] = ord("|"), ord(";")
        places = self.places[ids]
        written = self.digits[ids]
        written[np.arange(len(ids)), places] = after
        data = written[np.arange(written.shape[1]) <= places[:, None]].tobytes()
        byte = np.concatenate([[0], np.cumsum(places + 1)])
        # A document's bytes start where its first group does and leave out the last separator.
        tokens = np.concatenate([[0], np.cumsum(a_size + b_size)])[of_doc] if len(group) else np.zeros(len(of_doc), np.int64)
        at = byte[tokens]
        return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist())]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by about CHARS characters and at most ROWS; a longer text is one part."""
    for batch in batches:
        sizes = [len(t or "") for t in batch["text"].to_pylist()]
        start = chars = 0
        for at, size in enumerate(sizes):
            if at > start and (chars + size > CHARS or at - start >= ROWS):
                yield batch.slice(start, at - start)
                start, chars = at, 0
            chars += size
        if start < len(sizes):
            yield batch.slice(start)


class Tokenizers:
    """The files of both tokenizers as tasks get them, and the pairs they can link."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, a_ranks_path: str | None = None):
        def read(path: str | None) -> bytes | None:
            if path is None:
                return None
            with open(path, "rb") as file:
                return file.read()

        a, ranks, b = read(a_path), read(a_ranks_path), read(b_path)
        a_bytes, b_bytes = ByteTokens(a).bytes_of, PieceTokens(b).bytes_of
        self.pairs = possible_pairs(a_bytes, b_bytes)
        self.b_count = len(b_bytes)
        self.sent = docs.sparkSession.sparkContext.broadcast((a, ranks, b, self.pairs))  # vocabulary files


def align(docs: DataFrame, files: Tokenizers, detail: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links) of every row.

    ``links`` has, for each link in order, the place of its id pair in
    ``files.pairs``. With ``detail`` the ids of both tokenizers (a_ids, b_ids) and
    the byte offset at which each group ends follow. Whole texts are aligned.
    A text that is null, empty, or whose tokens' bytes differ from a space and the
    text (it holds U+2581) has no tokens: zeros, an empty digest, empty lists.
    Repeated rows and null ids stay; other columns are not read; an empty table
    gives none.
    """
    sent = files.sent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, ranks, b, pairs = sent.value
        aligner = Aligner(ByteTokens(a, ranks), PieceTokens(b), pairs)
        names = [f.split()[0] for f in (ALIGNED + DETAIL).split(", ")]
        for part in _parts(batches):
            columns = [part["doc_id"], *aligner(part["text"].to_pylist(), detail)]
            yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return texts(docs).mapInArrow(run, ALIGNED + (DETAIL if detail else ""))


def pair_counts(aligned: DataFrame, files: Tokenizers) -> np.ndarray:
    """How many links of all documents hold each pair of ``files.pairs``.

    A task adds up its links in one vector; Spark sums what the tasks found. The
    result has one number for each possible pair, whatever the corpus.
    """
    size = len(files.pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch["links"].flatten().to_numpy(), minlength=size)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(total[pair], pa.int64())], names=["pair", "n"])

    sums = aligned.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)
    counts[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return counts


def best_pairs(pairs: np.ndarray, counts: np.ndarray, b_count: int) -> np.ndarray:
    """Whether a pair's count is the highest of its id of B."""
    most = np.zeros(b_count, np.int64)
    np.maximum.at(most, pairs % b_count, counts)
    return (counts > 0) & (counts == most[pairs % b_count])


def rated(aligned: DataFrame, files: Tokenizers) -> DataFrame:
    """Adds n_best (links whose pair is the most frequent of its id of B, ties
    included) and count_sum (the counts of all its links) to the aligned documents."""
    counts = pair_counts(aligned, files)
    sent = aligned.sparkSession.sparkContext.broadcast((counts, best_pairs(files.pairs, counts, files.b_count)))

    def totals(batch: pa.RecordBatch, of_pair: np.ndarray) -> pa.Array:
        links = batch["links"]
        sums = np.concatenate([[0], np.cumsum(of_pair[links.flatten().to_numpy()])])
        size = np.concatenate([[0], np.cumsum(links.value_lengths().to_numpy())])
        return pa.array(sums[size[1:]] - sums[size[:-1]], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = sent.value
        for batch in batches:
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != "links"]
            names = [name for name in batch.schema.names if name != "links"]
            yield pa.RecordBatch.from_arrays([*columns, totals(batch, best), totals(batch, counts)], names=[*names, "n_best", "count_sum"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema.fields if f.name != "links")
    return aligned.mapInArrow(run, schema + ", n_best long, count_sum long")


def token_alignment(docs: DataFrame, a_path: str, b_path: str, a_ranks_path: str | None = None, detail: bool = False) -> DataFrame:
    """Aligned and rated documents: ``align`` without ``links``, then n_best, count_sum.

    The texts are encoded once; what ``align`` gives is written to the shared folder
    and read twice, to count the pairs and to rate the links.
    """
    files = Tokenizers(docs, a_path, b_path, a_ranks_path)
    return rated(staged(align(docs, files, detail), "aligned"), files)

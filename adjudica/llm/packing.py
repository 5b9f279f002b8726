"""Mixture-controlled packing by deficit round-robin.

Every source is a queue of its documents' tokens. A round gives each queue a
credit: its target share of one window. A queue spends credit in quanta; what is
left of its credit, the deficit, is carried to the next round, across windows and
partitions, so a source is never more than a quantum away from its target. When a
queue runs dry the others go on at their own proportions and fill its room.

Since all queues are full at the start, the round in which quantum k of a source
is served has a closed form: the first round in which the credit so far covers
it. So is the number of tokens all other queues were served before it. Tasks
therefore place their documents on their own, given one running total for each
(input partition, source) and one total for each source; nothing is simulated in
sequence and the tokens are never shuffled.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm.common import staged

WINDOW = 1024
QUANTUM = 128  # tokens a queue is served at once
POINT = 16  # binary places of a credit
END_ID = 0  # after every document
ROWS = 512  # documents of one result batch
TABLE = 1 << 19  # quanta times sources placed at once
TOKENS = "part int, doc_id long, source string, at long, n long, ids binary"
PIECES = "doc_id long, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: The pattern that cuts a text into words before byte-level BPE; a fixed value of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of texts as little-endian unsigned 16- or 32-bit bytes.

    The vocabulary's ranks encode a whole text at once; without ranks, or where a
    text has a special token, the tokenizer itself does. It takes twice the memory
    of the ranks and is only built for such a text.
    """

    def __init__(self, vocabulary: bytes, ranks: bytes | None):
        self.vocabulary, stated = vocabulary, json.loads(vocabulary)
        self.special = [t["content"] for t in stated["added_tokens"]]
        names = stated["model"]["vocab"]  # with numbers, or a list of (name, score)
        self.wide = len({*(names if isinstance(names, dict) else (n for n, _ in names)), *self.special}) > 1 << 16
        self.kind = np.dtype("<u4" if self.wide else "<u2")
        self.fast = None
        if ranks is not None:
            pairs = (line.split() for line in ranks.splitlines())
            self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})

    @cached_property
    def whole(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_str(self.vocabulary.decode())

    def __call__(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, self.kind).tobytes()


def tokens(docs: DataFrame, vocabulary_path: str, ranks_path: str | None = None) -> DataFrame:
    """(part, doc_id, source, at, n, ids) of every row: its token ids with END_ID, and
    how many tokens of its source come before it in its input partition.

    Null texts are empty, a null source is the queue named by the empty text.
    ``ranks_path`` is the same vocabulary as ranks, which encodes faster.
    """
    context = docs.sparkSession.sparkContext
    with open(vocabulary_path, "rb") as file:
        vocabulary = context.broadcast(file.read())
    ranks = None
    if ranks_path is not None:
        with open(ranks_path, "rb") as file:
            ranks = file.read()
    ranks = context.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = Encoder(vocabulary.value, ranks.value), TaskContext.get().partitionId()
        end = np.array([END_ID], encode.kind).tobytes()
        seen: dict[str, int] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                ids = [encode(t or "") + end for t in rows["text"].to_pylist()]
                at = []
                for source, data in zip(rows["source"].to_pylist(), ids):
                    at.append(seen.get(source, 0))
                    seen[source] = at[-1] + len(data) // encode.kind.itemsize
                n = [len(data) // encode.kind.itemsize for data in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), rows["doc_id"], rows["source"], pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "doc_id", "source", "at", "n", "ids"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, TOKENS)


@dataclass(frozen=True)
class Schedule:
    """When the tokens of each queue are served."""

    sources: list[str]
    totals: np.ndarray
    credits: np.ndarray  # of a round, in units of 2^-POINT tokens
    quantum: int

    def position(self, queue: np.ndarray, quanta: np.ndarray) -> np.ndarray:
        """Place of the first token of each quantum among all tokens served.

        Quanta by sources, a bounded piece of that table at a time.
        """
        place = np.empty(len(queue), np.int64)
        names = np.arange(len(self.sources))
        rows = max(1, TABLE // max(1, len(names)))
        for at in range(0, len(queue), rows):
            own, k = queue[at : at + rows], quanta[at : at + rows]
            needed = np.minimum((k + 1) * self.quantum, self.totals[own])
            # The first round in which the queue's credit covers the quantum; later queues were served up to the one before.
            rounds = -(-(needed << POINT) // self.credits[own])
            credit = (rounds[:, None] - (names > own[:, None])) * self.credits >> POINT
            served = np.where(credit >= self.totals, self.totals, credit // self.quantum * self.quantum)
            served[np.arange(len(own)), own] = k * self.quantum
            place[at : at + rows] = served.sum(1)
        return place


def schedule(totals: dict[str, int], mixture: dict[str, float] | None = None, window: int = WINDOW, quantum: int = QUANTUM) -> Schedule:
    """Credits from target shares: those of ``mixture``, and for sources it does not
    name their share of all tokens. A source always gets some credit."""
    names = sorted(totals)
    every = max(1, sum(totals.values()))
    shares = np.array([max(0.0, (mixture or {}).get(s, totals[s] / every)) for s in names])
    shares = shares / (shares.sum() or 1.0)
    credits = np.maximum(1, np.round(shares * window * (1 << POINT))).astype(np.int64)
    return Schedule(names, np.array([totals[s] for s in names], np.int64), credits, quantum)


def pack(
    docs: DataFrame, vocabulary_path: str, ranks_path: str | None = None, mixture: dict[str, float] | None = None,
    window: int = WINDOW, quantum: int = QUANTUM,
) -> DataFrame:
    """Pieces of all documents, each in its place in a window.

    (doc_id, source, start, length, ids, doc_tokens, sequence_id, offset): ``ids``
    are little-endian unsigned 32-bit, ``start`` counts the document's ids before
    the piece, ``doc_tokens`` has its END_ID. All windows but the last are full.
    A document follows its own order within its source. Repeated rows are packed
    each for itself, null and empty texts as their END_ID alone, a null id stays
    null, and an empty table gives no pieces. Other columns are not looked at. One
    total for each source is sent to all tasks: a mixture is stated by source.
    """
    rows = staged(tokens(docs, vocabulary_path, ranks_path), "tokens")
    sums = staged(rows.groupBy("part", "source").agg(F.sum("n").alias("n")), "token-sums")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", "source", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    totals = {r["source"]: r["n"] for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    plan = schedule(totals, mixture, window, quantum)
    placed = rows.join(bases, ["part", "source"]).select("doc_id", "source", (F.col("at") + F.col("base")).alias("at"), "n", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queues = {s: i for i, s in enumerate(plan.sources)}
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                yield _place(batch.slice(first, ROWS), plan, queues, window)

    return placed.mapInArrow(run, PIECES)


def _place(rows: pa.RecordBatch, plan: Schedule, queues: dict[str, int], window: int) -> pa.RecordBatch:
    """The pieces of some documents."""
    at, n = rows["at"].to_numpy(), rows["n"].to_numpy()
    queue = np.array([queues[s] for s in rows["source"].to_pylist()], np.int64)
    q = plan.quantum
    first, last = at // q, (at + n - 1) // q
    counts = last - first + 1
    doc = np.repeat(np.arange(len(n)), counts)
    k = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.maximum(k * q, at[doc])
    end = np.minimum((k + 1) * q, (at + n)[doc])
    place = plan.position(queue[doc], k) + begin - k * q
    # A stretch that reaches into further windows is cut at their starts.
    cuts = (place + end - begin - 1) // window - place // window + 1
    part = np.repeat(np.arange(len(doc)), cuts)
    nth = np.arange(len(part)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    low = np.maximum(place[part], (place[part] // window + nth) * window)
    high = np.minimum((place + end - begin)[part], (place[part] // window + nth + 1) * window)
    doc, start = doc[part], begin[part] + low - place[part] - at[doc[part]]
    # Neighbouring stretches of a document that also meet in a window are one piece.
    joins = np.concatenate([[False], (doc[1:] == doc[:-1]) & (low[1:] == high[:-1]) & (low[1:] % window != 0)])
    heads = np.flatnonzero(~joins)
    tails = np.concatenate([heads[1:], [len(doc)]]) - 1
    doc, start, low, high = doc[heads], start[heads], low[heads], high[tails]
    sizes = {len(d) // c for d, c in zip(rows["ids"].to_pylist(), n.tolist())}
    data = np.frombuffer(b"".join(rows["ids"].to_pylist()), f"<u{sizes.pop() if sizes else 4}").astype("<u4")
    length = high - low
    ids = pa.Array.from_buffers(
        pa.binary(), len(length), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(length * 4)]).astype(np.int32)), pa.py_buffer(data)]
    )
    columns = [rows["doc_id"].take(pa.array(doc)), rows["source"].take(pa.array(doc)), start, length, ids, n[doc], low // window, low % window]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], schema=_PIECES)


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, documents): the windows put together, at most WINDOW tokens each."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return pieces.groupBy("sequence_id").agg(inside.alias("_p")).select(
        "sequence_id",
        F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("_p", lambda p: p["doc_id"]).alias("documents"),
    )

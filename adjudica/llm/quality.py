"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is cut into blocks, every block is compressed with either
dictionary, and the difference of the two sizes over the raw size says which
kind of text it resembles. A logistic curve fitted on other labelled rows turns
that into a score. Blocks keep the dictionaries in play over very long texts,
which would otherwise be compressed from their own earlier lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import class_sizes, few, fold, rows_where, texts, whole_texts

PER_CLASS = 1500  # labelled rows of each class to learn from: half for the dictionaries, half for the curve
SAMPLE_BYTES = 1 << 24  # of all training texts of a class, whole ones; the longest go where they are more
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 1024
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float


def _blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


class _Sizes:
    """Compressed-size difference of texts; one per task, as compressors are not sent around."""

    def __init__(self, good: bytes, bad: bytes):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
            kind.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=kind, write_checksum=False, write_content_size=False)

        self.good, self.bad = compressor(good), compressor(bad)

    def difference(self, text: str | None) -> float:
        """(size with the bad dictionary - size with the good one) / raw size; 0 without text."""
        data = (text or "").encode()
        if not data:
            return 0.0
        blocks = _blocks(data)
        bad = sum(len(self.bad.compress(b)) for b in blocks)
        return (bad - sum(len(self.good.compress(b)) for b in blocks)) / len(data)


def _dictionary(rows: list[str]) -> bytes:
    blocks = [b for text in rows for b in _blocks(text.encode())]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on: use it as it is
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b"\n" * 8


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic curve, by Newton steps with a little ridge."""
    scale = float(np.std(x)) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], 1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * weights
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights += np.clip(step, -5, 5)
    return float(weights[0] / scale), float(weights[1])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> QualityModel:
    """Learn from at most PER_CLASS labelled rows of each class (SAMPLE_BYTES of whole texts).

    The curve weights the sample to the classes' shares of all labels. Null labels
    and null texts teach nothing. With no row of a class its
    dictionary is empty text and the curve is flat.
    """
    label = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    label = label.where("label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    # The sample is picked from the labels and sent to the texts, of which none is shuffled.
    rows = whole_texts(texts(docs).where("text is not null"), few(label, PER_CLASS, "label"), "label", SAMPLE_BYTES)
    rows = sorted(rows.collect(), key=lambda r: (r["label"], hash((r["doc_id"], 7)), r["doc_id"]))
    kinds = {k: [r["text"] for r in rows if r["label"] == k] for k in (0, 1)}
    first = {k: kinds[k][: len(kinds[k]) // 2] or kinds[k] for k in (0, 1)}
    rest = {k: kinds[k][len(kinds[k]) // 2 :] for k in (0, 1)}
    good, bad = _dictionary(first[1]), _dictionary(first[0])
    sizes = _Sizes(good, bad)
    x = np.array([sizes.difference(t) for k in (0, 1) for t in rest[k]])
    y = np.array([float(k) for k in (0, 1) for _ in rest[k]])
    sizes_of = class_sizes(label)
    weight = np.array([sizes_of[k] / len(rest[k]) for k in (0, 1) for _ in rest[k]])
    slope, offset = _curve(x, y, weight / weight.mean()) if len(set(y)) == 2 else (0.0, 0.0)
    return QualityModel(good, bad, slope, offset)


def _judge(model: QualityModel):
    """A function from texts to their scores; made in each task."""
    sizes = _Sizes(model.good, model.bad)

    def judge(found: list[str | None]) -> np.ndarray:
        x = np.array([sizes.difference(t) for t in found], float)
        return 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -30, 30)))

    return judge


def quality_scores(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, whole texts.

    Null and empty texts have difference 0 and the curve's value there. Repeated
    rows stay; a null id keeps a null id and counts as not held out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(judge(batch["text"].to_pylist()))], names=["doc_id", "score"])

    scored = texts(docs).mapInArrow(score, "doc_id long, score double")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_rows(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that score at least the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def accepts_of():
        judge = _judge(sent.value)
        return lambda found: judge(found) >= threshold

    return rows_where(docs, text_col, accepts_of)


def learnable(df: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Rows a model may learn from: those outside the held-out fold."""
    return df.where(fold("doc_id", folds) != held_out)

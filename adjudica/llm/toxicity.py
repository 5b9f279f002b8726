"""Toxicity by gradient-boosted trees over dense features.

Features of a whole text: density of lexicon words and of lexicon stems, there and
in the densest stretch of words, lexicon words near second-person words, capitals, punctuation, repeated marks and
obfuscated spellings. The lexicon is a short list of insults plus the words and
stems that labelled rows show to be telling. Spark's boosted trees give a raw
score and isotonic regression, fitted on other rows, calibrates it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import class_sizes, few, fold, staged, texts, whole_texts

PER_CLASS = 2500  # labelled rows of each class to learn from: two thirds for lexicon and trees, the rest to calibrate
SAMPLE_BYTES = 1 << 24  # of all training texts of a class, whole ones; the longest go where they are more
LEXICON_SIZE = 600
STEM_CHARS = 4
LEAST_DOCS = 5  # toxic training rows a lexicon entry must be in
LEAST_RATIO = 8.0  # times as frequent among toxic rows
NEAR = 4  # words between an insult and a second-person word
TREES, DEPTH = 20, 3
THRESHOLD = 0.5
CHUNK = 1 << 20  # characters read at once
STRETCH = 128  # words of which the densest stretch is a feature
SEED_WORDS = frozenset("idiot moron stupid trash scum loser pathetic worthless disgusting clown fool dumb".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre usted tú ti vosotros".split())
NAMES = ["words", "lexicon", "lexicon_max", "stems", "stems_max", "seeds", "near_you", "you", "capitals", "shouted", "marks", "repeats", "disguised"]
_WORD = re.compile(r"\w+(?:[@$*!|.\-]\w+)*\$?")
_DISGUISE = str.maketrans("@43105$7!|", "aaeiosstii")  # one letter for each mark


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]


def _parts(text: str) -> Iterator[str]:
    """The text in parts of about CHUNK characters, cut between words."""
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and not text[end].isspace() and end < at + 2 * CHUNK:
            end += 1
        yield text[at:end]
        at = end


def _spelling(word: str) -> tuple[str, bool]:
    """The word in lower case, marks and digits between letters read as letters."""
    low = word.lower()
    if low.isalpha():
        return low, False
    read = re.sub(r"[^\w]|\d|_", "", low.translate(_DISGUISE))
    return read, any(c.isalpha() for c in low)


HIT, SEED, DISGUISED, YOU, STEM, SHOUTED = 1, 2, 4, 8, 16, 32
UPPER, LETTER, MARK = 1, 2, 4
REMEMBERED = 1 << 17  # words a task remembers before it starts anew


class Flags(dict):
    """What a word is, as a sum of the flags above."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        low, odd = _spelling(word)
        found = SHOUTED * (len(word) > 1 and word.isupper()) + YOU * (low in SECOND_PERSON) + STEM * (low[:STEM_CHARS] in self.lexicon.stems)
        if low in self.lexicon.words or low in SEED_WORDS:
            found += HIT + SEED * (low in SEED_WORDS) + DISGUISED * odd
        self[word] = found
        return found


def _kind(c: str) -> int:
    return UPPER * c.isupper() + LETTER * c.isalpha() + MARK * (not c.isalnum() and not c.isspace() and c != "_")


_KINDS = np.array([_kind(chr(c)) for c in range(1 << 16)] + [0], np.uint8)  # beyond the basic plane: none


def _near(hits: np.ndarray, others: np.ndarray) -> int:
    """Of the places ``hits``, those with one of ``others`` at most NEAR words before."""
    before = np.searchsorted(others, hits) - 1
    return int(((before >= 0) & (hits - others[before] <= NEAR)).sum()) if len(others) else 0


def _densest(marked: np.ndarray) -> float:
    """The largest share of marked words in a stretch of the text; 0 without words."""
    if not len(marked):
        return 0.0
    starts = np.arange(0, len(marked), STRETCH)
    counts = np.add.reduceat((marked != 0).astype(np.int64), starts)
    return float((counts / np.maximum(np.minimum(len(marked) - starts, STRETCH), 20)).max())


def dense(text: str | None, flags: Flags) -> list[float]:
    """The features of one text, in the order of NAMES; all 0 without words."""
    words = hits = stems = seeds = near = you = shouted = upper = letters = marks = repeats = disguised = 0
    chars = 0
    best = best_stems = 0.0
    for part in _parts(text or ""):
        found = np.frombuffer(bytes(map(flags.__getitem__, _WORD.findall(part))), np.uint8)
        hit, yours = np.flatnonzero(found & HIT), np.flatnonzero(found & YOU)
        part_stems = int(np.count_nonzero(found & STEM))
        words, hits, stems, you = words + len(found), hits + len(hit), stems + part_stems, you + len(yours)
        seeds += int(np.count_nonzero(found & SEED))
        disguised += int(np.count_nonzero(found & DISGUISED))
        shouted += int(np.count_nonzero(found & SHOUTED))
        near += _near(hit, yours) + _near(yours, hit)
        best, best_stems = max(best, _densest(found & HIT)), max(best_stems, _densest(found & STEM))
        codes = np.minimum(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4"), 1 << 16)
        kinds = _KINDS[codes]
        chars += len(codes)
        upper += int(np.count_nonzero(kinds & UPPER))
        letters += int(np.count_nonzero(kinds & LETTER))
        marks += int(np.count_nonzero(kinds & MARK))
        repeats += int(np.count_nonzero((kinds[1:] & MARK) & (codes[1:] == codes[:-1]) * MARK))
    n, c = max(words, 1), max(chars, 1)
    return [
        float(np.log1p(words)), hits / n, best, stems / n, best_stems, seeds / n, near / n, you / n,
        upper / max(letters, 1), shouted / n, marks / c, repeats / c, disguised / n,
    ]


def with_features(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, features array) of every row."""
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)  # at most twice LEXICON_SIZE entries

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = Flags(sent.value)
        for batch in batches:
            found = [dense(t, flags) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "features"])

    return rows.select("doc_id", "text").mapInArrow(extract, "doc_id long, features array<double>")


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """The words and stems of (doc_id, text, label) that are telling of label 1."""
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))
    stems = F.array_distinct(F.transform(words, lambda w: F.substring(w, 1, STEM_CHARS)))
    entries = rows.select(
        "label", F.explode(F.concat(F.transform(words, lambda w: F.concat(F.lit("w"), w)), F.transform(stems, lambda s: F.concat(F.lit("s"), s)))).alias("entry")
    )
    counts = entries.groupBy("entry").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    ratio = ((F.col("bad") + 0.5) / (toxic + 1)) / ((F.col("good") + 0.5) / (clean + 1))
    told = counts.where((F.col("bad") >= LEAST_DOCS) & (ratio >= LEAST_RATIO))
    kept = lambda kind: told.where(F.col("entry").startswith(kind)).orderBy(F.col("bad").desc(), "entry").limit(LEXICON_SIZE)
    found = [r["entry"] for r in kept("w").union(kept("s")).select("entry").collect()]
    return Lexicon(frozenset(e[1:] for e in found if e[0] == "w"), frozenset(e[1:] for e in found if e[0] == "s"))


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    bounds: list[float]  # isotonic curve: raw score ...
    values: list[float]  # ... and calibrated score


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> ToxicityModel:
    """Learn from at most PER_CLASS labelled rows of each class (SAMPLE_BYTES of whole texts).

    Null labels and texts teach nothing; with one class only, every score is the
    share of label 1 (0 without labels).
    """
    label = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    label = label.where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    # The sample is picked from the labels and sent to the texts, of which none is shuffled.
    rows = whole_texts(texts(docs).where("text is not null"), few(label, PER_CLASS, "label"), "label", SAMPLE_BYTES)
    rows = staged(rows, "toxicity-sample")
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) > 0
    fit, rest = rows.where(part), rows.where(~part)
    both = {r["label"] for r in fit.select("label").distinct().collect()} & {r["label"] for r in rest.select("label").distinct().collect()}
    if len(both) < 2:
        share = rows.agg(F.avg("label")).first()[0] or 0.0
        return ToxicityModel(Lexicon(frozenset(), frozenset()), None, [0.0], [float(share)])
    lexicon = learn_lexicon(fit)
    table = staged(with_features(rows, lexicon).join(rows.select("doc_id", "label"), "doc_id"), "toxicity-features").coalesce(1)
    table = table.withColumn("x", array_to_vector("features")).orderBy("doc_id")
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, cacheNodeIds=False).fit(
        table.where(part)
    )
    # The calibration rows are weighted to the classes' shares of all labels.
    every, here = class_sizes(label), class_sizes(rest)
    weight = F.when(F.col("label") == 1, every[1] / here[1]).otherwise(every[0] / here[0]).alias("weight")
    scored = trees.transform(table.where(~part))
    raw = scored.select(F.col("label").cast("double").alias("label"), weight, vector_to_array("probability")[1].alias("raw"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(raw)
    return ToxicityModel(lexicon, trees, [float(b) for b in curve.boundaries], [float(v) for v in curve.predictions])


def toxicity_scores(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, whole texts.

    Null and empty texts have features 0 and the score of those. Repeated rows
    stay; a null id stays null and counts as not held out.
    """
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    rows = with_features(texts(docs), model.lexicon)
    if model.trees is None:
        scored = rows.select("doc_id", F.lit(model.values[0]).alias("score"))
    else:
        raw = model.trees.transform(rows.withColumn("x", array_to_vector("features"))).select("doc_id", vector_to_array("probability")[1].alias("raw"))
        scored = raw.select("doc_id", _calibrated("raw", model.bounds, model.values).alias("score"))
    return scored.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _calibrated(raw: str, bounds: list[float], values: list[float]):
    """Piecewise linear through the isotonic points, flat beyond them."""
    points: list[tuple[float, float]] = []
    for b, v in zip(bounds, values):
        if points and points[-1][0] == b:
            points[-1] = (b, v)
        else:
            points.append((b, v))
    x = F.col(raw)
    found = F.when(x <= points[0][0], F.lit(points[0][1]))
    for (b0, v0), (b1, v1) in zip(points, points[1:]):
        found = found.when(x <= b1, v0 + (x - b0) * ((v1 - v0) / (b1 - b0)))
    return F.least(F.greatest(found.otherwise(F.lit(points[-1][1])), F.lit(0.0)), F.lit(1.0))

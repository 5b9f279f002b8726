"""Language identification in two steps: the family, then the language within it.

Families are told apart by one-versus-one linear support vector machines, and so
are the languages of each family, so closely related languages are separated by
machines that saw only the two of them. Features are hashed byte bigrams and
trigrams of the whole lower-cased text. Every machine is fitted in its own Spark
task on a bounded sample; scoring reads every text to its end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import few, fold, rows_where, texts, whole_texts

#: Family of a language; one that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "pl": "slavic", "cs": "slavic", "ru": "slavic", "uk": "slavic",
}
PER_LANGUAGE = 800  # training rows of each language
SAMPLE_BYTES = 1 << 23  # of all training texts of a language, whole ones; the longest go where they are more
BITS = 13  # hashed features: 2^13
ROUNDS = 12  # passes of the coordinate descent
COST = 1.0
BLOCK = 64  # training rows made at once
CHUNK = 1 << 20  # bytes counted at once, so a huge text needs no huge arrays
UNDETERMINED = "und"
LEAST_LIKENESS = 0.15  # cosine of a text with the nearest centre of a learned language; see the README for what was measured
SHORT = 10  # letters below which a text is too short to resemble none
_LETTER = re.compile(r"[^\W\d_]")


def features(text: str) -> np.ndarray:
    """Unit vector of square-rooted counts of hashed byte bigrams and trigrams."""
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    counts = np.zeros(1 << BITS)
    for at in range(0, max(1, len(data) - 1), CHUNK):
        part = data[at : at + CHUNK + 2].astype(np.uint32)
        pairs = part[:-1] << np.uint32(8) | part[1:]
        triples = pairs[:-1] << np.uint32(8) | part[2:]
        for grams, salt in ((pairs[:CHUNK], 0x9E3779B1), (triples[:CHUNK], 0x85EBCA77)):
            slots = (grams * np.uint32(salt)) >> np.uint32(32 - BITS)
            counts += np.bincount(slots, minlength=1 << BITS)
    found = np.sqrt(counts)
    return (found / max(float(np.linalg.norm(found)), 1e-12)).astype(np.float32)


def training_rows(found: Sequence[str]) -> np.ndarray:
    """The features of texts with a last column of ones, filled in place: rows kept apart would take that memory twice."""
    x = np.ones((len(found), (1 << BITS) + 1), np.float32)
    for row, text in zip(x, found):
        row[:-1] = features(text)
    return x


class Rows:
    """The training rows of texts, kept as the columns that are not 0 and made whole one at a time."""

    def __init__(self, found: Sequence[str]):
        self.shape = len(found), (1 << BITS) + 1
        self.kept: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(found), BLOCK):
            for row in training_rows(found[at : at + BLOCK]):
                columns = np.flatnonzero(row)
                self.kept.append((columns.astype(np.uint16), row[columns]))

    def __len__(self) -> int:
        return len(self.kept)

    def __getitem__(self, n: int) -> np.ndarray:
        columns, values = self.kept[n]
        row = np.zeros(self.shape[1], np.float32)
        row[columns] = values
        return row


def fit_svm(x: np.ndarray | Rows, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM (squared hinge loss), by dual coordinate descent. The last column of ``x`` is 1."""
    alpha, weights = np.zeros(len(x)), np.zeros(x.shape[1], np.float64)
    ridge = 0.5 / COST
    # Two rows at a time: one alone is added up in another order than rows of a matrix.
    squares = np.array([np.einsum("ij,ij->i", *[np.stack([row, row])] * 2)[0] for row in x], np.float32) + ridge
    random = np.random.default_rng(0)
    for _ in range(ROUNDS):
        for i in random.permutation(len(x)):
            row = x[i]
            gradient = y[i] * float(row @ weights) - 1 + ridge * alpha[i]
            moved = max(alpha[i] - gradient / squares[i], 0.0)
            if moved != alpha[i]:
                weights += (moved - alpha[i]) * y[i] * row
                alpha[i] = moved
    return weights[:-1], float(weights[-1])


@dataclass(frozen=True)
class Machine:
    level: str  # "family", or the family whose languages it separates
    first: str
    second: str
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class LanguageModel:
    languages: dict[str, list[str]]  # of each family
    machines: list[Machine]
    centres: np.ndarray  # a row for each language: the unit mean of its features


def train(docs: DataFrame) -> LanguageModel:
    """Fit every machine on at most PER_LANGUAGE rows of each language (SAMPLE_BYTES of whole texts).

    ``docs`` has doc_id, text and lang; null texts and languages teach nothing.
    Languages with no letters in any sampled text still count as learned.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").alias("lang")
    ).where("text is not null and lang is not null")
    chosen = few(rows.select("doc_id", "lang"), PER_LANGUAGE, "lang")
    sample = whole_texts(rows, chosen, "lang", SAMPLE_BYTES).select("lang", "text")
    names = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    groups: dict[str, list[str]] = {}
    for name in names:
        groups.setdefault(FAMILIES.get(name, name), []).append(name)
    jobs = [("family", a, b, groups[a], groups[b]) for a, b in combinations(sorted(groups), 2)]
    jobs += [(g, a, b, [a], [b]) for g, members in sorted(groups.items()) for a, b in combinations(members, 2)]

    def centre(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        mean = sum(features(t).astype(float) for t in sorted(rows["text"]))
        return pd.DataFrame({"lang": [key[0]], "centre": [(mean / max(float(np.linalg.norm(mean)), 1e-12)).tolist()]})

    found = {r["lang"]: r["centre"] for r in sample.groupBy("lang").applyInPandas(centre, "lang string, centre array<double>").collect()}
    centres = np.array([found[name] for name in names]).reshape(len(names), 1 << BITS)
    if not jobs:
        return LanguageModel(groups, [], centres)
    plan = docs.sparkSession.createDataFrame(
        [(i, lang, sign) for i, (_, _, _, a, b) in enumerate(jobs) for langs, sign in ((a, 1), (b, -1)) for lang in langs],
        "job int, lang string, sign int",
    )

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sign", "text"])
        weights, bias = fit_svm(Rows(rows["text"].tolist()), rows["sign"].to_numpy(float))
        return pd.DataFrame({"job": [key[0]], "weights": [weights.tolist()], "bias": [bias]})

    fitted = sample.join(F.broadcast(plan), "lang").groupBy("job").applyInPandas(fit, "job int, weights array<double>, bias double")
    machines = [
        Machine(jobs[r["job"]][0], jobs[r["job"]][1], jobs[r["job"]][2], np.array(r["weights"]), r["bias"])
        for r in sorted(fitted.collect(), key=lambda r: r["job"])
    ]
    return LanguageModel(groups, machines, centres)


class _Judge:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.weights = np.stack([m.weights for m in model.machines], 1) if model.machines else np.zeros((1 << BITS, 0))
        self.bias = np.array([m.bias for m in model.machines])

    def _vote(self, level: str, choices: list[str], margins: np.ndarray) -> tuple[str, float]:
        """Most votes wins, then the larger sum of margins, then the name."""
        votes, sums, low = dict.fromkeys(choices, 0), dict.fromkeys(choices, 0.0), {}
        for machine, margin in zip(self.model.machines, margins):
            if machine.level != level:
                continue
            votes[machine.first if margin >= 0 else machine.second] += 1
            for name, m in ((machine.first, margin), (machine.second, -margin)):
                sums[name] += m
                low[name] = min(low.get(name, np.inf), m)
        best = min(choices, key=lambda c: (-votes[c], -sums[c], c))
        return best, float(1 / (1 + np.exp(-4 * np.clip(low.get(best, 5.0), -5, 5))))

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """The language, its score, and the likeness to the nearest learned language."""
        if text is None or not self.model.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0, 0.0
        own = features(text)
        margins = own @ self.weights + self.bias
        family, sure = self._vote("family", sorted(self.model.languages), margins)
        language, surer = self._vote(family, self.model.languages[family], margins)
        return language, sure * surer, float((self.model.centres @ own).max())


def languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, whole texts.

    ``und`` with score 0 for texts that are null or have no letter, and for all
    if nothing could be learned. Repeated rows stay; a null id stays null and
    counts as not held out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS weights for each pair of languages

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = _Judge(sent.value)
        for batch in batches:
            found = [decide(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    found = texts(docs).mapInArrow(judge, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def rows_in(
    docs: DataFrame, model: LanguageModel, wanted: list[str] | None = None, text_col: str = "text", least: float = LEAST_LIKENESS
) -> DataFrame:
    """The rows, with all their columns, in one of the wanted languages (in any learned one).

    The machines give every text a learned language, so a text less like all of
    them than ``least`` is in none; one of fewer than SHORT letters says too little
    for that and stays. Repeated rows are judged alike, and texts that are null or
    have no letter go.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def accepts_of():
        decide = _Judge(sent.value)

        def accepts(text: str | None) -> bool:
            lang, _, like = decide(text)
            if lang == UNDETERMINED or (wanted is not None and lang not in wanted):
                return False
            return like >= least or sum(map(str.isalpha, text)) < SHORT

        return lambda found: [accepts(t) for t in found]

    return rows_where(docs, text_col, accepts_of)

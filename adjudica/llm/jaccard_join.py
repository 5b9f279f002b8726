"""N-gram Jaccard join by vertical partitioning.

The shingles of all texts have one global order: rare ones first, then those that
many texts share, each by number. The order is cut into fragments, so a text is a
few short segments. Overlaps are counted fragment by fragment and summed per pair.

Texts with equal sets are one class from the start. Two sets as alike as asked for
share a shingle within the first few of each (their prefixes), so only prefixes
are joined:

* Rare shingles of the prefixes give the pairs directly. The overlap counted there,
  plus all that lies beyond the prefix that ends first, bounds the whole overlap
  and drops nearly all chance pairs.
* A shingle that many prefixes share is found only in texts that are almost all
  frequent shingles: copies of each other. Each such text is compared with the
  plainest one there. Texts that this links need no further comparison among
  themselves; what is left over is compared with the rest of that shingle's
  texts. Nothing is dropped, and no group is expanded into all its pairs.

What counts as frequent only shapes the order. Results do not depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import components, only, small_batches, staged, texts
from adjudica.llm.shingles import BUCKETED, CHUNK, Words, bucket_ends, bucketed, held, lists, shingles, slices, unpacked

WORDS, PERCENT = 5, 80
FREQUENT = 50  # texts that share a shingle, above which it comes late in the order
SENT = 4_000_000  # numbers sent to every task at most (32 MB)
FRAGMENTS = 8
END = (1 << 63) - 1


def prefix_size(n: int, percent: int) -> int:
    """Shingles of which a set of n must share one with any set as alike as asked for."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _key(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _number(key: bytes | None) -> int | None:
    return None if key is None else int.from_bytes(key[:8], "little", signed=True)


def _signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, k, digest, probe): size of the set, its number and digest, its prefix by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for rows in slices(batches):
            sets = [shingles(known.numbers(t), words) for t in rows["text"].to_pylist()]
            keys = [_key(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    rows["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array([_number(k) for k in keys], pa.int64()),
                    pa.array(keys, pa.binary()), lists([s[: prefix_size(len(s), percent)] for s in sets]),
                ],
                names=["doc_id", "n", "k", "digest", "probe"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, k long, digest binary, probe array<long>")


def _few_frequent(counts: DataFrame) -> np.ndarray:
    """The shingles of (shingle, count) above FREQUENT, or above the next higher
    bound at which at most SENT of them remain. Sorted."""
    bound = FREQUENT
    while counts.where(F.col("count") > bound).count() > SENT:
        bound *= 4
    rows = counts.where(F.col("count") > bound).select("shingle").toPandas()
    return np.sort(rows["shingle"].to_numpy(np.int64))


def _having(signed: DataFrame, frequent: np.ndarray, wanted: bool) -> DataFrame:
    """The signatures whose prefix has a frequent shingle, or those without one."""
    sent = signed.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            probes = batch["probe"]
            hits = held(probes.flatten().to_numpy(), sent.value)
            ends = np.concatenate([[0], np.cumsum(hits)])
            cuts = probes.offsets.to_numpy() - probes.offsets[0].as_py()
            yield batch.filter(pa.array((ends[cuts[1:]] > ends[cuts[:-1]]) == wanted))

    return signed.mapInArrow(run, signed.schema)


def _counts_of_frequent_texts(docs: DataFrame, frequent: np.ndarray, words: int, percent: int, most: int) -> DataFrame:
    """(shingle, count) over all shingles of the texts whose prefix has a frequent one.

    A task counts CHUNK shingles at a time and sends each distinct one once, packed, to the
    bucket that its number falls into; ``most`` shingles in all tell how many there are.
    """
    sent, ends = docs.sparkSession.sparkContext.broadcast(frequent), bucket_ends(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kept, many = Words(), [], 0
        for rows in slices(batches):
            for text in rows["text"].to_pylist():
                found = shingles(known.numbers(text), words)
                if held(found[: prefix_size(len(found), percent)], sent.value).any():
                    kept.append(found.view(np.uint64))
                    many += len(found)
                if many >= CHUNK:
                    yield bucketed(ends, *np.unique(np.concatenate(kept), return_counts=True))
                    kept, many = [], 0
        if many:
            yield bucketed(ends, *np.unique(np.concatenate(kept), return_counts=True))

    def summed(part: pa.Table) -> pa.Table:
        found, counts = (np.concatenate(c) for c in zip(*(unpacked(d) for d in part["data"].to_pylist())))
        order = np.argsort(found, kind="stable")
        found, counts = found[order], counts[order]
        heads = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        total = np.add.reduceat(counts, heads)
        return pa.table({"shingle": found[heads][total > FREQUENT].view(np.int64), "count": total[total > FREQUENT]})

    return docs.mapInArrow(run, BUCKETED).groupBy("bucket").applyInArrow(summed, "shingle long, count long")


def _prefixes(docs: DataFrame, frequent: np.ndarray, words: int, percent: int) -> DataFrame:
    """(doc_id, k, digest, n, r, rare, late, last): r rare shingles in all, the prefix as its
    rare and its frequent part, and where the rare part ends in the order (END: with
    the rare shingles themselves)."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for rows in slices(batches):
            out: list[list] = [[] for _ in range(8)]
            for doc, text in zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist()):
                if doc is None:
                    continue
                found = shingles(known.numbers(text), words)
                if not len(found):
                    continue
                late = held(found, sent.value)
                rare, p = found[~late], prefix_size(len(found), percent)
                first, key = rare[:p], _key(found)
                last = int(first[-1]) if len(first) and len(first) < len(rare) else END
                for column, value in zip(out, (doc, _number(key), key, len(found), len(rare), first, found[late][: p - len(first)], last)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), None, None, pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [lists(c) if kind is None else pa.array(c, kind) for c, kind in zip(out, kinds)],
                names=["doc_id", "k", "digest", "n", "r", "rare", "late", "last"],
            )

    return docs.mapInArrow(run, "doc_id long, k long, digest binary, n long, r long, rare array<long>, late array<long>, last long")


def _segments(docs: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(k, fragment, segment) of the texts whose ids are in ``needed``.

    Beyond SENT ids every text's segments are made, and the join with the pairs
    picks the needed ones. Written, as both sides of the pairs read them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for rows in slices(batches):
            keys, places, segments = [], [], []
            for text in rows["text"].to_pylist():
                found = shingles(known.numbers(text), words)
                key = _number(_key(found))
                # Within a fragment only equality counts, so equal ranges of numbers serve as fragments.
                cuts = np.searchsorted(found, [(-1 << 63) + i * (1 << 64) // FRAGMENTS for i in range(1, FRAGMENTS)])
                for place, segment in enumerate(np.split(found, cuts)):
                    if len(segment):
                        keys.append(key)
                        places.append(place)
                        segments.append(segment)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(places, pa.int32()), lists(segments)], names=["k", "fragment", "segment"])

    made = staged(only(docs, needed, SENT).mapInArrow(run, "k long, fragment int, segment array<long>"), "jaccard-segments")
    return made.groupBy("k", "fragment").agg(F.first("segment").alias("segment"))


def _alike(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (x, y, nx, ny) whose overlap, summed over the fragments, suffices."""
    ends = pairs.select(F.col("x").alias("k")).union(pairs.select(F.col("y").alias("k"))).distinct()
    segments = _segments(docs, staged(classes.join(ends, "k").select(F.col("rep").alias("doc_id")).distinct(), "jaccard-needed"), words)
    cut = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))))
    left = segments.select(F.col("k").alias("x"), "fragment", F.col("segment").alias("_sx"))
    right = segments.select(F.col("k").alias("y"), "fragment", F.col("segment").alias("_sy"))
    partial = cut.join(left, ["x", "fragment"]).join(right, ["y", "fragment"]).select(
        "x", "y", "nx", "ny", F.size(F.array_intersect("_sx", "_sy")).alias("part")
    )
    total = partial.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.sum("part").alias("overlap"))
    return total.where((100 + percent) * F.col("overlap") >= percent * (F.col("nx") + F.col("ny"))).select("x", "y")


def _side(entries: DataFrame, name: str) -> DataFrame:
    return entries.select("shingle", *[F.col(c).alias(f"{'' if c == 'k' else c}{name}") for c in entries.columns if c != "shingle"])


def _near_sizes(percent: int):
    small, large = F.least("nx", "ny"), F.greatest("nx", "ny")
    return 100 * small >= percent * large


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Texts link when 100 * overlap >= percent * union of their shingle sets; the
    component is the smallest id that links reach. Null and empty texts and those
    without words have no shingles and no links. Repeated rows stay; rows of the
    same id are one document that has the links of either. A null id is returned
    with its count, a null component, and no links.
    """
    small_batches(docs.sparkSession)
    docs = texts(docs, id_col, text_col)
    signed = staged(_signatures(docs, words, percent), "jaccard-signatures")
    linked = signed.where("n > 0 and doc_id is not null")
    classes = staged(linked.groupBy("digest", "k").agg(F.min("doc_id").alias("rep")), "jaccard-classes")

    counts = signed.select(F.explode("probe").alias("shingle")).groupBy("shingle").count()
    frequent = _few_frequent(staged(counts.where(F.col("count") > FREQUENT), "jaccard-frequent"))
    if len(frequent):
        chosen = staged(_having(linked, frequent, True).select("doc_id").distinct(), "jaccard-chosen")
        most = signed.agg(F.sum("n")).first()[0]
        more = staged(_counts_of_frequent_texts(only(docs, chosen, SENT), frequent, words, percent, most), "jaccard-frequent")
        frequent = np.union1d(frequent, _few_frequent(more))

    # A prefix without frequent shingles is as it was; the others are made anew.
    prefixes = _having(linked, frequent, False).select(
        "doc_id", "k", "digest", "n", F.col("n").alias("r"), F.col("probe").alias("rare"), F.array().cast("array<long>").alias("late"),
        F.when(F.size("probe") < F.col("n"), F.element_at("probe", -1)).otherwise(END).alias("last"),
    )
    if len(frequent):
        hit = staged(_having(linked, frequent, True).select("doc_id", "digest").distinct(), "jaccard-hit")
        made = _prefixes(only(docs, hit.select("doc_id").distinct(), SENT), frequent, words, percent)
        prefixes = prefixes.unionByName(made.join(hit, ["doc_id", "digest"], "left_semi"))
    prefixes = prefixes.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    prefixes = staged(prefixes.dropDuplicates(["digest"]).select("k", "n", "r", "rare", "late", "last"), "jaccard-prefixes")

    def enough(overlap):
        return (100 + percent) * overlap >= percent * (F.col("nx") + F.col("ny"))

    # Pairs that share rare shingles, with their overlap there.
    rare = prefixes.select(F.explode("rare").alias("shingle"), "k", "n", F.size("rare").cast("long").alias("p"), "last")
    shared = rare.groupBy("shingle").count().where(F.col("count") > 1).select("shingle")
    rare = rare.join(shared, "shingle")
    met = _side(rare, "x").join(_side(rare, "y"), "shingle").where("x < y").where(_near_sizes(percent))
    met = met.groupBy("x", "y", "nx", "ny", "px", "py", "lastx", "lasty").agg(F.count("*").alias("c"))
    beyond = (
        F.when(F.col("lastx") < F.col("lasty"), F.col("nx") - F.col("px"))
        .when(F.col("lastx") > F.col("lasty"), F.col("ny") - F.col("py"))
        .otherwise(F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")))
    )
    pairs = met.where(enough(F.col("c") + beyond)).select("x", "y", "nx", "ny")

    # Texts that share a frequent shingle: each with the plainest of them.
    late = staged(prefixes.where(F.size("late") > 0).select(F.explode("late").alias("shingle"), "k", "n", "r"), "jaccard-late")
    plainest = late.groupBy("shingle").agg(F.min(F.struct("r", "n", "k")).alias("_c"), F.count("*").alias("_m")).where("_m > 1")
    star = late.join(plainest, "shingle").where(F.col("k") != F.col("_c.k"))
    star = star.select(F.col("k").alias("x"), F.col("_c.k").alias("y"), F.col("n").alias("nx"), F.col("_c.n").alias("ny")).where(_near_sizes(percent))
    star = star.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), F.when(F.col("x") < F.col("y"), F.col("nx")).otherwise(F.col("ny")).alias("nx"), F.when(F.col("x") < F.col("y"), F.col("ny")).otherwise(F.col("nx")).alias("ny"))
    pairs = staged(pairs.union(star).dropDuplicates(["x", "y"]), "jaccard-pairs")
    links = staged(_alike(pairs, docs, classes, words, percent), "jaccard-links")

    # What the plainest text did not link, with the other texts of that shingle. Pairs
    # that share rare shingles were judged above, so only frequent ones can overlap here.
    found = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    grouped = late.join(found.select(F.col("id").alias("k"), "component_id"), "k", "left").withColumn("g", F.coalesce("component_id", "k"))
    grouped = grouped.select("shingle", "k", "n", "r", "g")
    sizes = grouped.groupBy("shingle", "g").agg(F.count("*").alias("m"))
    main = sizes.groupBy("shingle").agg(F.max(F.struct("m", "g")).getField("g").alias("main"), F.count("*").alias("_groups")).where("_groups > 1")
    open_ = staged(grouped.join(main.select("shingle", "main"), "shingle"), "jaccard-open")
    outside = _side(open_.where("g <> main").drop("main"), "x")
    rest = outside.join(_side(open_.drop("main"), "y"), "shingle").where("gx <> gy").where(_near_sizes(percent))
    rest = rest.where(enough(F.least(F.col("nx") - F.col("rx"), F.col("ny") - F.col("ry"))))
    rest = rest.select("x", "y", "nx", "ny").dropDuplicates(["x", "y"]).join(pairs.select("x", "y"), ["x", "y"], "left_anti")
    rest = staged(rest, "jaccard-rest")
    if not rest.isEmpty():
        links = links.union(_alike(rest, docs, classes, words, percent))

    reps = classes.select("k", "rep")
    named = links.join(reps.withColumnRenamed("k", "x").withColumnRenamed("rep", "a"), "x").join(
        reps.withColumnRenamed("k", "y").withColumnRenamed("rep", "b"), "y"
    )
    copies = linked.join(classes, ["digest", "k"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    whole = components(named.select("a", "b").union(copies))
    return signed.select("doc_id", F.col("n").alias("n_shingles")).join(
        whole.withColumnRenamed("id", "doc_id"), "doc_id", "left"
    ).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

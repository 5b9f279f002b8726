"""Collocations: phrases whose words meet more often than chance, from FM-indexes.

Documents are cut into shards of bounded size. A shard keeps the word ids of its
pieces (a piece ends at punctuation or a line end) and an FM-index over them: the
Burrows-Wheeler transform of the text and of the reversed text, sorted as deep as
the longest phrase. A phrase is an interval of both. One step extends all phrases
of a length at once: the symbols in a phrase's interval of the reversed text are
the words that follow it, with their counts; the first-to-last-column mapping gives
the longer phrase's interval there, and the number of smaller symbols its interval
in the text. The interval in the text shows what stands left of a phrase, the other
one what stands right of it. Counts are summed across shards.

Only phrases that are frequent in the whole corpus matter, and a phrase is no more
frequent than the phrases in it. Words are counted first, then phrases of two words,
of three and so on; those that reach the least count are marked in a bitmap of fixed
size that tasks get, and a longer phrase is counted only if all in it are marked. These
counts are taken by a number of 40 bits for each phrase: phrases that share one, or a
bit of the bitmap, are carried along and fall at the last count, which is by the words
themselves. So the tasks get the same amount of data for any corpus.

A shard sends what it counted as one packed row for each bucket of phrases; there are
as many buckets as keep one to about BUCKET_WORDS phrases, whatever the corpus.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm.common import staged

LEAST_COUNT = 100
MOST_WORDS = 5
KEPT = 2000  # phrases of a language
UNKNOWN = "und"
SHARD_WORDS = 1 << 21
BITS = 1 << 26  # of a bitmap, 8 MB
SEED = 42  # of Spark's xxhash64
BUCKET_WORDS = 1 << 20
LEAST_BUCKETS = 32
MARK_BITS = 40  # of a phrase's number
RAW_BYTES = 3  # of a difference of two numbers that are not compressed
_ROW_BITS = 1 << 15  # bits of one row of Spark's bitmap aggregate
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: A-Z in lower case, piece ends as full stops, tabs as spaces.
_CLEAN = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"." * 10 + b" ")
SHARDS = "lang string, words array<binary>, counts array<long>, text binary"
INDEXES = "lang string, words array<binary>, forward binary, backward binary"
COUNTED = "bucket long, lang string, data binary"
SUMMED = "lang string, words int, phrase binary, f long, held boolean"


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, so that the high bytes, mostly 0, stand together."""
    planes = np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


#: floor(1000 a n / (l r)); 1000 a n may pass 64 bits, so decimals of 38 places.
SCORE = "cast(cast(a as decimal(17,0)) * 1000 as decimal(20,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"


class _Shard:
    """Words and text of one language, until they are written; 0 ends a piece."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(lambda: len(self.ids))
        self.ids[b"."] = 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> int:
        """Takes a text in; a piece end follows it. Returns the size of what was added."""
        words = (text.encode().translate(_CLEAN) + b".").replace(b".", b" . ").split()
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.size += len(words)
        return len(words)

    def row(self) -> tuple[list[bytes], np.ndarray, bytes]:
        text = np.concatenate(self.parts)
        counts = np.bincount(text, minlength=len(self.ids))[1:]
        text = text[(text != 0) | np.concatenate([[True], text[:-1] != 0])]  # one end is enough
        return list(self.ids)[1:], counts, _packed(text)


def _shards(docs: DataFrame, shard_words: int) -> DataFrame:
    """The documents as shards of about ``shard_words`` words, each with its
    languages apart; a longer text is a shard of its own. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, kept = 0, defaultdict(_Shard)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, shard in kept.items():
                words, counts, text = shard.row()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang], pa.string()), pa.array([words], pa.list_(pa.binary())),
                        pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([text], pa.binary()),
                    ],
                    names=["lang", "words", "counts", "text"],
                )

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                size += kept[lang].add(text)
                if size >= shard_words:
                    yield from rows()
                    size, kept = 0, defaultdict(_Shard)
        yield from rows()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    # Rows with a text that is null or empty have no words.
    return docs.select(lang, F.col("text").cast("string").alias("text")).where("text <> ''").mapInArrow(run, SHARDS)


def _number(lang: str, word: str) -> Column:
    """Spark's number of a word, the same as ``_numbers`` gives."""
    return F.xxhash64(F.col(lang).cast("binary"), word).bitwiseAND(F.lit((1 << MARK_BITS) - 1))


def _numbers(lang: str, words: list[bytes]) -> np.ndarray:
    """64-bit numbers of a language's words."""
    seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _marks(numbers: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Numbers of MARK_BITS of phrases, from those of their words; ``names`` counts words from 1."""
    found = numbers[names[:, 0] - 1]
    for k in range(1, names.shape[1]):
        found = (found ^ found >> np.uint64(29)) * _MULTIPLIER + numbers[names[:, k] - 1]
    return (found & np.uint64((1 << MARK_BITS) - 1)).view(np.int64)


def _bitmap(marks: DataFrame, bits: int) -> np.ndarray:
    """The bits of the marks; Spark makes it from pieces of 4 KB."""
    bit = F.pmod(F.col("mark"), F.lit(bits)) + 1
    rows = marks.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
    found = np.zeros(bits // 8, np.uint8)
    for row in rows.toLocalIterator():
        at = (row["bucket"] - 1) * _ROW_BITS // 8
        found[at : at + _ROW_BITS // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return found


def _marked(bitmap: np.ndarray, marks: np.ndarray) -> np.ndarray:
    bit = marks % (len(bitmap) * 8)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def _deep_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of a text in the order of the ``depth`` symbols from each on (by doubling)."""
    rank, known = text.astype(np.int64), 1
    while True:
        then = np.zeros_like(rank)
        then[:-known] = rank[known:]
        key = rank * (rank.max() + 1) + then
        order = np.argsort(key, kind="stable")
        known *= 2
        if known >= depth:
            return order
        fresh = np.concatenate([[False], np.diff(key[order]) != 0])
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(fresh)


class Index:
    """A bidirectional FM-index: ``forward`` has the symbol left of every place of the
    text, in the order of what follows; ``backward`` the symbol right of it, in the
    order of what stands before, read backwards. 0 ends a piece."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.forward, self.backward = forward, backward
        symbols = int(backward.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(backward, minlength=symbols))])
        #: Where the place right of a row's place stands in the same order.
        self.step = np.empty(len(backward), np.int64)
        self.step[np.argsort(backward, kind="stable")] = np.arange(len(backward))

    @classmethod
    def of(cls, text: np.ndarray, depth: int) -> Index:
        """``text`` begins and ends with 0; read as a ring, it stays the same."""
        order = _deep_order(text, depth)
        back = len(text) - 1 - _deep_order(text[::-1], depth)
        return cls(text[order - 1], text[(back + 1) % len(text)])

    def phrases(self, most: int, wanted: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(symbols of each phrase, count, word always on its left or 0, on its right or 0)
        for lengths 2 to ``most``. ``wanted`` tells which of some phrases to keep and extend."""
        only = [np.concatenate([[0], np.cumsum(side[1:] != side[:-1])]) for side in (self.forward, self.backward)]
        words = np.arange(1, len(self.first) - 1)
        low, size = self.first[words], self.first[words + 1] - self.first[words]
        low_text, names = low, words[:, None]
        for _ in range(2, most + 1):
            # All symbols that follow the phrases, sorted within each phrase.
            owner = np.repeat(np.arange(len(low)), size)
            starts = np.cumsum(size) - size
            row = np.arange(len(owner)) + np.repeat(low - starts, size)
            order = np.argsort(owner * len(self.first) + self.backward[row], kind="stable")
            follows = self.backward[row[order]]
            head = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(follows) != 0)])[: len(owner)])
            count = np.diff(np.concatenate([head, [len(owner)]]))
            phrase, symbol = owner[head], follows[head]
            good = symbol > 0
            head, count, phrase, symbol = head[good], count[good], phrase[good], symbol[good]
            longer = np.column_stack([names[phrase], symbol])
            good = wanted(longer)
            head, count, phrase, names = head[good], count[good], phrase[good], longer[good]
            low, low_text, size = self.step[row[order[head]]], low_text[phrase] + head - starts[phrase], count
            sides = []
            for side, runs, at in ((self.forward, only[0], low_text), (self.backward, only[1], low)):
                sides.append(np.where(runs[at] == runs[at + size - 1], side[at], 0) if len(at) else at)
            yield names, count, *sides


def _joined(words: pa.Array, names: np.ndarray) -> pa.Array:
    """The phrases in words, joined by spaces."""
    columns = [words.take(pa.array(names[:, k] - 1)) for k in range(names.shape[1])]
    return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()))


def _indexes(shards: DataFrame, bitmap: np.ndarray, depth: int) -> DataFrame:
    """The index of every shard and language, over its frequent words."""
    sent = shards.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang, words = batch["lang"][row].as_py(), batch["words"][row].as_py()
                numbers = _numbers(lang, words) & np.uint64((1 << MARK_BITS) - 1)
                frequent = _marked(sent.value, numbers.view(np.int64))
                number = np.concatenate([[0], np.where(frequent, np.cumsum(frequent), 0)])
                text = number[_unpacked(batch["text"][row].as_py())]
                # Ends in a row say no more than one, a word between two ends is no phrase.
                text = np.concatenate([[0], text, [0]])
                text[1:-1][(text[:-2] == 0) & (text[2:] == 0)] = 0
                text = text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]
                if len(text) < 3:
                    continue
                index = Index.of(text, depth)
                kept = [w for w, f in zip(words, frequent.tolist()) if f]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([kept], pa.list_(pa.binary())), pa.array([_packed(index.forward)]), pa.array([_packed(index.backward)])],
                    names=["lang", "words", "forward", "backward"],
                )

    return shards.select("lang", "words", "text").mapInArrow(run, INDEXES)


def _each(indexes: DataFrame, bitmaps: list[np.ndarray], rows_of: Callable, schema: str) -> DataFrame:
    """``rows_of`` (lang, words, numbers of the words, index, wanted) for every index.

    ``bitmaps`` mark phrases of 2, 3, ... words. ``wanted`` takes phrases that are
    marked, and those of one word more than any bitmap has if their last words are.
    """
    sent = indexes.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang, words = batch["lang"][row].as_py(), batch["words"].slice(row, 1).flatten()
                numbers, marked = _numbers(lang, words.to_pylist()), sent.value

                def wanted(names: np.ndarray) -> np.ndarray:
                    size = names.shape[1]
                    if size - 2 < len(marked):
                        return _marked(marked[size - 2], _marks(numbers, names))
                    return _marked(marked[size - 3], _marks(numbers, names[:, 1:])) if marked else np.ones(len(names), bool)

                index = Index(_unpacked(batch["forward"][row].as_py()), _unpacked(batch["backward"][row].as_py()))
                yield from rows_of(lang, words, numbers, index, wanted)

    return indexes.mapInArrow(run, schema)


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """The low bytes of some numbers, place by place."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _packed_counts(marks: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted marks as their differences, and counts below 2^32, byte by byte. The low
    bytes of the differences hardly repeat and are kept as they are; the rest is compressed."""
    data, raw = _planes(np.diff(marks, prepend=0), MARK_BITS // 8) + _planes(counts, 4), RAW_BYTES * len(marks)
    return len(marks).to_bytes(8, "little") + data[:raw] + zstandard.ZstdCompressor(level=1).compress(data[raw:])


def _unpacked_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(data[:8], "little")
    raw = 8 + RAW_BYTES * size
    planes = np.frombuffer(data[8:raw] + zstandard.ZstdDecompressor().decompress(data[raw:]), np.uint8).reshape(MARK_BITS // 8 + 4, size)
    found = []
    for part in (planes[:-4], planes[-4:]):
        wide = np.zeros((size, 8), np.uint8)
        wide[:, : len(part)] = part.T
        found.append(wide.view("<u8").ravel().astype(np.int64))
    return np.cumsum(found[0]), found[1]


def _bucketed(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """An order by bucket and key, and (bucket, first, last + 1) of each that has keys."""
    bucket = keys % buckets
    order = np.lexsort((keys, bucket))
    heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    ends = np.concatenate([heads[1:], [len(keys)]])
    return order, zip(bucket[order[heads]].tolist(), heads.tolist(), ends.tolist())


def _rows(lang: str, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([lang] * len(rows), pa.string()), pa.array([r[1] for r in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "lang", "data"])


def _frequent_marks(indexes: DataFrame, bitmaps: list[np.ndarray], least: int, buckets: int) -> DataFrame:
    """(mark) of the phrases of one word more than the bitmaps have that may be frequent."""
    size = len(bitmaps) + 2

    def counted(lang: str, words: pa.Array, numbers: np.ndarray, index: Index, wanted: Callable) -> Iterator[pa.RecordBatch]:
        *_, (names, count, _, _) = index.phrases(size, wanted)
        marks = _marks(numbers, names)
        order, parts = _bucketed(marks, buckets)
        marks, count = marks[order], count[order]
        rows = [(bucket, _packed_counts(marks[a:b], count[a:b])) for bucket, a, b in parts]
        yield _rows(lang, rows)

    def summed(table: pa.Table) -> pa.Table:
        found = [_unpacked_counts(d) for d in table["data"].to_pylist()]
        marks, count = (np.concatenate(side) for side in zip(*found))
        order = np.argsort(marks, kind="stable")
        heads = np.flatnonzero(np.diff(marks[order], prepend=-1))
        return pa.table({"mark": pa.array(marks[order[heads]][np.add.reduceat(count[order], heads) >= least], pa.int64())})

    return _each(indexes, bitmaps, counted, COUNTED).groupBy("bucket").applyInArrow(summed, "mark long")


def _summed_phrases(indexes: DataFrame, bitmaps: list[np.ndarray], least: int, most: int, buckets: int) -> DataFrame:
    """SUMMED of all phrases of 2 to ``most`` words that occur ``least`` times or more."""

    def found(lang: str, words: pa.Array, numbers: np.ndarray, index: Index, wanted: Callable) -> Iterator[pa.RecordBatch]:
        lines = defaultdict(list)  # of a bucket: phrase, count, word on the left, on the right
        for names, count, *sides in index.phrases(most, wanted):
            order, parts = _bucketed(_marks(numbers, names), buckets)
            beside = [pc.fill_null(words.take(pa.array(np.maximum(side, 1) - 1, mask=side == 0)), b"") for side in sides]
            columns = [_joined(words, names), pa.array(count).cast(pa.string()).cast(pa.binary()), *beside]
            line = pc.binary_join_element_wise(*columns, pa.scalar(b"\t", pa.binary())).take(pa.array(order)).to_pylist()
            for bucket, a, b in parts:
                lines[bucket] += line[a:b]
        packer = zstandard.ZstdCompressor(level=3)
        yield _rows(lang, [(bucket, packer.compress(b"\n".join(sorted(part)))) for bucket, part in lines.items()])

    def summed(table: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()
        sums: dict[tuple[str, bytes], list] = {}
        for lang, data in zip(table["lang"].to_pylist(), table["data"].to_pylist()):
            for line in unpacker.decompress(data).split(b"\n"):
                phrase, count, left, right = line.split(b"\t")
                known = sums.get((lang, phrase))
                if known is None:
                    sums[lang, phrase] = [int(count), left, right]
                else:
                    known[0] += int(count)
                    # The word beside it, if all shards name one, and the same.
                    if known[1] != left:
                        known[1] = b""
                    if known[2] != right:
                        known[2] = b""
        rows = [(lang, phrase.count(b" ") + 1, phrase, *known) for (lang, phrase), known in sums.items() if known[0] >= least]
        columns = list(zip(*rows)) if rows else [[]] * 6
        held = [bool(left or right) and size < most for size, left, right in zip(columns[1], columns[4], columns[5])]
        names = ["lang", "words", "phrase", "f", "held"]
        kinds = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.bool_()]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, [*columns[:4], held], kinds)})

    return _each(indexes, bitmaps, found, COUNTED).groupBy("bucket").applyInArrow(summed, SUMMED)


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT, most: int = MOST_WORDS, shard_words: int = SHARD_WORDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """SUMMED of all words and phrases of 2 to ``most`` words that occur ``least`` times
    or more, and (lang, n): the words of each language.

    ``held``: one word stands left (or right) of all occurrences, and with it the phrase
    is one of at most ``most`` words.
    """
    shards = staged(_shards(docs, shard_words), "shards")
    found = shards.select("lang", F.inline(F.arrays_zip("words", "counts"))).toDF("lang", "phrase", "n")
    often = staged(found.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "words")
    sizes = shards.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    totals = staged(sizes.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    indexes = staged(_indexes(shards, _bitmap(often.select(_number("lang", "phrase").alias("mark")), bits), most + 1), "indexes")
    buckets = max(LEAST_BUCKETS, (totals.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)
    bitmaps: list[np.ndarray] = []
    for _ in range(2, most):
        bitmaps.append(_bitmap(_frequent_marks(indexes, bitmaps, least, buckets), bits))
    grown = _summed_phrases(indexes, bitmaps, least, most, max(LEAST_BUCKETS, buckets // 4))
    alone = often.select("lang", F.lit(1).alias("words"), "phrase", "f", F.lit(False).alias("held"))
    return staged(grown.union(alone), "phrases"), totals


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, most: int = MOST_WORDS, kept: int = KEPT, shard_words: int = SHARD_WORDS, bits: int = BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``kept`` phrases.

    A phrase's score is that of its weakest cut, floor(1000 a n / (l r)) in exact whole
    numbers, the first of equal ones. Phrases that a longer one always holds are left
    out. Null languages are ``und``; null and empty texts have no words; repeated rows
    count each; other columns are not read; an empty table gives no rows. Whole texts
    are read, one text in one shard. A text of one word has no phrases.
    """
    phrases, totals = phrase_counts(docs, least, most, shard_words, bits)
    counts = phrases.select("lang", "phrase", "f")
    candidates = phrases.where("words > 1 and not held").select("lang", F.col("phrase").cast("string").alias("phrase"), F.col("f").alias("a"), "words")
    parts = F.split("phrase", " ", -1)
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumn("left", F.concat_ws(" ", F.slice(parts, F.lit(1), F.col("k"))).cast("binary"))
    cut = cut.withColumn("right", F.concat_ws(" ", F.slice(parts, F.col("k") + 1, F.col("words"))).cast("binary"))
    cut = cut.join(counts.toDF("lang", "left", "l"), ["lang", "left"]).join(counts.toDF("lang", "right", "r"), ["lang", "right"]).join(totals, "lang")
    weakest = F.min_by(F.struct("score", "l", "r"), F.struct("score", "k"))
    scored = cut.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a", "n").agg(weakest.alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= kept)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

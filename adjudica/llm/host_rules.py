"""Quality rules judged by host.

Every document is held against a few rules; their failures are added up by host.
A host's failure rate of a rule is shrunk towards the rate of all hosts by a beta
prior whose two parameters follow from the hosts themselves (matched to the first
two moments of their rates), so a host of three documents is not judged by three
documents alone. A host whose shrunk rate of any rule is above ``LIMIT`` is
rejected, and its documents with it.

All in DataFrame expressions: no Python runs on the executors. The counts are exact
integers, and so are the sums that the priors are made from, which makes the
verdicts independent of how the rows were laid out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import staged

# The limits of the rules.
LEAST_WORDS = 50
REPEATED_PERCENT = 50  # words in repeated windows
SHORT_WORD, LONG_WORD = 3, 10  # mean characters of a word
SYMBOL_PERCENT = 10  # symbols to words
DUP_LINE_PERCENT = 30  # lines that repeat an earlier one
WINDOW = 3
LIMIT = 0.5  # shrunk failure rate above which a host goes
UNIT = 1_000_000_000  # rates are added up in units of 1 / UNIT
SALTS = 32  # keys that a host's documents are dealt to when its verdict is joined

_WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BASE_RULES = ["few_words", "repeated_words"]
RULES = [*BASE_RULES, "word_length", "symbols", "dup_lines"]


def _windows(words: str, of: Callable[[list[Column], Column], Column]) -> Column:
    """``of`` three neighbouring words (and the place of the first) for every window."""
    at = F.col(words)
    every = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: of([F.get(at, i + k) for k in range(WINDOW)], i))
    return F.when(F.size(words) >= WINDOW, every)


def _repeated_words(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows that the text has twice or more.

    Windows are first compared by a hash; only texts in which two agree sort their
    windows, by the words themselves, and look at neighbours. Then the repeated
    windows' stretches are joined: each adds what the one before does not cover.
    """
    hashed = rows.withColumn("_h", _windows("_w", lambda words, i: F.xxhash64(*words)))
    # A string for each window, in order; equal ones become neighbours.
    exact = F.sort_array(_windows("_w", lambda words, i: F.struct(F.concat_ws(" ", *words).alias("w"), i.alias("i"))))
    ordered = hashed.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), exact))

    def start(i: Column) -> Column:
        own = F.get("_s", i)["w"]
        twice = F.coalesce(own == F.get("_s", i - 1)["w"], F.lit(False)) | F.coalesce(own == F.get("_s", i + 1)["w"], F.lit(False))
        return F.when(twice, F.get("_s", i)["i"])

    starts = F.sort_array(F.array_compact(F.transform(F.sequence(F.lit(0), F.size("_s") - 1), start)))
    placed = ordered.withColumn("_p", F.when(F.col("_s").isNotNull(), starts))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        "_p", nothing,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_h", "_s", "_p")


def document_counts(docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, host, COUNTS, n_lines) of every row, over its whole text.

    Words are runs without ASCII white space, characters are code points, lines end
    at a line feed and count if they have a word. A null or empty text has no words:
    all counts are 0.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), text.alias("_t"))
    rows = rows.withColumn("_w", F.regexp_extract_all("_t", F.lit(_WORD), F.lit(0)))
    lines = F.filter(F.split("_t", "\n"), lambda line: line.rlike(_WORD))
    rows = rows.withColumn("_l", lines)
    counted = _repeated_words(rows)
    return counted.select(
        "doc_id", "host",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_l").cast("long").alias("n_lines"),
    )


def failures() -> dict[str, Column]:
    """Whether a document fails each rule, in whole numbers."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": words < LEAST_WORDS,
        "repeated_words": 100 * F.col("n_repeat_words") > REPEATED_PERCENT * words,
        "word_length": (chars < SHORT_WORD * words) | (chars > LONG_WORD * words),
        "symbols": 100 * F.col("n_symbols") > SYMBOL_PERCENT * words,
        "dup_lines": 100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines"),
    }


def host_totals(counts: DataFrame) -> DataFrame:
    """(host, rule, n, x): documents of each host and how many fail each rule.

    Added up in the tasks before the shuffle, so a host with a third of all
    documents is one row from each task. Documents without a host have none.
    """
    failed = failures()
    sums = counts.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(failed[rule]).alias(rule) for rule in RULES]
    )
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("x")) for rule in RULES])
    return sums.select("host", "n", F.inline(pairs))


def beta_priors(totals: DataFrame) -> DataFrame:
    """(rule, alpha, beta, mean): the empirical prior of each rule's failure rate.

    Every host of two or more documents counts once: x / n has the mean of the
    rates, x (x - 1) / (n (n - 1)) the mean of their squares, without the noise of
    small hosts. Both are added up in whole units, exactly. Where the hosts differ no
    more than chance, the prior is its mean alone (null parameters); without such
    hosts it is uniform.
    """
    n, x = F.col("n").cast("decimal(38,0)"), F.col("x").cast("decimal(38,0)")
    first = F.expr(f"cast(x as decimal(20,0)) * {UNIT} div n")
    second = F.expr(f"cast(cast(x as decimal(14,0)) * cast(x - 1 as decimal(14,0)) as decimal(28,0)) * {UNIT} div (cast(n as decimal(14,0)) * cast(n - 1 as decimal(14,0)))")
    sums = totals.groupBy("rule").agg(
        F.count_if(F.col("n") > 1).alias("hosts"),
        F.sum(F.when(F.col("n") > 1, first)).alias("s1"),
        F.sum(F.when(F.col("n") > 1, second)).alias("s2"),
    )
    scale = F.col("hosts").cast("double") * F.lit(float(UNIT))
    moments = sums.select("rule", "hosts", F.try_divide(F.col("s1").cast("double"), scale).alias("m1"), F.try_divide(F.col("s2").cast("double"), scale).alias("m2"))
    m1, spread = F.col("m1"), F.col("m2") - F.col("m1") * F.col("m1")
    weight = (F.col("m1") - F.col("m2")) / spread
    wide = spread > 0
    return moments.select(
        "rule",
        F.when(F.col("hosts") == 0, F.lit(1.0)).when(wide, m1 * weight).alias("alpha"),
        F.when(F.col("hosts") == 0, F.lit(1.0)).when(wide, (1 - m1) * weight).alias("beta"),
        "m1",
    ).withColumnRenamed("m1", "mean")


def host_verdicts(totals: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(host, n, worst_rule_rate, rejected): the highest shrunk rate of each host."""
    shrunk = (F.col("alpha") + F.col("x")) / (F.col("alpha") + F.col("beta") + F.col("n"))
    rated = totals.join(F.broadcast(beta_priors(totals)), "rule").withColumn("rate", F.coalesce(shrunk, F.col("mean")))
    return rated.groupBy("host").agg(F.first("n").alias("n"), F.max("rate").alias("worst_rule_rate"), (F.max("rate") > limit).alias("rejected"))


def host_rules(docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """(doc_id, host, COUNTS, base_failed, host_rejected, kept) of every row.

    ``base_failed``: fewer than LEAST_WORDS words, or more than REPEATED_PERCENT of
    them in repeated windows. ``kept`` is false for those and for all documents of
    a rejected host. A document without a host is judged by the base rules alone.
    Null and empty texts have no words and fail. Repeated rows count each; null
    ids stay; other columns are not read, whatever their names; an empty table
    gives none. The priors are five rows, sent to all tasks; the rejected hosts are
    joined, each dealt to SALTS keys so that a hot host's documents are split.
    """
    counts = staged(document_counts(docs, host_col, id_col, text_col), "host-counts")
    bad = host_verdicts(staged(host_totals(counts), "host-totals"), limit).where("rejected").select("host")
    bad = bad.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("host_rejected", F.lit(True))
    failed = failures()
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(SALTS)).cast("int"))
    judged = salted.join(bad, ["host", "salt"], "left").withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    judged = judged.withColumn("base_failed", reduce(or_, [failed[rule] for rule in BASE_RULES]))
    return judged.select("doc_id", "host", *COUNTS, "base_failed", "host_rejected", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"))

"""URL filter: glob rules packed into multiword Shift-And masks.

All rules run at once over each canonical URL (host + path). A rule is a host
glob and a path glob, written together like ``example.com/en/``: the host fits
itself and all its subdomains, the path is a prefix, ``*`` stands for any run of
characters (in the host: without ``/``) and ``?`` for one. Of the rules that fit,
the longest wins; the first listed wins among equally long ones.

Every rule takes consecutive bits of the state, one for each place where the next
character is awaited. A place whose bit is set moves on when its mask has the
character, and places in the loop mask also stay. One step is two ANDs, a shift
across words and an OR for all rules, over a whole batch of URLs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = "page_id long, host string, path string, rule string, verdict string"
BATCH = 4096  # URLs stepped together; bounds the state matrix


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path of a URL; both empty without ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", n), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


class ShiftAnd:
    """The masks of a list of (rule, verdict)."""

    def __init__(self, rules: list[tuple[str, str]]):
        places: list[tuple[object, str]] = []  # (awaited character, loop class) of every place
        starts, self.ends = [], []
        for text, _ in rules:
            starts += [len(places), len(places) + 1]
            loop, in_host = "host", True
            places.append((b".", "host"))  # any labels before the host
            loop = ""
            for byte in (text.encode()[i : i + 1] for i in range(len(text.encode()))):
                if byte == b"/":
                    in_host = False
                if byte == b"*":
                    loop = "host" if in_host else "any"
                    continue
                places.append((byte, loop))
                loop = ""
            places.append((None, "any"))  # reached: the rest of the URL may be anything
            self.ends.append(len(places) - 1)
        self.words = max(1, -(-len(places) // 64))
        self.move = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for at, (byte, loop) in enumerate(places):
            word, bit = at // 64, np.uint64(1 << at % 64)
            if byte == b"?":
                self.move[:, word] |= bit
            elif byte is not None:
                self.move[byte[0], word] |= bit
            if loop:
                self.stay[:, word] |= bit
            if loop == "host":
                self.stay[ord("/"), word] &= ~bit
        for at in starts:
            self.start[at // 64] |= np.uint64(1 << at % 64)
        # The longest rule first, so that the first end found is the winner.
        self.order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][0]), i))

    def winners(self, urls: list[bytes]) -> np.ndarray:
        """Index of the winning rule of each URL, -1 if none fits."""
        found = np.full(len(urls), -1)
        by_length = sorted(range(len(urls)), key=lambda i: -len(urls[i]))
        for at in range(0, len(urls), BATCH):
            chosen = by_length[at : at + BATCH]
            found[chosen] = self._run([urls[i] for i in chosen])
        return found

    def _run(self, urls: list[bytes]) -> np.ndarray:
        """Winners of some URLs, the longest first."""
        sizes = np.array([len(u) for u in urls])
        data = np.frombuffer(b"".join(urls), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        state = np.tile(self.start, (len(urls), 1))
        for at in range(sizes[0] if len(urls) else 0):
            active = int(np.searchsorted(-sizes, -at, "left"))  # longer than ``at``
            byte = data[offsets[:active] + at]
            moved = state[:active] & self.move[byte]
            kept = state[:active] & self.stay[byte]
            kept |= moved << np.uint64(1)
            kept[:, 1:] |= moved[:, :-1] >> np.uint64(63)
            state[:active] = kept
        winner = np.full(len(urls), -1)
        for rule in reversed(self.order):
            end = self.ends[rule]
            hit = (state[:, end // 64] >> np.uint64(end % 64)) & np.uint64(1)
            winner[hit == 1] = rule
        return winner


def url_verdicts(
    df: DataFrame, rules: list[tuple[str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    Nulls and URLs without ``://`` have an empty host and path and get the
    default; so do empty rule lists. Repeated rows stay, a null id stays null, an
    empty table gives no rows, and any length of URL is read to its end.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    parts = df.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    names = pa.array([r for r, _ in rules] + [None], pa.string())
    verdicts = pa.array([v for _, v in rules] + [default], pa.string())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd(rules)
        for batch in batches:
            urls = [(h + p).encode() for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist())]
            won = automaton.winners(urls)
            won = pa.array(np.where(won < 0, len(rules), won))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["host"], batch["path"], names.take(won), verdicts.take(won)],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return parts.mapInArrow(judge, RESULT)

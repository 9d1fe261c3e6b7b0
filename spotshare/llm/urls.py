"""URL filters: all wildcard rules in one bit-parallel Shift-And automaton.

A rule is a pattern over the canonical form ``.host<TAB>path``: ``*`` matches any bytes of its part (host or path) and ``?`` one of
them. Every state of every rule is a bit of a few 64-bit words; a step over one byte shifts all of them at once, for a whole
batch of URLs. Host rules that hold for subdomains are patterns too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

_TAB = 9


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is host and path divided by a slash; ``subtree`` rules fit their host, its subdomains, and longer paths."""

    action: str
    pattern: str
    subtree: bool = False


# The site rules, of which the longest that fits decides.
SITE_RULES = tuple(
    UrlRule(action, pattern, True) for action, pattern in (
        ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
)
# What decides where no site rule fits: blocked if one of these fits, else allowed.
GLOB_RULES = tuple(
    UrlRule("block", pattern) for pattern in (
        "ads.*/*", "*.ads.*/*", "*ads-track*/*", "*doubleclick*/*", "*tracker.*/*", "*/*/ads/*", "*/ads/*", "*/*.exe", "*/*.zip",
        "*/login*", "*/*/login*", "*/cart*", "*/wp-admin/*", "*.onion/*", "*casino*/*", "*/*.php?.bak", "*xxx.*/*",
    )
)


class ShiftAnd:
    """The patterns of rules as masks over words of 64 states."""

    def __init__(self, rules: tuple[UrlRule, ...]):
        self.rules = rules
        states, self.first, self.last = [], [], []  # of each state: the byte it takes, and the bytes it stays on
        for rule in rules:
            host, _, path = rule.pattern.partition("/")
            parts = self._elements(host.encode(), rule.subtree, host=True) + [("byte", _TAB)]
            parts += self._elements(b"/" + path.encode(), False, host=False) + ([("star", True)] if rule.subtree else [])
            self.first.append(len(states))
            states.append([None, None])
            for kind, value in parts:
                if kind == "star":
                    states[-1][1] = "path" if value else "host"
                else:
                    states.append([value if kind == "byte" else "any", None])
            self.last.append(len(states) - 1)
        self.words = max(1, (len(states) + 63) // 64)
        self.take, self.stay = np.zeros((256, self.words), dtype=np.uint64), np.zeros((256, self.words), dtype=np.uint64)
        others = [b for b in range(256) if b != _TAB]
        for i, (byte, loop) in enumerate(states):
            bit, word = np.uint64(1 << i % 64), i // 64
            if byte is not None:
                self.take[others if byte == "any" else byte, word] |= bit
            if loop is not None:
                self.stay[others, word] |= bit
        self.start = np.zeros(self.words, dtype=np.uint64)
        for i in self.first:
            self.start[i // 64] |= np.uint64(1 << i % 64)

    @staticmethod
    def _elements(part: bytes, subtree: bool, host: bool) -> list[tuple]:
        # the canonical host has a dot in front, so that a whole label can be told from the end of one
        found: list[tuple] = [] if not host else [("star", False)] if subtree else []
        found += [("byte", ord("."))] if host and not (part.startswith(b"*") and not subtree) else []
        return found + [("star", not host) if b == ord("*") else ("any", None) if b == ord("?") else ("byte", b) for b in part]

    def match(self, texts: list[bytes]) -> np.ndarray:
        """For each text and rule whether the rule fits the whole text."""
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(-size, kind="stable")
        base = (np.cumsum(size) - size)[order]
        buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        alive = np.searchsorted(-size[order], -np.arange(1, (size.max() if len(size) else 0) + 1), side="right")
        state = np.tile(self.start, (len(texts), 1))
        for step, n in enumerate(alive.tolist()):
            byte = buf[base[:n] + step]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.take[byte]) | (now & self.stay[byte])
        result = np.zeros((len(texts), len(self.rules)), dtype=bool)
        for k, i in enumerate(self.last):
            result[order, k] = state[:, i // 64] >> np.uint64(i % 64) & np.uint64(1) != 0
        return result


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, site: tuple[UrlRule, ...] = SITE_RULES, globs: tuple[UrlRule, ...] = GLOB_RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the longest site rule that fits, else NULL) and ``verdict``.

    Without a site rule a page is blocked if a glob rule fits. Every row gets a verdict: a NULL or malformed URL has an empty host and
    path, and is allowed unless a rule fits that; repeated rows stay, columns of these names are replaced. Of equally long rules
    the first in alphabetical order counts.
    """
    ranked = tuple(sorted(site, key=lambda r: (-len(r.pattern), r.pattern)))
    automaton = ShiftAnd(ranked + globs)
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*(f"`{c}`" for c in keep), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    schema = StructType([*rows.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = (batch.column(i).to_pylist() for i in (n, n + 1))
            # a tab in a URL must not look like the border
            texts = [b"." + h.encode().replace(b"\t", b" ") + b"\t" + p.encode().replace(b"\t", b" ") for h, p in zip(hosts, paths)]
            fits = automaton.match(texts)
            rule, verdict = [], []
            for row in fits:
                at = int(np.argmax(row[: len(ranked)])) if row[: len(ranked)].any() else -1
                rule.append(ranked[at].pattern if at >= 0 else None)
                verdict.append(ranked[at].action if at >= 0 else "block" if row[len(ranked):].any() else "allow")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)

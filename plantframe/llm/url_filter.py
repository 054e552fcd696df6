"""URL filter: all glob rules at once in one bit-parallel automaton.

A rule is a verdict and a glob over the canonical URL (host in lower case,
then the path).  In a glob ``*`` stands for any characters but ``/``, ``**``
for any characters, ``?`` for one character but ``/``; the whole URL must
match.  Each pattern character is a bit of a mask that spans as many 64-bit
words as the rules need; a Shift-And step moves every rule's states on by one
character for a whole batch of URLs.  Stars are loops on a state.

``site_glob`` writes a rule "host and its subdomains, path prefix" as globs.

Defined cases: a null url, or one without ``://``, has an empty host and path
and matches only globs that match the empty text; repeated rows are judged one
by one; an empty input gives no rows.  Long URLs cost their own length only:
a batch steps over the characters that are left.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantframe.llm._arrays import text_blocks, text_buffer

U64 = np.uint64
#: verdict and rule ``host/path`` that hold before the globs; the longest that fits wins.
SITE_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: verdict and glob; the last that fits wins, and a URL that none fits is allowed.
GLOB_RULES = [
    ("block", "**pills**"), ("block", "**casino**"), ("block", "**viagra**"), ("block", "*adult*/**"), ("block", "ads.*"), ("block", "ads.*/**"), ("block", "*.ads.*/**"),
    ("block", "track??.*/**"), ("block", "**/wp-login*"), ("block", "**/cgi-bin/**"), ("block", "**.exe"), ("block", "**.zip"),
    ("block", "*.xxx"), ("block", "*.xxx/**"), ("allow", "*.edu"), ("allow", "*.edu/**"),
]


def site_globs(rule: str) -> list[str]:
    """Globs of a rule ``host/path``: the host or a subdomain, a path that starts with the rule's."""
    return [f"{rule}**", f"*.{rule}**"]


class GlobAutomaton:
    """Masks of all globs: ``step`` by byte, ``loop`` by byte, ``first`` and ``final`` states."""

    def __init__(self, globs: Sequence[str]):
        states: list[tuple[np.ndarray, np.ndarray]] = []  # bytes that enter, bytes that stay
        self.final, self.first, self.empty = [], [], []
        no_slash = np.ones(256, bool)
        no_slash[ord("/")] = False
        for glob in globs:
            parts = self._parts(glob)
            # a state before the first character takes the loops of leading stars
            self.first.append(len(states))
            states.append((np.zeros(256, bool), np.zeros(256, bool)))
            for kind in parts:
                if kind == "**":
                    states[-1] = (states[-1][0], np.ones(256, bool))
                elif kind == "*":
                    states[-1] = (states[-1][0], states[-1][1] | no_slash)
                else:
                    enter = no_slash.copy() if kind is None else np.zeros(256, bool)
                    if kind is not None:
                        enter[kind] = True
                    states.append((enter, np.zeros(256, bool)))
            self.final.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.step, self.loop = (self._masks([s[i] for s in states]) for i in (0, 1))
        self.begin = np.zeros(self.words, np.uint64)
        for at in self.first:
            self.begin[at // 64] |= U64(1) << U64(at % 64)

    @staticmethod
    def _parts(glob: str) -> list:
        out, raw, i = [], glob.encode(), 0
        while i < len(raw):
            if raw[i:i + 2] == b"**":
                out.append("**")
                i += 2
                continue
            out.append("*" if raw[i:i + 1] == b"*" else None if raw[i:i + 1] == b"?" else raw[i])
            i += 1
        return out

    def _masks(self, rows: list[np.ndarray]) -> np.ndarray:
        bits = np.zeros((256, self.words * 64), bool)
        bits[:, :len(rows)] = np.array(rows).T
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def match(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which globs match ``raw[start:start+length]``, a row per text."""
        order = np.argsort(-length, kind="stable")
        begin, left = start[order], length[order]
        state = np.tile(self.begin, (start.size, 1))
        active = start.size
        for j in range(int(left[0]) if left.size else 0):
            active = int(np.searchsorted(-left[:active], -j, "left"))  # those longer than j
            now, c = state[:active], raw[begin[:active] + j]
            moved = now << U64(1)
            moved[:, 1:] |= now[:, :-1] >> U64(63)
            state[:active] = (moved & self.step[c]) | (now & self.loop[c])
        out = np.zeros((start.size, len(self.final)), bool)
        for i, at in enumerate(self.final):
            out[order, i] = (state[:, at // 64] >> U64(at % 64)) & U64(1) == 1
        return out


def _canonical(df: DataFrame, url: str) -> DataFrame:
    """Adds host and path: after the first ``://`` to ``/``, ``?``, ``#`` or the end; then to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.expr("substring(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1)"), r"^[^?#]*", 0)
    return df.withColumn("rest", F.coalesce(rest, F.lit(""))).withColumns({"host": low, "path": path}).drop("rest")


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", site_rules=SITE_RULES, glob_rules=GLOB_RULES) -> DataFrame:
    """Key, host, path, rule (the site rule that fits, else null), verdict (its own, else the globs') and the globs that match."""
    rows = _canonical(pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url")), "url").select("key", "host", "path", F.concat("host", "path").alias("target"))
    ranked = sorted(site_rules, key=lambda x: (len(x[1]), x[1]))  # the longest last
    sites = [(v, r, g) for v, r in ranked for g in site_globs(r)]
    globs = [g for _, _, g in sites] + [g for _, g in glob_rules]
    schema = rows.select("key", "host", "path").schema.add("rule", "string").add("verdict", "string").add("globs", T.ArrayType(T.StringType()))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobAutomaton(globs)
        names = np.array([r for _, r, _ in sites] + [None], object)
        site_verdicts = np.array([v for v, _, _ in sites] + ["allow"], object)
        glob_verdicts = np.array([v for v, _ in glob_rules] + ["allow"], object)
        for batch in text_blocks(batches, "target"):
            raw, bounds = text_buffer(batch.column("target"))
            hit = automaton.match(raw, bounds[:-1].astype(np.int64), np.diff(bounds))
            n = len(sites)
            last = lambda x: np.where(x.any(axis=1), x.shape[1] - 1 - np.argmax(x[:, ::-1], axis=1), x.shape[1]) if x.shape[1] else np.zeros(len(x), int)
            site, glob = last(hit[:, :n]), last(hit[:, n:])
            verdict = np.where(site < n, site_verdicts[site], glob_verdicts[glob])
            which = [[g for g, h in zip(globs[n:], row) if h] if row.any() else [] for row in hit[:, n:]]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("host"), batch.column("path"), pa.array(names[site], pa.string()), pa.array(verdict, pa.string()), pa.array(which, pa.list_(pa.string()))],
                                             names=["key", "host", "path", "rule", "verdict", "globs"])

    return rows.mapInArrow(judge, schema).withColumnRenamed("key", key)

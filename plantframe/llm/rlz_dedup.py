"""Substring dedup over words by relative Lempel-Ziv factors.

Documents are factored against reference blocks: pieces of text around the
anchors of ``_shared_windows``, each owned by the least document that has it.
A document's piece that equals a block of an earlier document is one factor,
taken whole.  Where a passage begins or ends, pieces differ; they meet in a
shard, where each is parsed against the index of all blocks of earlier
documents there: a factor starts where the next ``size`` words are found and
runs as long as the words after it follow in the same block.  At a factor's
boundary the search starts again, so a window across two factors is looked up
itself.  Factors of at least ``size`` words become duplicate spans.

Defined cases: null and short texts (under ``size`` words) have no windows and
keep all words; a null doc_id counts as the largest; rows with the same doc_id
are one document that cannot copy itself; repeats within a document stay;
other columns are not read; an empty input gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plantframe.llm._arrays import U64, Words, prefix_sums, range_hash, text_buffer
from plantframe.llm._shared_windows import mark_repeats, packed_bits, removed_per_document

SIZE = 50
ANCHOR_WORDS = 12
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,n_words:long>>"


def matching(code: np.ndarray, at: int, source: int, most: int) -> int:
    """Number of words from ``at`` on that equal those from ``source`` on, at most ``most``."""
    done, step = 0, 64
    while done < most:
        step = min(step, most - done)
        differs = code[at + done:at + done + step] != code[source + done:source + done + step]
        if differs.any():
            return done + int(differs.argmax())
        done, step = done + step, step * 2
    return most


def greedy(found: np.ndarray, start: np.ndarray, source: np.ndarray, end: np.ndarray, source_end: np.ndarray, code: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy factors of the contexts: (window, place of its source, words).

    ``found``: windows (their numbers, ascending) whose first ``size`` words the index holds; ``start``, ``source``: first
    word of each window and of its occurrence in a block; ``end``, ``source_end``: where context and block end.  A factor runs as far as
    its block goes on like the context.  The search starts again at the boundary, with the
    windows that lie across it.
    """
    out, at = [], 0
    while at < found.size:
        w = int(found[at])
        p, s = int(start[w]), int(source[w])
        length = matching(code, p, s, min(int(end[w]) - p, int(source_end[w]) - s))
        out.append((w, s, length))
        at = int(np.searchsorted(found, w + length - size + 1))
    return out


def factors(size: int):
    def parse(table: pa.Table) -> pa.Table:
        """Windows of each context that factors copied from blocks of earlier documents cover."""
        raw, bounds = text_buffer(table.column("text"))
        words = Words(raw, bounds)
        did = table.column("did").to_numpy()
        n_windows = np.maximum(words.count - size + 1, 0)
        context = np.repeat(np.arange(did.size), n_windows)
        offset = np.arange(context.size) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        start = words.first[context] + offset
        sums = prefix_sums(words.code)
        code = range_hash(sums, start, start + size)
        # the index: for each window the earliest document's block and the place in it
        order = np.lexsort((start, did[context], code))
        new = np.ones(order.size, bool)
        new[1:] = code[order][1:] != code[order][:-1]
        source = np.empty(order.size, np.int64)
        source[order] = np.repeat(start[order[new]], np.diff(np.append(np.flatnonzero(new), order.size)))
        block = np.searchsorted(words.first, source, "right") - 1
        found = np.flatnonzero(did[block] < did[context])
        covered = np.zeros(context.size + 1, np.int64)
        for w, _, length in greedy(found, start, source, words.first[context + 1], words.first[block + 1], words.code, size):
            covered[w] += 1
            covered[w + length - size + 1] -= 1
        copied = np.cumsum(covered[:-1]) > 0
        return packed_bits(context[copied], offset[copied], n_windows)

    return parse


def _digest(block: pa.RecordBatch, raw: np.ndarray, covered: np.ndarray, first: np.ndarray, words: Words) -> pa.RecordBatch:
    removed = removed_per_document(covered, first)
    # bytes of the kept words and one blank after each
    ends = np.minimum(words.end + 1, words.bounds[1:][words.doc] if words.doc.size else 0)
    change = np.zeros(raw.size + 1, np.int32)
    change[words.start[~covered]] += 1
    np.subtract.at(change, ends[~covered], 1)
    keep = np.cumsum(change[:-1]) > 0
    flat = raw.copy()
    flat[words.end[words.end < raw.size]] = np.where(np.isin(raw[words.end[words.end < raw.size]], [9, 10, 11, 12, 13, 32]), 32, raw[words.end[words.end < raw.size]])
    kept = flat[keep]
    at = np.concatenate([[0], np.cumsum(keep)])[words.bounds]
    data = kept.tobytes()
    digests = [hashlib.sha256(data[a:b].rstrip(b" ")).hexdigest() for a, b in zip(at, at[1:])]
    edge = covered.copy()
    if covered.size:
        edge[1:] &= ~(covered[:-1] & (words.doc[1:] == words.doc[:-1]))
    begin = np.flatnonzero(edge)
    stop = covered.copy()
    if covered.size:
        stop[:-1] &= ~(covered[1:] & (words.doc[1:] == words.doc[:-1]))
    length = np.flatnonzero(stop) + 1 - begin
    of = words.doc[begin]
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(first))), pa.int32()),
                                     pa.StructArray.from_arrays([pa.array(begin - first[of]), pa.array(length)], names=["start", "n_words"]))
    return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(words.count.astype(np.int64)), pa.array(removed), pa.array(digests, pa.string()), spans],
                                      names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per document: word counts, the removed spans (in words) and the digest of the kept words."""
    return mark_repeats(docs, key, text, "word", size, min(ANCHOR_WORDS, max(1, size // 2)), factors(size), _digest, SCHEMA)

"""Substring dedup over bytes with suffix arrays built by induced sorting.

Which pieces of text are compared is found by ``_shared_windows``; the pieces
of a shard, parted by zero bytes, become one text whose suffix array is built
by induced sorting: suffixes are classified (smaller or larger than the next),
the leftmost smaller ones are sorted by inducing, their substrings named, the
string of names sorted recursively, and all suffixes induced from that order.
A sweep over a bucket takes the bucket's entries as arrays, in rounds only for
runs of one byte.  Below the bytes, where names are as many as the string is
long, buckets hold one entry and sweeps gain nothing; there the string of names
is sorted by doubling ranks.  Permuted common prefixes (each suffix against its
neighbour in the array, in text order) are worked out as far as ``size``
bytes; neighbours with that much in common form a group, and a window is a
repeat if its group has an earlier document.

Defined cases: null and short texts (under ``size`` bytes) have no windows and
keep all bytes; a null doc_id counts as the largest; rows with the same doc_id
are one document that cannot copy itself; repeats within a document stay;
other columns are not read; an empty input gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plantframe.llm._arrays import U64, prefix_sums, range_hash, text_buffer
from plantframe.llm._shared_windows import mark_repeats, packed_bits, removed_per_document

SIZE = 50
ANCHOR_BYTES = 18
#: Largest alphabet that bucket sweeps are used for.
SWEEP_ALPHABET = 512
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,n_bytes:long>>"


def suffix_array(codes: np.ndarray, alphabet: int) -> np.ndarray:
    """Order of the suffixes of ``codes`` (0 <= code < alphabet); the end of the text is smaller than any code."""
    if codes.size < 3 or alphabet > SWEEP_ALPHABET:
        return _by_doubling(codes)
    smaller = _classify(codes)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    ends = np.cumsum(np.bincount(codes, minlength=alphabet))
    if lms.size:
        first = _induce(codes, smaller, lms, ends)
        is_lms = np.zeros(codes.size, bool)
        is_lms[lms] = True
        ranked = first[is_lms[first]]
        # names: substrings to the next leftmost smaller suffix, compared by hash and length
        stop = np.empty(codes.size, np.int64)
        stop[lms] = np.append(lms[1:] + 1, codes.size)
        code = range_hash(prefix_sums(codes.astype(np.uint64) + U64(1)), ranked, stop[ranked])
        new = np.ones(ranked.size, bool)
        new[1:] = code[1:] != code[:-1]
        new |= stop[ranked] == codes.size  # it meets the end of the text
        if new.size > 1:
            new[1:] |= stop[ranked[:-1]] == codes.size
        name = np.empty(codes.size, np.int64)
        name[ranked] = np.cumsum(new) - 1
        names = name[lms]
        order = lms[suffix_array(names, int(new.sum()))] if not new.all() else ranked
    else:
        order = lms
    return _induce(codes, smaller, order, ends)


def _classify(codes: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last is not: the end is smallest)."""
    n = codes.size
    step = np.sign(codes[1:].astype(np.int64) - codes[:-1])
    known = np.append(step, -1)
    at = np.where(known != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return known[nearest] > 0


def _induce(codes: np.ndarray, smaller: np.ndarray, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost smaller ones in (some) order."""
    n, alphabet = codes.size, ends.size
    sa = np.full(n, -1, np.int64)
    begins = ends - np.bincount(codes, minlength=alphabet)
    # the given ones at the ends of their buckets
    by = np.argsort(codes[lms], kind="stable")
    given = lms[by]
    in_bucket = np.bincount(codes[lms], minlength=alphabet)
    given_begin = np.cumsum(in_bucket) - in_bucket

    def place(j: np.ndarray, head: np.ndarray, sign: int) -> None:
        c = codes[j]
        if c.size > 1:
            o = np.argsort(c, kind="stable")
            j, c = j[o], c[o]
        count = np.bincount(c, minlength=alphabet)
        within = np.arange(c.size) - (np.cumsum(count) - count)[c]
        sa[head[c] + sign * within - (sign < 0)] = j
        head += sign * count

    # larger suffixes, left to right; the last suffix of the text comes first of all
    head = begins.copy()
    place(np.array([n - 1]), head, 1)
    for c in range(alphabet):
        done = begins[c]
        while done < head[c]:
            batch = sa[done:head[c]]
            done = head[c]
            j = batch[batch > 0] - 1
            j = j[~smaller[j]]
            if j.size:
                place(j, head, 1)
        if in_bucket[c]:
            j = given[given_begin[c]:given_begin[c] + in_bucket[c]]
            j = j[j > 0] - 1
            if j.size:
                place(j, head, 1)  # what precedes a leftmost smaller suffix is larger
    # smaller suffixes, right to left
    tail = ends.copy()
    for c in range(alphabet - 1, -1, -1):
        done = ends[c]
        while True:
            batch = sa[tail[c]:done][::-1]
            if not batch.size:
                break
            done = tail[c]
            j = batch[batch > 0] - 1
            j = j[smaller[j]]
            if j.size:
                place(j, tail, -1)
        larger = sa[begins[c]:head[c]][::-1]
        j = larger[larger > 0] - 1
        j = j[smaller[j]]
        if j.size:
            place(j, tail, -1)
    return sa


def _by_doubling(codes: np.ndarray) -> np.ndarray:
    n, width = codes.size, 1
    if n == 0:
        return np.zeros(0, np.int64)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(n - width, 0)] = rank[width:]
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        ranked = pair[order]
        new = np.ones(n, bool)
        new[1:] = ranked[1:] != ranked[:-1]
        rank[order] = np.cumsum(new)
        if new.all():
            return order
        width *= 2


def _common(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Whether the common prefix from ``a`` and ``b`` has ``size`` bytes; eight at a time."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = padded[:raw.size].copy()
    for i in range(1, 8):
        words |= padded[i:raw.size + i] << U64(8 * i)
    same = np.ones(a.size, bool)
    if size < 8:
        mask = U64((1 << 8 * size) - 1)
        return (words[a] & mask) == (words[b] & mask)
    for o in [*range(0, size - 7, 8), size - 8]:
        same &= words[np.minimum(a + o, raw.size - 1)] == words[np.minimum(b + o, raw.size - 1)]
    return same


def repeated_windows(size: int):
    def resolve(table: pa.Table) -> pa.Table:
        """Windows of each context that also start in the context of an earlier document."""
        raw, bounds = text_buffer(table.column("text"))
        did = table.column("did").to_numpy()
        # contexts parted by zeros; bytes are codes from 1 on
        n = np.diff(bounds)
        start = bounds[:-1] + np.arange(n.size)
        codes = np.zeros(raw.size + n.size, np.int64)
        codes[np.arange(raw.size) + np.repeat(np.arange(n.size), n)] = raw.astype(np.int64) + 1
        sa = suffix_array(codes, 257)
        context = np.searchsorted(start, np.arange(codes.size), "right") - 1
        offset = np.arange(codes.size) - start[context]
        whole = offset + size <= n[context]  # a window's first bytes hold no zero, so its equals lie within contexts too
        before = np.full(codes.size, -1, np.int64)  # each suffix's neighbour in the array, in text order
        before[sa[1:]] = sa[:-1]
        at = np.flatnonzero(whole & (before >= 0))
        at = at[whole[before[at]]]
        joined = np.zeros(codes.size, bool)
        flat = codes.astype(np.uint16)
        joined[at] = _common((flat & 0xFF).astype(np.uint8), at, before[at], size)
        windows = sa[whole[sa]]
        if not windows.size:
            return packed_bits(np.zeros(0, np.int64), np.zeros(0, np.int64), n)
        first = np.flatnonzero(~joined[windows])
        owner = did[context[windows]]
        least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.append(first, windows.size)))
        hit = windows[owner > least]
        return packed_bits(context[hit], offset[hit], np.maximum(n - size + 1, 0))

    return resolve


def _digest(block: pa.RecordBatch, raw: np.ndarray, covered: np.ndarray, first: np.ndarray, _words) -> pa.RecordBatch:
    removed = removed_per_document(covered, first)
    at = np.concatenate([[0], np.cumsum(~covered)])[first]
    data = raw[~covered].tobytes()
    digests = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(at, at[1:])]
    heads = np.zeros(raw.size, bool)
    heads[first[:-1][first[:-1] < raw.size]] = True
    edge, stop = covered.copy(), covered.copy()
    if covered.size:
        edge[1:] &= ~covered[:-1] | heads[1:]
        stop[:-1] &= ~covered[1:] | heads[1:]
    begin = np.flatnonzero(edge)
    length = np.flatnonzero(stop) + 1 - begin
    cut = np.searchsorted(begin, first)
    of = np.repeat(np.arange(len(first) - 1), np.diff(cut))
    spans = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(begin - first[of]), pa.array(length)], names=["start", "n_bytes"]))
    return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), pa.array(removed), pa.array(np.diff(cut).astype(np.int64)), pa.array(digests, pa.string()), spans],
                                      names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per document: byte counts, the removed spans (in bytes) and the digest of the kept bytes."""
    return mark_repeats(docs, key, text, "byte", size, min(ANCHOR_BYTES, max(1, size // 2)), repeated_windows(size), _digest, SCHEMA)

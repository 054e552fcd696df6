"""Which windows of a document also start in a document with a smaller id.

The common part of the two substring operators; their units are words or
bytes, and each brings its own ``resolve`` for the blocks of contexts.

1. ``anchored runs``: each document's windows are grouped by their least k-gram
   (``_arrays.Runs``).  A task sends each distinct (key, content) once, with the
   least document that has it, packed by bucket of the key; the others that it
   has seen itself are copies already.
2. ``owners``: a bucket finds the least document of each (key, content).  Later
   documents with the same content copy the whole run.  Where a key has several
   contents that may share windows, their owners are asked for the units.
3. ``contexts``: the asked documents send those units, to shards by key.
4. ``resolve``: a shard finds, window by window, which contexts of later owners
   repeat a window of an earlier one.
5. ``marked``: every document gets the contents it copies and the windows that
   shards found, and is read once more to mark them.

Hot anchors.  An anchor that many documents have with ever new surroundings (the
edge of a very common passage) would bring all of them to one bucket and one
shard.  Such anchors are found beforehand: those that at least ``HOT_SHARE`` of a
bounded sample of documents have, so there are at most (anchors a document) /
``HOT_SHARE`` of them.  Their runs are dealt by content instead of key, and their
contexts are sent window by window, dealt by the window's hash; a task sends a
content or a window once, with its least document, so what arrives for one is
bounded by the number of tasks.  The sample only chooses the way; the result is
the same either way.

Only run fingerprints, contexts at the edges of copied passages, and verdicts
are shuffled; the texts themselves move once, by document, for steps 3 and 5
together (the same exchange).  A group of copies costs a row for each task and
content, not for each pair; a run that a third of all documents have is one
entry a task.  No window is sampled: every window has an anchor.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantframe.llm._scratch import written
from plantframe.llm._arrays import Runs, Words, byte_codes, from_planes, give_back, mix, planes, range_hash, text_blocks, text_buffer

U64 = np.uint64
#: A null doc_id counts as larger than all others.
NO_ID = (1 << 63) - 1
KEY_BYTES, CONTENT_BYTES = 5, 6
KEY_MASK, CONTENT_MASK = (1 << 8 * KEY_BYTES) - 1, (1 << 8 * CONTENT_BYTES) - 1
#: Runs that a task holds before it sends them.
FLUSH_RUNS = 250_000
#: Runs a bucket should get; their number follows the input.
BUCKET_RUNS = 150_000
#: Asked contexts a shard should get.
SHARD_CONTEXTS = 2_000
#: Documents that are looked at for hot anchors, the share and the number of them that makes an anchor hot.
HOT_SAMPLE, HOT_SHARE, HOT_LEAST = 10_000, 0.02, 150
#: In place of an anchor's key: the context is sent window by window.
BY_WINDOW = -1
#: Windows that a task holds before it sends them.
FLUSH_WINDOWS = 100_000


def units_of(batch: pa.RecordBatch, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words | None]:
    """Raw bytes, codes of the units, first unit of each document, and the words if they are the units."""
    raw, bounds = text_buffer(batch.column("text"))
    if unit == "byte":
        return raw, byte_codes(raw), bounds, None
    words = Words(raw, bounds)
    return raw, words.code, words.first, words


def _pack(key: np.ndarray, content: np.ndarray, doc: np.ndarray, side: np.ndarray) -> bytes:
    least = int(doc.min())
    offset = (doc - least).astype(np.uint64)
    width = max(1, (int(offset.max()).bit_length() + 7) // 8)
    return struct.pack("<qqq", key.size, least, width) + planes(key, KEY_BYTES) + planes(content, CONTENT_BYTES) + planes(offset, width) + side.tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, ...]:
    n, least, width = struct.unpack_from("<qqq", raw)
    at, out = 24, []
    for w in (KEY_BYTES, CONTENT_BYTES, width):
        out.append(from_planes(raw[at:at + n * w], n, w))
        at += n * w
    return out[0], out[1], out[2].astype(np.int64) + least, np.frombuffer(raw, np.uint8, n, at)


def _new(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns begin to differ from the row before."""
    out = np.ones(sorted_columns[0].size, bool)
    if out.size:
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return out


def _rows(**columns) -> pa.RecordBatch:
    types = {"kind": pa.int32(), "bucket": pa.int32(), "did": pa.int64(), "key": pa.int64(), "content": pa.int64(), "packed": pa.binary(), "hot": pa.binary(), "copies": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[k], types[k]) for k in columns], names=list(columns))


def send_anchors(unit: str, size: int, k: int) -> Callable:
    """Number of documents of a block that have each anchor."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            _, codes, first, _ = units_of(block, unit)
            runs = Runs(codes, first, size, k)
            pair = np.unique(np.rec.fromarrays([runs.key, runs.doc], names="k,d"))
            key, n = np.unique(pair.k, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    return send


def hot_anchors(body: DataFrame, unit: str, size: int, k: int, n_docs: int) -> np.ndarray:
    share = min(1.0, HOT_SAMPLE / max(n_docs, 1))
    sample = body.where(F.pmod(F.xxhash64("did", F.lit(5)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))).select("text")
    least = max(HOT_LEAST, HOT_SHARE * share * n_docs)
    rows = sample.mapInArrow(send_anchors(unit, size, k), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= F.lit(least)).select("key").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def send_runs(unit: str, size: int, k: int, buckets: int, hot: np.ndarray) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for block in text_blocks(batches):
            _, codes, first, _ = units_of(block, unit)
            runs = Runs(codes, first, size, k)
            held.append((runs.key, runs.content & U64(CONTENT_MASK), block.column("did").to_numpy(zero_copy_only=False)[runs.doc], runs.side))
            n += runs.key.size
            if n >= FLUSH_RUNS:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)
        held.clear()
        give_back()

    def flush(held):
        key, content, doc, side = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, content, key))
        key, content, doc, side = key[order], content[order], doc[order], side[order]
        new = _new(key, content)
        at = np.flatnonzero(new)
        least = np.repeat(doc[at], np.diff(np.append(at, key.size)))
        again = (doc > least) & _new(key, content, doc)
        copies, where = np.stack([doc[again], content[again].astype(np.int64)], axis=1), doc[again] % buckets
        by = np.argsort(where, kind="stable")
        copies, where = copies[by], where[by]
        key, content, doc, side = key[at], content[at], doc[at], side[at]
        is_hot = np.isin(key, hot)
        cold = (~is_hot).nonzero()[0]
        warm = is_hot.nonzero()[0][np.argsort(content[is_hot] % U64(buckets), kind="stable")]
        bucket = ((key[cold] >> U64(40)) * U64(buckets) >> U64(24)).astype(np.int64)  # in order of the key
        hot_bucket = (content[warm] % U64(buckets)).astype(np.int64)
        used = np.unique(np.concatenate([bucket, hot_bucket, where]))
        cut, hot_cut, own = (np.searchsorted(x, np.append(used, buckets)) for x in (bucket, hot_bucket, where))

        def packs(rows, cuts):
            return [_pack(key[rows[a:b]], content[rows[a:b]], doc[rows[a:b]], side[rows[a:b]]) if b > a else None for a, b in zip(cuts, cuts[1:])]

        yield _rows(bucket=used.astype(np.int32), packed=packs(cold, cut), hot=packs(warm, hot_cut), copies=[copies[a:b].tobytes() if b > a else None for a, b in zip(own, own[1:])])

    return send


def find_owners(table: pa.Table) -> pa.Table:
    """Of one bucket: kind 1 (did copies content) and kind 2 (did owns content, whose units are asked for)."""
    give_back()
    bucket = table.column("bucket")[0].as_py()
    seen = np.frombuffer(b"".join(c.as_py() for c in table.column("copies") if c.is_valid), np.int64).reshape(-1, 2)
    nothing = [_unpack(struct.pack("<qqq", 0, 0, 1))]
    key, content, doc, side = (np.concatenate(x) for x in zip(*([_unpack(p.as_py()) for p in table.column("packed") if p.is_valid] or nothing)))
    hot_key, hot_content, hot_doc, _ = (np.concatenate(x) for x in zip(*([_unpack(p.as_py()) for p in table.column("hot") if p.is_valid] or nothing)))
    by = np.lexsort((hot_doc, hot_content, hot_key))
    hot_key, hot_content, hot_doc = hot_key[by], hot_content[by], hot_doc[by]
    hot_at = np.flatnonzero(_new(hot_key, hot_content))
    hot_again = (hot_doc > np.repeat(hot_doc[hot_at], np.diff(np.append(hot_at, hot_doc.size)))) & _new(hot_key, hot_content, hot_doc)
    order = np.lexsort((doc, content, key))
    key, content, doc, side = key[order], content[order], doc[order], side[order]
    at = np.flatnonzero(_new(key, content))
    least = np.repeat(doc[at], np.diff(np.append(at, key.size)))
    again = (doc > least) & _new(key, content, doc)
    own_key, own_content, owner, own_side = key[at], content[at], doc[at], side[at]
    asked = np.zeros(at.size, bool)
    for shift in (0, 4):
        half = (own_side >> np.uint8(shift)) & np.uint8(15)
        group = np.lexsort((owner, half, own_key))
        starts = np.flatnonzero(_new(own_key[group], half[group]))
        ends = np.append(starts[1:], group.size)
        differ = owner[group][starts] != owner[group][ends - 1] if starts.size else np.zeros(0, bool)
        asked[group] |= np.repeat(differ, ends - starts) & (half[group] > 0)
    # shard by the whole key; the bucket stands for its high bits
    where = own_key[asked].astype(np.int64) | (np.int64(bucket) << 40)
    copy_doc = np.concatenate([doc[again], hot_doc[hot_again], seen[:, 0]])
    copy_content = np.concatenate([content[again].astype(np.int64), hot_content[hot_again].astype(np.int64), seen[:, 1]])
    where = np.concatenate([where, np.full(hot_at.size, BY_WINDOW)])
    n1, n2 = copy_doc.size, where.size
    return pa.Table.from_batches([
        _rows(kind=np.ones(n1, np.int32), did=copy_doc, key=np.zeros(n1, np.int64), content=copy_content),
        _rows(kind=np.full(n2, 2, np.int32), did=np.concatenate([owner[asked], hot_doc[hot_at]]), key=where,
              content=np.concatenate([own_content[asked], hot_content[hot_at]]).astype(np.int64))])


def _flat(column) -> tuple[np.ndarray, pa.Array]:
    """Row of each element of a list column (null: none), and the elements."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.nan_to_num(np.array(pc.list_value_length(column).to_numpy(zero_copy_only=False), float)).astype(np.int64)
    return np.repeat(np.arange(len(column)), n), column.flatten()


def _least(code: np.ndarray, did: np.ndarray) -> np.ndarray:
    """For each entry the least document with its code."""
    by = np.lexsort((did, code))
    at = np.flatnonzero(_new(code[by]))
    out = np.empty(did.size, np.int64)
    out[by] = np.repeat(did[by][at], np.diff(np.append(at, did.size)))
    return out


_CONTEXT = pa.schema([("shard", pa.int32()), ("did", pa.int64()), ("content", pa.int64()), ("window", pa.int32()), ("text", pa.binary())])


def send_contexts(unit: str, size: int, k: int, shards: int) -> Callable:
    """Contexts (window -1) by key; of hot anchors single windows, by hash.  Without a text: a window that is a repeat for certain."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0
        for block in text_blocks(batches):
            rows, asked = _flat(block.column("asked"))
            if not rows.size:
                continue
            raw, codes, first, words = units_of(block, unit)
            runs = Runs(codes, first, size, k)
            key, content = (asked.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            have = np.rec.fromarrays([runs.doc, (runs.content & U64(CONTENT_MASK)).astype(np.int64)], names="d,c")
            order = np.argsort(have, order=["d", "c"], kind="stable")
            want = np.rec.fromarrays([rows, content], names="d,c")
            if not order.size:
                continue
            at = order[np.minimum(np.searchsorted(have[order], want), order.size - 1)]
            found = have[at] == want  # documents without an id are all asked for what one of them has
            at, rows, key, content = at[found], rows[found], key[found], content[found]
            did = block.column("did").to_numpy(zero_copy_only=False)[rows]
            data = raw.tobytes()

            def text(start, end):
                a, b = (start, end) if words is None else (words.start[start], words.end[end - 1])
                return [data[x:y] for x, y in zip(a, b)]

            whole = np.flatnonzero(key != BY_WINDOW)
            if whole.size:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    ((key[whole] % shards).astype(np.int32), did[whole], content[whole], np.full(whole.size, -1, np.int32), text(runs.lo[at[whole]], runs.hi[at[whole]] + size)), _CONTEXT.types)], schema=_CONTEXT)
            apart = np.flatnonzero(key == BY_WINDOW)
            if apart.size:
                count = runs.hi[at[apart]] - runs.lo[at[apart]] + 1
                of = np.repeat(apart, count)
                offset = np.arange(of.size) - np.repeat(np.cumsum(count) - count, count)
                start = runs.lo[at[of]] + offset
                code = range_hash(runs.sums, start, start + size)
                texts = np.full(of.size, None, object)
                lead = np.flatnonzero(did[of] == _least(code, did[of]))  # the others are repeats for certain
                texts[lead] = text(start[lead], start[lead] + size)
                held.append((code, did[of], content[of], offset, texts))
                n += of.size
                if n >= FLUSH_WINDOWS:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    def flush(held) -> pa.RecordBatch:
        code, did, content, offset, texts = (np.concatenate(x) for x in zip(*held))
        repeat = did > _least(code, did)
        texts[repeat] = None
        shard = np.where(repeat, mix(code ^ did.astype(np.uint64)), code) % U64(shards)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((shard.astype(np.int32), did, content, offset.astype(np.int32), texts), _CONTEXT.types)], schema=_CONTEXT)

    return send


def with_known(resolve: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """Adds windows that were known as repeats before, and puts single windows in their contexts' masks."""
    def run(table: pa.Table) -> pa.Table:
        give_back()
        known = pc.is_null(table.column("text"))
        asked, told = table.filter(pc.invert(known)), table.filter(known)
        window = asked.column("window").to_numpy()
        found = resolve(asked.append_column("place", pa.array(np.arange(asked.num_rows)))) if asked.num_rows else None
        did, content, bits = [told.column("did").to_numpy()], [told.column("content").to_numpy()], [_one_bit(told.column("window").to_numpy())]
        if found is not None and found.num_rows:
            place = found.column("place").to_numpy()
            single = window[place] >= 0
            masks = np.array(found.column("bits").to_pylist(), object)
            masks[single] = _one_bit(window[place[single]])
            did.append(asked.column("did").to_numpy()[place])
            content.append(asked.column("content").to_numpy()[place])
            bits.append(masks)
        return pa.table({"did": pa.array(np.concatenate(did), pa.int64()), "content": pa.array(np.concatenate(content), pa.int64()), "bits": pa.array(np.concatenate(bits), pa.binary())})

    return run


def _one_bit(windows: np.ndarray) -> np.ndarray:
    out = np.empty(windows.size, object)
    for i, w in enumerate(windows):
        out[i] = bytes(w // 8) + bytes([128 >> w % 8])
    return out


def mark(unit: str, size: int, k: int, digest: Callable) -> Callable:
    """``digest(block, raw, covered, first, words)`` turns the covered units of a block into its output columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            raw, codes, first, words = units_of(block, unit)
            runs = Runs(codes, first, size, k)
            change = np.zeros(codes.size + size + 1, np.int32)
            content = (runs.content & U64(CONTENT_MASK)).astype(np.int64)
            have = np.rec.fromarrays([runs.doc, content], names="d,c")
            rows, copied = _flat(block.column("copied"))
            if rows.size and runs.doc.size:
                wanted = np.unique(np.rec.fromarrays([rows, copied.to_numpy(zero_copy_only=False)], names="d,c"))
                found = np.minimum(np.searchsorted(wanted, have), wanted.size - 1)
                hit = wanted[found] == have
                np.add.at(change, runs.lo[hit], 1)
                np.add.at(change, runs.hi[hit] + size, -1)
            rows, parts = _flat(block.column("parts"))
            if rows.size and runs.doc.size:
                order = np.argsort(have, order=["d", "c"], kind="stable")
                ranked = have[order]
                values, bits = parts.field(0).to_numpy(zero_copy_only=False), parts.field(1)
                want = np.rec.fromarrays([rows, values], names="d,c")
                for i, (a, b) in enumerate(zip(np.searchsorted(ranked, want, "left"), np.searchsorted(ranked, want, "right"))):
                    for j in order[a:b]:  # the document may have the content several times
                        at = runs.lo[j] + np.flatnonzero(np.unpackbits(np.frombuffer(bits[i].as_py(), np.uint8)))
                        np.add.at(change, at, 1)
                        np.add.at(change, at + size, -1)
            covered = np.cumsum(change[:codes.size]) > 0
            yield digest(block, raw, covered, first, words)

    return run


def packed_bits(context: np.ndarray, window: np.ndarray, n_windows: np.ndarray) -> pa.Table:
    """Output of a resolver: the place of each context with repeated windows, and their bit mask."""
    out = []
    order = np.lexsort((window, context))
    context, window = context[order], window[order]
    starts = np.flatnonzero(_new(context))
    for a, b in zip(starts, np.append(starts[1:], context.size)):
        mask = np.zeros(int(n_windows[context[a]]), bool)
        mask[window[a:b]] = True
        out.append(np.packbits(mask).tobytes())
    return pa.table({"place": pa.array(context[starts], pa.int64()), "bits": pa.array(out, pa.binary())})


def mark_repeats(docs: DataFrame, key: str, text: str, unit: str, size: int, k: int, resolve: Callable[[pa.Table], pa.Table], digest: Callable, schema: str) -> DataFrame:
    """Runs the five steps; ``schema`` is that of ``digest``'s rows."""
    body = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("did"), F.col(f"`{text}`").alias("text"))
    n_docs, n_bytes = body.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    hot = hot_anchors(body, unit, size, k, n_docs)
    n_runs = n_bytes * 0.06 / (1 if unit == "byte" else 6)
    buckets = int(min(max(n_runs / BUCKET_RUNS, 12), 1 << 22))
    shards = int(min(max(n_runs * 0.06 / SHARD_CONTEXTS, 12), 1 << 30))
    sent = body.select("did", "text").mapInArrow(send_runs(unit, size, k, buckets, hot), "bucket int, packed binary, hot binary, copies binary")
    found = written(sent.groupBy("bucket").applyInArrow(find_owners, "kind int, did long, key long, content long"), "run-owners")
    copied = found.where("kind = 1").groupBy("did").agg(F.collect_set("content").alias("copied"))
    asked = found.where("kind = 2").groupBy("did").agg(F.collect_set(F.struct("key", "content")).alias("asked"))
    # left joins, so that both have the same exchange of the texts below them
    contexts = body.join(asked, "did", "left").select("did", "asked", F.when(F.col("asked").isNotNull(), F.col("text")).alias("text")) \
        .mapInArrow(send_contexts(unit, size, k, shards), "shard int, did long, content long, window int, text binary")
    parts = contexts.groupBy("shard").applyInArrow(with_known(resolve), "did long, content long, bits binary").groupBy("did").agg(F.collect_list(F.struct("content", "bits")).alias("parts"))
    return body.join(copied, "did", "left").join(parts, "did", "left").select("doc_id", "text", "copied", "parts").mapInArrow(mark(unit, size, k, digest), schema)


def removed_per_document(covered: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(covered)])[bounds]).astype(np.int64)

"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is its five-word shingles, each weighted by the number of times it
occurs.  Two documents are linked if the probability Jaccard similarity of
these weights is ``SIMILARITY`` or more: the sum over common shingles i of
1 / sum over all j of max(x_j / x_i, y_j / y_i).  Where no shingle recurs
this is the plain Jaccard similarity of the sets.

Every shingle starts a Poisson process of arrivals with its weight as the rate,
seeded by the shingle; each arrival falls on a random register, and a register
keeps its earliest arrival.  A shingle's process ends as soon as its next
arrival is later than the latest register of its document.  The chance that two
documents agree in a register is their probability Jaccard similarity, so 24
bands of 4 registers miss a link with a chance of 3e-6 at most.  Documents that
agree in a band share a bucket.

Documents with the same words are one node from the start.  The least node of a
bucket (its leader) is verified against the others, which joins most of a group of copies
at once.  What the links of all leaders leave apart is compared in blocks:
the nodes of such a bucket that are outside the leader's component are dealt to
blocks, so are the others, and each pair of blocks with an outside one is a task.
The task multiplies the blocks' shingle tables, which gives the common weight of every
pair of nodes and from it an upper bound of the similarity (exact where no
shingle recurs); the pairs that reach ``SIMILARITY`` are verified, and only the links that join
components are returned.  So no table ever holds a row per pair of a bucket's
nodes: the rows are nodes, once per block that theirs is compared with, and a
block holds up to ``BLOCK_NODES`` nodes.  No bucket is capped.

Classes are the connected components of the links, found by rounds of large
and small stars over the link table.

Defined cases: a null or wordless text is a class of its own; a text of one to
four words is a single shingle; a row's class is that of its text, and texts with
the same least doc_id are one class; a null doc_id never names a class
unless no member has an id (then the class id is null); ids from 2**62 on count as null; repeated rows get
a row each; an empty input gives no rows; other columns are not read.
``keep_one`` takes every row as a document, whatever its id: one row of each class
stays, the one with the least id (nulls last).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.llm._arrays import U64, Words, from_planes, mix, planes, prefix_sums, range_hash, run_hash, text_blocks, text_buffer
from plantframe.llm._scratch import written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
#: Bytes of a shingle's hash in the sets that are compared.
SET_BYTES = 6
#: A document without an id is named by its text's hash, from this number on.
UNNAMED = 1 << 62
#: Size of a block: nodes, or shingles / SHINGLES_A_NODE if these are more.
BLOCK_NODES, SHINGLES_A_NODE = 2048, 512
#: Shingles that more nodes of a task share are multiplied as dense columns, so many at a time.
DENSE_FROM, DENSE_COLUMNS = 16, 512
#: Keys that a leader's or a text's rows are dealt to.
DEALS = 16


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and count of each distinct shingle, by document and hash."""
    sums = prefix_sums(words.code)
    n = np.maximum(words.count - SHINGLE + 1, 0)
    doc = np.repeat(np.arange(n.size), n)
    at = np.arange(doc.size) + np.repeat(words.first[:-1] - (np.cumsum(n) - n), n)
    code = run_hash(sums, SHINGLE)[at] if at.size else np.zeros(0, np.uint64)
    short = np.flatnonzero((words.count > 0) & (n == 0))
    doc = np.concatenate([doc, short])
    code = np.concatenate([code, range_hash(sums, words.first[short], words.first[short + 1])])
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    new = np.ones(doc.size, bool)
    new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    first = np.flatnonzero(new)
    return doc[first], code[first], np.diff(np.append(first, doc.size))


def prob_min_hash(doc: np.ndarray, code: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """For each document and register the element whose arrival is the earliest (0 where there is no element)."""
    time = np.full(n_docs * registers, np.inf)
    element = np.zeros(n_docs * registers, np.uint64)
    state, arrival = mix(code ^ U64(0xA5A5A5A55A5A5A5A)), np.zeros(code.size)
    while doc.size:
        state = mix(state + U64(0x9E3779B97F4A7C15))
        uniform = ((state >> U64(12)).astype(np.float64) + 0.5) / float(1 << 52)
        arrival = arrival - np.log(uniform) / weight
        at = doc * registers + (mix(state ^ U64(0x5851F42D4C957F2D)) % U64(registers)).astype(np.int64)
        np.minimum.at(time, at, arrival)
        won = time[at] == arrival
        element[at[won]] = code[won]
        # early termination: later than every register of the document
        docs = doc[np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))]
        latest = np.zeros(n_docs)
        latest[docs] = time.reshape(n_docs, registers)[docs].max(axis=1)
        alive = arrival < latest[doc]
        doc, code, weight, state, arrival = doc[alive], code[alive], weight[alive], state[alive], arrival[alive]
    return element.reshape(n_docs, registers)


def signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            words = Words(*text_buffer(block.column("text")))
            doc, code, count = shingles(words)
            picked = prob_min_hash(doc, code, count.astype(np.float64), block.num_rows, bands * rows).reshape(-1, bands, rows)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), picked.shape[:2])
            for r in range(rows):
                key = mix(key * U64(0x9E3779B97F4A7C15) + picked[:, :, r])
            sums = prefix_sums(words.code)
            one = range_hash(sums, words.first[:-1], words.first[1:])
            two = range_hash(prefix_sums(mix(words.code)), words.first[:-1], words.first[1:])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(key).reshape(-1).view(np.int64)), bands)
            none = words.count == 0
            yield pa.RecordBatch.from_arrays(
                [block.column("did"), pa.array(one.view(np.int64), mask=none), pa.array(two.view(np.int64), mask=none), pa.array(np.bincount(doc, minlength=block.num_rows)), lists.cast(pa.list_(pa.int64()))],
                names=["did", "h1", "h2", "n", "bands"])

    return run


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the wanted texts' shingles, and their counts (empty: each occurs once)."""
    for block in text_blocks(batches):
        wanted = np.flatnonzero(block.column("wanted").to_numpy(zero_copy_only=False).astype(bool))
        if not wanted.size:
            continue
        block = block.take(pa.array(wanted))
        words = Words(*text_buffer(block.column("text")))
        doc, code, count = shingles(words)
        code = code & U64((1 << 8 * SET_BYTES) - 1)
        order = np.lexsort((code, doc))
        code, count, cut = code[order], count[order].astype("<u4"), np.searchsorted(doc, np.arange(block.num_rows + 1))
        ranges = list(zip(cut, cut[1:]))
        yield pa.RecordBatch.from_arrays(
            [block.column("did"), pa.array([planes(code[a:b], SET_BYTES) for a, b in ranges], pa.binary()), pa.array([b"" if (count[a:b] == 1).all() else count[a:b].tobytes() for a, b in ranges], pa.binary())],
            names=["node", "grams", "counts"])


def _weights(grams: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    code = from_planes(grams, len(grams) // SET_BYTES, SET_BYTES)
    return code, np.frombuffer(counts, "<u4").astype(np.int64) if counts else np.ones(code.size, np.int64)


def prob_jaccard(code_a: np.ndarray, x: np.ndarray, code_b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted codes, positive whole weights)."""
    common, i, j = np.intersect1d(code_a, code_b, assume_unique=True, return_indices=True)
    if not common.size:
        return 0.0
    x, y = x.astype(np.float64), y.astype(np.float64)
    if x.max() == x.min() and y.max() == y.min():
        return common.size / (x.size + y.size - common.size)
    # by falling x_j / y_j: those ahead of a shingle count by x, those behind by y; what only one side has is ahead or behind of all
    both = x[i] / y[j]
    order = np.argsort(-both, kind="stable")
    p, q, ratio = x[i][order], y[j][order], both[order]
    ahead = x.sum() - p.sum() + np.cumsum(p)
    behind = y.sum() - np.cumsum(q)
    last = np.searchsorted(-ratio, -ratio, "right") - 1  # equal ratios: either side gives the same
    return float((1 / (ahead[last] / p + behind[last] / q)).sum())


def similarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, seen, one = [], None, None
        for grams_a, counts_a, grams_b, counts_b in zip(*(batch.column(c).to_pylist() for c in ("grams_a", "counts_a", "grams_b", "counts_b"))):
            if (grams_a, counts_a) != seen:
                seen, one = (grams_a, counts_a), _weights(grams_a, counts_a)
            out.append(prob_jaccard(*one, *_weights(grams_b, counts_b)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def common_weights(code: list[np.ndarray], weight: list[np.ndarray]) -> np.ndarray:
    """``out[a, b]``: the weight in row a of the shingles that rows a and b share."""
    n = len(code)
    out = np.zeros((n, n), np.float64 if max((int(w.sum()) for w in weight), default=0) >= 1 << 24 else np.float32)
    row = np.repeat(np.arange(n), [c.size for c in code])
    all_codes, all_weights = np.concatenate(code), np.concatenate(weight)
    order = np.lexsort((row, all_codes))
    row, w, c = row[order], all_weights[order].astype(out.dtype), all_codes[order]
    first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
    size = np.diff(np.append(first, c.size))
    # few rows share a shingle: all its pairs, neighbours at distance 1, 2, ... in the sorted list
    few = np.repeat((size > 1) & (size <= DENSE_FROM), size)
    at = np.flatnonzero(few)
    for k in range(1, DENSE_FROM):
        pair = at[:-k][c[at[:-k]] == c[at[k:]]] if at.size > k else at[:0]
        if not pair.size:
            break
        other = pair + k
        flat = np.concatenate([row[pair] * n + row[other], row[other] * n + row[pair]])
        out += np.bincount(flat, np.concatenate([w[pair], w[other]]), n * n).reshape(n, n).astype(out.dtype)
    # many do: products of dense columns
    many = np.flatnonzero(size > DENSE_FROM)
    for begin in range(0, many.size, DENSE_COLUMNS):
        columns = many[begin:begin + DENSE_COLUMNS]
        entry = np.repeat(first[columns] - (np.cumsum(size[columns]) - size[columns]), size[columns]) + np.arange(size[columns].sum())
        table = np.zeros((n, columns.size), out.dtype)
        table[row[entry], np.repeat(np.arange(columns.size), size[columns])] = w[entry]
        out += table @ (table > 0).T.astype(out.dtype)
    return out


def joining_links(similarity: float):
    """Links between the components of two blocks (or within one), none that others already imply."""
    def run(table: pa.Table) -> pa.Table:
        root, side = table["root"].to_numpy(), table["side"].to_numpy()
        code, weight = zip(*(_weights(g, c) for g, c in zip(table["grams"].to_pylist(), table["counts"].to_pylist())))
        total = np.array([w.sum() for w in weight], np.float64)
        plain = np.array([not c for c in table["counts"].to_pylist()])
        two_blocks = side.min() != side.max()
        shared = common_weights(list(code), list(weight))
        group = {int(r): int(r) for r in np.unique(root)}

        def top(r: int) -> int:
            while group[r] != r:
                group[r] = r = group[group[r]]
            return r

        links: list[tuple[int, int]] = []
        for begin in range(0, total.size, 256):  # a strip of rows at a time
            mine = slice(begin, begin + 256)
            ab, ba = shared[mine].astype(np.float64), shared[:, mine].T.astype(np.float64)
            with np.errstate(divide="ignore"):
                bound = 1 / (total[mine, None] / ab + total[None, :] / ba - 1)
            fits = (bound >= similarity - 1e-6) & (root[mine, None] != root[None, :])
            fits &= side[mine, None] < side[None, :] if two_blocks else np.arange(total.size)[mine, None] < np.arange(total.size)[None, :]
            sure = fits & plain[mine, None] & plain[None, :]
            a, b = np.nonzero(sure)
            common = ab[a, b]
            a += begin
            linked = common / (total[a] + total[b] - common) >= similarity
            for r, s in np.unique(np.stack([root[a[linked]], root[b[linked]]], axis=1), axis=0).tolist():
                if top(r) != top(s):
                    links.append((r, s))
                    group[top(r)] = top(s)
            for a, b in zip(*np.nonzero(fits & ~sure)):
                r, s = int(root[a + begin]), int(root[b])
                if top(r) != top(s) and prob_jaccard(code[a + begin], weight[a + begin], code[b], weight[b]) >= similarity:
                    links.append((r, s))
                    group[top(r)] = top(s)
        return pa.table({"a": pa.array([r for r, _ in links], pa.int64()), "b": pa.array([s for _, s in links], pa.int64())})

    return run


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Similarity of pairs (leader a, node b), written.  A leader's rows are dealt, and its shingles go only where it has some."""
    pairs = pairs.withColumn("deal", F.pmod(F.xxhash64("b"), F.lit(DEALS)))
    leaders = pairs.select("a", "deal").distinct().join(sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"), F.col("counts").alias("counts_a")), "a")
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"), F.col("counts").alias("counts_b")), "b").join(leaders, ["a", "deal"])
    return written(both.select("a", "b", "grams_a", "counts_a", "grams_b", "counts_b").mapInArrow(similarities, "a long, b long, similarity double"), "near-similarities")


def components(links: DataFrame) -> DataFrame:
    """node and root (least node of its component) for every node of the links (a, b)."""
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        # large star: a node's larger neighbours move to its least neighbour
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "links")
        # done when every node hangs on one root: no node has two parents or is a child and a parent
        ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(edges.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where((F.col("child") > 1) | (F.col("child") * F.col("parent") > 0)).isEmpty():
            return edges.toDF("node", "root")


def open_blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes of buckets with several components, by pair of blocks (bucket, one, two) to compare: node, root, side.

    ``members``: bucket, leader, node and n (shingles) of all nodes, the leader too.
    """
    home = roots.select(F.col("node").alias("leader"), F.col("root").alias("home"))
    placed = members.join(roots, "node", "left").join(home, "leader", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root"), F.greatest(F.col("n") / SHINGLES_A_NODE, F.lit(1)).alias("size"), F.coalesce("home", "leader").alias("home"))
    placed = written(placed.withColumn("outside", F.col("root") != F.col("home")).drop("home"), "near-placed")
    blocks = lambda size: F.ceil(F.coalesce(F.sum(size), F.lit(0)) / BLOCK_NODES).cast("int")
    buckets = placed.groupBy("bucket").agg(blocks(F.when(F.col("outside"), F.col("size"))).alias("n_out"), blocks(F.when(~F.col("outside"), F.col("size"))).alias("n_in"),
                                           F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same"), F.count(F.lit(1)).alias("rows")).where("n_out > 0")
    # buckets of the same nodes are one
    buckets = buckets.groupBy("same", "rows", "n_out", "n_in").agg(F.min("bucket").alias("bucket")).drop("same", "rows")
    own = F.pmod(F.xxhash64("node", "bucket"), F.when(F.col("outside"), F.col("n_out")).otherwise(F.col("n_in"))).cast("int")
    dealt = placed.join(buckets, "bucket").withColumn("own", own)
    # outside blocks 0, 1, ... meet each other and the inside blocks -1, -2, ...
    others = F.when(F.col("outside"), F.sequence(-F.col("n_in"), F.col("n_out") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_out") - 1))
    dealt = dealt.withColumn("own", F.when(F.col("outside"), F.col("own")).otherwise(-1 - F.col("own"))).withColumn("other", F.explode(others))
    return dealt.select("bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "root", (F.col("own") > F.col("other")).cast("int").alias("side"))


def _named(key: str, text: str) -> Column:
    real = F.col(f"`{key}`").cast("long")
    return F.coalesce(F.when(real < UNNAMED, real), F.shiftrightunsigned(F.xxhash64(F.col(f"`{text}`")), 2) + F.lit(UNNAMED))


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id and class_id (the least doc_id of the class) of every row."""
    body = docs.select(_named(key, text).alias("did"), F.col(f"`{text}`").alias("text"))
    base = written(body.mapInArrow(signatures(bands, rows), "did long, h1 long, h2 long, n long, bands array<long>"), "near-base")
    nodes = written(base.where("h1 is not null").groupBy("h1", "h2").agg(F.min("did").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "near-nodes")

    buckets = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last").drop("last")
    members = written(buckets.join(leaders, "bucket"), "near-members")
    asked = members.select(F.col("node").alias("did")).distinct().withColumn("wanted", F.lit(True))
    sets = body.join(asked, "did", "left").select("did", F.coalesce("wanted", F.lit(False)).alias("wanted"), F.when(F.col("wanted"), F.col("text")).alias("text"))
    sets = written(sets.mapInArrow(shingle_sets, "node long, grams binary, counts binary").distinct(), "near-sets")
    stars = _verify(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), sets)
    roots = written(components(stars.where(F.col("similarity") >= similarity).select("a", "b")), "near-roots")

    blocks = open_blocks(members, roots).join(sets, "node")
    between = written(blocks.groupBy("bucket", "one", "two").applyInArrow(joining_links(similarity), "a long, b long").distinct(), "near-between")
    if not between.isEmpty():  # links between components: join their roots
        upper = written(components(between), "near-upper").toDF("root", "top")
        roots = roots.join(upper, "root", "left").select("node", F.coalesce("top", "root").alias("root")) \
            .union(upper.join(roots.select(F.col("node").alias("root")), "root", "left_anti"))

    # a text without copies and links is a class of its own; the others' rows are dealt, as one text may be a third of all
    classes = nodes.join(roots, "node", "left").select("h1", "h2", F.coalesce("root", "node").alias("class"), "copies", "node").where("copies > 1 or class <> node").drop("copies", "node")
    classes = classes.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEALS - 1).cast("long"))))
    dealt = base.select("did", "h1", "h2").withColumn("deal", F.pmod(F.xxhash64("did", F.spark_partition_id()), F.lit(DEALS)))
    out = dealt.join(classes, ["h1", "h2", "deal"], "left").withColumn("class", F.coalesce("class", "did"))
    real = lambda c: F.when(F.col(c) < UNNAMED, F.col(c))
    return out.select(real("did").alias(key), real("class").alias("class_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that of the least id, nulls last."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    table = written(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    classes = near_duplicate_classes(table, row, text, **options)
    ids = classes.join(table.select(row, F.col(f"`{key}`").alias("id")), row).groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col(row))).alias("least"))
    return table.join(ids.select(F.col(f"least.{row}").alias(row)), row, "left_semi").select(*(f"`{c}`" for c in docs.columns))

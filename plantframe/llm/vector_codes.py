"""Product codes of vectors by tables over per-dimension value dictionaries.

A component is the integer floor(256 * x).  A vector is cut into equal
consecutive parts, each coded by the nearest entry of its part's codebook.  In
a block of vectors each dimension has a dictionary of its distinct integers;
the squared differences of every dictionary value to all entries are tabulated
once, and a part's distances are gathers from these tables by dictionary code,
added up over the part's dimensions.

A codebook starts as the parts of the vectors with the least ids.  In a round
every task adds up, per entry, the parts nearest to it; one partial row per task
and entry is shuffled, and the driver gets the new entries only (parts x
entries x dimensions of a part numbers, whatever the table's size).  Rows are
coded in a last pass and written; the sums of errors per label are aggregated
before any shuffle and joined back, by broadcast only if there are few labels.

Defined cases: a vector that is null or holds null, NaN or infinite components
is dropped, as is one whose length is not that of the least id's vector; a
length that the parts don't divide is filled up with zeros; components beyond
+-2**16 count as that bound; rows with the same id are coded one by one, the
least of their vectors starts an entry; rows without an id are coded but start
no entry; null labels are one label; without any kept id there are no rows; a
sum of errors beyond 64 bits is null.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantframe.llm._scratch import written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Components are cut off here, so that squares and sums of a vector fit 64 bits.
BOUND = float(1 << 16)
BLOCK_ROWS = 2048
#: Labels whose sums are broadcast; more are joined by shuffle, each label dealt to ``SALTS`` keys.
MAX_BROADCAST_LABELS, SALTS = 100_000, 16


def usable(vector: Column) -> Column:
    """True where a vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def integers(column: pa.ListArray, dims: int) -> np.ndarray:
    """floor(256 * x) of vectors of one length, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(flat, -BOUND, BOUND) * SCALE).astype(np.int64).reshape(-1, dims)


def filled(vectors: np.ndarray, parts: int) -> np.ndarray:
    more = -vectors.shape[1] % parts
    return np.pad(vectors, ((0, 0), (0, more))) if more else vectors


def nearest(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance for each row and part; ``books``: part, entry, place."""
    parts, entries, width = books.shape
    code, error = np.empty((len(vectors), parts), np.int64), np.empty((len(vectors), parts), np.int64)
    rows = np.arange(len(vectors))
    for p in range(parts):
        distance = np.zeros((len(vectors), entries), np.int64)
        for j in range(width):
            values, at = np.unique(vectors[:, p * width + j], return_inverse=True)
            table = (values[:, None] - books[p, :, j][None, :]) ** 2
            distance += table[at]
        code[:, p] = distance.argmin(axis=1)
        error[:, p] = distance[rows, code[:, p]]
    return code, error


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def part_sums(books: np.ndarray, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for block in _blocks(batches):
            vectors = filled(integers(block.column("v"), dims), parts)
            code, _ = nearest(vectors, books)
            for p in range(parts):
                count[p] += np.bincount(code[:, p], minlength=entries)
                np.add.at(total[p], code[:, p], vectors[:, p * width:(p + 1) * width])
        part, entry = np.nonzero(count)
        cell = np.repeat(part * entries + entry, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(np.tile(np.arange(width), part.size)), pa.array(total[part, entry].reshape(-1)), pa.array(np.repeat(count[part, entry], width))],
            names=["cell", "place", "total", "n"])

    return run


def coder(books: np.ndarray, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            code, error = nearest(filled(integers(block.column("v"), dims), books.shape[0]), books)
            width = max(2, len(f"{books.shape[1] - 1:x}"))
            text = ["".join(f"{c:0{width}x}" for c in row) for row in code]
            yield pa.RecordBatch.from_arrays([block.column("k"), block.column("label"), pa.array(text, pa.string()), pa.array(error.sum(axis=1))], names=["k", "label", "code", "error"])

    return run


def _kept(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    return rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v")).where(usable(F.col("v")))


def first_vectors(kept: DataFrame, n: int) -> list[np.ndarray]:
    """Integer vectors of the ``n`` least ids, ascending, those of the first one's length only."""
    ids = [r["k"] for r in kept.select("k").where(F.col("k").isNotNull()).distinct().orderBy("k").limit(n).collect()]
    found = {r["k"]: r["v"] for r in kept.where(F.col("k").isin(ids)).groupBy("k").agg(F.min("v").alias("v")).collect()} if ids else {}
    vectors = [integers(pa.array([found[k]], pa.list_(pa.float64())), max(len(found[k]), 1)) for k in ids if found[k]]
    return [v[0] for v in vectors if v.shape == vectors[0].shape]


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray | None, int]:
    """Codebooks (part, entry, place) after ``rounds`` over all rows, and the vectors' length."""
    first = first_vectors(kept, entries)
    if not first:
        return None, 0
    dims = first[0].size
    books = filled(np.array(first), parts).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    same = kept.where(F.size("v") == dims).select("v")
    for _ in range(rounds):
        sums = same.mapInArrow(part_sums(books, dims), "cell long, place long, total long, n long").groupBy("cell", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():  # at most parts x entries x width numbers
            books[r["cell"] // books.shape[1], r["cell"] % books.shape[1], r["place"]] = r["total"] // r["n"]
    return books, dims


def books_hash(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``key``, code, error, label_error and codebooks_sha256 of every kept row."""
    kept = _kept(rows, key, vector, label)
    books, dims = fit(kept, parts, entries, rounds)
    schema = T.StructType([kept.schema["k"], kept.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        coded = kept.where("false").select("k", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = written(kept.where(F.size("v") == dims).mapInArrow(coder(books, dims), schema), "vector-codes")
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "of")
    same = coded["label"].eqNullSafe(F.col("of"))
    if sums.limit(MAX_BROADCAST_LABELS + 1).count() <= MAX_BROADCAST_LABELS:
        both = coded.join(F.broadcast(sums), same)
    else:
        dealt = coded.withColumn("deal", F.pmod(F.xxhash64("k", "code"), F.lit(SALTS)))
        both = dealt.join(sums.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), dealt["label"].eqNullSafe(F.col("of")) & (F.col("deal") == F.col("to")))
    return both.select(F.col("k").alias(key), "code", "error", "label_error", F.lit("" if books is None else books_hash(books)).alias("codebooks_sha256"))

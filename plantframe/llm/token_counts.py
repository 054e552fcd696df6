"""Token counts of a byte-pair vocabulary, without the tokens.

The vocabulary is a sentencepiece BPE model.  A text is cut where no piece of
the vocabulary has the two neighbouring characters side by side: no merge ever
crosses such a place, so each segment is merged on its own and the counts add
up.  Within a segment the symbols are a linked list and the pairs that are
pieces lie in a heap; the best pair (highest score, then leftmost) is popped and
merged, its new neighbours are pushed, and pairs that a merge has broken are
passed over when they come up.  The count is the number of symbols at the start
minus the number of merges; no token id is ever looked up.  A character that
no piece has stands for its UTF-8 bytes, a symbol each that never merges.

Segments and their parts recur, so a task remembers the counts of short ones; the
memory is emptied when it is full, which changes no result.  There is no shuffle.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted one by one; a null key stays null; an empty input gives no rows; other
columns are not read.  Texts are never truncated, and a text of one endless word
costs n log n steps.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import partial
from heapq import heapify, heappop, heappush
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantframe.llm._arrays import text_blocks

#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 4096
#: sentencepiece's sign for a blank.
BLANK = "▁"
#: Segments and parts that a task remembers, and the longest of them.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 48


class Merges:
    """Counts the symbols that byte-pair merging leaves of a text.

    ``cost``: pieces and their costs, the least of which merges first.
    """

    def __init__(self, cost: dict[str, float], prefix: bool):
        places = {c: i for i, c in enumerate(sorted(set(cost.values())))}
        self.rank, self.prefix = {piece: places[c] for piece, c in cost.items()}, prefix
        self.inside = {a + b for piece in cost for a, b in zip(piece, piece[1:])}
        #: no piece has a blank behind another character, so blanks start segments
        by_blank = not any(pair[1] == BLANK != pair[0] for pair in self.inside)
        self.segments = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+" if by_blank else "(?s).+")
        self.known, self.known_parts = Memory(self.segment), Memory(self.merged)

    def count(self, text: str) -> int:
        """Symbols left of a whole text."""
        if not text:
            return 0
        return sum(map(self.known.__getitem__, self.segments.findall((BLANK if self.prefix else "") + text.replace(" ", BLANK))))

    def segment(self, segment: str) -> int:
        """The same of a segment, cut between characters that no piece has side by side."""
        total, start, inside = 0, 0, self.inside
        for i, pair in enumerate(map(add, segment, segment[1:]), 1):
            if pair not in inside:
                total += self.known_parts[segment[start:i]]
                start = i
        return total + self.known_parts[segment[start:]]

    def merged(self, part: str) -> int:
        """Symbols at the start minus merges."""
        n, rank = len(part), self.rank
        if n == 1:
            return 1 if part in rank else len(part.encode())
        symbol: list[str | None] = list(part)
        links = list if n <= REMEMBERED_LENGTH else partial(array, "q")
        before, after = links(range(-1, n - 1)), links(range(1, n + 1))
        # a pair is its rank and its left symbol's place, in one number
        heap = [rank[pair] * n + i for i, pair in enumerate(map(add, part, part[1:])) if pair in rank]
        heapify(heap)
        merges = 0
        while heap:
            best, left = divmod(heappop(heap), n)
            right, first = after[left], symbol[left]
            if right >= n or first is None or rank.get(first + symbol[right]) != best:
                continue  # one of the two has merged with another neighbour
            merges += 1
            first += symbol[right]
            symbol[left], symbol[right] = first, None
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                if (longer := rank.get(first + symbol[right])) is not None:
                    heappush(heap, longer * n + left)
            if (left := before[left]) >= 0 and (longer := rank.get(symbol[left] + first)) is not None:
                heappush(heap, longer * n + left)
        return n + sum(len(c.encode()) - 1 for c in part if c not in rank) - merges


class Memory(dict):
    """Results of a function for short strings, emptied when full."""

    def __init__(self, of: Callable[[str], int]):
        super().__init__()
        self.of = of

    def __missing__(self, key: str) -> int:
        value = self.of(key)
        if len(key) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


def read_pieces(path: str) -> tuple[dict[str, float], bool]:
    """Pieces with their costs, and whether a text gets a blank in front, of a sentencepiece BPE model."""
    from sentencepiece import sentencepiece_model_pb2 as model

    spec = model.ModelProto()
    with open(path, "rb") as f:
        spec.ParseFromString(f.read())
    kinds = model.ModelProto.SentencePiece
    rules, kept = spec.normalizer_spec, [p for p in spec.pieces if p.type not in (kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE)]
    if spec.trainer_spec.model_type != model.TrainerSpec.BPE or not spec.trainer_spec.byte_fallback or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: only BPE models with byte fallback and blanks in front of words are counted")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or any(p.type != kinds.NORMAL for p in kept):
        raise ValueError(f"{path}: only models without normalisation and without pieces of the user are counted")
    return {p.piece: -p.score for p in kept}, rules.add_dummy_prefix


def counter(cost: dict[str, float], prefix: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(cost, prefix)
        for block in text_blocks(batches):
            n = [merges.count(text or "") for text in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("k"), block.column("n_bytes"), pa.array(n, pa.int64())], names=["k", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit of every row; ``model``: path of a sentencepiece BPE model, read by the driver."""
    body = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long").alias("n_bytes"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([body.schema["k"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = body.mapInArrow(counter(*read_pieces(model)), schema)
    return counted.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

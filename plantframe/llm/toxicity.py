"""Toxicity scores from a lexicon, with misspellings and context.

The lexicon is learned: words, and stems of words, of labelled documents whose
log-odds of a toxic label are high and well supported.  Its trie is intersected with the
Levenshtein automaton of a word (a bit mask of the word's places for each
number of errors, moved along the trie's edges) to catch terms with up to
``MAX_DISTANCE`` errors.  Each hit is judged by the words around it: inside
quotation marks or after a verb of reporting it is a quotation, else abuse, more
so beside an address ("you").  Sums of these feed a logistic regression.

Training reads a bounded sample (``MAX_TRAIN`` documents, drawn by a hash of the
id), one row of each id.  The regression sees each half of it through a lexicon learned
from the other half, so that words that are rare by chance don't look better than they
are; the lexicon that scores is learned from both.  Misspellings and quotations
are rare in labelled rows, so the regression sees every toxic document also
with its hits misspelled (toxic as well) and with its hits quoted (not toxic).
A term must occur in several toxic documents of the sample, which bounds the lexicon.
Scoring is one scan of all documents.

Defined cases: a null or wordless text has no hits and gets the regression's
base score; a null doc_id or label is never trained on; a document with several
labels counts as toxic if one says so; without any labelled row of both kinds
all scores are 0; repeated rows are scored one by one; an empty input gives no
rows.  Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.llm._arrays import Words, byte_codes, prefix_sums, range_hash, text_blocks, text_buffer
from plantframe.llm._scratch import written

MAX_TRAIN = 24_000
MIN_SUPPORT = 5
MIN_LOG_ODDS = 2.5
#: Bytes of the stems that are learned beside whole words, for terms that come with many endings.
STEMS = (4, 5, 6, 7, 8)
MIN_STEM_SUPPORT = 8
MAX_DISTANCE = 1
#: Shorter terms are not searched with errors.
MIN_FUZZY_LETTERS = 5
MIN_FUZZY_SUPPORT = 15
CONTEXT = 6
THRESHOLD = 0.7

# Verbs of reporting, words of address and quotation marks.
REPORTING = {"said", "says", "called", "calls", "wrote", "quoted", "quote", "sagte", "schrieb", "nannte", "zitat", "dit", "écrit", "appelé", "citation", "dijo", "llamó", "escribió", "cita"}
ADDRESS = {"you", "your", "u", "ur", "du", "dich", "dein", "ihr", "euch", "tu", "toi", "vous", "votre", "usted", "eres", "tú"}
OPENING, CLOSING = "\"“„«‚‘", "\"”“»‘’"

_WORD = np.zeros(256, bool)
_WORD[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *b"@$", *range(128, 256)]] = True
FEATURES = ["strength", "terms", "density", "fuzzy", "quoted", "addressed"]


class TermTrie:
    """Trie of terms, searched by words with errors."""

    def __init__(self, terms: list[str]):
        self.root: dict = {}
        for i, term in enumerate(terms):
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = i
        # a word with one error keeps the first or the second half of the term
        self.heads = {t[:len(t) // 2] for t in terms}
        self.tails = {t[len(t) // 2:] for t in terms}
        self.lengths = {len(t) for t in terms}

    def may_match(self, word: str, errors: int) -> bool:
        if errors != 1:
            return True
        n = len(word)
        return any(t in self.lengths and (word[:t // 2] in self.heads or word[max(n - (t - t // 2), 0):] in self.tails) for t in (n - 1, n, n + 1))

    def search(self, word: str, errors: int) -> tuple[int, int] | None:
        """Term and number of errors of the nearest term within ``errors`` (ties: the first term)."""
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | 1 << i
        goal = 1 << len(word)
        best: tuple[int, int] | None = None
        stack = [(self.root, tuple((1 << (e + 1)) - 1 for e in range(errors + 1)))]
        while stack:
            node, states = stack.pop()
            for c, below in node.items():
                if c == "":
                    for e, s in enumerate(states):
                        if s & goal:
                            if best is None or (e, below) < (best[1], best[0]):
                                best = (below, e)
                            break
                    continue
                mask, moved = at.get(c, 0), []
                for e, s in enumerate(states):
                    m = (s & mask) << 1
                    if e:
                        m |= states[e - 1] | states[e - 1] << 1 | moved[e - 1] << 1
                    moved.append(m)
                if any(moved):
                    stack.append((below, tuple(moved)))
        return best


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def _lowered(block: pa.RecordBatch) -> tuple[bytes, Words]:
    raw, bounds = text_buffer(pc.utf8_lower(block.column("text").cast(pa.large_string()).fill_null("")))
    return raw.tobytes(), Words(np.where(_WORD[raw], raw, np.uint8(32)), bounds)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, and those with the label, for each word and stem of a block."""
    for block in text_blocks(batches):
        data, words = _lowered(block)
        toxic = block.column("toxic").to_numpy(zero_copy_only=False)
        sums = prefix_sums(byte_codes(np.frombuffer(data, np.uint8)))
        for length in (0, *STEMS):
            of = np.flatnonzero(words.end - words.start > length)
            end = words.start[of] + length if length else words.end[of]
            if not of.size:
                continue
            _, one = np.unique(np.rec.fromarrays([range_hash(sums, words.start[of], end), words.doc[of]], names="c,d"), return_index=True)
            of, end = of[one], end[one]
            _, first, which = np.unique(range_hash(sums, words.start[of], end), return_index=True, return_inverse=True)
            hits = np.bincount(which, weights=toxic[words.doc[of]]).astype(np.int64)
            text = [data[a:b] + b"*" * (length > 0) for a, b in zip(words.start[of[first]], end[first])]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.binary()), pa.array(hits), pa.array(np.bincount(which).astype(np.int64))], names=["word", "toxic", "docs"])


class Scorer:
    """Features of documents against a lexicon; words seen before are remembered."""

    def __init__(self, lexicon: list[tuple[str, float, int]], max_distance: int):
        self.exact = {w: s for w, s, _ in lexicon if w[-1] != "*"}
        self.stems = {w[:-1].encode("utf-8", "surrogateescape"): s for w, s, _ in lexicon if w[-1] == "*"}
        fuzzy = [w for w, _, n in lexicon if w[-1] != "*" and len(w) >= MIN_FUZZY_LETTERS and n >= MIN_FUZZY_SUPPORT]
        self.strength = [self.exact[w] for w in fuzzy]
        self.trie = TermTrie(fuzzy)
        self.errors = max_distance
        self.known: dict[int, tuple[float, int] | None] = {}

    def look_up(self, word: str) -> tuple[float, int] | None:
        if word in self.exact:
            return self.exact[word], 0
        raw = word.encode()
        for n in STEMS:
            if len(raw) > n and raw[:n] in self.stems:
                return self.stems[raw[:n]], 0
        if len(word) < MIN_FUZZY_LETTERS - self.errors or not self.trie.may_match(word, self.errors):
            return None
        found = self.trie.search(word, self.errors)
        return None if found is None or not found[1] else (self.strength[found[0]], found[1])

    def features(self, block: pa.RecordBatch) -> np.ndarray:
        return np.log1p(np.maximum(self.sums(block), 0))

    def sums(self, block: pa.RecordBatch) -> np.ndarray:
        """The features before the logarithm."""
        data, words = _lowered(block)
        out = np.zeros((block.num_rows, len(FEATURES)))
        code, first, which = np.unique(words.code, return_index=True, return_inverse=True)
        hit = np.zeros(code.size, bool)
        if len(self.known) > 2_000_000:
            self.known.clear()
        values: list[tuple[float, int] | None] = []
        for i, (c, a, b) in enumerate(zip(code.tolist(), words.start[first].tolist(), words.end[first].tolist())):
            if c not in self.known:
                self.known[c] = self.look_up(data[a:b].decode("utf-8", "replace"))
            v = self.known[c]
            values.append(v)
            hit[i] = v is not None
        terms: dict[int, set[int]] = {}
        for at in np.flatnonzero(hit[which]).tolist() if code.size else []:
            d = int(words.doc[at])
            strength, errors = values[which[at]]
            quoted, addressed = self._context(data, words, at, d)
            row = out[d]
            if quoted:
                row[4] += 1
                continue
            row[2] += 1
            row[5] += addressed
            if errors:
                row[3] += 1
            elif which[at] not in terms.setdefault(d, set()):
                terms[d].add(which[at])
                row[0] += strength
                row[1] += 1
        out[:, 2] = 100 * out[:, 2] / np.maximum(words.count, 20)
        return out

    @staticmethod
    def _context(data: bytes, words: Words, at: int, doc: int) -> tuple[bool, bool]:
        lo, hi = max(words.first[doc], at - CONTEXT), min(words.first[doc + 1], at + CONTEXT + 1)
        near = [data[words.start[i]:words.end[i]].decode("utf-8", "replace") for i in range(lo, hi) if i != at]
        before = data[words.start[lo]:words.start[at]].decode("utf-8", "replace")
        after = data[words.end[at]:words.end[hi - 1]].decode("utf-8", "replace")
        inside = any(before.count(o) > (before.count(c) if o != c else before.count(o) // 2 * 2) and c in after for o, c in zip(OPENING, CLOSING) if o in before)
        return inside or any(w in REPORTING for w in near[:at - lo]), any(w in ADDRESS for w in near)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Logistic regression (intercept last) by Newton's method with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def with_variants(sums: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents, and toxic ones again with all hits misspelled (toxic) and with all hits quoted (not toxic)."""
    hits = sums[toxic & (sums[:, 1] + sums[:, 3] > 0)]
    n = hits[:, 1] + hits[:, 3]
    misspelled, quoted = hits.copy(), np.zeros_like(hits)
    misspelled[:, [0, 1]], misspelled[:, 3], quoted[:, 4] = 0, n, n
    return np.concatenate([sums, misspelled, quoted]), np.concatenate([toxic, np.ones(len(hits), bool), np.zeros(len(hits), bool)])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_train: int = MAX_TRAIN) -> tuple[list[tuple[str, float, int]], np.ndarray | None]:
    """Lexicon (term, log-odds, support) and weights, from a bounded sample of the rows that are not held out."""
    own = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id"))) \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = own.count()
    share = min(1.0, max_train / max(n, 1))
    sample = own.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    # at most about max_train rows: of a repeated id the least text
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(sample), "id")
    rows = written(rows.groupBy("id", "toxic").agg(F.min("text").alias("text")), "toxic-train")
    rows = rows.withColumn("half", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(2)).cast("int"))
    totals = {r["half"]: (r["a"], r["n"]) for r in rows.groupBy("half").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")).collect()}
    a_all, n_all = (sum(t[i] for t in totals.values()) for i in (0, 1))
    if not 0 < a_all < n_all:
        return [], None
    counted = "word binary, toxic long, docs long"
    words = [rows.where(F.col("half") == h).select("text", "toxic").mapInArrow(count_words, counted).groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("docs").alias("n")) for h in (0, 1)]
    lexicons = [_lexicon(words[h], *totals.get(h, (0, 0))) for h in (0, 1)]
    lexicon = _lexicon(words[0].unionByName(words[1]).groupBy("word").agg(F.sum("a").alias("a"), F.sum("n").alias("n")), a_all, n_all)

    def learner(terms: list[tuple[str, float, int]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(terms, MAX_DISTANCE)
            for block in text_blocks(batches):
                x, toxic = with_variants(scorer.sums(block), block.column("toxic").to_numpy(zero_copy_only=False) > 0)
                x = np.log1p(np.maximum(x, 0))
                yield pa.RecordBatch.from_arrays([pa.array(toxic.astype(np.int32)), *[pa.array(x[:, i]) for i in range(len(FEATURES))]], names=["toxic", *FEATURES])

        return run

    features = "toxic int, " + ", ".join(f"{f} double" for f in FEATURES)
    # each half is seen through the other half's lexicon
    seen = rows.where("half = 0").select("text", "toxic").mapInArrow(learner(lexicons[1]), features).union(rows.where("half = 1").select("text", "toxic").mapInArrow(learner(lexicons[0]), features)).toPandas()
    y = (seen["toxic"] > 0).to_numpy(float)
    if not 0 < y.sum() < len(y):
        return lexicon, None
    return lexicon, _fit(seen[FEATURES].to_numpy(), y)


def _lexicon(words: DataFrame, toxic: int, total: int) -> list[tuple[str, float, int]]:
    """Terms of enough toxic documents and log-odds, from counts of documents (a: toxic, n: all)."""
    odds = F.log((F.col("a") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("n") - F.col("a") + 0.5) / F.lit(total - toxic + 1.0))
    least = F.when(F.substring("word", -1, 1) == F.lit(b"*"), MIN_STEM_SUPPORT).otherwise(MIN_SUPPORT)
    top = words.where(F.col("a") >= least).withColumn("odds", odds).where(F.col("odds") >= MIN_LOG_ODDS).orderBy(F.desc(F.col("odds") * F.log("a")), "word").collect()
    return [(bytes(r["word"]).decode("utf-8", "surrogateescape"), float(r["odds"]), int(r["a"])) for r in top]


def score(docs: DataFrame, lexicon: list[tuple[str, float, int]], weights: np.ndarray | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score and predicted of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon, MAX_DISTANCE)
        for block in text_blocks(batches):
            if weights is None:
                p = np.zeros(block.num_rows)
            else:
                p = 1 / (1 + np.exp(-np.clip(scorer.features(block) @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(p)], names=["id", "score"])

    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("id").schema.add("score", "double")
    return rows.mapInArrow(run, schema).select(F.col("id").alias(key), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Vector codes, token counts and hard negatives against plain Python, on odd and empty tables."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantframe.llm import hard_negatives, token_counts, vector_codes

tokenizers = pytest.importorskip("public_tokenizers")
MODEL = "piece_bpe_32k.model"
CLASH = ["k", "id", "v", "n", "of", "deal", "code", "block", "grp", "place", "n_bytes", "rank", "score", "positives"]


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(4)]
    return [(i * 10, [rng.choice(centre)[d] + rng.gauss(0, 0.1) * spread for d in range(dims)], rng.randrange(3)) for i in range(n)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASH})


ODD = [(5, None, 1), (6, [], 1), (7, [1.0, None, 2.0, 0.0], 1), (8, [math.nan, 0.0, 0.0, 0.0], 2), (9, [math.inf, 0.0, 0.0, 0.0], 2), (11, [1.0], 0),
       (None, [0.25, 0.5, -1.0, 0.125], 1), (12, [0.25, 0.5, -1.0, 0.125], None), (100, [1e300, -1e300, 5.0, 0.0], 1)]


def usable(v, dims):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)


def whole(v, bound):
    return [math.floor(256 * Fraction(min(max(x, -bound), bound))) for x in v]


def brute_codes(rows, parts, entries, rounds):
    first = min((r for r in rows if r[0] is not None and usable(r[1], len(r[1] or [])) and r[1]), key=lambda r: r[:2])
    dims = len(first[1])
    kept = [(k, whole(v, vector_codes.BOUND) + [0] * (-dims % parts), label) for k, v, label in rows if usable(v, dims)]
    width = len(kept[0][1]) // parts
    seeds = {}
    for k, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: r[:2]):
        seeds.setdefault(k, v)
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for v in list(seeds.values())[:entries]] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(members[i]) for c in zip(*members[i])] if i in members else e for i, e in enumerate(books[p])]
    out = []
    for k, v, label in kept:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((k, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), label))
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((k, c, e, total[label], hashlib.sha256(text.encode()).hexdigest()) for k, c, e, label in out), key=str)


@pytest.mark.parametrize("seed,n,dims,parts,entries", [(1, 120, 8, 4, 8), (2, 5, 8, 2, 64), (3, 60, 6, 4, 16)])
def test_vector_codes(spark, seed, n, dims, parts, entries):
    rows = vectors(seed, n, dims)
    rows += [rows[0], (rows[1][0], rows[2][1], 2)]  # a repeated row, and another vector of the same id
    got = vector_codes.encode(frame(spark, rows), parts=parts, entries=entries).collect()
    assert sorted(map(tuple, got), key=str) == brute_codes(rows, parts, entries, 2)


def test_vector_codes_odd_rows(spark, monkeypatch):
    odd = [r for r in ODD if r[0] not in (6, 11)]
    whole_rows = sorted(map(tuple, vector_codes.encode(frame(spark, odd), parts=2, entries=4).collect()), key=str)
    assert whole_rows == brute_codes(odd, 2, 4, 2)
    assert len(whole_rows) == 3 and {r[0] for r in whole_rows} == {None, 12, 100}
    monkeypatch.setattr(vector_codes, "MAX_BROADCAST_LABELS", 0)  # the shuffled join of the sums
    assert sorted(map(tuple, vector_codes.encode(frame(spark, odd), parts=2, entries=4).collect()), key=str) == whole_rows
    # the least id's vector gives the length
    assert [r["vec_id"] for r in vector_codes.encode(frame(spark, ODD), parts=2, entries=4).collect()] == [11]
    assert vector_codes.encode(frame(spark, ODD[:1])).collect() == [] and vector_codes.encode(frame(spark, ODD).where("false")).collect() == []


def brute_negatives(rows):
    kept = {}
    for k, v, label in rows:
        if k is None or label is None or not usable(v, len(v or [])) or not v:
            continue
        label = (label + 1) % 10 if k % 7 == 0 else label
        kept[k] = min(kept.get(k, (label, v)), (label, v))
    dims = len(kept[min(kept)][1]) if kept else 0
    kept = {k: (label, whole(v, hard_negatives.BOUND)) for k, (label, v) in kept.items() if len(v) == dims}
    out = []
    for a, (tag, x) in kept.items():
        if a % 100:
            continue
        score = {k: sum(p * q for p, q in zip(x, v)) for k, (_, v) in kept.items()}
        order = sorted((k for k in kept if k != a), key=lambda k: (-score[k], k))
        for p in [k for k in order if kept[k][0] == tag][:5]:
            fits = [k for k in order if kept[k][0] != tag and 30 * score[p] <= 100 * score[k] <= 90 * score[p]]
            out += [(a, p, i, k, score[p], score[k]) for i, k in enumerate(fits[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,n,block,deal,group", [(1, 300, 256, 32, 1024), (2, 300, 7, 3, 4), (3, 90, 1, 1, 1), (4, 250, 16, 2, 5)])
def test_hard_negatives(spark, monkeypatch, seed, n, block, deal, group):
    """Also with blocks so small that the zone maps let blocks out, and several groups and deals."""
    for name, value in (("BLOCK_ROWS", block), ("BLOCKS_PER_DEAL", deal), ("ANCHORS_PER_GROUP", group)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(seed, n, 5, 0.2)
    rows += rows[:20] + [(rows[3][0], rows[4][1], 0)]  # repeated rows
    rows += [(5000 + i, rows[i][1], 1) for i in range(0, 60, 3)]  # equal vectors, so equal scores
    rows += [(700_000, [0.0] * 5, 1)]  # an anchor whose scores are all 0
    got = sorted(map(tuple, hard_negatives.mine(frame(spark, rows)).collect()))
    assert got == brute_negatives(rows)
    assert got


def test_more_partitions_than_asked_for(spark, monkeypatch):
    """A cluster that raises partition counts spreads the anchors over more of them than there are groups."""
    kind = type(spark.range(1))
    plain = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, n, *cols: plain(self, 29, *cols))
    rows = vectors(5, 900, 4, 0.3)
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, rows)).collect())) == brute_negatives(rows)


def test_hard_negatives_odd_rows(spark):
    odd = [r for r in ODD if r[0] not in (6, 11)] + [(101, [1e300, -3.0, 5.0, 0.0], 1), (102, [2e4, 0.0, 0.0, 1.0], 2), (200, [0.5, 0.5, 0.5, 0.5], 9), (203, [0.4, 0.5, 0.5, 0.5], 8)]
    got = sorted(map(tuple, hard_negatives.mine(frame(spark, odd)).collect()))
    assert got == brute_negatives(odd) and got
    for rows in (ODD[:1], ODD[:2], [(100, [1.0, 2.0], 1)]):
        assert hard_negatives.mine(frame(spark, rows)).collect() == []
    empty = hard_negatives.mine(frame(spark, ODD).where("false"))
    assert empty.collect() == [] and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hilbert_curve_and_bounds():
    cells = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    place = hard_negatives.hilbert(cells, 3)
    assert sorted(place.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()  # one step at a time
    rng = np.random.default_rng(4)
    x, anchors = rng.integers(-9, 9, (40, 6)), rng.integers(-9, 9, (10, 6))
    least, most = hard_negatives.bounds(anchors, x.min(axis=0)[None, :], x.max(axis=0)[None, :])
    exact = hard_negatives.scores(anchors, x)
    assert (exact == anchors @ x.T).all() and (least[:, 0] <= exact.min(axis=1)).all() and (most[:, 0] >= exact.max(axis=1)).all()
    big = rng.integers(-(1 << 23), 1 << 23, (5, 300))
    assert (hard_negatives.scores(big, big) == big @ big.T).all()


def test_zone_maps_let_blocks_out():
    """Two distant clusters: an anchor of one asks for the blocks of its own only."""
    import pyarrow as pa

    low, high = np.full((1, 4), -100), np.full((1, 4), 100)
    lo, hi = np.concatenate([high - 5, low - 5]), np.concatenate([high + 5, low + 5])
    pack = lambda v: v.astype("<i4").tobytes()
    anchors = pa.table({"id": [100], "label": [1], "vector": [pack(high)], "least": [30_000]})
    ask, _ = hard_negatives.Wanted(anchors, 4, False).asks(lo, hi, [np.array([1, 2]), np.array([1, 2])])
    assert ask.tolist() == [[True, False]]
    anchors = pa.table({"id": [100], "label": [1], "vector": [pack(high)], "positives": [[{"positive": 7, "score": 40_000}]]})
    ask, _ = hard_negatives.Wanted(anchors, 4, True).asks(lo, hi, [np.array([1, 2]), np.array([1, 2])])
    assert ask.tolist() == [[False, False]]  # the window ends at 36,000, below the first block's least score


def test_token_counts(spark, sf_small):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path(MODEL))
    rng = random.Random(2)
    odd = [None, "", " ", "a  b", "\n", "<s> hi </s><unk>", "x ▁ y", "日本語のテキスト", "🙂🙂 z", "a" * 5000, "<0x0A>", "\x00a", "   lead", "trail   ", "alpha beta " * 30_000]
    odd += ["".join(rng.choice("ab ▁\n日é🙂<>s/ tion") for _ in range(rng.randrange(80))) for _ in range(400)]
    docs = spark.createDataFrame([(i // 2 if i > 3 else None, t) for i, t in enumerate(odd)], "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASH})
    real = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    for df in (docs, real):
        got = token_counts.count_tokens(df, tokenizers.path(MODEL), limit=500).collect()
        want = []
        for r in df.collect():
            n = len(library.encode(r["text"] or ""))
            want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 500))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(docs.where("false"), tokenizers.path(MODEL)).collect() == []


def test_heap_merges_follow_the_ranks():
    """Against the plain loop that scans all pairs for the best one, on small vocabularies where pieces cross."""
    rng = random.Random(7)
    for _ in range(300):
        cost = {c: 0.0 for c in "abc"}
        for _ in range(rng.randrange(1, 9)):
            cost[rng.choice(list(cost)) + rng.choice(list(cost))] = float(rng.randrange(5))
        merges = token_counts.Merges(cost, False)
        for _ in range(20):
            text = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 25)))
            symbols = list(text)
            while True:
                pairs = [(cost[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in cost]
                if not pairs:
                    break
                i = min(pairs)[1]
                symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            assert merges.count(text) == sum(1 if s in cost else len(s.encode()) for s in symbols)
    limited = token_counts.Merges({"a": 0.0, "b": 0.0, "ab": 1.0}, False)
    token_counts_limit, token_counts.REMEMBERED = token_counts.REMEMBERED, 2
    try:
        assert [limited.count(t) for t in ("ab", "a", "b", "ba", "abab", "ab")] == [1, 1, 1, 2, 2, 1]
    finally:
        token_counts.REMEMBERED = token_counts_limit

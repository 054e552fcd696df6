"""Operators against plain Python on small and planted inputs."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantframe.llm import _arrays, _shared_windows, decontaminate, licenses, line_dedup, mixing, near_dedup, quality, rlz_dedup, suffix_dedup, toxicity, url_filter

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def corpus(seed, n=60, alphabet=("a", "b", "cd", "é"), most=60):
    """Texts of few words, so that passages recur by themselves; some are cut and pasted from others."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(alphabet) for _ in range(rng.randrange(most))]
        for _ in range(rng.randrange(3)):
            if out:
                other = rng.choice(out)[1].split()
                a = rng.randrange(len(other) + 1)
                at = rng.randrange(len(words) + 1)
                words[at:at] = other[a:a + rng.randrange(5, 40)]
        out.append((i * 3 % 101, rng.choice([" ", "  ", "\n"]).join(words)))
    return out


@pytest.mark.parametrize("seed,least", [(1, None), (2, None), (1, 1), (2, 8)])
def test_word_and_byte_repeats(spark, monkeypatch, seed, least):
    """Also with all anchors hot, and with some."""
    if least:
        monkeypatch.setattr(_shared_windows, "HOT_LEAST", least)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got7 = {r["doc_id"]: r for r in rlz_dedup.remove_repeats(df, size=10).collect()}
    got8 = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(df, size=20).collect()}
    for split, got, size, glue, columns in ((WORD.findall, got7, 10, " ", "n_words"), (lambda t: [bytes([b]) for b in t.encode()], got8, 20, b"", "n_bytes")):
        seen: set = set()
        for i, t in sorted(docs):
            units = split(t)
            covered, own = [False] * len(units), set()
            for p in range(len(units) - size + 1):
                w = tuple(units[p:p + size])
                own.add(w)
                if w in seen:
                    covered[p:p + size] = [True] * size
            seen |= own
            kept = glue.join(u for u, c in zip(units, covered) if not c)
            r = got[i]
            assert (r[columns], r["n_removed"]) == (len(units), sum(covered))
            assert r["kept_sha256"] == hashlib.sha256(kept if isinstance(kept, bytes) else kept.encode()).hexdigest()
            spans = [x for s in r["spans"] for x in range(s["start"], s["start"] + s[1])]
            assert spans == [p for p, c in enumerate(covered) if c]


def test_greedy_factors():
    """Factors with their lengths: the first as long as its block goes on, then a new search from the windows across its end."""
    block, other = list(range(100, 130)), list(range(118, 140))
    document = [1, 2, *range(105, 128), *range(128, 136), 3, 4, *range(100, 112)]
    code = np.array(block + other + document, np.uint64)
    size, at = 6, len(block) + len(other)
    bounds = [(0, len(block)), (len(block), at)]
    index = {}
    for a, b in bounds:
        for p in range(a, b - size + 1):
            index.setdefault(tuple(code[p:p + size]), (p, b))
    windows = range(at, code.size - size + 1)
    hits = [index.get(tuple(code[p:p + size])) for p in windows]
    found = np.array([i for i, h in enumerate(hits) if h])
    source, source_end = (np.array([h[k] if h else 0 for h in hits]) for k in (0, 1))
    got = rlz_dedup.greedy(found, np.array(windows), source, np.full(len(hits), code.size), source_end, code, size)
    # 25 words up to the first block's end; across its end the second block takes over; then the first one's head again
    assert [(w, s, n) for w, s, n in got] == [(2, 5, 25), (22, len(block) + 7, 11), (35, 0, 12)]
    covered = {w + k for w, _, n in got for k in range(n - size + 1)}
    assert covered == set(found.tolist())
    assert rlz_dedup.matching(np.arange(300) % 150, 0, 150, 150) == 150 and rlz_dedup.matching(np.array([1, 2, 1, 3]), 0, 2, 2) == 1


def test_suffix_array():
    rng = np.random.default_rng(5)
    for _ in range(300):
        alphabet = int(rng.integers(1, 6))
        x = rng.integers(0, alphabet, int(rng.integers(1, 80)))
        assert suffix_dedup.suffix_array(x, alphabet).tolist() == sorted(range(x.size), key=lambda i: x[i:].tolist())


def test_anchored_runs_cover_all_windows():
    """Each window is in exactly one run, and equal windows have equal keys."""
    rng = np.random.default_rng(3)
    codes = _arrays.mix(rng.integers(0, 3, 400).astype(np.uint64))
    first = np.array([0, 90, 95, 250, 400])
    runs = _arrays.Runs(codes, first, 12, 4)
    windows = [w for a, b in zip(runs.lo, runs.hi) for w in range(a, b + 1)]
    assert windows == [w for a, b in zip(first, first[1:]) for w in range(a, max(b - 11, a))]
    key = {}
    for a, b, k in zip(runs.lo, runs.hi, runs.key):
        for w in range(a, b + 1):
            assert key.setdefault(codes[w:w + 12].tobytes(), k) == k


def test_planes_round_trip():
    x = np.array([0, 1, 255, 256, (1 << 48) - 1], np.uint64)
    assert _arrays.from_planes(_arrays.planes(x, 6), x.size, 6).tolist() == x.tolist()


def near_corpus():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 40, 200]))]
        for _ in range(rng.choice([1, 2, 5, 20])):
            words = list(base)
            for _ in range(rng.randrange(len(base) // 12 + 1)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append((len(out) * 7 % 1009, " ".join(words)))
    return out + [(2000, "x y"), (2001, "x  y"), (2002, "x")]


def similarity(x, y):
    """Probability Jaccard similarity of two Counters, by its definition."""
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())


def brute_classes(docs):
    bags = {i: Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, t in docs if (w := WORD.findall(t))}
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def linked(a, b):
        n = len(bags[a].keys() & bags[b].keys())
        if set(bags[a].values()) == {1} == set(bags[b].values()):
            return n / len(bags[a].keys() | bags[b].keys()) >= 0.8
        return n and similarity(bags[a], bags[b]) >= 0.8

    for a in bags:
        for b in bags:
            if a < b and find(a) != find(b) and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in docs}


def test_near_duplicates(spark):
    docs = near_corpus()
    got = near_dedup.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(docs)
    kept = near_dedup.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(brute_classes(docs).values()))


def test_near_duplicates_with_repeated_passages(spark):
    """Texts that repeat passages: the counts decide, not the sets."""
    docs = []
    for pair in range(20):
        base = [f"p{pair}w{i}" for i in range(104)]  # 100 shingles
        foot = [f"p{pair}f{i}" for i in range(17)]
        docs += [(10 * pair, " ".join(base)), (10 * pair + 1, " ".join(base + foot * 200))]  # the foot outweighs the rest
        docs += [(10 * pair + 2, " ".join(foot * 30)), (10 * pair + 3, " ".join(foot * 200))]  # nearly the same shares
        docs += [(10 * pair + 4, " ".join(base * 2 + foot)), (10 * pair + 5, " ".join(base * 3 + foot))]
    expected = brute_classes(docs)
    assert all(expected[10 * p + 1] == expected[10 * p + 2] == expected[10 * p + 3] == 10 * p + 1 and expected[10 * p + 4] == expected[10 * p + 5] == 10 * p for p in range(20))
    got = near_dedup.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == expected


def edited_copies(n, edits, length=300, seed=9):
    """Copies of one text, each with words of its own at random places."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    out = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(length), edits):
            words[k] = f"x{i}_{k}"
        out.append((i, " ".join(words)))
    return out


def test_weighted_similarity_and_its_bound():
    rng = np.random.default_rng(8)
    for _ in range(200):
        size = int(rng.integers(1, 12))
        codes = [np.sort(rng.choice(40, int(rng.integers(1, 20)), replace=False)).astype(np.uint64) for _ in range(size)]
        weights = [rng.integers(1, rng.choice([2, 4, 30]), c.size) for c in codes]
        shared = near_dedup.common_weights(codes, weights)
        for a in range(size):
            for b in range(size):
                x, y = (Counter(dict(zip(codes[i].tolist(), weights[i].tolist()))) for i in (a, b))
                exact = similarity(x, y)
                assert abs(near_dedup.prob_jaccard(codes[a], weights[a], codes[b], weights[b]) - exact) < 1e-9
                if a != b:
                    assert shared[a, b] == sum(x[i] for i in x.keys() & y.keys())
                    bound = 1 / (sum(x.values()) / float(shared[a, b]) + sum(y.values()) / float(shared[b, a]) - 1) if shared[a, b] else 0.0
                    assert exact <= bound + 1e-9


@pytest.mark.parametrize("dense", [2, 16])
def test_common_weights_of_frequent_shingles(monkeypatch, dense):
    monkeypatch.setattr(near_dedup, "DENSE_FROM", dense)
    monkeypatch.setattr(near_dedup, "DENSE_COLUMNS", 3)
    rng = np.random.default_rng(2)
    codes = [np.sort(rng.choice(25, 12, replace=False)).astype(np.uint64) for _ in range(60)]
    weights = [rng.integers(1, 5, 12) for _ in codes]
    shared = near_dedup.common_weights(codes, weights)
    for a, b in ((0, 1), (5, 40), (59, 3)):
        assert shared[a, b] == weights[a][np.isin(codes[a], codes[b])].sum()


@pytest.mark.parametrize("block", [2048, 16])
def test_large_groups_near_the_similarity(spark, monkeypatch, block):
    """Copies of which some pairs reach the similarity and most don't, in one block and in many."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", block)
    docs = edited_copies(120, 6) + [(1000 + i, t) for i, t in edited_copies(60, 2, seed=3)] + [(2000, edited_copies(1, 6)[0][1])]
    expected = brute_classes(docs)
    assert 1 < len(set(expected.values())) < 121
    got = near_dedup.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == expected


def test_rows_grow_with_the_copies_not_their_pairs(spark, monkeypatch):
    """Copies just below the similarity, so that no link takes any of them out: no table has a row per pair."""
    rows = {}
    for n in (400, 800, 1600):
        written, most = near_dedup.written, [0]

        def counted(df, name):
            out = written(df, name)
            most.append(out.count())
            return out

        monkeypatch.setattr(near_dedup, "written", counted)
        docs = spark.createDataFrame(edited_copies(n, 5, 200), "doc_id long, text string")
        got = near_dedup.near_duplicate_classes(docs).collect()
        monkeypatch.setattr(near_dedup, "written", written)
        rows[n] = max(most)
        assert len(got) == n
        if n == 400:
            expected = brute_classes(edited_copies(n, 5, 200))
            assert {r["doc_id"]: r["class_id"] for r in got} == expected and len(set(expected.values())) > 300
    assert rows[1600] < 5 * rows[400]


def test_one_row_of_each_class_whatever_the_ids(spark):
    """Rows without an id and rows with one id for different texts are documents of their own."""
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(None, text), (None, text), (7, other), (7, other + " tail"), (3, text), (None, other), (9, text + " more"), (9, "short"), (9, None), (None, ""), (None, "alone here")]
    kept = sorted(map(tuple, near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()), key=str)
    assert [(i, t) for i, t in kept if t != other and t != other + " tail"] == sorted([(3, text), (9, "short"), (9, None), (None, ""), (None, "alone here")], key=str)
    assert len(kept) == 6


def test_prob_min_hash_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    code = _arrays.mix(np.arange(60, dtype=np.uint64))
    x, y = rng.integers(0, 4, 60), rng.integers(0, 4, 60)
    exact = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(60)) for i in range(60) if x[i] and y[i])
    doc = np.concatenate([np.zeros((x > 0).sum(), int), np.ones((y > 0).sum(), int)])
    both = near_dedup.prob_min_hash(doc, np.concatenate([code[x > 0], code[y > 0]]), np.concatenate([x[x > 0], y[y > 0]]).astype(float), 2, 4096)
    assert abs((both[0] == both[1]).mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / 4096)


def test_decontamination_catches_new_parameters(spark):
    items = [(1, "A farmer in the valley named Tom has 12 sheep and sells 5 sheep to Ann for 40 dollars each, how much does Tom get"),
             (2, "Compute the mean of the following list of numbers and explain each step of your answer in plain words")]
    same = items[0][1].replace("Tom", "Bob").replace("12", "31").replace("40", "55").replace("Ann", "Sue")
    torn = items[0][1].replace("named Tom", "named Bob")  # one name for two people: Tom is Bob here and Tom there
    docs = [(1, "intro words. " + items[0][1] + " more"), (2, "x " + same), (3, "x " + torn), (4, "no such thing at all, just 12 sheep"), (5, items[1][1][:60]), (6, "so " + items[1][1].upper())]
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in got}
    assert found.pop((1, 1)) == 0 and found.pop((2, 1)) >= 4
    assert (3, 1) not in found and (4, 1) not in found and (6, 2) in found

def leaked(spark, docs, items):
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]): r["n_changed"] for r in got}


def test_decontamination_finds_copies_whatever_stands_before_or_between(spark):
    items = [(1, "What is the capital of France?"), (2, "Near the old mill Tom Smith met Ann and Bob Jones, then they went to Paris with Sue for 3 days"), (3, "What is 12 + 30 + 7?")]
    docs = [(1, "Question: What is the capital of France? Answer"), (2, "as they say What is the capital of France"), (3, "x " + items[1][1].replace(" ", "\n")), (4, "x " + items[1][1].replace(" ", "  ")),
            (5, items[1][1].lower()), (6, "y. " + items[1][1].upper()), (7, "so what is 12 + 30 + 7"), (8, "Question: What is the capital of Spain?"), (9, "Question: Where is the harbour of France?"), (10, "what is 12 + 31 + 7")]
    found = leaked(spark, docs, items)
    assert found == {(1, 1): 0, (2, 1): 0, (3, 2): 0, (4, 2): 0, (5, 2): 0, (6, 2): 0, (7, 3): 0, (8, 1): 1}

def test_decontamination_checks_every_diagonal(spark):
    """A torn question first, then the item as it is or with other values."""
    item = "A farmer in the valley named Tom has 12 sheep and sells 5 sheep to Ann for 40 dollars each, how much does Tom get"
    torn, other = item.replace("named Tom", "named Bob"), item.replace("Tom", "Max").replace("12", "31")
    docs = [(1, f"x {torn}. And now {item}"), (2, f"x {torn}. Then {torn}. Last {other}"), (3, f"x {torn}. Again {torn}"), (4, f"x {other}")]
    assert leaked(spark, docs, [(1, item)]) == {(1, 1): 0, (2, 1): 3, (4, 1): 3}
    halves = item.replace("sells 5 sheep", "sells over there 5 sheep").replace("farmer in the", "farmer in all the")  # no diagonal of half the item
    assert (5, 1) in leaked(spark, [(5, f"x {halves}")], [(1, item)])


def test_decontamination_finds_every_whole_item(spark, sf_small):
    docs, items = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    whole = {(d, r["item_id"]) for r in items.collect() for d, t in texts if r["text"] in t}
    assert whole <= got and len(got) <= len(whole) + 2


def test_license_dice(spark):
    mit = licenses.TEMPLATES["mit-notice"][1]
    docs = [(1, f"text here\n{mit}\nmore text"), (2, "Released under the GPL License"), (3, licenses.TEMPLATES["mit-text"][1].replace(". ", ".\n")), (4, "released under   THE MIT license!")]
    got = {(r["doc_id"], r["unit"], r["license"]): r["dice"] for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[(1, "line", "mit-notice")] == 1.0 and got[(4, "line", "mit-notice")] == 1.0
    assert not any(k[0] == 2 for k in got)
    assert got[(3, "paragraph", "mit-text")] == 1.0  # over several lines
    para = spark.createDataFrame([(3, "intro\n\n" + docs[2][1] + "\n \nend")], "doc_id long, text string")
    assert [(r["unit"], r["unit_no"]) for r in licenses.scan_licenses(para).collect() if r["license"] == "mit-text" and r["unit"] == "paragraph"] == [("paragraph", 1)]


def test_license_inside_lines_and_paragraphs(spark):
    text = {n: t for n, (_, t) in licenses.TEMPLATES.items()}
    junk = " ".join(f"w{i}" for i in range(90)) + " "
    docs = [(1, "Copyright 2020 X Inc. Released under the MIT License. See LICENSE for details."), (2, junk + text["mit-text"].replace("free of charge", "at no charge") + " " + junk),
            (3, junk + "\nthis is released under\nthe MIT License and\n" + junk), (4, junk + " under the mit " + junk + " license released"), (5, "a b\n" + text["mit-notice"] + "\nc d " + text["mit-notice"]),
            (None, junk + text["gpl-header"] + junk), (6, "We hold that all rights reserved here stay.")]
    got = {(r["doc_id"], r["unit"], r["license"]): (r["unit_no"], r["dice"]) for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[(1, "window", "mit-notice")] == (4, 1.0) and got[(3, "window", "mit-notice")] == (92, 1.0)
    assert got[(2, "window", "mit-text")][0] == 90 and 0.95 < got[(2, "window", "mit-text")][1] < 1
    assert got[(None, "window", "gpl-header")] == (90, 1.0) and got[(6, "window", "all-rights-reserved")] == (3, 1.0)
    assert {k for k in got if k[0] in (4, 5)} == {(5, "line", "mit-notice")}


def test_license_every_notice_and_every_template(spark):
    """Several notices in one text are a row each; templates of one text are a row each; a notice of a matching unit is none twice."""
    mit, rights = licenses.TEMPLATES["mit-notice"][1], licenses.TEMPLATES["all-rights-reserved"][1]
    docs = [(1, f"we say {mit} and later once more {mit} at the end. {rights} so be it"), (2, f"{mit}\n{mit}\nx y z {mit} u v w\n{rights}"),
            (3, f"head\n\n{mit}\nreleased\n\ntail of the whole {mit}"), (4, " ".join([f"word{i} {mit}" for i in range(40)]))]
    scan = lambda rows, **kw: sorted((r["doc_id"], r["license"], r["unit"], r["unit_no"], r["dice"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), **kw).collect())
    got = scan(docs)
    assert [r[:4] for r in got if r[0] == 1] == [(1, "all-rights-reserved", "window", 19), (1, "mit-notice", "window", 2), (1, "mit-notice", "window", 11)]
    assert [r[:4] for r in got if r[0] == 2] == [(2, "all-rights-reserved", "line", 3), (2, "mit-notice", "line", 0), (2, "mit-notice", "line", 1), (2, "mit-notice", "window", 13)]
    assert {r[2:4] for r in got if r[0] == 3 and r[2] != "document"} == {("line", 2), ("paragraph", 1), ("window", 11)}
    assert [r[3] for r in got if r[0] == 4] == [1 + 6 * i for i in range(40)] and all(r[4] == 1.0 for r in got if r[0] == 4)
    same = {"b": ("x", mit), "a": ("x", mit)}
    assert [r[1:3] for r in scan(docs[:1], templates=same)] == [("a", "window"), ("a", "window"), ("b", "window"), ("b", "window")]


def test_license_windows_against_brute_force(spark):
    """All windows of all lengths, the best first, none across another."""
    rng = random.Random(11)
    templates = {"t1": ("x", "red green blue black white grey pink"), "t2": ("y", "one two three four")}
    vocabulary = "red green blue black white grey pink one two three four other".split()
    docs = [(i, " ".join(rng.choice(["red green blue black white", "one two three four", "one two", "grey pink", *vocabulary]) for _ in range(rng.randrange(1, 14)))) for i in range(150)]
    expected = []
    for key, text in docs:
        w = text.split()
        for name, (_, t) in templates.items():
            tw = t.split()
            grams = {*zip(tw, tw[1:])}
            dice = lambda a, b: 2 * len({*zip(w[a:b], w[a + 1:b])} & grams) / (len({*zip(w[a:b], w[a + 1:b])}) + len(grams))
            if len(w) > 1 and dice(0, len(w)) >= 0.8:
                continue  # the whole line matches
            most = int(len(grams) * 1.2 / 0.8 + 1e-9)
            found = []
            for a in range(len(w) - 1):
                if (w[a], w[a + 1]) in grams:
                    best = max(((dice(a, b), -b) for b in range(a + 2, min(len(w), a + 1 + most) + 1)), default=(0, 0))
                    if best[0] >= 0.8:
                        found.append((-best[0], a, -best[1]))
            taken = []
            for d, a, b in sorted(found):
                if all(b <= x or y <= a for x, y in taken):
                    taken.append((a, b))
                    expected.append((key, name, a, -d))
    got = [(r["doc_id"], r["license"], r["unit_no"], r["dice"]) for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), templates=templates).collect() if r["unit"] == "window"]
    assert len(expected) > 30 and sorted((k, n, a, round(d, 9)) for k, n, a, d in got) == sorted((k, n, a, round(d, 9)) for k, n, a, d in expected)


def test_quality_repeat_words(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(40)))) for i in range(60)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.quality_rules(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        w = t.split()
        count = Counter(tuple(w[p:p + 8]) for p in range(len(w) - 7))
        covered = {p + k for p in range(len(w) - 7) if count[tuple(w[p:p + 8])] > 1 for k in range(8)}
        assert got[i] == len(covered)


def test_quality_keeps_clean_documents(spark, sf_small):
    base = sf_small.replace("0.001", "0.1")
    got = quality.quality_rules(spark.read.parquet(f"{base}/documents.parquet")).join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id").select("quality", "base_failed", "kept").collect()
    assert all(r["kept"] for r in got if r["quality"] == 1 and not r["base_failed"])
    assert sum(r["kept"] for r in got if r["quality"] == 0) <= 0.05 * sum(r["quality"] == 0 for r in got)


def test_globs_against_regular_expressions():
    rng = random.Random(4)
    globs = ["".join(rng.choice(["a", "b", "/", ".", "*", "**", "?"]) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts = ["".join(rng.choice("ab/.") for _ in range(rng.randrange(0, 10))) for _ in range(300)]

    def regex(g):
        return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", g)))

    raw, bounds = _arrays.text_buffer(pa.array(texts))
    got = url_filter.GlobAutomaton(globs).match(raw, bounds[:-1], np.diff(bounds))
    for j, g in enumerate(globs):
        r = regex(g)
        assert got[:, j].tolist() == [bool(r.fullmatch(t)) for t in texts], g


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/x?y", "http://example.net", "http://net/", "https://x.org/fr/1", "https://x.org/fr", "https://example.com/de/#a", "http://badexample.com/de/", None, "no scheme", "http://h?x://y/net/"]
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()]
    assert got == [("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "", None, "allow"), ("net", "/", "net/", "block"), ("x.org", "/fr/1", "org/fr/", "allow"),
                   ("x.org", "/fr", None, "allow"), ("example.com", "/de/", "example.com/de/", "block"), ("badexample.com", "/de/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h", "", None, "allow")]


def test_line_dedup_by_site(spark):
    rows = [(i, "a" if i < 40 else "b", f"own line {i}\n  menu  \nmenu" + ("\nrare" if i in (1, 2) else "")) for i in range(45)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, host string, text string"), "host").collect()}
    assert got[0] == "own line 0" and got[1] == "own line 1\nrare"  # 2 of 40 pages is not above the ratio
    assert got[44] == "own line 44"  # the rule is the same for a host of five pages


@pytest.mark.parametrize("pages", [2, 3, 19, 20, 60, 61])
def test_line_dedup_is_the_same_at_every_size(spark, pages):
    """Lines on all pages, on three, on two and on one."""
    rows = [(i, "h", "\n".join(["all", f"own {i}", *(["three"] if i < 3 else []), *(["two"] if i < 2 else [])])) for i in range(pages)]
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, host string, text string"), "host").collect()}
    assert ("all" in got[0]) == (pages < 3) and ("three" in got[0]) == (pages == 2 or pages >= 60) and "two" in got[0] and all(f"own {i}" in got[i] for i in got)


def test_line_dedup_salted_join_is_the_same(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn("source", F.lit("one"))
    one = {(r["doc_id"], r["text"]) for r in line_dedup.drop_boilerplate(docs, "source").collect()}
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST_HOSTS", -1)
    assert {(r["doc_id"], r["text"]) for r in line_dedup.drop_boilerplate(docs, "source").collect()} == one


def fill(children, budget):
    """Shares by repeated rounds: give by weight, take back what a child cannot hold, share that again."""
    got = {k: 0.0 for k in children}
    left, open_ = budget, {k for k, (w, s) in children.items() if s > 0}
    while left > 1e-9 and open_:
        total = sum(children[k][0] for k in open_)
        give = {k: left * children[k][0] / total for k in open_}
        left = 0.0
        for k in list(open_):
            room = children[k][1] - got[k]
            got[k] += min(room, give[k])
            if give[k] >= room - 1e-12:
                left += give[k] - room
                open_.discard(k)
    return got


def test_mixing_budgets(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice(["en", "en", "de", "fr", "xx"]), rng.choice(["src0", "src0", "src0", "src7", "src13", "other"])) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    for share in (0.3, 0.9, 1.7):
        rows = mixing.mix_sources(df, budget_share=share).collect()
        leaves = Counter()
        for _, t, lang, s in docs:
            m = re.search(r"(\d+)$", s)
            leaves[("other" if not m else "web" if int(m[1]) < 5 else "books" if int(m[1]) < 12 else "other", lang, s)] += len(t.split())
        budget = math.floor(sum(leaves.values()) * share)
        by_domain = fill({d: (mixing.DOMAIN_WEIGHTS[d], 2.0 * sum(v for k, v in leaves.items() if k[0] == d)) for d in {k[0] for k in leaves}}, budget)
        taken = Counter()
        for r in rows:
            taken[(r["mix_domain"], r["lang"], r["source"])] += r["mix_tokens"] * r["mix_copies"]
        for d, b in by_domain.items():
            langs = fill({x: (mixing.LANG_WEIGHTS.get(x, mixing.OTHER_LANG_WEIGHT), 2.0 * sum(v for k, v in leaves.items() if k[:2] == (d, x))) for x in {k[1] for k in leaves if k[0] == d}}, b)
            for lang, lb in langs.items():
                for s, sb in fill({k[2]: (1.0, 2.0 * v) for k, v in leaves.items() if k[:2] == (d, lang)}, lb).items():
                    assert sb - 31 < taken[(d, lang, s)] <= sb + 1e-6
        again = mixing.mix_sources(df, budget_share=share).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_levenshtein_trie():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(3)
    terms = ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 9))) for _ in range(30)]
    trie = toxicity.TermTrie(terms)
    for _ in range(2000):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 10)))
        near = min(distance(word, t) for t in terms)
        found = trie.search(word, 1) if trie.may_match(word, 1) else None
        assert (found is not None) == (near <= 1) and (found is None or found[1] == near)


def test_toxicity_held_out(spark, sf_small):
    base = sf_small.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    lexicon, weights = toxicity.train(docs, labels)
    assert weights[toxicity.FEATURES.index("fuzzy")] > 0 > weights[toxicity.FEATURES.index("quoted")]
    text = "many plain words stand here and there before the end of the long line in this place, {} and so on"
    cases = [text.format(x) for x in ("you idiot and worthless man", "you idoit and worthles man", "you idlot and wortless man", 'the note says "idiot and worthless man"', "you kind and gentle man")]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"), lexicon, weights).collect()}
    assert scores[0] > 0.7 and scores[2] > 0.7 and scores[3] < 0.1 and scores[4] < 0.1, scores
    got = toxicity.score(docs, lexicon, weights).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in got)
    assert hit / sum(r["predicted"] for r in got) > 0.97 and hit / sum(r["toxic"] for r in got) > 0.9


def test_decontamination_of_rows_without_a_key(spark):
    item = "A farmer in the valley named Tom has 12 sheep and sells 5 sheep to Ann for 40 dollars each, how much does Tom get"
    again = item.replace("Tom", "Bob").replace("12", "31").replace("40", "55")
    rows = [(None, "see: " + item), (None, again), (None, again), (None, "quite another text of no harm"), (None, None), (5, item), (5, "clean text under the same key")]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    leaks = sorted((str(r["doc_id"]), r["n_changed"]) for r in decontaminate.find_leaks(docs, items).collect())
    assert leaks == [("5", 0), ("None", 0), ("None", 4)]
    kept = sorted((str(r["doc_id"]), str(r["text"])) for r in decontaminate.drop_leaks(docs, items).collect())
    assert kept == [("5", "clean text under the same key"), ("None", "None"), ("None", "quite another text of no harm")]


def test_toxicity_trains_on_one_row_of_an_id(spark):
    rows = [(i, f"word{i} idiot" if i % 2 else f"word{i} fine") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    once = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    again = toxicity.train(spark.createDataFrame(rows + rows * 3 + [(1, "zzz idiot")] * 50, "doc_id long, text string"), labels)
    assert once[0] == again[0] and once[0]
    assert (once[1] is None) == (again[1] is None) and (once[1] is None or np.allclose(once[1], again[1]))


def test_toxicity_context():
    scorer = toxicity.Scorer([("stupid", 5.0, 100)], 1)
    texts = ["you are a stupid man", "he said that the word \"stupid\" is rude", "you are a stupld man", "nothing here"]
    x = scorer.features(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))
    name = {f: i for i, f in enumerate(toxicity.FEATURES)}
    assert x[0, name["strength"]] > 0 and x[0, name["addressed"]] > 0 and x[0, name["quoted"]] == 0
    assert x[1, name["strength"]] == 0 and x[1, name["quoted"]] > 0
    assert x[2, name["fuzzy"]] > 0 and not x[3].any()


def test_pipeline_stages_follow_each_other(spark, sf_small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    good = corpus_pipeline.quality_stage(spark, docs, sf_small)
    kept = {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == docs.columns
    lines = corpus_pipeline.line_stage(spark, good, sf_small)
    texts = [(r["doc_id"], r["text"]) for r in lines.collect()]
    one = corpus_pipeline.near_duplicate_stage(spark, lines, sf_small)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(brute_classes(texts).values()))
    clean = corpus_pipeline.decontamination_stage(spark, one, sf_small)
    leaks = {r["doc_id"] for r in decontaminate.find_leaks(one, spark.read.parquet(f"{sf_small}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in one.collect()} - leaks
    mixed = corpus_pipeline.mixing_stage(spark, clean, sf_small).collect()
    assert sorted(map(str, corpus_pipeline.run(spark, sf_small).collect())) == sorted(map(str, mixed))

"""Mixing with many leaves, repeated rows and rows without a key, and by each way of joining."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plantframe.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string"


def prefixes(docs, plan, seed=mixing.SEED):
    """Copies of each row by a loop: whole epochs, and of the last one the rows up to the rest in seeded order."""
    leaves = defaultdict(list)
    for i, t, lang, s in docs:
        leaves[(lang, s)].append((i, len(t.split())))
    got = Counter()
    for leaf, rows in leaves.items():
        epochs, rest = plan[leaf]
        order = lambda r: (hashlib.md5(f"{seed}:{epochs}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[1])
        run, fits = 0, True
        for i, n in sorted(rows, key=order):
            run += n
            fits = fits and run <= rest
            if epochs + fits:
                got[(i, *leaf, n, epochs + fits)] += 1
    return got


@pytest.mark.parametrize("broadcast", [True, False])
def test_prefixes_with_repeated_rows_and_null_keys(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(mixing, "MAX_BROADCAST_LEAVES", 0)
    rng = random.Random(8)
    docs = [(rng.choice([None, *range(12)]), " ".join(["w"] * rng.randrange(1, 4)), rng.choice(["en", "de"]), rng.choice(["src1", "src7"])) for _ in range(400)]
    for share in (0.37, 0.8):
        plans = {}
        real = mixing._ends
        monkeypatch.setattr(mixing, "written", lambda df, name, w=mixing.written: plans.setdefault(name, w(df, name)) if name == "mix-plan" else w(df, name))
        rows = mixing.mix_sources(spark.createDataFrame(docs, SCHEMA), budget_share=share).collect()
        monkeypatch.undo()
        if not broadcast:
            monkeypatch.setattr(mixing, "MAX_BROADCAST_LEAVES", 0)
        assert mixing._ends is real
        plan = {(r["k_lang"][1:], r["k_source"][1:]): (r["epochs"], r["rest"]) for r in plans["mix-plan"].collect()}
        assert Counter((r["doc_id"], r["lang"], r["source"], r["mix_tokens"], r["mix_copies"]) for r in rows) == prefixes(docs, plan)


def test_levels_of_many_children(spark):
    rng = random.Random(9)
    leaves = [("web", "=en", f"=s{i}", 0.35, 0.5, 1.0, rng.choice([1, 1, 1, 7, rng.randrange(1, 10**6)])) for i in range(3000)]
    total = 2 * sum(x[-1] for x in leaves)
    for budget in (total // 1000, total // 2, total - 1, total + 5):
        t = spark.createDataFrame([(*x, float(budget)) for x in leaves], "k_domain string, k_lang string, k_source string, w_domain double, w_lang double, w_source double, tokens long, budget double")
        got = {r["k_source"]: r["allotment"] for r in mixing.allot(t).select("k_source", "allotment").collect()}
        left, level = float(budget), None
        supplies = sorted(2.0 * x[-1] for x in leaves)
        for i, s in enumerate(supplies):
            if s > left / (len(supplies) - i):
                level = left / (len(supplies) - i)
                break
            left -= s
        assert got == {x[2]: int((2.0 * x[-1] if level is None else min(2.0 * x[-1], level)) + 1e-6) for x in leaves}


def test_weights_of_siblings(spark):
    """Shortages go to siblings first, then to the ancestors."""
    leaves = [("books", "=en", "=src7", 0.45, 0.5, 1.0, 10), ("books", "=de", "=src8", 0.45, 0.2, 1.0, 1000), ("web", "=en", "=src1", 0.35, 0.5, 1.0, 1000), ("other", "=en", "=x", 0.2, 0.5, 1.0, 1000)]
    t = spark.createDataFrame([(*x, 1000.0) for x in leaves], "k_domain string, k_lang string, k_source string, w_domain double, w_lang double, w_source double, tokens long, budget double")
    got = {r["k_source"]: r["allotment"] for r in mixing.allot(t).collect()}
    assert got == {"=src7": 20, "=src8": 430, "=src1": 350, "=x": 200}


def test_no_window_over_all_leaves(spark, monkeypatch):
    plans = {}
    monkeypatch.setattr(mixing, "written", lambda df, name, w=mixing.written: (plans.__setitem__(name, df._jdf.queryExecution().executedPlan().toString()), w(df, name))[1])
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("src"), F.col("id") % 9).alias("source"))
    mixing.mix_sources(docs).collect()
    assert len(plans) >= 10
    for name, p in plans.items():  # the domains alone, which are fixed, have one parent
        assert name in ("mix-levels-b_domain", "mix-domains") or "Window" not in p or "SinglePartition" not in p, name

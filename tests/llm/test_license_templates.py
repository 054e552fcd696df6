"""The template table: every template finds itself, telling bigrams lose no match, no product of documents and templates."""

import random

from plantframe.llm import licenses


def _scan(spark, docs, **kw):
    return licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), **kw)


def test_every_template_finds_itself(spark):
    names = sorted(licenses.TEMPLATES)
    junk = " ".join(f"w{i}" for i in range(600))  # so much that the line itself does not match
    docs = [(i, licenses.TEMPLATES[n][1]) for i, n in enumerate(names)]
    docs += [(1000 + i, f"{junk} {licenses.TEMPLATES[n][1]} {junk}") for i, n in enumerate(names)]
    got = {(r["doc_id"], r["unit"], r["license"]): (r["license_class"], r["dice"]) for r in _scan(spark, docs).collect()}
    for i, n in enumerate(names):
        assert got[(i, "line", n)] == (licenses.TEMPLATES[n][0], 1.0)
        assert got[(1000 + i, "window", n)][1] == 1.0
    assert not [k for k in got if k[0] == names.index("spdx-apache-2.0") and k[2] != "spdx-apache-2.0"]
    assert not list(_scan(spark, [(1, junk), (2, None), (3, ""), (4, "information required by the original distribution")]).collect())


def test_units_against_all_pairs(spark):
    rng = random.Random(4)
    words = [f"x{i}" for i in range(12)]
    templates = {f"t{i}": ("c", " ".join(rng.choice(words) for _ in range(rng.randrange(2, 14)))) for i in range(25)}
    docs = []
    for i in range(300):
        w = rng.choice([*templates.values()])[1].split()
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((i, " ".join(w)))
    grams = lambda t: set(zip(t.split(), t.split()[1:]))
    for least in (0.5, 0.8):
        expected = set()
        for i, t in docs:
            for n, (_, x) in templates.items():
                a, b = grams(t), grams(x)
                if a and b and 2 * len(a & b) / (len(a) + len(b)) >= least:
                    expected.add((i, n, round(2 * len(a & b) / (len(a) + len(b)), 9)))
        got = [(r["doc_id"], r["license"], round(r["dice"], 9)) for r in _scan(spark, docs, templates=templates, min_dice=least).collect() if r["unit"] == "line"]
        assert len(got) == len(set(got)) > 100 and set(got) == expected


def test_documents_meet_templates_by_an_equality(spark):
    plan = _scan(spark, [(1, "a b c")])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BroadcastHashJoin [g" in plan

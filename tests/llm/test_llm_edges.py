"""Every operator and stage on null, empty, long, repeated and clashing rows, and on empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plantframe.llm import decontaminate, licenses, line_dedup, mixing, near_dedup, quality, rlz_dedup, suffix_dedup, toxicity, url_filter

# names that the operators use inside
CLASH = ["did", "key", "row", "n", "t", "k_id", "bin", "host_key", "h1", "node", "copied", "parts", "_text", "_words", "mix_copies", "n_dropped", "n_words", "target"]
LONG = "alpha beta gamma " * 40_000


def rows():
    words = " ".join(f"w{i}" for i in range(80))
    return [(1, words, "en", "src1"), (2, None, "en", "src1"), (3, "", None, None), (4, words, None, "src1"), (4, words, None, "src1"), (None, words, "en", None),
            (None, None, None, None), (5, "   \n\t ", "en", "src2"), (6, LONG, "xx", "src1"), (7, "one two", "de", "zz"), (8, "é ü 漢字 \u2028 \x85", "fr", "src19")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "What is the price of seven red apples in the old market"), (2, None), (None, ""), (3, "hi")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (4, 0), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")


OPERATORS = {
    "op1": lambda d, b, x: decontaminate.find_leaks(d, b),
    "op2": lambda d, b, x: quality.quality_rules(d),
    "op3": lambda d, b, x: licenses.scan_licenses(d),
    "op4": lambda d, b, x: toxicity.score(d, *toxicity.train(d, x)),
    "op5": lambda d, b, x: near_dedup.near_duplicate_classes(d),
    "op6": lambda d, b, x: line_dedup.drop_boilerplate(d, "source", counts=True),
    "op7": lambda d, b, x: rlz_dedup.remove_repeats(d),
    "op8": lambda d, b, x: suffix_dedup.remove_repeats(d),
    "op9": lambda d, b, x: mixing.mix_sources(d),
    "op10": lambda d, b, x: url_filter.filter_urls(d, "doc_id", "text"),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows(name, docs, benchmark, labels):
    out = OPERATORS[name](docs, benchmark, labels).collect()
    if name not in ("op1", "op3", "op9"):
        assert len(out) == len(rows())


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables(name, docs, benchmark, labels):
    assert OPERATORS[name](docs.where("false"), benchmark.where("false"), labels.where("false")).collect() == []


def test_defined_results(docs, benchmark, labels):
    classes = [(r["doc_id"], r["class_id"]) for r in OPERATORS["op5"](docs, benchmark, labels).collect()]
    assert sorted(c for c in classes if c[0] is not None) == [(1, 1), (2, 2), (3, 3), (4, 1), (4, 1), (5, 5), (6, 6), (7, 7), (8, 8)]
    assert sorted((c[1] or 0) for c in classes if c[0] is None) == [0, 1]  # a copy of document 1, and a null text
    seven = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in OPERATORS["op7"](docs, benchmark, labels).collect()}
    assert {(1, 80, 0), (4, 80, 80), (None, 80, 80), (None, 0, 0), (6, 120_000, 0), (3, 0, 0)} <= seven
    eight = {(r["doc_id"], r["n_removed"]) for r in OPERATORS["op8"](docs, benchmark, labels).collect()}
    assert (1, 0) in eight and (2, 0) in eight and all(n == len(rows()[0][1]) for i, n in eight if i == 4)
    taken = [r["doc_id"] for r in OPERATORS["op9"](docs, benchmark, labels).collect()]
    assert not {2, 3, 5} & set(taken)
    lines = {r["doc_id"]: r["text"] for r in OPERATORS["op6"](docs, benchmark, labels).collect()}
    assert lines[2] is None and lines[3] == ""


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, tmp_path, name, stage, docs, benchmark):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, docs, str(tmp_path))
    out.collect()
    if name != "source_mixing":
        assert out.columns == docs.columns
        assert stage(spark, docs.where("false"), str(tmp_path)).collect() == []
    if name in ("line_dedup", "benchmark_decontamination"):
        assert out.count() == len(rows())
    if name == "minhash_near_dedup":
        assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == [1, 2, 3, 5, 6, 7, 8]

"""Benchmark decontamination by template canonicalisation.

Texts become tokens in which numbers, units after a number and names
(capitalised words inside a sentence) are typed placeholders.  Windows of
``WINDOW`` canonical tokens of the documents are hash-joined with those of the
benchmark items, and beside them windows of the plain lower-cased tokens, with
numbers and names as they are, so that a verbatim copy is found whatever the
placeholders make of it (other case, other text before it, few plain words).  A
name at the head of a window is also taken as a plain word, as an item's first
word is none.  The windows of a (document, item) pair that lie on one
diagonal (same offset between the two) are taken together.  All of a pair's
windows must cover ``MIN_COVERAGE`` of the item's tokens, and on a diagonal that
covers as much by itself (if none does, on one that covers the most) the slots
must be consistent: a value of the item always stands for the same value in the
document.  Each such diagonal is checked; one that is consistent is enough.  So a
question asked again with other numbers, names or units is caught, and a text
that merely has the same form is not.

Defined cases: null and tokenless texts match nothing; items shorter than a
window are one window of their own length, items of fewer than ``MIN_TOKENS``
tokens are not looked for; windows with fewer than ``MIN_LITERALS`` plain words
count only where the plain tokens are equal; white space of any kind and length
is one blank; rows with the same key and text are one document, so rows without a
key are told apart by their texts (each is reported, and dropped, for itself);
an empty input gives no rows.  Other columns are not read.

The document side is one scan: its windows are built, joined and dropped in
the same stage if the benchmark's windows are few enough to be broadcast
(checked by a count), and shuffled by window hash otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.llm._scratch import written

WINDOW = 8
MIN_TOKENS = 3
MIN_LITERALS = 3
MIN_COVERAGE = 0.5
MAX_BROADCAST_WINDOWS = 1_000_000
WINDOWS = "array<struct<pos:int,hash:bigint>>"

NUM, NAME, UNIT = "\ue000", "\ue001", "\ue002"  # private-use characters, blanked in the input first
# Units of measure and money after a number.
UNITS = ["km", "m", "cm", "mm", "kg", "g", "mg", "l", "ml", "s", "ms", "h", "min", "miles", "mile", "feet", "foot", "inches", "inch", "yards", "pounds", "ounces",
         "liters", "litres", "meters", "metres", "kilometers", "kilometres", "kilograms", "grams", "seconds", "minutes", "hours", "days", "weeks", "months", "years",
         "dollars", "cents", "euros", "percent", "degrees", "watts", "kw", "kwh", "mph"]


def _marked(text: Column) -> Column:
    """Text in which each slot is one token led by its type's mark."""
    t = F.translate(F.coalesce(text, F.lit("")), NUM + NAME + UNIT, "   ")
    t = F.regexp_replace(t, r"(?<=[\p{L}\p{N},;:])([\s\p{Z}]++)(\p{Lu}\p{Ll}+)(?!\p{L})", "$1" + NAME + "$2")
    t = F.regexp_replace(t, r"(?<!\p{N})\p{N}+(?:[.,:/]\p{N}+)*", " " + NUM + "$0 ")
    return F.regexp_replace(t, rf"({NUM}[^ ]+[\s\p{{Z}}]+)((?i:{'|'.join(UNITS)}))(?!\p{{L}})", "$1" + UNIT + "$2")


def _tokens(marked: Column) -> Column:
    return F.regexp_extract_all(F.lower(marked), F.lit(rf"{NUM}[^ ]+|[{NAME}{UNIT}]?[\p{{L}}\p{{M}}]+"), F.lit(0))


def _slot(token: Column) -> Column:
    return F.substring(token, 1, 1).isin(NUM, NAME, UNIT)


def _plain(token: Column) -> Column:
    """A token without its mark."""
    return F.when(_slot(token), F.substr(token, F.lit(2))).otherwise(token)


def _windows(raw: Column, sizes: list[int]) -> Column:
    """Structs of pos and hash for each window: of plain tokens, and of canonical tokens (marks hash to 0) with enough plain words."""
    def every(size: int, codes: Column, made: Column) -> Column:
        return F.when(F.size(codes) >= size, made).otherwise(F.array().cast(WINDOWS))

    def plain(codes: Column, size: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(codes) - size), lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice(codes, i + 1, size)).alias("hash")))

    def slotted(literal: Column, canon: Column, names: Column, size: int) -> Column:
        few = max(size - MIN_LITERALS, 0)

        def variants(counted: Column) -> Column:
            template = F.transform(F.filter(counted, lambda w: (w["slots"] > 0) & (w["slots"] <= few)), lambda w: F.struct(
                w["pos"].alias("pos"), F.xxhash64(F.slice(canon, w["pos"] + 1, size)).alias("hash")))
            # a name at the head as a plain word, where other slots make this differ from the plain window
            headed = F.transform(F.filter(counted, lambda w: (w["slots"] > 1) & (w["slots"] <= few + 1) & F.get(names, w["pos"])), lambda w: F.struct(
                w["pos"].alias("pos"), F.xxhash64(F.concat(F.slice(literal, w["pos"] + 1, 1), F.slice(canon, w["pos"] + 2, size - 1))).alias("hash")))
            return F.concat(plain(literal, size), template, headed)

        counted = F.transform(F.sequence(F.lit(0), F.size(canon) - size), lambda i: F.struct(i.alias("pos"), F.aggregate(
            F.slice(canon, i + 1, size), F.lit(0), lambda a, c: a + F.when(c == 0, 1).otherwise(0)).alias("slots")))
        return F.transform(F.array(counted), variants)[0]

    def coded(r: Column) -> Column:
        literal, names = F.transform(r, lambda t: F.xxhash64(_plain(t))), F.transform(r, lambda t: t.startswith(NAME))

        def build(canon: Column) -> Column:
            both = F.transform(F.array(F.struct(literal.alias("literal"), names.alias("names"))), lambda s: F.concat(*[every(n, canon, slotted(s["literal"], canon, s["names"], n)) for n in sizes]))[0]
            # without slots the canonical tokens are the plain ones
            return F.when(F.array_contains(canon, F.lit(0).cast("long")), both).otherwise(F.concat(*[every(n, canon, plain(canon, n)) for n in sizes]))

        return F.transform(F.array(F.transform(r, lambda t: F.when(_slot(t), F.lit(0).cast("long")).otherwise(F.xxhash64(t)))), build)[0]

    # each lambda over an array of one holds a value that is used more than once
    return F.transform(F.array(raw), coded)[0]


def _document(key: str, text: str) -> list[Column]:
    """A document's key and its text's hash."""
    return [F.col(f"`{key}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("own")]


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
               window: int = WINDOW, min_coverage: float = MIN_COVERAGE, mark: str | None = None) -> DataFrame:
    """One row per contaminated (document, item): keys, n_windows, coverage of the item, n_slots, n_changed slots.

    A column named by ``mark`` gets the hash that tells documents of one key apart.
    """
    items = benchmark.select(F.col(f"`{item_key}`").alias("item"), F.monotonically_increasing_id().alias("item_row"), F.col(f"`{item_text}`").alias("t")) \
        .select("item", "item_row", _tokens(_marked(F.col("t"))).alias("raw")) \
        .withColumn("n_tokens", F.size("raw")).where(F.col("n_tokens") >= MIN_TOKENS)
    items = written(items, "leak-items")
    sizes = sorted(r[0] for r in items.select(F.least("n_tokens", F.lit(window)).alias("n")).distinct().collect())  # at most `window` numbers
    known, found = None, None
    for size in sizes:
        own = items.where(F.least("n_tokens", F.lit(window)) == size).select("item_row", F.explode_outer(F.array_distinct(_windows(F.col("raw"), [size]))).alias("w")).where("w is not null").select("item_row", F.col("w.pos").alias("bpos"), F.col("w.hash").alias("hash"), F.lit(size).alias("size"))
        known = own if known is None else known.unionByName(own)
    if known is None:
        return docs.sparkSession.createDataFrame([], f"`{key}` {dict(docs.dtypes)[key]}, {f'`{mark}` long, ' if mark else ''}`{item_key}` {dict(benchmark.dtypes)[item_key]}, n_windows long, coverage double, n_slots long, n_changed long")
    known = written(known, "leak-windows")
    small = known.count() <= MAX_BROADCAST_WINDOWS
    # explode_outer, as explode would add a filter that makes the windows twice
    made = _windows(_tokens(_marked(F.col(f"`{text}`"))), sizes)
    windows = docs.select(*_document(key, text), F.explode_outer(made).alias("w")).select("doc", "own", F.col("w.pos").alias("dpos"), F.col("w.hash").alias("hash"))
    hits = windows.join(F.broadcast(known) if small else known, "hash").select("doc", "own", "item_row", "bpos", "size", (F.col("dpos") - F.col("bpos")).alias("diagonal"))
    lines = hits.groupBy("doc", "own", "item_row", "diagonal").agg(F.collect_set(F.struct("bpos", "size")).alias("at"))
    # item tokens that a diagonal's windows cover
    lines = lines.withColumn("covered", F.array_distinct(F.flatten(F.transform("at", lambda w: F.sequence(w["bpos"], w["bpos"] + w["size"] - 1)))))
    pairs = lines.groupBy("doc", "own", "item_row").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n_windows"), F.collect_list(F.struct(F.size("covered").alias("n"), "diagonal", "covered")).alias("each"))
    item_side = F.broadcast(items) if small else items
    pairs = pairs.join(item_side, "item_row").withColumn("coverage", F.size(F.array_distinct(F.flatten("each.covered"))) / F.col("n_tokens")).where(F.col("coverage") >= F.lit(min_coverage))
    # one row per document, item and diagonal that can speak for the pair
    least = F.least(F.lit(min_coverage), F.array_max("each.n") / F.col("n_tokens"))
    pairs = pairs.withColumn("least", least).select("doc", "own", "item", "item_row", "n_windows", "coverage", "raw", F.explode(F.filter("each", lambda x: x["n"] / F.col("n_tokens") >= F.col("least"))).alias("x"))
    slots = F.transform(F.filter("x.covered", lambda p: _slot(F.get("raw", p))), lambda p: F.struct((p + F.col("x.diagonal")).alias("at"), _plain(F.get("raw", p)).alias("b")))
    pairs = written(pairs.select("doc", "own", F.struct("item", "item_row", "n_windows", "coverage", "x.n", "x.diagonal").alias("line"), slots.alias("slots")), "leak-pairs")
    plain = pairs.where(F.size("slots") == 0).select("doc", "own", "line", F.lit(0).alias("n_slots"), F.lit(0).alias("n_changed"))
    # texts are read again for pairs with slots only, once for all of a document's; a table of their own, so that its size decides how it is joined
    with_slots = written(pairs.where(F.size("slots") > 0).groupBy("doc", "own").agg(F.collect_list(F.struct("line", "slots")).alias("asked")), "leak-slots")
    texts = docs.select(*_document(key, text), F.col(f"`{text}`").alias("t")).withColumnsRenamed({"doc": "doc_", "own": "own_"})

    def answered(own: Column) -> Column:
        return F.transform("asked", lambda x: F.struct(x["line"].alias("line"), F.transform(x["slots"], lambda s: F.struct(s["b"].alias("b"), _plain(F.get(own, s["at"])).alias("d"))).alias("values")))

    slotted = with_slots.join(texts, (F.col("own") == F.col("own_")) & F.col("doc").eqNullSafe(F.col("doc_"))).select("doc", "own", F.explode(F.transform(F.array(_tokens(_marked(F.col("t")))), answered)[0]).alias("x")).select("doc", "own", "x.*")
    consistent = F.size(F.array_distinct(F.transform("values", lambda v: v["b"]))) == F.size(F.array_distinct("values"))
    slotted = slotted.where(consistent).select("doc", "own", "line", F.size("values").alias("n_slots"), F.size(F.filter("values", lambda v: v["b"] != v["d"])).alias("n_changed"))
    # of several consistent diagonals the one that covers most is reported, the first of those
    first = F.max(F.struct("line.coverage", "line.n", (-F.col("line.diagonal")).alias("back"), (-F.col("n_changed")).alias("same"), "line.n_windows", "n_slots", "n_changed")).alias("best")
    both = plain.unionByName(slotted).groupBy("doc", "own", F.col("line.item").alias("item")).agg(first).select("doc", "own", "item", "best.*")
    return both.select(F.col("doc").alias(key), *([F.col("own").alias(mark)] if mark else []), F.col("item").alias(item_key), F.col("n_windows").cast("long").alias("n_windows"), "coverage", F.col("n_slots").cast("long").alias("n_slots"), F.col("n_changed").cast("long").alias("n_changed"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents."""
    leaks = written(find_leaks(docs, benchmark, key, text, mark="_own", **options).select(F.col(f"`{key}`").alias("_leak"), "_own").distinct(), "leaks")
    return docs.join(leaks, docs[key].eqNullSafe(leaks["_leak"]) & (F.xxhash64(docs[text]) == leaks["_own"]), "left_anti")

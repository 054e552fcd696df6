"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source.  A token budget runs down from the root;
at each node it is shared among the children by weight, and a child whose
whole subtree holds less than its share gives the rest to its siblings.  Only
what no sibling can take goes back to the ancestors: a node's share is capped
by its subtree's supply before its own siblings are settled.  Each leaf then
takes its allotment as a prefix, counted in tokens, of its documents in seeded
order: whole epochs first, each in an order of its own, and of the last epoch
the documents up to the allotment.

No task holds all children of a node: equal ratios of supply and weight are
summed, ratios are binned, and only the distinct ratios of the one bin in which
the water level lies are put in order.  A leaf's prefix ends in one bin of one
bin of its seeded order, found by sums, and only the rows there are put in order.

Defined cases: null language or source is a leaf of its own (shown as null);
null and wordless texts have no tokens and are never taken; repeated rows are
documents of their own, and ties of the order are broken by doc_id and token
count; an empty input gives no rows; an input column named like an added one
is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantframe.llm._scratch import written

SEED = "mix-1"
MAX_EPOCHS = 2
#: Budget as a share of the corpus's tokens.
BUDGET_SHARE = 0.6
#: Bins of the seeded order, and of each of these bins: 16^BIN_DIGITS.
BIN_DIGITS = 3
#: Bins of the ratios of supply and weight, for each doubling.  With T tokens in all, the bin of ratio r has at most T / r leaves
#: and, at equal weights, r / 64 distinct ratios: less than the root of T / 64 are put in order.
RATIO_BINS = 64
DOMAIN_WEIGHTS = {"books": 0.45, "web": 0.35, "other": 0.2}
LANG_WEIGHTS = {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.1}
OTHER_LANG_WEIGHT = 0.05
WORD = r"[^\x20\x09-\x0D]+"
LEAF = ["k_domain", "k_lang", "k_source"]
#: The plan has a row for each leaf; up to so many rows it is broadcast, beyond that joined by shuffle.
MAX_BROADCAST_LEAVES = 20_000
#: Keys that the rows of a node are dealt to where they are joined by shuffle.
DEALS = 32


def domain_of(source: Column) -> Column:
    """Domain by the number that ends a source's name: below 5 web, below 12 books, else other."""
    n = F.nullif(F.regexp_extract(source, r"(\d{1,9})$", 1), F.lit("")).cast("int")
    return F.when(n < 5, "web").when(n < 12, "books").otherwise("other")


def _named(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("~"))


def _weight(key: Column, table: dict[str, float], other: float) -> Column:
    out = F.lit(other)
    for k, w in table.items():
        out = F.when(key == k, F.lit(w)).otherwise(out)
    return out


def _meet(rows: DataFrame, nodes: DataFrame, keys: list[str], deal: list[str]) -> DataFrame:
    """Rows with the row of their node; ``nodes`` is a written table, broadcast if it is small, else joined in deals of a node's rows."""
    if nodes.count() <= MAX_BROADCAST_LEAVES:
        return rows.join(F.broadcast(nodes), keys)
    many = nodes.withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEALS - 1).cast("long"))))
    return rows.withColumn("_deal", F.pmod(F.xxhash64(*deal), F.lit(DEALS))).join(many, [*keys, "_deal"]).drop("_deal")


def _share(nodes: DataFrame, parent: list[str], budget: str, supply: str, weight: str, out: str) -> DataFrame:
    """Shares each parent's budget among its children, capped by their supply: supply or water level times weight, whichever is less.

    Children fill up in the order of their ratio of supply and weight.  Those up to ratio r are full if their supply, and r
    times the weight of all others, is within the budget; of the first one that is not, the level is what
    is left of the budget over the weight that is left.
    """
    ratios = nodes.select(*parent, F.col(budget).alias("b"), F.col(supply).alias("s"), F.col(weight).alias("w"), (F.col(supply) / F.col(weight)).alias("r")) \
        .groupBy(*parent, "r").agg(F.sum("s").alias("s"), F.sum("w").alias("w"), F.max("b").alias("b")).withColumn("bin", F.floor(F.log2("r") * F.lit(RATIO_BINS)))
    bins = ratios.groupBy(*parent, "bin").agg(F.sum("s").alias("s"), F.sum("w").alias("w"), F.max("r").alias("r"), F.max("b").alias("b"))
    up = Window.partitionBy(*parent).orderBy("bin")
    sums = bins.withColumns({"before": F.coalesce(F.sum("s").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
                             "above": F.coalesce(F.sum("w").over(up.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))})
    first = sums.where(F.col("before") + F.col("s") + F.col("r") * F.col("above") > F.col("b")).groupBy(*parent).agg(F.min(F.struct("bin", "before", "above")).alias("e")) \
        .select(*parent, "e.*")
    within = Window.partitionBy(*parent).orderBy("r")
    inside = ratios.join(first, [*parent, "bin"]).withColumns({
        "before": F.col("before") + F.coalesce(F.sum("s").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "left": F.col("above") + F.sum("w").over(within.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    found = inside.withColumn("level", (F.col("b") - F.col("before")) / F.col("left")).where(F.col("r") > F.col("level")).groupBy(*parent).agg(F.min_by("level", "r").alias("level"))
    levels = nodes.select(*parent).distinct().join(found, parent, "left")  # no level: all children are full
    met = _meet(nodes, written(levels, f"mix-levels-{out}"), parent, [c for c in nodes.columns if c.startswith("k_")])
    return met.withColumn(out, F.coalesce(F.least(F.col(supply), F.col("level") * F.col(weight)), F.col(supply))).drop("level")


def allot(leaves: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Tokens to take from each leaf.

    ``leaves``: k_domain, k_lang, k_source, their weights w_domain, w_lang,
    w_source, the leaf's tokens, and the root's budget (the same in each row).
    """
    t = leaves.withColumn("supply", F.col("tokens").cast("double") * max_epochs)
    langs = written(t.groupBy("k_domain", "k_lang").agg(F.sum("supply").alias("s_lang"), F.max("w_lang").alias("w_lang"), F.max("w_domain").alias("w_domain"), F.max("budget").alias("b_root")), "mix-langs")
    domains = langs.groupBy("k_domain").agg(F.sum("s_lang").alias("s_domain"), F.max("w_domain").alias("w_domain"), F.max("b_root").alias("b_root")).withColumn("k_root", F.lit(0))
    domains = written(_share(domains, ["k_root"], "b_root", "s_domain", "w_domain", "b_domain").select("k_domain", "b_domain"), "mix-domains")
    langs = written(_share(_meet(langs, domains, ["k_domain"], ["k_lang"]), ["k_domain"], "b_domain", "s_lang", "w_lang", "b_lang").select("k_domain", "k_lang", "b_lang"), "mix-shares")
    out = _share(_meet(t, langs, ["k_domain", "k_lang"], ["k_source"]), ["k_domain", "k_lang"], "b_lang", "supply", "w_source", "allotment")
    return out.withColumn("allotment", F.floor(F.col("allotment") + F.lit(1e-6)).cast("long"))


def _ends(slim: DataFrame) -> DataFrame:
    """Where each leaf's prefix of the last epoch ends: the key of the first rows that do not all fit, and how many of them (they are repeated rows) do."""
    part = lambda i: F.substring("key.o", 1 + i * BIN_DIGITS, BIN_DIGITS)
    rows = slim.withColumns({"bin0": part(0), "bin1": part(1)})
    ends = None
    for i in (0, 1):
        by = [*LEAF, *[f"bin{j}" for j in range(i)]]
        inside = rows if ends is None else _meet(rows, ends, by, ["key"])
        ahead = F.lit(0).cast("long") if ends is None else F.col("ahead")
        sums = inside.groupBy(*by, f"bin{i}").agg(F.sum("key.n").alias("t"), F.max("rest").alias("r"), F.max(ahead).alias("ahead"))
        before = F.sum("t").over(Window.partitionBy(*by).orderBy(f"bin{i}").rowsBetween(Window.unboundedPreceding, -1))
        here = sums.withColumn("ahead", F.col("ahead") + F.coalesce(before, F.lit(0))).where(F.col("ahead") + F.col("t") > F.col("r"))
        ends = written(here.groupBy(*by).agg(F.min(F.struct(f"bin{i}", "ahead")).alias("e")).select(*by, "e.*"), f"mix-ends{i}")
    keys = _meet(rows, ends, [*LEAF, "bin0", "bin1"], ["key"]).groupBy(*LEAF, "key").agg(F.count(F.lit(1)).alias("copies"), F.max("rest").alias("rest"), F.max("ahead").alias("ahead"))
    before = F.sum(F.col("key.n") * F.col("copies")).over(Window.partitionBy(*LEAF).orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    left = keys.withColumn("left", F.col("rest") - F.col("ahead") - F.coalesce(before, F.lit(0))).where(F.col("key.n") * F.col("copies") > F.col("left"))
    return left.groupBy(*LEAF).agg(F.min(F.struct("key", F.floor(F.col("left") / F.col("key.n")).alias("more"))).alias("e")).select(*LEAF, F.col("e.key").alias("end"), F.col("e.more").alias("more"))


def mix_sources(docs: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
                text: str = "text", lang: str = "lang", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The taken documents with the columns of ``docs``, plus mix_domain, mix_tokens and mix_copies.

    mix_copies is the number of epochs in which a document is taken.
    """
    own = [c for c in docs.columns if c.lower() not in ("mix_domain", "mix_tokens", "mix_copies")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col(key).alias("k_id"),
        domain_of(F.coalesce(F.col(source), F.lit(""))).alias("k_domain"), _named(lang).alias("k_lang"), _named(source).alias("k_source"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("n")).where("n > 0")
    # texts are read twice: to count their words, and for the documents that are taken
    slim = written(rows.select(*LEAF, "k_id", "n"), "mix-tokens")
    whole = written(slim.groupBy(*LEAF).agg(F.sum("n").alias("tokens")), "mix-leaves")
    total = whole.agg(F.sum("tokens")).first()[0] or 0
    weighted = whole.withColumns({
        "budget": F.floor(F.lit(total) * F.lit(budget_share)).cast("double"),
        "w_domain": _weight(F.col("k_domain"), DOMAIN_WEIGHTS, 0.0), "w_lang": _weight(F.expr("substring(k_lang, 2)"), LANG_WEIGHTS, OTHER_LANG_WEIGHT), "w_source": F.lit(1.0)})
    plan = written(allot(weighted, max_epochs).select(
        *LEAF, F.floor(F.col("allotment") / F.col("tokens")).cast("int").alias("epochs"), (F.col("allotment") % F.col("tokens")).alias("rest")), "mix-plan")
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs").cast("string"), F.coalesce(F.col("k_id").cast("string"), F.lit(""))))
    place = F.struct(order.alias("o"), "k_id", "n")
    ends = written(_ends(_meet(slim, plan, LEAF, ["k_id", "n"]).select(*LEAF, place.alias("key"), "rest")), "mix-ends")

    joined = _meet(rows, written(plan.join(ends, LEAF), "mix-bounds"), LEAF, ["k_id", "n"]).withColumn("key", place)
    whole_epochs = joined.withColumn("part", (F.col("key") < F.col("end")).cast("int"))
    if not ends.where("more > 0").isEmpty():  # repeated rows, of which a part is taken, are numbered
        last = F.col("key").eqNullSafe(F.col("end")) & (F.col("more") > 0)
        number = F.row_number().over(Window.partitionBy(*LEAF).orderBy("key"))
        whole_epochs = whole_epochs.where(~last).unionByName(joined.where(last).withColumn("part", (number <= F.col("more")).cast("int")))
    return whole_epochs.withColumn("copies", (F.col("epochs") + F.col("part")).cast("long")).where("copies > 0") \
        .select("row.*", F.col("k_domain").alias("mix_domain"), F.col("n").alias("mix_tokens"), F.col("copies").alias("mix_copies"))

"""Forecast pipelines on MLlib (M1–M8) and the model store.

Boosted trees are MLlib ``GBTRegressor`` (distributed tree aggregation, no
driver-side data); the scaler, when wanted, is a pipeline stage so it is
fitted once and saved with the model (the reference re-fits it on the data
being scored).  Sequence features come from ``operators.samples`` and are
turned into vectors with ``array_to_vector`` inside the same plan.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Sequence

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantframe.operators import chunks, samples
from plantframe.operators.series import time_grid_periods, with_position
from plantframe.plans import boosting
from plantframe.session import ensure_checkpoint_dir, scratch_path

# Boosted-tree settings of the reference (rounds, depth, learning rate, seed).
GBT_ROUNDS, GBT_DEPTH, GBT_STEP, GBT_SEED = 100, 6, 0.1, 42
#: MLlib's defaults: a tree sees a feature in so many bins at most, whose limits come from so many rows.
GBT_BINS, LIMIT_ROWS = 32, 10_000
#: Prefix of the columns that hold the bins of a row.
BIN = "__bin_"


def gbt_pipeline(features: Sequence[str], label: str, *, rounds: int = GBT_ROUNDS, depth: int = GBT_DEPTH,
                 step: float = GBT_STEP, seed: int = GBT_SEED, scale: bool = True,
                 prediction: str = "prediction", weight: str | None = None, bins: int = GBT_BINS) -> Pipeline:
    """VectorAssembler (skip rows with NULLs) [-> MinMaxScaler] -> GBTRegressor."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="__raw", handleInvalid="skip")]
    feats = "__raw"
    if scale:
        stages.append(MinMaxScaler(inputCol="__raw", outputCol="__scaled"))
        feats = "__scaled"
    gbt = GBTRegressor(featuresCol=feats, labelCol=label, predictionCol=prediction, maxIter=rounds,
                       maxDepth=depth, stepSize=step, seed=seed, maxBins=bins)
    stages.append(gbt.setWeightCol(weight) if weight else gbt)
    return Pipeline(stages=stages)


def score(model: PipelineModel | None, df: DataFrame, prediction: str = "prediction",
          drop_vectors: bool = True) -> DataFrame:
    """Apply a fitted pipeline; with no model the prediction is NULL (M7 contract)."""
    if model is None:
        return df.withColumn(prediction, F.lit(None).cast("double"))
    out = model.transform(df)
    if drop_vectors:
        out = out.drop(*[c for c in out.columns if c in ("__raw", "__scaled", "__vec") or c.startswith(BIN)])
    return out


def binned(model: PipelineModel | None, df: DataFrame) -> DataFrame:
    """Rows with the bins of a ``fit_gbt`` model, without those that it skips (NULL features); for another model the rows as they are."""
    return model.stages[0].transform(df) if _bins(model) else df


def score_each(model: PipelineModel | None, rows: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``score`` of ``binned`` rows, which are read twice: the trees are asked once for each combination of bins.

    The combinations are written with their predictions, so Spark knows their size when it plans the join: few are
    broadcast, many are shuffled like any table.
    """
    bins = _bins(model)
    if not bins:
        return score(model, rows, prediction)
    spark = rows.sparkSession
    each = PipelineModel(stages=model.stages[1:]).transform(rows.select(*bins).distinct()).select(*bins, prediction)
    path = scratch_path(spark, f"combinations-{uuid.uuid4().hex}")
    each.write.parquet(path)
    return rows.join(spark.read.schema(each.schema).parquet(path), bins).select(*[c for c in rows.columns if c not in bins], prediction)


def _bins(model: PipelineModel | None) -> list[str]:
    """The bins' columns of a ``fit_gbt`` model, which its trees see alone."""
    first = model.stages[0] if model is not None and len(model.stages) > 1 else None
    return [c for c in first.getOutputCols() if c.startswith(BIN)] if isinstance(first, Bucketizer) else []


# ---------------------------------------------------------------- M1 / M2
def fit_gbt(df: DataFrame, features: Sequence[str], label: str, **kw) -> PipelineModel:
    """Bucketizer -> the stages of ``gbt_pipeline`` over its bins.

    All that a tree asks of a row is in which of ``GBT_BINS`` bins each feature lies, so rows that share their bins
    go to the same leaf of every tree.  They are counted together first, by one aggregate over all rows: gains and leaves
    of squared errors follow from counts and means of the label, and the rounds run over the groups.  There are no more
    groups than rows, and no more than combinations of bins, however many rows there are.
    """
    held = df.select(*dict.fromkeys([*features, label])).persist(StorageLevel.MEMORY_AND_DISK)
    groups = None
    try:
        cut = bucketizer(held, features)
        groups = grouped(cut.transform(held), cut.getOutputCols(), label).persist(StorageLevel.MEMORY_AND_DISK)
        n = groups.count()
        held.unpersist()
        # dealt out, as the aggregate leaves a few MB of groups in a partition or two; and kept apart from the plan that
        # made them, which every task of the fit's hundreds of jobs would carry
        ensure_checkpoint_dir(df.sparkSession)
        spread = groups.repartition(wave(n, df, GROUP_ROWS)).checkpoint()
        model = gbt_pipeline([BIN + c for c in features], label, weight="__rows", bins=all_seen(n), **kw).fit(spread)
    finally:
        held.unpersist()
        if groups is not None:
            groups.unpersist()
    return PipelineModel(stages=[cut, *model.stages])


def split_points(counts: Sequence[tuple[float, float]], bins: int = GBT_BINS, *, total: float | None = None) -> list[float]:
    """MLlib's thresholds of a feature, from its values and their counts: between any two of at most ``bins`` values, else about equal shares (of ``total``) apart."""
    values = sorted(counts)
    middle = [(a + b) / 2.0 for (a, _), (b, _) in zip(values, values[1:])]
    if len(middle) < bins:
        return middle
    stride = (sum(n for _, n in values) if total is None else total) / bins
    out, seen, goal = [], values[0][1], stride
    for (_, n), m in zip(values[1:], middle):
        if abs(seen - goal) < abs(seen + n - goal):
            out.append(m)
            goal += stride
        seen += n
    return out


def bucketizer(df: DataFrame, features: Sequence[str], *, seed: int = GBT_SEED) -> Bucketizer:
    """The stage that puts each feature into its bins (``BIN`` + name) and skips rows with NULLs.

    As MLlib does for its trees, the bins' limits are taken from about ``LIMIT_ROWS`` rows; all rows are binned.
    """
    names = list(dict.fromkeys(features))
    known = df.na.drop(subset=names)
    rows = known.count()
    some = known if rows <= LIMIT_ROWS else known.sample(LIMIT_ROWS / rows, seed=seed)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(names)]))
    counts = [[] for _ in names]
    for r in some.select(each.alias("e")).groupBy("e.i", "e.v").count().collect():
        counts[r["i"]].append((r["v"], r["count"]))
    limits = []
    for c in counts:
        # a tree's threshold belongs to the bin below it, a bucket's lower limit to the bucket; a constant has one bin (and one that stays empty)
        inner = sorted({math.nextafter(x, math.inf) for x in split_points(c) if math.isfinite(x)} - {math.inf}) or [sys.float_info.max]
        limits.append([-math.inf, *inner, math.inf])
    return Bucketizer(splitsArray=limits, inputCols=names, outputCols=[BIN + c for c in names], handleInvalid="skip")


def grouped(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """The mean label and the number of rows (``__rows``) of each combination of bins; one with a NULL label has none, which a fit refuses."""
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(F.col(label).cast("double")))
    # as sums the bins are plain numbers: Bucketizer marks them as categories, which a tree would take in any order
    return df.groupBy(*[(F.col(c) + F.lit(0.0)).alias(c) for c in by]).agg(mean.alias(label), F.count(F.lit(1)).cast("double").alias("__rows"))


def all_seen(groups: int) -> int:
    """``maxBins`` by which MLlib looks at all groups for its thresholds (the square of it), so that no bin is overlooked; features have no more bins by it."""
    return min(max(GBT_BINS, math.isqrt(max(groups - 1, 0)) + 1), 46_340)


def fit_once(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """Fit on a persisted frame: every level of every tree reads the training rows again."""
    held = packed(df.persist(StorageLevel.MEMORY_AND_DISK))
    try:
        return pipeline.fit(held)
    finally:
        df.unpersist()


#: Rows of a training partition at least, where there are more partitions than that needs; and at most, beyond a partition for each core.
TRAIN_ROWS, FULL_ROWS = 50_000, 4_000_000
#: Groups of a training partition at least, as they are few.
GROUP_ROWS = 5_000


def packed(held: DataFrame) -> DataFrame:
    """A persisted frame in no more partitions than its rows are worth: a fit runs hundreds of jobs over them."""
    return held.coalesce(wave(held.count(), held, TRAIN_ROWS))


def wave(rows: int, df: DataFrame, each: int) -> int:
    """Partitions for a fit over so many rows, of ``each`` rows at least.

    One for each core is enough, so that a level of a tree is one wave of tasks however many rows there
    are; only partitions of more than ``FULL_ROWS`` are split into further waves.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    waves = max(1, -(-rows // (FULL_ROWS * cores)))
    return max(1, min(-(-rows // each), waves * cores))


def holdout_mse(model: PipelineModel, test: DataFrame, label: str) -> float:
    pred = score(model, test)
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mse").evaluate(pred)


# ---------------------------------------------------------------------- M3
def lag_vector_frame(df: DataFrame, features: Sequence[str], target: str, w: int, *, site: str = "site_id",
                     ts: str = "ts", rows_per_chunk: int = 4096) -> DataFrame:
    """W5 windows as an MLlib vector column ``__vec`` (w lags ++ current features)."""
    win = samples.lag_concat_current(df, features, target, w, site=site, ts=ts, rows_per_chunk=rows_per_chunk, nulls="drop").where(F.col("y").isNotNull())
    return win.withColumn("__vec", array_to_vector("x"))


def fit_gbt_vector(df: DataFrame, label: str = "y", *, parts: tuple[str, str] | None = None, **kw) -> PipelineModel:
    """Boosted trees over the vectors ``__vec``.

    ``parts``: the columns that ``__vec`` is made of, where neighbouring rows mostly agree in the first (an array) and
    differ in the second (a number): the fit then counts such rows together (``boosting``).
    """
    gbt = GBTRegressor(featuresCol="__vec", labelCol=label, maxIter=kw.get("rounds", GBT_ROUNDS),
                       maxDepth=kw.get("depth", GBT_DEPTH), stepSize=kw.get("step", GBT_STEP),
                       seed=kw.get("seed", GBT_SEED), maxBins=GBT_BINS)
    if parts:
        return PipelineModel(stages=[boosting.fit_bundles(gbt, df, *parts, lambda n: wave(n, df, TRAIN_ROWS), LIMIT_ROWS)])
    return fit_once(Pipeline(stages=[gbt]), df.select("__vec", label))


# ---------------------------------------------------------------------- M4
def multi_horizon_frame(df: DataFrame, target: str, w: int, horizons: int, *, site: str = "site_id",
                        ts: str = "ts", rows_per_chunk: int = 4096, chunk: str = "day") -> DataFrame:
    """Direct multi-horizon samples: for each anchor, w lags and the target h = 1..H steps ahead.

    One row per (anchor, h) with ``h`` as a feature — one model for all
    horizons instead of a recursive loop.
    """
    pos = with_position(df, site=site, ts=ts, pos="__pos", chunk=chunk)
    halo = chunks.halo_partition(pos, site, "__pos", w, horizons, rows_per_chunk)
    win = Window.partitionBy(site, "_pchunk").orderBy("__pos")
    out = halo.select(site, "_halo", F.col(ts).alias("anchor_ts"), "__pos",
                      F.collect_list(F.col(target).cast("double")).over(win.rowsBetween(-w + 1, 0)).alias("lags"),
                      F.collect_list(F.struct(F.col(target).cast("double").alias("y"))).over(win.rowsBetween(1, horizons)).alias("ahead"))
    # collect_list leaves NULLs out: only anchors whose lags are all known are samples, and NULL targets drop out one by one
    out = out.filter(~F.col("_halo") & (F.size("lags") == w)).drop("_halo")
    ex = out.select(site, "anchor_ts", "__pos", "lags", F.posexplode("ahead").alias("h0", "a")).select(site, "anchor_ts", "__pos", "lags", "h0", F.col("a.y").alias("y"))
    ex = ex.where(F.col("y").isNotNull()).withColumn("h", (F.col("h0") + 1).cast("double"))
    return ex.withColumn("__vec", array_to_vector(F.concat("lags", F.array("h")))).drop("h0")


def fallback_short_history(forecast: DataFrame, history: DataFrame, window: int, *, col: str = "prediction",
                           site: str = "site_id", default: float | None = None) -> DataFrame:
    """A site whose history is shorter than the model window gets the constant default forecast.

    ``forecast`` holds one row per (site, step) to fill; the per-site history
    length is a partial-aggregated count joined on the site.
    """
    from plantframe.functions.profiles import DEFAULT_FORECAST
    value = DEFAULT_FORECAST if default is None else default
    counts = history.groupBy(site).agg(F.count(F.lit(1)).alias("__hist_n"))
    out = forecast.join(counts, site, "left")
    short = F.coalesce(F.col("__hist_n"), F.lit(0)) < F.lit(window)
    return out.withColumn(col, F.when(short, F.lit(float(value))).otherwise(F.col(col))).drop("__hist_n")


# ---------------------------------------------------------------------- M6
#: Rounds without a lower validation loss after which boosting stops (a fixed value of the reference).
PATIENCE = 10
#: Rounds of the first attempt; each further one has twice as many.
FIRST_ROUNDS = 25


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """Number of rounds with the least loss before the patience ran out, and whether it did (ties: the earlier round)."""
    best, least = 0, math.inf
    for i, loss in enumerate(losses):
        if loss < least:
            best, least = i + 1, loss
        elif i + 1 - best >= patience:
            return best, True
    return best, False


def cut_ensemble(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model of the first ``n`` trees."""
    trees = model.trees
    if n >= len(trees):
        return model
    jvm, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    regression = gateway.jvm.org.apache.spark.ml.regression
    some = gateway.new_array(regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        some[i], weights[i] = trees[i]._java_obj, float(model.treeWeights[i])
    cut = regression.GBTRegressionModel(f"{model.uid}_{n}", some, weights)
    for name in ("featuresCol", "predictionCol", "labelCol"):
        cut.set(name, jvm.get(jvm.getParam(name)).get())
    return GBTRegressionModel(cut)


def fit_validated(train: DataFrame, val: DataFrame, features: Sequence[str], label: str, *, rounds: int = GBT_ROUNDS, patience: int = PATIENCE,
                  depth: int = GBT_DEPTH, step: float = GBT_STEP, seed: int = GBT_SEED, scale: bool = True, prediction: str = "prediction") -> tuple[PipelineModel, list[float]]:
    """Boosting that stops after ``patience`` rounds without a lower validation loss, cut to its best round; and the loss of each round.

    MLlib can't be resumed, so attempts have 25, 50, ... rounds until one holds
    the stop; their trees are the same as far as they go, as seed and rows are.  The scaler
    sees training rows only.  Without validation rows all rounds are kept.
    """
    prepare = [VectorAssembler(inputCols=list(features), outputCol="__raw", handleInvalid="skip")]
    column = "__raw"
    if scale:
        prepare.append(MinMaxScaler(inputCol="__raw", outputCol="__scaled"))
        column = "__scaled"
    keep = [*dict.fromkeys([*features, label])]
    train, val = (x.select(*keep).where(F.col(label).isNotNull()) for x in (train, val))
    # features are made once: the scaler, every attempt and the losses read the kept rows
    kept = [x.persist(StorageLevel.MEMORY_AND_DISK) for x in (train, val)]
    try:
        rows = [packed(x) for x in kept]
        prepared = Pipeline(stages=prepare).fit(rows[0])
        held = [prepared.transform(x).select(column, F.col(label).cast("double").alias(label)) for x in rows]
        checked = not held[1].isEmpty()
        n, losses = min(FIRST_ROUNDS, rounds) if checked else rounds, []
        while True:
            model = GBTRegressor(featuresCol=column, labelCol=label, predictionCol=prediction, maxIter=n, maxDepth=depth, stepSize=step, seed=seed).fit(held[0])
            if not checked:
                break
            losses = model.evaluateEachIteration(held[1], "squared")
            best, stopped = best_round(losses, patience)
            if stopped or n >= rounds:
                model = cut_ensemble(model, best)
                break
            n = min(2 * n, rounds)
    finally:
        for x in kept:
            x.unpersist()
    return PipelineModel(stages=[*prepared.stages, model]), losses


# ---------------------------------------------------------------------- M5
#: Places of the trend's bends, as shares of the table's span.
BENDS = (0.2, 0.4, 0.6, 0.8)
#: Pairs of sine and cosine per period (days).
SEASONS = (("d", 1.0, 3), ("w", 7.0, 3), ("y", 365.25, 2))
RIDGE = 1e-4
_EPOCH = "2000-01-01 00:00:00"


def _days(ts: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.col(ts)) / F.lit(86_400_000_000.0)


def seasonal_features(ts: str = "ts", span: tuple[float | Column, float | Column] = (0.0, 1.0)) -> dict[str, Column]:
    """The terms of the seasonal model: 1, a trend that may bend, and daily, weekly and yearly waves.

    ``span``: first and last day (since 2000) of the training table; the trend runs from 0 to 1 over it.
    """
    lo, hi = F.lit(span[0]), F.lit(span[1])
    days = _days(ts)
    share = (days - lo) / F.greatest(hi - lo, F.lit(1e-9))
    cols: dict[str, Column] = {"one": F.lit(1.0), "trend": share}
    for i, bend in enumerate(BENDS):
        cols[f"bend{i}"] = F.greatest(share - F.lit(bend), F.lit(0.0))
    for name, period, k_max in SEASONS:
        for k in range(1, k_max + 1):
            angle = F.lit(2.0 * math.pi * k / period) * days
            cols[f"s_{name}{k}"] = F.sin(angle)
            cols[f"c_{name}{k}"] = F.cos(angle)
    return cols


def time_span(df: DataFrame, ts: str = "ts") -> tuple[float, float]:
    """First and last day (since 2000) of a table: two numbers."""
    r = df.agg(F.min(_days(ts)), F.max(_days(ts))).first()
    return (0.0, 1.0) if r[0] is None else (float(r[0]), float(r[1]))


def seasonal_statistics(df: DataFrame, target: str, span: tuple[float, float], *, site: str = "site_id", ts: str = "ts") -> DataFrame:
    """What a least-squares fit needs of each site: n, the terms' products ``gram`` (upper triangle, row by row) and ``moment``.

    All sums are partial on the map side, so a site with a third of all rows
    sends one row per task.  Rows without a target don't count; the target is log1p,
    which makes seasons and trend multiplicative.
    """
    terms = seasonal_features(ts, span)
    y = F.log1p(F.greatest(F.col(target), F.lit(0.0)))
    rows = df.where(F.col(target).isNotNull() & F.col(ts).isNotNull()).select(site, y.alias("y"), *[c.alias(k) for k, c in terms.items()])
    names = list(terms)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = rows.groupBy(site).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"g{i}") for i, (a, b) in enumerate(pairs)],
                                  *[F.sum(F.col(a) * F.col("y")).alias(f"m{i}") for i, a in enumerate(names)])
    return sums.select(site, "n", F.array(*[f"g{i}" for i in range(len(pairs))]).alias("gram"), F.array(*[f"m{i}" for i in range(len(names))]).alias("moment"))


def _solve(ridge: float):
    """Coefficients of each row's normal equations, a batch at a time."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            moment = np.array(batch.column("moment").to_pylist())
            p = moment.shape[1]
            gram, upper = np.zeros((len(moment), p, p)), np.triu_indices(p)
            gram[:, upper[0], upper[1]] = np.array(batch.column("gram").to_pylist())
            gram[:, upper[1], upper[0]] = gram[:, upper[0], upper[1]]
            n = batch.column("n").to_numpy().astype(float)
            # the level is free, all other terms are drawn to 0 by the same share of the rows
            penalty = np.diag([0.0] + [1.0] * (p - 1))
            coef = np.linalg.solve(gram + (ridge * n)[:, None, None] * penalty, moment[:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("n"), pa.array(coef.tolist(), pa.list_(pa.float64()))], names=[batch.schema.names[0], "n", "coef"])

    return run


def fit_seasonal(df: DataFrame, target: str, *, site: str = "site_id", ts: str = "ts", ridge: float = RIDGE,
                 span: tuple[float, float] | None = None) -> DataFrame:
    """A seasonal model for each site: site, n, coef (one per term) and the span (lo, hi) that the terms refer to.

    One aggregate over the table gives every site's normal equations; solving them
    is a small matter per site, done where the row lies.  A site without a known
    target has no row.
    """
    span = span or time_span(df, ts)
    stats = seasonal_statistics(df, target, span, site=site, ts=ts)
    schema = T.StructType([stats.schema[site], T.StructField("n", T.LongType()), T.StructField("coef", T.ArrayType(T.DoubleType()))])
    return stats.mapInArrow(_solve(ridge), schema).withColumns({"lo": F.lit(span[0]), "hi": F.lit(span[1])})


def apply_seasonal(df: DataFrame, *, ts: str = "ts", out: str = "forecast") -> DataFrame:
    """Adds the forecast of rows that carry their site's model (coef, lo, hi); without one it is NULL."""
    terms = seasonal_features(ts, (F.col("lo"), F.col("hi"))).values()
    log = sum((F.get("coef", F.lit(i)) * term for i, term in enumerate(terms)), F.lit(0.0))
    # without greatest, which would turn a missing forecast into 0
    return df.withColumn(out, F.when(log < 0, F.lit(0.0)).otherwise(F.expm1(log)))


def forecast_seasonal(model: DataFrame, starts: DataFrame, periods: int, every: str, *,
                      site: str = "site_id", start: str = "start", ts: str = "ts") -> DataFrame:
    """The ``periods`` stamps after each site's ``start`` with the forecast of the site's own model.

    Sites meet their models before the stamps are made, one row each.  A site without a model gets NULL.
    """
    named = starts.join(model.select(site, "coef", "lo", "hi"), site, "left")
    grid = time_grid_periods(named, periods + 1, every, site=site, start=start, ts=ts, keep=("coef", "lo", "hi")).filter(F.col("step") > 0)
    return apply_seasonal(grid, ts=ts).select(site, "step", ts, "forecast")


# ---------------------------------------------------------------------- S10
_VERSION, _MANIFEST = "version-", "manifest-"


def _names(path: str, spark) -> tuple[object, list[str]]:
    """A folder's file system and the names in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def model_versions(path: str) -> list[str]:
    """Finished versions of a stored model, oldest first."""
    _, names = _names(path, SparkSession.active())
    return [n[len(_MANIFEST):].split("-", 1)[1] for n in names if n.startswith(_MANIFEST)]


def save_model(model: PipelineModel, path: str) -> str:
    """Store a model as a new version; it counts once its manifest stands, which is made last.

    A version has a folder of its own, so runs that train at the same time don't
    write over each other, and one that breaks off leaves what was there.
    """
    spark = SparkSession.active()
    version = uuid.uuid4().hex
    model.write().save(f"{path}/{_VERSION}{version}")
    fs, names = _names(path, spark)
    last = max((int(n[len(_MANIFEST):].split("-", 1)[0]) for n in names if n.startswith(_MANIFEST)), default=0)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_MANIFEST}{last + 1:09d}-{version}"), False).close()
    return version


def load_model(path: str) -> PipelineModel:
    """The last finished version; without one it is an error."""
    versions = model_versions(path)
    if not versions:
        raise FileNotFoundError(f"{path}: no finished model")
    return PipelineModel.load(f"{path}/{_VERSION}{versions[-1]}")


def load_or_train(path: str, train: DataFrame, features: Sequence[str], label: str, **kw) -> PipelineModel:
    """Load the stored pipeline if there is one, else fit on ``train`` and store it.

    Only absence of a finished version trains: one that is there but cannot be read is an error,
    and is never overwritten.
    """
    if model_versions(path):
        return load_model(path)
    model = fit_gbt(train, features, label, **kw)
    save_model(model, path)
    return model


def feature_importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances
    return sorted(zip(features, imp.toArray().tolist()), key=lambda t: -t[1])


__all__ = ["gbt_pipeline", "score", "binned", "score_each", "fit_gbt", "fit_validated", "best_round", "cut_ensemble", "holdout_mse", "lag_vector_frame", "fit_gbt_vector",
           "multi_horizon_frame", "fallback_short_history", "seasonal_features", "seasonal_statistics", "time_span", "fit_seasonal", "apply_seasonal", "forecast_seasonal", "save_model",
           "load_model", "load_or_train", "model_versions", "feature_importances", "vector_to_array"]

"""Tree-ensemble and linear forecasts on MLlib."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.config import BoosterSettings
from wattline.operators.boosting import fit_boosted
from wattline.operators.features import feature_columns
from wattline.operators.joins import join_groups_results
from wattline.operators.split import regression_metrics
from wattline.schemas import ORDER, TARGET
from wattline.session import materialize, shared_dir

CATEGORICAL = ["primary_use_code", "site_id", "meter"]
MIN_SITE_TRAIN, MIN_SITE_HELD_OUT = 100, 10


@dataclass(frozen=True)
class Forecast:
    name: str
    predictions: DataFrame
    model: PipelineModel
    features: list[str]
    train_seconds: float


def _inputs(features: Sequence[str], categorical: Sequence[str]) -> list:
    indexed = [c for c in categorical if c in features]
    plain = [c for c in features if c not in indexed]
    stages = []
    if indexed:
        stages.append(StringIndexer(
            inputCols=indexed, outputCols=[f"{c}_index" for c in indexed], handleInvalid="keep",
            stringOrderType="alphabetAsc"))
    return [*stages, VectorAssembler(inputCols=[*plain, *[f"{c}_index" for c in indexed]], outputCol="features")]


def _feature_names(features: Sequence[str], categorical: Sequence[str]) -> list[str]:
    indexed = [c for c in categorical if c in features]
    return [c for c in features if c not in indexed] + indexed


def _predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Consumption cannot be negative; a missing prediction stays missing."""
    keep = [c for c in rows.columns if c != "predicted"]
    raw = F.col("prediction")
    return model.transform(rows).select(*keep, F.when(raw.isNotNull(), F.greatest(raw, F.lit(0.0))).alias("predicted"))


@dataclass(frozen=True)
class Vectors:
    """Training rows as feature vectors, stored once for every fit on them, and the stages that made them."""

    rows: DataFrame
    stages: PipelineModel
    features: list[str]

    def forecast(self, name: str, model, held_out: DataFrame, seconds: float) -> Forecast:
        whole = PipelineModel(stages=[*self.stages.stages, model])
        return Forecast(name, _predict(whole, held_out), whole, self.features, seconds)


def training_vectors(train: DataFrame, categorical: Sequence[str], target: str = TARGET) -> Vectors:
    features = feature_columns(train)
    stages = Pipeline(stages=_inputs(features, categorical)).fit(train)
    kept = [ORDER, target] if ORDER in train.columns else [target]
    return Vectors(materialize(stages.transform(train).select(*kept, "features")), stages, _feature_names(features, categorical))


def _bins(vectors: Vectors, least: int = 128) -> int:
    """Trees need a bin for every value of a categorical input, and one for values not seen. The indexer has counted them."""
    indexers = [s for s in vectors.stages.stages if isinstance(s, StringIndexerModel)]
    return max([least, *(len(values) + 2 for s in indexers for values in s.labelsArray)])


def rounds_with_patience(errors: Sequence[float], patience: int) -> int:
    """How many trees to keep: up to the lowest error seen before ``patience`` rounds brought no lower one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _boosted_trees(vectors: Vectors, held_out: DataFrame, cfg: BoosterSettings, bins: int, target: str) -> Forecast:
    # A row's node is found from the root: in trees this shallow that takes less time, and memory, than to store it per level.
    learner = GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol="prediction",
        maxDepth=cfg.max_depth, maxIter=cfg.rounds, stepSize=cfg.step_size,
        subsamplingRate=cfg.row_fraction, featureSubsetStrategy=str(cfg.feature_fraction),
        minInstancesPerNode=cfg.min_rows_per_leaf, maxBins=bins, seed=cfg.seed,
        cacheNodeIds=False, checkpointInterval=10,
    )
    started = time.perf_counter()
    rows = vectors.rows
    if cfg.stopping_fraction > 0:
        seconds = F.unix_seconds(F.col(ORDER).cast("timestamp"))
        ends = rows.agg(F.min(seconds).alias("a"), F.max(seconds).alias("b"))
        border = ends.select(F.col("b") - (F.col("b") - F.col("a")) * cfg.stopping_fraction).first()[0]
        tail = rows.where(seconds > border)
        if border is not None and not tail.isEmpty():
            found = fit_boosted(learner, rows.where(seconds <= border))
            count = rounds_with_patience(found.evaluateEachIteration(tail, "squared"), cfg.patience)
            learner = learner.copy({learner.maxIter: count})
    model = fit_boosted(learner, rows)
    return vectors.forecast("boosted_trees", model, held_out, time.perf_counter() - started)


def fit_boosted_trees(
    train: DataFrame, held_out: DataFrame, cfg: BoosterSettings = BoosterSettings(), target: str = TARGET
) -> Forecast:
    """Gradient-boosted trees. One fit to all but the latest training rows gives the error of every prefix of its trees
    on those latest rows; as many trees as were best, with patience, are then fitted to all training rows. The rows that
    are scored play no part in either."""
    shared_dir(train.sparkSession)
    vectors = training_vectors(train, CATEGORICAL, target)
    return _boosted_trees(vectors, held_out, cfg, _bins(vectors), target)


def fit_forest(
    train: DataFrame, held_out: DataFrame, cfg: BoosterSettings = BoosterSettings(), target: str = TARGET
) -> Forecast:
    """The second learner of the comparison; all inputs are taken as numbers."""
    shared_dir(train.sparkSession)
    learner = RandomForestRegressor(
        featuresCol="features", labelCol=target, predictionCol="prediction",
        maxDepth=cfg.max_depth, numTrees=cfg.forest_trees, subsamplingRate=cfg.row_fraction,
        featureSubsetStrategy=str(cfg.feature_fraction), minInstancesPerNode=cfg.min_rows_per_leaf, seed=cfg.seed,
        cacheNodeIds=True, checkpointInterval=10,
    )
    vectors, started = training_vectors(train, [], target), time.perf_counter()
    model = learner.fit(vectors.rows)
    return vectors.forecast("forest", model, held_out, time.perf_counter() - started)


def feature_importance(forecast: Forecast, top_n: int | None = 20) -> DataFrame:
    """Inputs by their share of the impurity decrease."""
    values = forecast.model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(forecast.features, values)]
    ranked = forecast.predictions.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
    return ranked.limit(top_n) if top_n else ranked


def compare_models(entries: Sequence[tuple[str, DataFrame, float]], target: str = TARGET) -> DataFrame:
    """Metrics of several ``(name, predictions, training seconds)`` as one table."""
    tables = [
        regression_metrics(predictions, target=target).select(
            F.lit(name).alias("model"), "rmse", "cv_rmse", "mae", F.lit(float(seconds)).alias("train_seconds"))
        for name, predictions, seconds in entries
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


SITE_SCHEMA = (
    "site_id int, status string, rmse double, cv_rmse double, mae double, train_seconds double, "
    "n_train long, n_val long"
)


def _by_site(rows: DataFrame) -> DataFrame:
    path = f"{shared_dir(rows.sparkSession)}/sites-{uuid.uuid4().hex}"
    rows.write.partitionBy("site_id").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fit_site_models(
    train: DataFrame, held_out: DataFrame, cfg: BoosterSettings = BoosterSettings(),
    fit: Callable[..., Forecast] = fit_boosted_trees, workers: int = 4, target: str = TARGET,
) -> DataFrame:
    """One model per site. Every fit is a distributed job, so a site's size does
    not matter; a small pool of driver threads only keeps the cluster busy."""
    sizes = {
        r["site_id"]: (r["n_train"], r["n_val"])
        for r in train.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_train"))
        .join(held_out.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_val")), "site_id", "left")
        .fillna(0, subset=["n_val"]).where(F.col("site_id").isNotNull()).collect()
    }

    # Stored by site, so that each fit reads its own files and the work grows with the rows.
    train, held_out = (_by_site(part) for part in (train, held_out))

    def one(site: int) -> tuple:
        n_train, n_val = sizes[site]
        if n_train < MIN_SITE_TRAIN or n_val < MIN_SITE_HELD_OUT:
            return site, "skipped", None, None, None, None, n_train, n_val
        try:
            mine = F.col("site_id") == site
            result = fit(train.where(mine), held_out.where(mine), cfg)
            m = regression_metrics(result.predictions, target=target).first()
            return site, "ok", m["rmse"], m["cv_rmse"], m["mae"], result.train_seconds, n_train, n_val
        except Exception as error:  # one site's failure must not stop the others
            return site, f"failed: {type(error).__name__}: {error}"[:500], None, None, None, None, n_train, n_val

    with ThreadPoolExecutor(max_workers=workers) as pool:
        rows = list(pool.map(one, sorted(sizes)))
    return train.sparkSession.createDataFrame(rows, SITE_SCHEMA)


def fit_site_lines(train: DataFrame, held_out: DataFrame, x: str = "lag_24h", target: str = TARGET) -> DataFrame:
    """Least-squares line per site from sums of products: one aggregation for
    all sites. Returns the held-out rows with their prediction."""
    lines = train.groupBy("site_id").agg(
        F.regr_slope(target, x).alias("_slope"), F.regr_intercept(target, x).alias("_intercept"),
        F.count(F.lit(1)).alias("_n"),
    ).where(F.col("_n") >= MIN_SITE_TRAIN)
    line = F.col("_intercept") + F.col("_slope") * F.col(x)
    return join_groups_results(held_out, lines, ["site_id"], "left").withColumn(
        "predicted", F.when(line.isNotNull(), F.greatest(line, F.lit(0.0)))).drop("_slope", "_intercept", "_n")


def _solve(penalty: float, width: int):
    """Coefficients of a site from the sums of products of its centred inputs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, means, products in zip(*[batch.column(c).to_pylist() for c in ("_n", "_means", "_products")], strict=True):
                full = np.zeros((width, width))
                full[np.triu_indices(width)] = products
                full += np.triu(full, 1).T
                spread, means = full[:-1, :-1], np.array(means)
                # inputs that don't vary at a site get no weight
                scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
                used = scale > 1e-9 * np.sqrt(n) * np.maximum(np.abs(means[:-1]), 1.0)
                beta = np.zeros(width - 1)
                if used.any():
                    s = scale[used]
                    scaled = spread[np.ix_(used, used)] / np.outer(s, s) + penalty * np.eye(used.sum())
                    beta[used] = np.linalg.solve(scaled, full[:-1, -1][used] / s) / s
                out.append([float(means[-1] - beta @ means[:-1]), *beta.tolist()])
            yield pa.RecordBatch.from_arrays([batch.column("site_id"), pa.array(out, pa.list_(pa.float64()))], names=["site_id", "_beta"])

    return run


def fit_site_ridges(
    train: DataFrame, held_out: DataFrame, features: Sequence[str] | None = None, penalty: float = 1e-6, target: str = TARGET
) -> DataFrame:
    """A ridge regression per site on many inputs, for any number of sites in one job. Returns the held-out rows with their
    prediction; sites with too few training rows, and rows with a missing input, get none.

    The sums of products of all pairs of inputs, centred about the site's means so that nothing cancels, come from two
    aggregations; a site is then one row of sums, and the small systems are solved where those rows are. ``penalty`` is
    in units of the inputs' variance.
    """
    inputs = list(features or feature_columns(train))
    columns, width = [*inputs, target], len(inputs) + 1
    v = [F.col(c).cast("double") for c in columns]
    known = reduce(and_, [c.isNotNull() for c in v])
    rows = train.where(known & F.col("site_id").isNotNull()).select("site_id", F.array(*v).alias("_x"))
    # one long row of averages per site; the second pass adds up products of what is left
    means = rows.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("_n"), F.array(*[F.avg(F.col("_x")[i]) for i in range(width)]).alias("_means")).where(F.col("_n") >= MIN_SITE_TRAIN)
    means = materialize(means)
    centred = join_groups_results(rows, means.select("site_id", "_means"), ["site_id"]).select(
        "site_id", F.zip_with("_x", "_means", lambda a, b: a - b).alias("_x"))
    sums = centred.mapInArrow(_partial_products(width), f"{_site_type(train)}, place int, total double")
    sums = sums.groupBy("site_id", "place").agg(F.sum("total").alias("total"))
    grams = sums.groupBy("site_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda x: x["total"]).alias("_products"))
    solved = grams.join(means, "site_id").select("site_id", "_n", "_means", "_products").mapInArrow(
        _solve(penalty, width), f"{_site_type(train)}, _beta array<double>")
    scored = join_groups_results(held_out, solved, ["site_id"], "left")
    line = F.col("_beta")[0] + reduce(add, [F.col("_beta")[i + 1] * F.col(c).cast("double") for i, c in enumerate(inputs)])
    return scored.withColumn("predicted", F.when(line.isNotNull(), F.greatest(line, F.lit(0.0)))).drop("_beta")


def _site_type(rows: DataFrame) -> str:
    return f"site_id {dict(rows.dtypes)['site_id']}"


#: Sites whose sums a task holds before it hands them on.
HELD_SITES = 4096


def _partial_products(width: int):
    """Every task adds up the upper triangle of X'X of each of its sites, so that a site costs one set of sums per task."""
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kind = {}, None

        def handed_on() -> pa.RecordBatch:
            size = len(upper[0])
            site = pa.array(list(sums), kind).take(pa.array(np.repeat(np.arange(len(sums)), size)))
            place = pa.array(np.tile(np.arange(size, dtype=np.int32), len(sums)))
            total = pa.array(np.concatenate(list(sums.values())))
            sums.clear()
            return pa.RecordBatch.from_arrays([site, place, total], names=["site_id", "place", "total"])

        for batch in batches:
            if not batch.num_rows:
                continue
            codes, kind = batch.column("site_id").dictionary_encode(), batch.column("site_id").type
            own = np.asarray(codes.indices)
            order = np.argsort(own, kind="stable")
            x = np.asarray(batch.column("_x").flatten()).reshape(-1, width)[order]
            present, first = np.unique(own[order], return_index=True)
            for site, part in zip(present.tolist(), np.split(x, first[1:]), strict=True):
                total = (part.T @ part)[upper]
                name = codes.dictionary[site].as_py()
                sums[name] = sums[name] + total if name in sums else total
                if len(sums) >= HELD_SITES:
                    yield handed_on()
        if sums:
            yield handed_on()

    return run


GOLDEN = (3 - math.sqrt(5)) / 2


def minimize_bounded(error: Callable[[float], float], low: float, high: float, evaluations: int, tolerance: float = 1e-3) -> dict[float, float]:
    """Brent's bounded search: a parabola through the three best points where it promises a step inside, else a golden-section
    step. Returns every point tried with its error."""
    tried: dict[float, float] = {}

    def at(x: float) -> float:
        if x not in tried:
            tried[x] = error(x)
        return tried[x]

    best = second = third = low + GOLDEN * (high - low)
    at(best)
    step = before = 0.0
    while len(tried) < evaluations:
        middle, least = (low + high) / 2, tolerance * abs(best) + 1e-9
        if abs(best - middle) <= 2 * least - (high - low) / 2:
            break
        golden = True
        if abs(before) > least:
            r = (best - second) * (at(best) - at(third))
            q = (best - third) * (at(best) - at(second))
            p, q = (best - third) * q - (best - second) * r, 2 * (q - r)
            p, q = (-p, q) if q > 0 else (p, -q)
            if abs(p) < abs(q * before / 2) and q * (low - best) < p < q * (high - best):
                before, step, golden = step, p / q, False
                if best + step - low < 2 * least or high - best - step < 2 * least:
                    step = math.copysign(least, middle - best)
        if golden:
            before = (high if best < middle else low) - best
            step = GOLDEN * before
        new = best + (step if abs(step) >= least else math.copysign(least, step))
        if new in tried:
            break
        if at(new) <= at(best):
            low, high = (best, high) if new >= best else (low, best)
            best, second, third = new, best, second
        else:
            low, high = (new, high) if new < best else (low, new)
            if at(new) <= at(second) or second == best:
                second, third = new, second
            elif at(new) <= at(third) or third in (best, second):
                third = new
    return tried


def search_step_size(
    train: DataFrame, held_out: DataFrame, cfg: BoosterSettings = BoosterSettings(),
    bounds: tuple[float, float] = (0.005, 0.3), evaluations: int = 8, target: str = TARGET,
) -> tuple[float, DataFrame]:
    """Bounded search of the step size. Each evaluation is one distributed fit; all fits share one stored table of feature
    vectors. Returns the step size with the lowest error, the smaller of equal ones, and the table of everything tried."""
    shared_dir(train.sparkSession)
    train, held_out = materialize(train), materialize(held_out)
    vectors = training_vectors(train, CATEGORICAL, target)
    bins = _bins(vectors)

    def error(step: float) -> float:
        forecast = _boosted_trees(vectors, held_out, replace(cfg, step_size=step), bins, target)
        return regression_metrics(forecast.predictions, target=target).first()["rmse"]

    tried = minimize_bounded(error, *bounds, evaluations)
    best = min(tried, key=lambda step: (tried[step], step))
    table = train.sparkSession.createDataFrame(list(tried.items()), "step_size double, rmse double")
    return best, table.orderBy("rmse", "step_size")

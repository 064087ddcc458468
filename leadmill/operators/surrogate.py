"""The surrogate model: training set, split, scaling, a regressor on vectors, versioned predictions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import spool
from .merge import with_dense_ids
from .select import ONE_TASK, smallest


def training_set(state: DataFrame, cutoff: float) -> DataFrame:
    """Docked compounds under the cutoff; NaN sorts above every number and stays out."""
    return state.filter(F.col("dock_score") < cutoff).select("smilesid", F.col("dock_score").alias("docking_score"))


def tail_split(rows: DataFrame, id_col: str, share: float = 0.1) -> DataFrame:
    """id, split: of rows with different ids the last max(1, floor(share * n)) by id validate. Rows are
    numbered in range partitions, without a global window or a collected tail."""
    placed = with_dense_ids(rows.select(id_col), id_col, 0, "place")
    n = placed.count()
    k = max(1, int(share * n)) if n else 0
    return placed.select(id_col, F.when(F.col("place") > n - k, "val").otherwise("train").alias("split"))


def scaling(rows: DataFrame, target: str) -> tuple[float, float]:
    """Mean and deviation of the training part's target; the deviation of a constant is 1."""
    mean, deviation = rows.agg(F.avg(target), F.stddev_pop(target)).first()
    return mean, deviation or 1.0


def train(rows: DataFrame, vector_col: str, target: str, id_col: str, regularisation: tuple[float, ...] = (0.0, 0.01, 0.1)) -> tuple[LinearRegressionModel, float, float]:
    """The regressor with the least error on the tail tenth, fitted on the scaled rest; with the
    mean and deviation that undo the scaling."""
    split = rows.join(tail_split(rows, id_col), id_col).withColumn("features", array_to_vector(F.col(vector_col).cast("array<double>")))
    split = spool(split.select("features", F.col(target).cast("double").alias("y"), "split"), "training")
    mean, deviation = scaling(split.filter("split = 'train'"), "y")
    scaled = split.withColumn("label", (F.col("y") - mean) / deviation)
    fit, held = scaled.filter("split = 'train'"), scaled.filter("split = 'val'")
    models = [LinearRegression(regParam=r, solver="normal").fit(fit) for r in regularisation]
    errors = [m.transform(held).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0] for m in models]
    return models[errors.index(min(errors))], mean, deviation


def predict(model, rows: DataFrame, vector_col: str, version: int) -> DataFrame:
    """`rows` with pred_score and pred_version, by a linear model with its scaling or by a network; an empty input gives an empty result."""
    if not isinstance(model, tuple):
        from .network import predicted

        score = predicted(rows.sparkSession, model, F.col(vector_col).cast("array<double>"))
        return rows.withColumn("pred_score", score).withColumn("pred_version", F.lit(version))
    fitted, mean, deviation = model
    done = fitted.transform(rows.withColumn("features", array_to_vector(F.col(vector_col).cast("array<double>"))))
    return done.withColumn("pred_score", F.col("prediction") * deviation + mean).withColumn("pred_version", F.lit(version)).drop("features", "prediction")


def chunks(rows: DataFrame, order: str, size: int) -> DataFrame:
    """order, chunk: rows dealt into chunks of `size` in the order of a unique column."""
    return with_dense_ids(rows.select(order), order, -1, "place").select(order, F.floor(F.col("place") / size).alias("chunk"))


def exact_sample(rows: DataFrame, n: int, seed: int, id_col: str) -> DataFrame:
    """Exactly n rows (all, if fewer), those whose ids hash lowest under the seed: the same rows
    however they are partitioned. A null id counts as an empty one. Many rows are picked in place, by the first 52 bits of the hash."""
    place = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    placed = rows.withColumn("_md5", place)
    if n <= ONE_TASK:
        return placed.orderBy("_md5", id_col).limit(n).drop("_md5")
    return smallest(placed.withColumn("_bits", F.conv(F.substring("_md5", 1, 13), 16, 10).cast("double")), "_bits", ["_md5", id_col], n).drop("_md5", "_bits")


def shuffled(rows: DataFrame, parts: int, seed: int, id_col: str) -> DataFrame:
    """Rows dealt evenly over `parts` partitions, in an order that their ids do not decide."""
    return rows.repartition(parts, F.xxhash64(F.lit(seed), F.col(id_col)))



def epoch_order(rows: DataFrame, epoch: int, seed: int, id_col: str) -> DataFrame:
    """id, place (from 1): the rows, of different ids, in an order that epoch and seed fix, without a global window."""
    own = F.col(id_col).cast("string")
    keyed = rows.select(id_col, F.concat(F.md5(F.concat(F.lit(f"{seed}|{epoch}|"), own).cast("binary")), own).alias("_order"))
    return with_dense_ids(keyed, "_order", 0, "place").select(id_col, "place")

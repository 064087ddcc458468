"""A surrogate that bends: a network with hidden layers, trained by epochs over the data where it lies.

An epoch is one job: tasks sum the gradients of their rows, Spark sums these by weight, and the driver, which only ever holds weights, takes the
step. The same job measures the loss of the held-out tail under the same weights, and the weights of the best epoch are kept. Steps are resilient
backpropagation: they look at the sign of the summed gradient only, so they need no rate to be tuned and no batches.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..store import spool
from .surrogate import scaling, tail_split

GROW, SHRINK, LEAST_STEP, MOST_STEP, FIRST_STEP = 1.2, 0.5, 1e-6, 1.0, 0.05


@dataclass
class Network:
    """Weights of each layer (inputs and a constant by outputs), and what undoes the scaling of inputs and target."""

    layers: list[np.ndarray]
    shift: np.ndarray
    scale: np.ndarray
    mean: float = 0.0
    deviation: float = 1.0
    history: list[tuple[float, float]] = field(default_factory=list)  # loss of training and held-out rows by epoch
    best_epoch: int = -1

    @property
    def width(self) -> int:
        return len(self.shift)

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """Values of all layers for rows x: the scaled inputs first, the scaled prediction last."""
        values = [(x - self.shift) / self.scale]
        for k, w in enumerate(self.layers):
            z = values[-1] @ w[:-1] + w[-1]
            values.append(z if k == len(self.layers) - 1 else np.tanh(z))
        return values

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.forward(np.asarray(x, float))[-1][:, 0] * self.deviation + self.mean

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Sums over rows of the gradient of half the squared error of the scaled target, and of that error."""
        values = self.forward(x)
        error = values[-1] - ((y - self.mean) / self.deviation)[:, None]
        loss, parts = float((error**2).sum() / 2), []
        for k in range(len(self.layers) - 1, -1, -1):
            inputs = np.hstack([values[k], np.ones((len(x), 1))])
            parts.append((inputs.T @ error).ravel())
            if k:
                error = (error @ self.layers[k][:-1].T) * (1 - values[k] ** 2)
        return np.concatenate(parts[::-1]), loss

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.layers])

    def with_flat(self, weights: np.ndarray) -> Network:
        layers, at = [], 0
        for w in self.layers:
            layers.append(weights[at : at + w.size].reshape(w.shape))
            at += w.size
        return Network(layers, self.shift, self.scale, self.mean, self.deviation, self.history, self.best_epoch)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        history = np.array(self.history).reshape(-1, 2)
        np.savez(out, shift=self.shift, scale=self.scale, target=[self.mean, self.deviation], history=history, best=self.best_epoch, **{f"layer{k}": w for k, w in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, content: bytes) -> Network:
        z = np.load(io.BytesIO(content))
        layers = [z[f"layer{k}"] for k in range(sum(name.startswith("layer") for name in z.files))]
        return cls(layers, z["shift"], z["scale"], *map(float, z["target"]), [tuple(h) for h in z["history"].tolist()], int(z["best"]))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(bytearray(self.to_bytes()),)], "network binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Network:
        return cls.from_bytes(bytes(spark.read.parquet(path).first()[0]))


def _sums(rows: DataFrame, net: Network) -> dict[int, float]:
    """By place: sums of the gradient over training rows, then of the loss of training and of held-out rows. A task gives one row for each weight."""
    n = sum(w.size for w in net.layers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n + 2)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").values.to_numpy(zero_copy_only=False)[batch.column("x").offsets[0].as_py() : batch.column("x").offsets[-1].as_py()].reshape(batch.num_rows, -1)
            y, held = batch.column("y").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
            gradient, loss = net.gradient(x[~held], y[~held])
            total[:n] += gradient
            total[n] += loss
            total[n + 1] += net.gradient(x[held], y[held])[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n + 2, dtype=np.int32)), pa.array(total)], ["place", "value"])

    return dict(rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value")).collect())


def train(rows: DataFrame, vector_col: str, target: str, id_col: str, hidden: tuple[int, ...] = (32,), epochs: int = 60, seed: int = 1) -> Network:
    """The network of the epoch with the least loss on the tail tenth of `rows` by id. Vectors are of one length; rows with a null in the target or
    vector take no part. Rows are never collected, and results do not depend on how they are dealt but for rounding."""
    vector = F.col(vector_col).cast("array<double>")
    usable = rows.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")) & vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull()))
    split = usable.join(tail_split(usable, id_col), id_col).select(vector.alias("x"), F.col(target).cast("double").alias("y"), (F.col("split") == "val").alias("held"))
    split = spool(split, "training")
    fit = split.filter("not held")
    mean, deviation = scaling(fit, "y")
    stats = fit.select(F.posexplode("x")).groupBy("pos").agg(F.avg("col"), F.stddev_pop("col")).orderBy("pos").collect()
    if not stats:
        raise ValueError("no rows to train on")
    n, n_held = fit.count(), max(1, split.filter("held").count())
    shift, scale = np.array([r[1] for r in stats]), np.array([r[2] or 1.0 for r in stats])
    r = np.random.default_rng(seed)
    sizes = [len(stats), *hidden, 1]
    layers = [np.vstack([r.normal(0, 1 / np.sqrt(a), (a, b)), np.zeros((1, b))]) for a, b in zip(sizes, sizes[1:])]
    net = Network(layers, shift, scale, mean, deviation)
    weights, steps, before = net.flat(), np.full(len(net.flat()), FIRST_STEP), np.zeros(len(net.flat()))
    best, history = (np.inf, -1, weights), []
    for epoch in range(epochs):
        sums = _sums(split, net.with_flat(weights))
        gradient = np.array([sums[k] for k in range(len(weights))])
        history.append((sums[len(weights)] / n, sums[len(weights) + 1] / n_held))
        if history[-1][1] < best[0]:
            best = (history[-1][1], epoch, weights)
        turned = gradient * before
        steps = np.clip(np.where(turned > 0, steps * GROW, np.where(turned < 0, steps * SHRINK, steps)), LEAST_STEP, MOST_STEP)
        before = np.where(turned < 0, 0, gradient)
        weights = weights - np.sign(before) * steps
    done = net.with_flat(best[2])
    done.history, done.best_epoch = history, best[1]
    return done


def predicted(spark: SparkSession, net: Network, vector: Column, batch_size: int = 1024) -> Column:
    """The prediction for a vector column, in batches; a worker unpacks the broadcast model once. A null vector has none."""
    content = spark.sparkContext.broadcast(net.to_bytes())

    def make():
        model = Network.from_bytes(content.value)
        return lambda x: model.predict(x)

    run = predict_batch_udf(make, return_type=DoubleType(), batch_size=batch_size, input_tensor_shapes=[[net.width]])
    able = vector.isNotNull() & (F.size(vector) == net.width) & F.forall(vector, lambda v: v.isNotNull())
    return F.when(able, run(F.when(able, vector).otherwise(F.lit([0.0] * net.width))))

"""The learnt form of the next-event model (M1): a multilayer perceptron on the scaled context.

``c1..c3`` divided by K (W4) are the features, the next event is the class. The net is trained on
all training windows: its loss over them is a sum over the distinct 4-grams, each weighted by
its windows, so the windows are counted once and every step reads the counts alone (at
most K^4 rows, whatever the number of windows). Optimizer (L-BFGS with 10 corrections and a strong
Wolfe line search), loss (the mean over blocks of 512 windows of a partition, the last one shorter),
starting weights and limits are those of MLlib's perceptron, which takes no weights; the trained net is an MLlib model, saved and loaded with its own writer (S10). ``score``
gives the rank of the true event among the class probabilities (ties by event id), so accuracy and
top-k test are those of the count model.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators.nextevent import CTX
from logweave.session import materialize

HIDDEN = (32,)
ITERATIONS = 60
SEED = 17
# As in MLlib: relative tolerance, corrections kept, steps of a line search, values looked back at.
TOLERANCE = 1e-6
CORRECTIONS = 10
LINE_STEPS = 10
LOOK_BACK = 20
BLOCK_WINDOWS = 512
# Outputs of a block of contexts that a task holds at once.
_BLOCK = 1 << 20
_BLOCKS = "context binary, owner binary, y binary, n binary"


def _features(windows: DataFrame, classes: int) -> DataFrame:
    scaled = F.array(*[F.col(c).cast("double") / F.lit(float(classes)) for c in CTX])
    return windows.withColumn("_x", array_to_vector(scaled))


def _pack(classes: int):
    """mapInArrow function over weighted 4-grams sorted by context: blocks of contexts, and (context, y, n) of each 4-gram."""
    import pyarrow as pa
    rows = max(1, _BLOCK // classes)

    def run(batches):
        for b in (whole.slice(i, rows) for whole in batches for i in range(0, whole.num_rows, rows)):
            c1, c2, c3, y, n = (np.asarray(b.column(k)) for k in range(5))
            context = np.stack([c1, c2, c3], axis=1)
            heads = np.concatenate([[True], (context[1:] != context[:-1]).any(axis=1)])
            parts = context[heads].astype("<i4"), (np.cumsum(heads) - 1).astype("<i4"), y.astype("<i4"), n.astype("<f8")
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in parts], names=["context", "owner", "y", "n"])
    return run


def _unpack(w: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix (out x in) and bias of every layer, in MLlib's order: matrix by columns, then bias."""
    out, at = [], 0
    for n_in, n_out in zip(layers, layers[1:]):
        out.append((w[at:at + n_in * n_out].reshape(n_out, n_in, order="F"), w[at + n_in * n_out:at + (n_in + 1) * n_out]))
        at += (n_in + 1) * n_out
    return out


def loss_and_gradient(w: np.ndarray, layers: list[int], context, owner, y, n) -> tuple[float, np.ndarray]:
    """Summed cross-entropy and its gradient over 4-grams: windows of weight ``n`` have context ``owner`` and are followed by ``y``."""
    classes = layers[-1]
    parts, acts = _unpack(w, layers), [context / float(classes)]
    with np.errstate(over="ignore"):
        for matrix, bias in parts[:-1]:
            acts.append(1 / (1 + np.exp(-(acts[-1] @ matrix.T + bias))))
        z = acts[-1] @ parts[-1][0].T + parts[-1][1]
    z -= z.max(axis=1, keepdims=True)
    own = z[owner, y]
    np.exp(z, out=z)
    total = z.sum(axis=1)
    loss = float((n * (np.log(total)[owner] - own)).sum())
    z *= (np.bincount(owner, weights=n, minlength=len(context)) / total)[:, None]
    z[owner, y] -= n  # (owner, y) occurs once in a block
    out = []
    for k in range(len(parts) - 1, -1, -1):
        out += [z.sum(axis=0), (z.T @ acts[k]).ravel(order="F")]
        if k:
            z = (z @ parts[k][0]) * acts[k] * (1 - acts[k])
    return loss, np.concatenate(out[::-1])


def _step(layers: list[int], w: np.ndarray):
    """mapInArrow function: one row with the loss and the gradient of the task's blocks."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(len(w) + 1)
        for b in batches:
            for row in zip(*(b.column(k) for k in range(4))):
                context, owner, y, n = (np.frombuffer(v.as_buffer(), t) for v, t in zip(row, ("<i4", "<i4", "<i4", "<f8")))
                loss, g = loss_and_gradient(w, layers, context.reshape(-1, len(CTX)), owner, y, n)
                total[0] += loss
                total[1:] += g
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])
    return run


class _SearchFailed(Exception):
    """No step along the direction does."""


def _line_search(phi: Callable[[float], tuple[float, float]], at: tuple[float, float, float], step: float) -> float:
    """Strong Wolfe conditions; ``phi`` gives value and slope at a step, ``at`` is (0, value, slope) of the start."""
    c1, c2 = 1e-4, 0.9
    _, start, slope = low = at
    if not slope <= 0:
        raise _SearchFailed("not a direction of descent")

    def between(l, r):
        d1 = l[2] + r[2] - 3 * (l[1] - r[1]) / (l[0] - r[0])
        with np.errstate(invalid="ignore"):
            d2 = np.sqrt(d1 * d1 - l[2] * r[2])
        t = r[0] - (r[0] - l[0]) * (r[2] + d2 - d1) / (r[2] - l[2] + 2 * d2)
        least, most = l[0] + 0.1 * (r[0] - l[0]), l[0] + 0.9 * (r[0] - l[0])
        return float(least if t < least else most if t > most else t)

    def zoom(low, high):
        for _ in range(LINE_STEPS):
            t = between(high, low) if low[0] > high[0] else between(low, high)
            c = (t, *phi(t))
            if c[1] > start + c1 * t * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= c2 * abs(slope):
                return t
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _SearchFailed("zoom")

    for i in range(LINE_STEPS):
        c = (step, *phi(step))
        if not np.isfinite(c[1]):
            step /= 2
            continue
        if c[1] > start + c1 * step * slope or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= c2 * abs(slope):
            return step
        if c[2] >= 0:
            return zoom(c, low)
        low, step = c, step * 1.5
    raise _SearchFailed("no step")


def minimize(f: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, iterations: int) -> np.ndarray:
    """L-BFGS as MLlib runs it: ``f`` gives value and gradient."""
    value, g = f(w)
    first, values, kept, failed = value, [value], [], False
    done = 0
    while done < iterations and np.linalg.norm(g) > max(TOLERANCE * abs(value), 1e-8):
        d, shares = g.copy(), []
        for s, y in kept:  # the newest first
            shares.append((s @ d) / (s @ y))
            d -= shares[-1] * y
        if kept:
            s, y = kept[0]
            d *= (s @ y) / (y @ y)
        for (s, y), share in zip(reversed(kept), reversed(shares)):
            d += (share - (y @ d) / (s @ y)) * s
        d = -d
        seen = {}

        def phi(t, w=w, d=d, seen=seen):
            v, grad = seen[t] = f(w + t * d)
            return v, float(grad @ d)
        try:
            t = _line_search(phi, (0.0, value, float(g @ d)), 1.0 if done else 1 / np.linalg.norm(d))
        except _SearchFailed:
            if failed:
                break
            kept, failed = [], True  # once more without the history
            continue
        new, grad = seen[t]
        kept = [(t * d, grad - g), *kept][:CORRECTIONS]
        w, value, g, done = w + t * d, new, grad, done + 1
        if abs(value - max(values)) <= TOLERANCE * abs(first):
            break
        values = [*values, value][-LOOK_BACK:]
    return w


def _net(spark: SparkSession, layers: list[int], seed: int, weights: np.ndarray | None = None) -> MultilayerPerceptronClassificationModel:
    """An MLlib model with these weights (None: those that its training starts from), without a step of training."""
    net = MultilayerPerceptronClassifier(featuresCol="_x", labelCol="_label", layers=layers, maxIter=0, seed=seed)
    if weights is not None:
        net.setInitialWeights(Vectors.dense(weights))
    return net.fit(spark.createDataFrame([(Vectors.dense([0.0] * layers[0]), 0.0)], ["_x", "_label"]))


def _weighted(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c1, c2, c3, y, n) of the distinct 4-grams, and the number of blocks. A window weighs one by the windows of its
    block: all blocks of a partition have ``BLOCK_WINDOWS`` but the last. The shares are added in a fixed order."""
    at = F.monotonically_increasing_id()
    placed = windows.select(*CTX, "y", at.alias("_at")).withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    rest = F.col("_rows") % BLOCK_WINDOWS
    sized = placed.join(F.broadcast(parts), "_part").withColumn(  # a row for each partition
        "_block", F.when(F.col("_at").bitwiseAND((1 << 33) - 1) < F.col("_rows") - rest, BLOCK_WINDOWS).otherwise(rest))
    counted = sized.groupBy(*CTX, "y", "_block").agg(F.count(F.lit(1)).alias("_n"))
    shares = F.array_sort(F.collect_list(F.struct("_block", "_n")))  # of a 4-gram: one, and those of last blocks
    total = F.aggregate(shares, F.lit(0.0), lambda s, p: s + p["_n"].cast("double") / p["_block"].cast("double"))
    return (counted.groupBy(*CTX, "y").agg(total.alias("n")),
            parts.agg(F.sum(F.ceil(F.col("_rows") / BLOCK_WINDOWS)).cast("long").alias("blocks")))


def fit(train_windows: DataFrame, classes: int, hidden=HIDDEN, iterations: int = ITERATIONS,
        seed: int = SEED) -> MultilayerPerceptronClassificationModel:
    """Train on ``(c1, c2, c3, y)`` with event ids in 0..classes-1."""
    spark = train_windows.sparkSession
    layers = [len(CTX), *hidden, classes]
    weighted, blocks = _weighted(train_windows)
    packed = (weighted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *CTX).sortWithinPartitions(*CTX)
              .select(*[F.col(c).cast("long") for c in [*CTX, "y"]], "n").mapInArrow(_pack(classes), _BLOCKS))
    grams = materialize(packed, "path-grams")
    n = blocks.first()["blocks"]

    def value(w):
        rows = grams.mapInArrow(_step(layers, w), "total binary").collect()  # a row per task
        total = np.sum([np.frombuffer(r["total"]) for r in rows], axis=0) / n
        return float(total[0]), total[1:]

    return _net(spark, layers, seed, minimize(value, _net(spark, layers, seed).weights.toArray(), iterations))


def save(model: MultilayerPerceptronClassificationModel, path: str, fit_id: str) -> None:
    model.write().overwrite().save(f"{path}/fit_id={fit_id}")


def load(path: str, fit_id: str) -> MultilayerPerceptronClassificationModel:
    return MultilayerPerceptronClassificationModel.load(f"{path}/fit_id={fit_id}")


def score(windows: DataFrame, model: MultilayerPerceptronClassificationModel, top_k: int) -> DataFrame:
    """``rank`` of the true next event (null for an event without a class) and ``is_anomaly``; each distinct 4-gram once."""
    classes = model.numClasses
    grams = _features(windows.select(*CTX, "y").distinct(), classes)
    # the raw outputs order the classes as the probabilities do, without ties made by rounding to 0
    model.setRawPredictionCol("_raw")
    raw = model.transform(grams).withColumn("_p", vector_to_array("_raw"))
    mine = F.try_element_at("_p", (F.col("y") + 1).cast("int"))
    ahead = F.filter("_p", lambda p, i: (p > mine) | ((p == mine) & (i < F.col("y"))))
    rank = F.when((F.col("y") >= 0) & (F.col("y") < classes), F.size(ahead) + 1).cast("long")
    ranked = raw.select(*CTX, "y", rank.alias("rank"))
    return (windows.join(ranked, [*CTX, "y"])
            .withColumn("is_anomaly", F.col("rank").isNull() | (F.col("rank") > F.lit(top_k))))

"""Networks trained data-parallel, one job a step or a chain of steps.

Rows are dealt once, by a hash of their ids, into micro-batches of about ``micro_rows`` and these into batches, and written by
batch.  A step of a large batch is a job: each task takes its micro-batches forward and backward and adds up their gradients, tasks
are added up by Spark, and the driver moves the weights (Adam).  Steps of small batches, which have work for a few tasks only and take
less time than a job, go in chains: one job reads the batches of many steps, in their order, and its last task takes these steps
one after the other.  Both give the same weights.  The driver holds weights only, a task one micro-batch of rows.

Gradients travel as integers (32 binary places), dropout masks are a hash of (row, step, layer, unit), batch statistics
are those of a micro-batch, and rows stand in a fixed order: so weights do not depend on partitions or retries.

Layers: ``Dense``, ``BatchNorm``, ``Relu``, ``Dropout``, ``Conv`` (same padding), ``Pool`` (2 x 2 maximum), ``Flat``, ``Lstm``.  The last layer
has one unit, whose sigmoid is the probability of label 1.  Training stops when the loss of the held-out share has not fallen for
``patience`` epochs; the best weights are kept.

Defined cases: ids are unique; rows without id, label or vector are not trained on; components that are NULL or NaN count as the
mean; constant components become 0; vectors have one length; an empty table gives a network that scores 0.5.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.functions.scalars import hash_int
from loanmart.session import scratch_path

UNIT = float(1 << 32)
CHAIN_MICROS = 32               # micro-batches up to which a batch goes in a chain
CHAIN_BYTES = 1 << 27           # inputs of the steps of one chain
CHAIN_THREADS = 4               # micro-batches of a step that its task takes side by side
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# ------------------------------------------------------------------ layers

class Layer:
    """Shapes are without the row axis.  ``weights`` and ``stats`` name arrays; both live in flat vectors of the network."""

    def build(self, shape: tuple[int, ...]) -> tuple[int, ...]:
        self.weights: dict[str, tuple[int, ...]] = {}
        self.stats: dict[str, tuple[int, ...]] = {}
        return shape

    def start(self, name: str, rng) -> np.ndarray:
        shape = self.weights[name]
        if len(shape) == 1:
            return np.full(shape, 1.0 if name == "gain" else 0.0)
        fan = np.prod(shape[:-1]) + shape[-1]
        return rng.uniform(-1, 1, shape) * np.sqrt(6 / fan)


class Dense(Layer):
    def __init__(self, units: int):
        self.units = units

    def build(self, shape):
        super().build(shape)
        self.weights = {"w": (shape[0], self.units), "b": (self.units,)}
        return (self.units,)

    def forward(self, x, w, _how):
        return x @ w["w"] + w["b"], x

    def backward(self, dy, x, w):
        return dy @ w["w"].T, {"w": x.T @ dy, "b": dy.sum(0)}


class Relu(Layer):
    def forward(self, x, w, _how):
        return np.maximum(x, 0), x > 0

    def backward(self, dy, on, w):
        return dy * on, {}


class Flat(Layer):
    def build(self, shape):
        super().build(shape)
        return (int(np.prod(shape)),)

    def forward(self, x, w, _how):
        return x.reshape(len(x), -1), x.shape

    def backward(self, dy, shape, w):
        return dy.reshape(shape), {}


class Dropout(Layer):
    def __init__(self, rate: float):
        self.rate = rate

    def forward(self, x, w, how):
        if how is None or not self.rate:
            return x, None
        units = np.arange(int(np.prod(x.shape[1:])), dtype=np.uint64)
        salt = np.uint64((how["step"] * 1_000_003 + how["layer"] * 7919) & (2 ** 63 - 1))
        drawn = _mix(_mix(how["rows"] ^ _mix(np.array([salt])))[:, None] + units[None, :] * np.uint64(0x9E3779B97F4A7C15))
        keep = ((drawn >> np.uint64(11)).astype(float) / (1 << 53) >= self.rate).reshape(x.shape) / (1 - self.rate)
        return x * keep, keep

    def backward(self, dy, keep, w):
        return dy if keep is None else dy * keep, {}


class BatchNorm(Layer):
    """Statistics of the micro-batch while training, their running means afterwards; over all but the last axis."""

    EPS = 1e-3

    def build(self, shape):
        super().build(shape)
        self.weights = {"gain": (shape[-1],), "shift": (shape[-1],)}
        self.stats = {"mean": (shape[-1],), "var": (shape[-1],)}
        return shape

    def forward(self, x, w, how):
        axes = tuple(range(x.ndim - 1))
        mean, var = (w["mean"], w["var"]) if how is None else (x.mean(axes), x.var(axes))
        z = (x - mean) / np.sqrt(var + self.EPS)
        return z * w["gain"] + w["shift"], (z, var, {"mean": mean, "var": var})

    def backward(self, dy, cache, w):
        z, var, _ = cache
        axes = tuple(range(dy.ndim - 1))
        dz = dy * w["gain"]
        dx = (dz - dz.mean(axes) - z * (dz * z).mean(axes)) / np.sqrt(var + self.EPS)
        return dx, {"gain": (dy * z).sum(axes), "shift": dy.sum(axes)}


class Conv(Layer):
    """Convolution over (height, width, channels), same padding, odd kernel."""

    def __init__(self, filters: int, kernel: int):
        self.filters, self.kernel = filters, kernel

    def build(self, shape):
        super().build(shape)
        self.weights = {"w": (self.kernel * self.kernel * shape[2], self.filters), "b": (self.filters,)}
        return (shape[0], shape[1], self.filters)

    def _patches(self, x):
        k, p = self.kernel, self.kernel // 2
        wide = np.pad(x, ((0, 0), (p, p), (p, p), (0, 0)))
        view = np.lib.stride_tricks.sliding_window_view(wide, (k, k), (1, 2))     # n, h, w, c, k, k
        return view.transpose(0, 1, 2, 4, 5, 3).reshape(*x.shape[:3], -1)

    def forward(self, x, w, _how):
        patches = self._patches(x)
        return patches @ w["w"] + w["b"], (patches, x.shape)

    def backward(self, dy, cache, w, first=False):
        patches, (n, h, wd, c) = cache
        k, p = self.kernel, self.kernel // 2
        flat = patches.reshape(-1, patches.shape[-1])
        own = {"w": flat.T @ dy.reshape(-1, self.filters), "b": dy.sum((0, 1, 2))}
        if first:                                           # nobody asks for the gradient of the inputs
            return None, own
        d = (dy @ w["w"].T).reshape(n, h, wd, k, k, c)
        wide = np.zeros((n, h + 2 * p, wd + 2 * p, c))
        for i in range(k):
            for j in range(k):
                wide[:, i:i + h, j:j + wd] += d[:, :, :, i, j]
        return wide[:, p:p + h, p:p + wd], own


class Pool(Layer):
    """Maximum of 2 x 2 cells; a last odd row or column goes."""

    def build(self, shape):
        super().build(shape)
        return (shape[0] // 2, shape[1] // 2, shape[2])

    def forward(self, x, w, _how):
        n, h, wd, c = x.shape
        cells = x[:, :h // 2 * 2, :wd // 2 * 2].reshape(n, h // 2, 2, wd // 2, 2, c).transpose(0, 1, 3, 5, 2, 4).reshape(n, h // 2, wd // 2, c, 4)
        best = cells.argmax(-1)
        return cells.max(-1), (best, x.shape)

    def backward(self, dy, cache, w):
        best, (n, h, wd, c) = cache
        d = np.zeros((*dy.shape, 4))
        np.put_along_axis(d, best[..., None], dy[..., None], -1)
        out = np.zeros((n, h, wd, c))
        out[:, :h // 2 * 2, :wd // 2 * 2] = d.reshape(n, h // 2, wd // 2, c, 2, 2).transpose(0, 1, 4, 2, 5, 3).reshape(n, h // 2 * 2, wd // 2 * 2, c)
        return out, {}


class Lstm(Layer):
    """Over (steps, inputs), giving (steps, units)."""

    def __init__(self, units: int):
        self.units = units

    def build(self, shape):
        super().build(shape)
        self.weights = {"w": (shape[1], 4 * self.units), "r": (self.units, 4 * self.units), "b": (4 * self.units,)}
        return (shape[0], self.units)

    def forward(self, x, w, _how):
        u, (n, steps, _) = self.units, x.shape
        h, c, out, cache = np.zeros((n, u)), np.zeros((n, u)), [], []
        for t in range(steps):
            a = x[:, t] @ w["w"] + h @ w["r"] + w["b"]
            gate = 1 / (1 + np.exp(-a[:, :3 * u]))
            i, f, o, g = gate[:, :u], gate[:, u:2 * u], gate[:, 2 * u:], np.tanh(a[:, 3 * u:])
            cache.append((h, c, i, f, o, g))
            c = f * c + i * g
            h = o * np.tanh(c)
            out.append(h)
        return np.stack(out, 1), (x, cache)

    def backward(self, dy, cache, w):
        x, states = cache
        dx, dh, dc = np.zeros_like(x), 0.0, 0.0
        grads = {k: np.zeros(s) for k, s in self.weights.items()}
        for t in reversed(range(x.shape[1])):
            h, c, i, f, o, g = states[t]
            th = np.tanh(f * c + i * g)
            dh = dh + dy[:, t]
            dc = dc + dh * o * (1 - th * th)
            da = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], 1)
            grads["w"] += x[:, t].T @ da
            grads["r"] += h.T @ da
            grads["b"] += da.sum(0)
            dx[:, t], dh, dc = da @ w["w"].T, da @ w["r"].T, dc * f
        return dx, grads


# ----------------------------------------------------------------- network

class Net:
    """Layers over inputs of a shape; all weights in one vector, all running statistics in another."""

    def __init__(self, shape: tuple[int, ...], layers: Sequence[Layer]):
        self.shape, self.layers = shape, list(layers)
        self.places: list[tuple[dict, dict]] = []
        self.n_weights = self.n_stats = 0
        for layer in self.layers:
            shape = layer.build(shape)
            w, s = {}, {}
            for k, x in layer.weights.items():
                w[k] = (slice(self.n_weights, self.n_weights + int(np.prod(x))), x)
                self.n_weights = w[k][0].stop
            for k, x in layer.stats.items():
                s[k] = (slice(self.n_stats, self.n_stats + int(np.prod(x))), x)
                self.n_stats = s[k][0].stop
            self.places.append((w, s))
        if shape != (1,):
            raise ValueError(f"the last layer has shape {shape}; one unit is needed")

    def start(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        rng, weights, stats = np.random.default_rng(seed), np.zeros(self.n_weights), np.zeros(self.n_stats)
        for layer, (w, s) in zip(self.layers, self.places):
            for k, (at, _) in w.items():
                weights[at] = layer.start(k, rng).ravel()
            if "var" in s:
                stats[s["var"][0]] = 1.0
        return weights, stats

    def _own(self, i: int, weights: np.ndarray, stats: np.ndarray) -> dict:
        w, s = self.places[i]
        return {k: weights[at].reshape(x) for k, (at, x) in w.items()} | {k: stats[at].reshape(x) for k, (at, x) in s.items()}

    def forward(self, x: np.ndarray, weights: np.ndarray, stats: np.ndarray, until: int | None = None) -> np.ndarray:
        """Output of the last layer (or of layer ``until``), with running statistics and without dropout."""
        x = x.reshape(len(x), *self.shape)
        for i, layer in enumerate(self.layers[:None if until is None else until + 1]):
            x = layer.forward(x, self._own(i, weights, stats), None)[0]
        return x

    def gradient(self, x: np.ndarray, y: np.ndarray, rows: np.ndarray, step: int, weights: np.ndarray, stats: np.ndarray):
        """(summed loss, its gradient, the micro-batch's statistics times its rows)."""
        x, caches = x.reshape(len(x), *self.shape), []
        for i, layer in enumerate(self.layers):
            x, cache = layer.forward(x, self._own(i, weights, stats), {"rows": rows, "step": step, "layer": i})
            caches.append(cache)
        z = x[:, 0]
        loss = float(np.sum(np.logaddexp(0, z) - y * z))
        d, grad, seen = (1 / (1 + np.exp(-z)) - y)[:, None], np.zeros(self.n_weights), np.zeros(self.n_stats)
        for i in reversed(range(len(self.layers))):
            more = {"first": True} if i == 0 and isinstance(self.layers[i], Conv) else {}
            d, own = self.layers[i].backward(d, caches[i], self._own(i, weights, stats), **more)
            for k, g in own.items():
                grad[self.places[i][0][k][0]] = g.ravel()
            for k, (at, _) in self.places[i][1].items():
                seen[at] = caches[i][2][k].ravel() * len(y)
        return loss, grad, seen


@dataclass(frozen=True)
class NetParams:
    epochs: int = 20
    batch_rows: int = 4096
    micro_rows: int = 256
    rate: float = 1e-3
    patience: int = 10
    valid_share: float = 0.05
    momentum: float = 0.9               # of running statistics, a step
    seed: int = 1234


@dataclass
class NetModel:
    net: Net
    weights: np.ndarray
    stats: np.ndarray
    mean: np.ndarray
    dev: np.ndarray
    history: list[tuple[int, float, float]] = field(default_factory=list)     # epoch, training loss, held-out loss

    def save(self, spark, path: str) -> None:
        """Layers, weights and scaling as JSON text."""
        layers = [[type(x).__name__, {k: v for k, v in vars(x).items() if k not in ("weights", "stats")}] for x in self.net.layers]
        d = {"shape": list(self.net.shape), "layers": layers, "history": self.history} | {
            k: getattr(self, k).tolist() for k in ("weights", "stats", "mean", "dev")}
        spark.createDataFrame([(json.dumps(d),)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> "NetModel":
        d = json.loads(spark.read.text(path, wholetext=True).first()[0])
        kinds = {x.__name__: x for x in Layer.__subclasses__()}
        net = Net(tuple(d["shape"]), [kinds[name](**how) for name, how in d["layers"]])
        return cls(net, *[np.array(d[k]) for k in ("weights", "stats", "mean", "dev")], [tuple(x) for x in d["history"]])

    def _ready(self, col: pa.Array) -> np.ndarray:
        return _scaled(_rows_of(col, int(np.prod(self.net.shape))), self.mean, self.dev)

    def _map(self, df: DataFrame, keep: Sequence[str], vec: str, out: str, kind: T.DataType, fn) -> DataFrame:
        kept = [df.schema[c] for c in keep]
        schema = T.StructType([*kept, T.StructField(out, kind)])

        def run(batches):
            for b in batches:
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([*b.columns[:-1], fn(self._ready(b.column(b.num_columns - 1)))], names=schema.names)

        return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{vec}`").cast("array<double>").alias("_x")).mapInArrow(run, schema)

    def score(self, df: DataFrame, keep: Sequence[str], vec: str, threshold: float = 0.5) -> DataFrame:
        """``keep``, ``score`` (probability of label 1) and ``pred``."""
        def fn(x):
            return pa.array(1 / (1 + np.exp(-self.net.forward(x, self.weights, self.stats)[:, 0])))
        return self._map(df, keep, vec, "score", T.DoubleType(), fn).withColumn("pred", (F.col("score") > threshold).cast("int"))

    def hidden(self, df: DataFrame, keep: Sequence[str], vec: str, layer: int, out: str = "hidden") -> DataFrame:
        """``keep`` and the output of a layer as an array."""
        def fn(x):
            h = self.net.forward(x, self.weights, self.stats, layer)
            return pa.array(list(h.reshape(len(h), -1)), pa.list_(pa.float64()))
        return self._map(df, keep, vec, out, T.ArrayType(T.DoubleType()), fn)


def _rows_of(col: pa.Array, width: int) -> np.ndarray:
    return np.array([[np.nan] * width if r is None else [np.nan if v is None else v for v in r] for r in col.to_pylist()], float).reshape(len(col), width)


def _scaled(x: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(x) | (dev == 0), 0.0, (x - mean) / np.where(dev == 0, 1, dev))


def _moments(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each component (to seven digits, so that the order of sums does not show)."""
    found = rows.select(F.posexplode("x").alias("i", "v")).filter("v IS NOT NULL AND NOT isnan(v)").groupBy("i").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()          # two numbers a component
    mean, dev = np.zeros(width), np.zeros(width)
    for r in found:
        if r["s"] > 1e-12 * max(1.0, abs(r["m"])):
            mean[r["i"]], dev[r["i"]] = np.float32(r["m"]), np.float32(r["s"])
    return mean, dev


def _sums(data: DataFrame, size: int, fn) -> np.ndarray:
    """Integer sums of the vectors that ``fn`` makes of micro-batches (x, y, rows); one row reaches the driver."""
    def add(batches):
        total, some = np.zeros(size, np.int64), False
        for b in batches:
            for x, y, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                y = np.frombuffer(y)
                total += np.rint(fn(np.frombuffer(x).reshape(len(y), -1), y, np.frombuffer(rows, np.uint64)) * UNIT).astype(np.int64)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["k", "v"])

    def meet(t: pa.Table) -> pa.Table:
        return pa.table({"k": pa.array([0], pa.int32()), "v": pa.array([sum(np.frombuffer(v, np.int64) for v in t.column("v").to_pylist()).tobytes()], pa.binary())})

    parts = data.select("x", "y", "rows").mapInArrow(add, "k int, v binary")
    few = parts.withColumn("k", (F.spark_partition_id() % 64).cast("int")).groupBy("k").applyInArrow(meet, "k int, v binary")
    got = few.collect()                                     # 64 vectors at most
    return sum((np.frombuffer(r["v"], np.int64) for r in got), np.zeros(size, np.int64)) / UNIT


def _adam(p: "NetParams", net: Net, state: tuple, step: int, got: np.ndarray) -> tuple:
    """(weights, stats, first, second, summed loss) after a step with the sums ``got`` of a batch."""
    weights, stats, first, second, lost = state
    loss, count = got[-2:]
    if not count:
        return state
    grad = got[:net.n_weights] / count
    first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
    weights = weights - p.rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-7)
    stats = p.momentum * stats + (1 - p.momentum) * got[net.n_weights:-2] / count
    return weights, stats, first, second, lost + loss


def _step_sums(net: Net, x: np.ndarray, y: np.ndarray, rows: np.ndarray, step: int, state: tuple) -> np.ndarray:
    loss, grad, seen = net.gradient(x, y, rows, step, state[0], state[1])
    return np.concatenate([grad, seen, [loss, len(y)]])


def _chain(data: DataFrame, order: Sequence[int], step: int, p: "NetParams", net: Net, state: tuple) -> tuple:
    """The state after the steps of the batches ``order``, the first of which is ``step``; one state reaches the driver."""
    sizes = np.cumsum([net.n_weights, net.n_stats, net.n_weights, net.n_weights])

    def one(args):
        i, x, y, rows, now = args
        y = np.frombuffer(y.as_buffer())
        sums = _step_sums(net, np.frombuffer(x.as_buffer()).reshape(len(y), -1), y, np.frombuffer(rows.as_buffer(), np.uint64), step + i, now)
        return np.rint(sums * UNIT).astype(np.int64)

    def walk(batches):
        now = state
        cells = ((i, *row) for b in batches for i, *row in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3)))
        with ThreadPoolExecutor(CHAIN_THREADS) as pool:
            for i, micros in groupby(cells, lambda c: c[0]):
                total = sum(pool.map(one, ((*m, now) for m in micros)))
                now = _adam(p, net, now, step + i, total / UNIT)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([*now[:4], [now[4]]]).tobytes()], pa.binary())], names=["v"])

    place = F.array_position(F.array(*[F.lit(b) for b in order]), F.col("batch")) - 1
    steps = data.filter(F.col("batch").isin(list(order))).select(place.cast("int").alias("i"), "x", "y", "rows")
    got = steps.repartition(1).sortWithinPartitions("i").mapInArrow(walk, "v binary").collect()
    if not got:
        return state
    *arrays, lost = np.split(np.frombuffer(got[0]["v"]), sizes)
    return (*arrays, float(lost[0]))


def fit_network(df: DataFrame, id_col: str, label: str, vec: str, shape: tuple[int, ...], layers: Sequence[Layer],
                params: NetParams | None = None) -> NetModel:
    """Train ``layers`` over vectors ``vec`` of ``shape`` (row-major)."""
    p, net = params or NetParams(), Net(shape, layers)
    width, spark = int(np.prod(shape)), df.sparkSession
    rows = df.select(hash_int(id_col, p.seed).cast("bigint").alias("h"), F.col(f"`{id_col}`").cast("string").alias("id"),
                     F.col(f"`{label}`").cast("double").alias("y"), F.col(f"`{vec}`").cast("array<double>").alias("x"))
    rows = rows.filter("id IS NOT NULL AND y IS NOT NULL AND x IS NOT NULL")
    rows = rows.withColumn("valid", F.col("h") < int(p.valid_share * (1 << 32)))
    n = {r["valid"]: r["count"] for r in rows.groupBy("valid").count().collect()}
    mean, dev = _moments(rows.filter("NOT valid"), width)
    weights, stats = net.start(p.seed)
    model = NetModel(net, weights, stats, mean, dev)
    if not n.get(False):
        model.weights = weights * 0
        return model
    batches = max(1, round(n[False] / p.batch_rows))
    micros = max(1, round(n[False] / (p.micro_rows * batches)))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("id", "ascending")])
        key = _mix(np.array(t.column("h").to_numpy(), np.uint64) + np.uint64(1))
        return pa.table({"batch": t.column("batch").slice(0, 1), "x": pa.array([_scaled(_rows_of(t.column("x").combine_chunks(), width), mean, dev).tobytes()], pa.binary()),
                         "y": pa.array([t.column("y").to_numpy().tobytes()], pa.binary()), "rows": pa.array([key.tobytes()], pa.binary())})

    draw = F.xxhash64("id", F.lit(p.seed))
    dealt = rows.withColumn("batch", F.when(F.col("valid"), -1).otherwise(F.pmod(draw, F.lit(batches))).cast("int")).withColumn(
        "micro", F.pmod(F.shiftrightunsigned(draw, 20), F.when(F.col("valid"), max(1, n.get(True, 0) // p.micro_rows)).otherwise(micros)))
    path = scratch_path(spark, "network")
    (dealt.repartition("batch", "micro").groupBy("batch", "micro").applyInArrow(pack, "batch int, x binary, y binary, rows binary")
     .write.partitionBy("batch").parquet(path))
    data = spark.read.parquet(path)

    def held_out(w, s):
        def fn(x, y, _rows):
            z = net.forward(x, w, s)[:, 0]
            return np.array([np.sum(np.logaddexp(0, z) - y * z)])
        return float(_sums(data.filter("batch = -1"), 1, fn)[0]) / max(1, n.get(True, 0))

    chain = max(1, CHAIN_BYTES * batches // (8 * width * n[False])) if micros <= CHAIN_MICROS else 0
    best, waited, first, second, step = None, 0, np.zeros(net.n_weights), np.zeros(net.n_weights), 0
    for epoch in range(p.epochs):
        state = weights, stats, first, second, 0.0
        order = np.random.default_rng([p.seed, epoch]).permutation(batches).tolist()
        for at in range(0, batches, chain or 1):
            if chain:
                state = _chain(data, order[at:at + chain], step + 1, p, net, state)
                step += len(order[at:at + chain])
                continue
            step += 1

            def fn(x, y, rows, step=step, state=state):
                return _step_sums(net, x, y, rows, step, state)
            state = _adam(p, net, state, step, _sums(data.filter(F.col("batch") == order[at]), net.n_weights + net.n_stats + 2, fn))
        weights, stats, first, second, lost = state
        loss = held_out(weights, stats) if n.get(True) else lost / n[False]
        model.history.append((epoch, float(lost / n[False]), float(loss)))
        if best is None or loss < best:
            best, waited, model.weights, model.stats = loss, 0, weights, stats
        else:
            waited += 1
            if waited >= p.patience:
                break
    return model


# The layers of the source's networks.
def connected(units: Sequence[int] = (150, 75, 25), dropout: float = 0.2) -> list[Layer]:
    """Fully connected units, each with batch statistics, relu and dropout."""
    return [x for u in units for x in (Dense(u), BatchNorm(), Relu(), Dropout(dropout))] + [Dense(1)]


def convolutional(features: int = 100) -> tuple[list[Layer], int]:
    """Two convolutions and two connected layers; (layers, the number of the layer whose output are the features)."""
    layers = [Conv(32, 5), Relu(), Pool(), Conv(32, 5), Relu(), Pool(), Flat(), Dense(128), Relu(), Dropout(0.5), Dense(features), Relu(), Dense(1)]
    return layers, 10


def recurrent(features: int = 100) -> tuple[list[Layer], int]:
    """Two LSTM layers and two connected layers; (layers, the number of the feature layer)."""
    layers = [Lstm(50), BatchNorm(), Relu(), Dropout(0.2), Lstm(50), BatchNorm(), Relu(), Dropout(0.2), Flat(), Dense(128), BatchNorm(), Relu(),
              Dropout(0.5), Dense(features), BatchNorm(), Relu(), Dense(1)]
    return layers, 13

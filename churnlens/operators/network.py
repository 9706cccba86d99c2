"""The network with one hidden layer (H5): ReLU, binary cross entropy, mini-batch Adam.

The training rows are dealt once, by a seeded hash, to blocks of a mini-batch
each, whatever their number: an epoch has rows / batch steps, one after the
other. The blocks are written and kept by the executors in shares of ``SHARE``
rows, and the network goes to the rows: a task takes the weights, makes the
steps of one share's blocks, and hands the weights on to the next share. The
order of the blocks in a share, and of the shares, is drawn anew in every epoch.

A search trains all its settings in the same jobs, a task for each, and each
goes through the shares in an order of its own, so that the settings are spread
over the executors. A setting with a larger batch adds up the gradients of as
many blocks as its batch has before it steps; a sum begun goes along to the
next share.

A block larger than a share is worth a job: its tasks sum the gradient of
their rows, and the driver adds these sums (``PARTS`` at most) and makes the
step.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.session import scratch_path

# --- fixed values: settings of the reference configuration ---
DEFAULTS = {"hidden": 128, "lr": 0.001, "epochs": 20, "batch": 512}
GRID = {"hidden": [64, 128, 256], "lr": [0.001, 0.005, 0.01], "batch": [128, 256, 512]}
# --- fixed values: decay rates and guard of the Adam step ---
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
#: Rows that a network meets in one task.
SHARE = 1 << 16
#: Partitions of a block, and so partial sums of one setting that reach the driver, at most.
PARTS = 16
#: Rows times hidden units, over all settings, that make up a partition's worth of work; the driver does less itself.
WORK = 1 << 20
#: Rows whose hidden layer is held at once.
CHUNK = 1024


@dataclass
class Network:
    """Weights: hidden (features x hidden), its bias, output, its bias, in one flat array."""
    features: tuple[str, ...]
    hidden: int
    flat: np.ndarray

    @property
    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return unpack(self.flat, len(self.features), self.hidden)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the ``probability`` vector, as a fitted Spark model does."""
        d, h, flat = len(self.features), self.hidden, self.flat

        @F.pandas_udf(T.DoubleType())
        def p(columns: pd.DataFrame) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-logits(flat, columns.to_numpy(float), h))))
        one = p(F.struct(*[F.col(f).cast("double").alias(f) for f in self.features]))
        scored = df.withColumn("_p1", one)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p1"), F.col("_p1")))).drop("_p1")


def unpack(flat: np.ndarray, d: int, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return flat[:d * h].reshape(d, h), flat[d * h:d * h + h], flat[d * h + h:d * h + 2 * h], flat[-1:]


def initial(d: int, h: int, seed: int) -> np.ndarray:
    """Uniform within 1 / sqrt(inputs) of each layer."""
    rng = np.random.default_rng(seed)
    a, b = d ** -0.5, h ** -0.5
    return np.concatenate([rng.uniform(-a, a, d * h + h), rng.uniform(-b, b, h + 1)])


def logits(flat: np.ndarray, x: np.ndarray, h: int) -> np.ndarray:
    w1, b1, w2, b2 = unpack(flat, x.shape[1], h)
    out = np.empty(len(x))
    for a in range(0, len(x), CHUNK):
        out[a:a + CHUNK] = np.maximum(x[a:a + CHUNK] @ w1 + b1, 0) @ w2 + b2[0]
    return out


def loss_and_gradient(flat: np.ndarray, x: np.ndarray, y: np.ndarray, h: int) -> tuple[float, np.ndarray]:
    """Sum of the cross entropy over the rows and its gradient."""
    d = x.shape[1]
    w1, b1, w2, b2 = unpack(flat, d, h)
    loss, g = 0.0, np.zeros(len(flat))
    g1, gb1, g2, gb2 = unpack(g, d, h)
    for a in range(0, len(x), CHUNK):
        xs, ys = x[a:a + CHUNK], y[a:a + CHUNK]
        z = xs @ w1 + b1
        act = np.maximum(z, 0)
        s = act @ w2 + b2[0]
        loss += float((np.logaddexp(0, s) - ys * s).sum())
        off = 1 / (1 + np.exp(-s)) - ys
        back = (off[:, None] * w2) * (z > 0)
        g1 += xs.T @ back
        gb1 += back.sum(0)
        g2 += act.T @ off
        gb2 += off.sum()
    return loss, g


class Adam:
    def __init__(self, size: int, lr: float):
        self.lr, self.m, self.v, self.t = lr, np.zeros(size), np.zeros(size), 0

    def step(self, flat: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = BETA1 * self.m + (1 - BETA1) * g
        self.v = BETA2 * self.v + (1 - BETA2) * g * g
        m, v = self.m / (1 - BETA1 ** self.t), self.v / (1 - BETA2 ** self.t)
        return flat - self.lr * m / (np.sqrt(v) + EPSILON)


class Learner:
    """What goes from share to share: the weights of one setting, its Adam state, the gradient sum and rows of the batch
    begun, and the blocks met in this epoch."""

    def __init__(self, d: int, setting: Mapping, blocks: int, block: int, seed: int):
        self.d, self.hidden, self.blocks, self.seed = d, setting["hidden"], blocks, seed
        self.per_step = max(1, round(setting["batch"] / block))
        self.flat = initial(d, self.hidden, seed)
        self.adam = Adam(len(self.flat), setting["lr"])
        self.total, self.rows, self.met = np.zeros(len(self.flat)), 0, 0
        self.name = zlib.crc32(f"{self.hidden} {float(setting['lr'])} {setting['batch']}".encode())

    def route(self, shares: int, epoch: int) -> np.ndarray:
        """The shares in the order of this setting and epoch."""
        return np.random.default_rng([self.seed, self.name, epoch]).permutation(shares)

    def add(self, rows: int, g: np.ndarray) -> None:
        """A block's gradient sum; the step, if it ends the batch or the epoch."""
        self.total, self.rows, self.met = self.total + g, self.rows + rows, self.met + 1
        if self.rows and (self.met % self.per_step == 0 or self.met == self.blocks):
            self.flat = self.adam.step(self.flat, self.total / self.rows)
            self.total, self.rows = np.zeros(len(self.flat)), 0
        self.met %= self.blocks

    def visit(self, packs: Iterable[tuple[int, bytes, bytes]], first: int, after: int, share: int, epoch: int) -> None:
        """The steps of a share, which has the blocks from ``first`` to before ``after``."""
        found = [([], []) for _ in range(first, after)]
        for block, x, y in packs:
            found[block - first][0].append(x)
            found[block - first][1].append(y)
        for b in block_order(after - first, share, epoch, self.seed):
            y = np.frombuffer(b"".join(found[b][1]))
            x = np.frombuffer(b"".join(found[b][0])).reshape(len(y), self.d)
            self.add(len(y), loss_and_gradient(self.flat, x, y, self.hidden)[1])


def block_order(blocks: int, share: int, epoch: int, seed: int) -> np.ndarray:
    """The blocks of a share in the order of an epoch: draw ``epoch`` of the share's generator."""
    rng = np.random.default_rng(seed + share)
    return [rng.permutation(blocks) for _ in range(epoch + 1)][-1]


def _dealt(df: DataFrame, features: Sequence[str], label: str, blocks: int, place: Callable[[Column, Column], Column], places: int, seed: int) -> DataFrame:
    """``block, x, y``: the rows as arrays, a record for the rows of a block that lie together. ``place`` gives a row's
    partition from its block and hash. Rows without a label are left out."""
    spark = df.sparkSession
    rows = df.where(F.col(label).isNotNull()).select(
        F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]).alias("x"), F.col(label).cast("double").alias("y"))
    # equal rows are told apart, so that a row that repeats is spread over the blocks
    row = F.xxhash64("x", "y", F.monotonically_increasing_id(), F.lit(seed))
    rows = rows.withColumn("_row", row).withColumn("block", F.pmod(F.col("_row"), F.lit(blocks)))
    # written, so that a row has the same place wherever it is read
    path = scratch_path(spark, "blocks", "network")
    rows.select("x", "y", "block", place(F.col("block"), F.col("_row")).cast("int").alias("place")).write.parquet(path)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1), np.asarray(batch.column(1))
                block = np.asarray(batch.column(2))
                starts = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
                ends = [*starts[1:], len(block)]
                yield pa.record_batch([pa.array(block[starts]), *(pa.array([v[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()) for v in (x, y))],
                                      names=["block", "x", "y"])

    kept = spark.read.schema("x array<double>, y double, block bigint, place int").parquet(path).repartitionById(places, F.col("place"))
    return kept.sortWithinPartitions("block").select("x", "y", "block").mapInArrow(pack, "block bigint, x binary, y binary")


def deal_blocks(df: DataFrame, features: Sequence[str], label: str, blocks: int, parts: int, seed: int) -> RDD:
    """The rows as (x, y) arrays, block b in the partitions b * parts to (b + 1) * parts - 1, kept by the executors.
    Rows without a label are left out."""
    packed = _dealt(df, features, label, blocks, lambda block, row: block * parts + F.pmod(F.xxhash64(row, F.lit(1)), F.lit(parts)), blocks * parts, seed)
    return packed.rdd.map(lambda r: (bytes(r[1]), bytes(r[2]))).persist(StorageLevel.MEMORY_AND_DISK)


def deal_shares(df: DataFrame, features: Sequence[str], label: str, blocks: int, per_share: int, seed: int) -> RDD:
    """The rows as (block, x, y), ``per_share`` blocks after one another in a partition, kept by the executors."""
    packed = _dealt(df, features, label, blocks, lambda block, _: F.floor(block / per_share), -(-blocks // per_share), seed)
    return packed.rdd.map(lambda r: (r[0], bytes(r[1]), bytes(r[2]))).persist(StorageLevel.MEMORY_AND_DISK)


def _gradients(rows: RDD, block: int, parts: int, nets: Sequence[tuple[int, np.ndarray]]) -> tuple[int, list[np.ndarray]]:
    """(rows, summed gradient of every network) of one block."""
    nets = list(nets)

    def partial(packs: Iterator[tuple[bytes, bytes]]) -> Iterator[tuple[int, list[np.ndarray]]]:
        sums, n = [np.zeros(len(flat)) for _, flat in nets], 0
        for x, y in packs:
            y = np.frombuffer(y)
            x = np.frombuffer(x).reshape(len(y), -1)
            for total, (h, flat) in zip(sums, nets):
                total += loss_and_gradient(flat, x, y, h)[1]
            n += len(y)
        if n:
            yield n, sums

    out = rows.context.runJob(rows, partial, range(block * parts, (block + 1) * parts))
    return sum(n for n, _ in out), [sum(g[k] for _, g in out) for k in range(len(nets))]


def _visits(every: RDD, per_share: int, learners: Sequence[Learner], at: Sequence[int], epoch: int) -> list[Learner]:
    """One job: every learner after its steps on the rows of its share, a task each. ``every`` has all shares once a learner."""
    sc, blocks = every.context, learners[0].blocks
    shares = -(-blocks // per_share)
    sent = sc.broadcast([pickle.dumps(one) for one in learners])  # a task unpacks its own

    def run(part: int, packs: Iterator[tuple[int, bytes, bytes]]) -> Iterator[Learner]:
        k, share = divmod(part, shares)
        learner = pickle.loads(sent.value[k])
        learner.visit(packs, share * per_share, min(blocks, (share + 1) * per_share), share, epoch)
        yield learner

    try:
        return sc.runJob(every.mapPartitionsWithIndex(run), iter, [k * shares + share for k, share in enumerate(at)])
    finally:
        sent.destroy()


def _by_shares(df: DataFrame, n: int, features: Sequence[str], label: str, learners: list[Learner], block: int, seed: int, epochs: int) -> list[Learner]:
    blocks, per_share = learners[0].blocks, max(1, SHARE // block)
    shares = -(-blocks // per_share)
    dealt = deal_shares(df, features, label, blocks, per_share, seed)
    # the same steps on the same rows: less work than a job is worth is done here
    here = dealt.collect() if shares == 1 and n * sum(one.hidden for one in learners) <= WORK else None
    every = df.sparkSession.sparkContext.union([dealt] * len(learners))
    for epoch in range(epochs):
        for at in zip(*[one.route(shares, epoch) for one in learners]):
            if here is None:
                learners = _visits(every, per_share, learners, [int(share) for share in at], epoch)
            else:
                for one in learners:
                    one.visit(here, 0, blocks, 0, epoch)
    dealt.unpersist()
    return learners


def _by_blocks(df: DataFrame, n: int, features: Sequence[str], label: str, learners: list[Learner], block: int, seed: int, epochs: int) -> list[Learner]:
    blocks = learners[0].blocks
    # a block is large: several tasks share it
    parts = min(PARTS, max(1, block * sum(one.hidden for one in learners) // WORK))
    dealt = deal_blocks(df, features, label, blocks, parts, seed)
    for epoch in range(epochs):
        for b in block_order(blocks, 0, epoch, seed):
            rows, gs = _gradients(dealt, int(b), parts, [(one.hidden, one.flat) for one in learners])
            for one, g in zip(learners, gs):
                one.add(rows, g)
    dealt.unpersist()
    return learners


def train_networks(df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Mapping], seed: int = 42,
                   epochs: int | None = None) -> list[Network]:
    """A network for each of the settings (``hidden``, ``lr``, ``batch``), all trained by the same jobs."""
    settings = [{**DEFAULTS, **s} for s in settings]
    n = df.where(F.col(label).isNotNull()).count()
    if not n:
        raise ValueError("no labelled row to train on")
    block = min(s["batch"] for s in settings)
    if block < 1:
        raise ValueError("a batch has one row at least")
    learners = [Learner(len(features), s, -(-n // block), block, seed) for s in settings]
    train = _by_shares if block <= SHARE else _by_blocks
    learners = train(df, n, features, label, learners, block, seed, epochs or settings[0]["epochs"])
    return [Network(tuple(features), one.hidden, one.flat) for one in learners]


def train_network(df: DataFrame, features: Sequence[str], label: str, cfg: Mapping | None = None, seed: int = 42) -> Network:
    """H5: one network."""
    return train_networks(df, features, label, [cfg or {}], seed, (cfg or {}).get("epochs"))[0]


def network_grid(grid: Mapping[str, Sequence] = GRID) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def network_scores(df: DataFrame, networks: Sequence[Network], label: str) -> DataFrame:
    """``setting, label, p`` for every labelled row and network, in one pass."""
    nets = [(n.hidden, n.flat) for n in networks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.asarray(batch.column(1))
            if len(y):
                x = np.asarray(batch.column(0).flatten()).reshape(len(y), -1)
                for k, (h, flat) in enumerate(nets):
                    yield pa.record_batch([pa.array(np.full(len(y), k, np.int32)), pa.array(y),
                                           pa.array(1 / (1 + np.exp(-logits(flat, x, h))))], names=["setting", "y", "p"])

    rows = df.where(F.col(label).isNotNull()).select(
        F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in networks[0].features]).alias("x"), F.col(label).cast("int").alias("y"))
    return rows.mapInArrow(run, "setting int, y int, p double")


def network_search(train: DataFrame, held_out: DataFrame, features: Sequence[str], label: str, grid: Mapping[str, Sequence] = GRID,
                   seed: int = 42, epochs: int | None = None) -> tuple[DataFrame, list[Network]]:
    """H5 search: (one row a setting with its metrics on the held-out rows and its rank by F1, the networks)."""
    from pyspark.sql import Window

    from churnlens.operators.metrics import binary_metrics, roc_auc
    from churnlens.session import materialize
    points = network_grid(grid)
    networks = train_networks(train, features, label, points, seed, epochs)
    scores = network_scores(held_out, networks, label).withColumn("h", (F.col("p") > 0.5).cast("int"))
    scores = materialize(scores, "network_scores")
    table = train.sparkSession.createDataFrame([(k, *(p[c] for c in ("hidden", "lr", "batch"))) for k, p in enumerate(points)],
                                               "setting int, hidden int, lr double, batch int")
    found = binary_metrics(scores, "y", "h", ["setting"]).join(roc_auc(scores, "y", "p", ["setting"]), "setting", "left")
    found = F.broadcast(table).join(found, "setting", "left")  # one row a setting
    rank = F.row_number().over(Window.orderBy(F.desc_nulls_last("f1"), "setting"))
    return found.withColumn("rank", rank), networks

"""Quality classifier: random-indexing word vectors, pooled, into a small calibrated network.

Random indexing gives every token a sparse random index vector (from its hash) and every
hashed word a context vector: the sum of the index vectors of its neighbours over
all documents. The context table has a fixed size; tasks add up their own, and Spark adds
the tasks' tables block by block.

A document is pooled into: the mean context vector and the mean index vector of its words, the
mean inner product of neighbouring words' index vectors (repetition shows as a positive one),
and the mean index vector of its character runs' shapes (letters, capitals, digits,
each punctuation run as itself). A two-layer numpy network turns that into a logit;
a temperature fitted on a fifth of the labelled sample that was not trained on calibrates it.

The network is fitted on at most MAX_LABELLED labelled rows (the smallest hashes of their ids);
everything else covers all rows and whole texts. Its inputs come from the text alone.

Defined results: null and empty texts have zero features and get the network's score for these;
labels that are null are not used, of repeated labels of an id the smallest counts; with
no labels, or one value only, every score is (ones + 1) / (labels + 2); repeated rows
score alike; an empty table stays empty; columns beside id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.batches import list_array, slices, small_batches, text_bytes
from skein.llm.hashing import mix, prefix_hash, range_hash, rows_of

DIM = 32  # of every vector
NONZERO = 4  # ones and minus ones of an index vector
BUCKETS = 4096  # hashed words of the context table
BLOCK = 128  # buckets of a block when tables are added up
SALTS = 64
MAX_LABELLED = 20_000
POOLED_ROWS = 512  # documents counted at once
HIDDEN, EPOCHS, RATE, DECAY = 24, 60, 0.01, 1e-4

_SPACE, _LOW, _CAPITAL, _DIGIT, _MARK = range(5)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[*range(97, 123), *range(128, 256)]] = _LOW
_CLASS[65:91] = _CAPITAL
_CLASS[48:58] = _DIGIT
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
#: bucket of a run of a class, by its length up to 6
_SHAPE = (mix(np.arange(1, 36, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64).reshape(5, 7)


@lru_cache(maxsize=1)
def index_table() -> np.ndarray:
    """Index vectors of BUCKETS hashed tokens."""
    rng = np.random.default_rng(29)
    table = np.zeros((BUCKETS, DIM), np.float32)
    for k in range(BUCKETS):
        table[k, rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return table


@lru_cache(maxsize=1)
def index_products() -> np.ndarray:
    """Inner products of all index vectors."""
    return (index_table() @ index_table().T).astype(np.int8)


def _bucket(code: np.ndarray) -> np.ndarray:
    return (code % np.uint64(BUCKETS)).astype(np.int64)


def tokens(data: np.ndarray, offs: np.ndarray):
    """(word buckets, their rows, shape buckets, their rows)."""
    kind = _CLASS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    prefix = prefix_hash(data)
    word = kind != _SPACE

    def runs(cut: np.ndarray):
        """Starts and ends of the runs of non-space between changes."""
        change = edge.copy()
        change[1:-1] |= cut
        return np.flatnonzero(word & change[:-1]), np.flatnonzero(word & change[1:]) + 1

    start, stop = runs(word[1:] != word[:-1])
    word_at, word_row = _bucket(range_hash(prefix, start, stop)), rows_of(start, offs)
    start, stop = runs(kind[1:] != kind[:-1])
    shape = _SHAPE[kind[start], np.minimum(stop - start, 6)]
    marks = np.flatnonzero(kind[start] == _MARK)  # a punctuation run counts as itself
    shape[marks] = _bucket(range_hash(prefix, start[marks], np.minimum(stop[marks], start[marks] + 6)))
    return word_at, word_row, shape, rows_of(start, offs)


def _mean(table: np.ndarray, at: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Mean vector of the table's lines ``at`` of each row, through counts."""
    count = np.bincount(row * BUCKETS + at, minlength=rows * BUCKETS).reshape(rows, BUCKETS).astype(np.float32)
    return (count @ table) / np.maximum(np.bincount(row, minlength=rows), 1)[:, None].astype(np.float32)


def _likeness(word: np.ndarray, row: np.ndarray, rows: int, lag: int) -> np.ndarray:
    """Mean inner product of the index vectors of words ``lag`` apart: 0 by chance, NONZERO for a repeated word."""
    pair = np.flatnonzero(row[lag:] == row[:-lag])
    total = np.bincount(row[pair], index_products()[word[pair], word[pair + lag]], rows)
    return (total / np.maximum(np.bincount(row[pair], minlength=rows), 1)).astype(np.float32)


def pooled(data: np.ndarray, offs: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Feature rows of a slice of texts."""
    rows = len(offs) - 1
    if rows > POOLED_ROWS:  # counts of a few rows at a time
        return np.concatenate([pooled(data[offs[a]:offs[min(a + POOLED_ROWS, rows)]], offs[a:a + POOLED_ROWS + 1] - offs[a], context)
                               for a in range(0, rows, POOLED_ROWS)])
    word, row, shape, shape_row = tokens(data, offs)
    long = np.log1p(np.bincount(row, minlength=rows)).astype(np.float32)
    return np.hstack([_mean(np.hstack([context, index_table()]), word, row, rows), _mean(index_table(), shape, shape_row, rows),
                      *(_likeness(word, row, rows, lag)[:, None] for lag in (1, 2)), long[:, None]])


def context_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of all hashed words, from all documents, scaled to length 1."""

    def run(batches):
        index = index_table()
        # neighbours are counted first, their vectors added once at the end
        follows = np.zeros(BUCKETS * BUCKETS, np.int32)
        for batch in batches:
            data, offs = text_bytes(batch.column(0))
            for a, b in slices(offs):
                word, row, _, _ = tokens(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                at = np.flatnonzero(row[1:] == row[:-1])
                np.add.at(follows, word[at] * BUCKETS + word[at + 1], 1)
        table = follows.reshape(BUCKETS, BUCKETS)
        blocks = np.zeros((BUCKETS, DIM))
        for a in range(0, BUCKETS, BLOCK):
            part = table[a:a + BLOCK].astype(np.float64)
            blocks[a:a + BLOCK] += part @ index
            blocks += part.T @ index[a:a + BLOCK]
        blocks = blocks.reshape(-1, BLOCK * DIM)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks)), pa.int32()), pa.array([x.tobytes() for x in blocks], pa.binary())],
                                         names=["block", "sums"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in t["sums"].to_pylist())
        return pa.table([t["block"].slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])

    kind = "block int, sums binary"
    parts = small_batches(docs).select(text).mapInArrow(run, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    # a row of each block from every task: added up in SALTS parts first, so that no task holds those of all tasks
    parts = parts.groupBy("block", "salt").applyInArrow(add, kind)
    got = parts.groupBy("block").applyInArrow(add, kind).collect()  # BUCKETS * DIM numbers
    table = np.zeros((BUCKETS // BLOCK, BLOCK * DIM))
    for r in got:
        table[r.block] = np.frombuffer(r.sums, np.float64)
    table = table.reshape(BUCKETS, DIM)
    return (table / np.maximum(np.sqrt((table * table).sum(1)), 1e-12)[:, None]).astype(np.float32)


@dataclass
class Network:
    """Two layers on standardised features; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x.astype(np.float64)) / self.temperature)


@dataclass
class Constant:
    """What is known without two kinds of labels."""

    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network | Constant:
    """Trains on four fifths, calibrates on the rest."""
    if len(np.unique(y)) < 2:
        return Constant((float(y.sum()) + 1) / (len(y) + 2))
    rng = np.random.default_rng(seed)
    x, y = x.astype(np.float64), y.astype(np.float64)
    order = rng.permutation(len(y))
    held, train = order[: len(y) // 5], order[len(y) // 5:]
    if len(np.unique(y[train])) < 2:
        train = order
    mean, scale = x[train].mean(0), x[train].std(0) + 1e-3
    z = (x - mean) / scale
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        mixed = rng.permutation(train)
        for a in range(0, len(mixed), 256):
            k = mixed[a:a + 256]
            h = np.tanh(z[k] @ p[0] + p[1])
            d = (_sigmoid(h @ p[2] + p[3][0]) - y[k]) / len(k)
            dh = d[:, None] * p[2] * (1 - h * h)
            grads = [z[k].T @ dh + DECAY * p[0], dh.sum(0), h.T @ d + DECAY * p[2], np.array([d.sum()])]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    check = held if len(held) else train
    logit, target = net.logit(x[check]), y[check]

    def loss(t: float) -> float:
        q = np.clip(_sigmoid(logit / t), 1e-9, 1 - 1e-9)
        return -float((target * np.log(q) + (1 - target) * np.log(1 - q)).mean())

    net.temperature = min(np.geomspace(0.25, 8, 60), key=loss)
    return net


def features(rows: DataFrame, context: np.ndarray) -> DataFrame:
    """(y, features) of (y, text)."""
    context_of = rows.sparkSession.sparkContext.broadcast(context)

    def run(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for a, b in slices(offs):
                f = pooled(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], context_of.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a),
                                                  list_array(f.ravel(), np.arange(b - a + 1) * f.shape[1], pa.float32())], names=["y", "features"])

    return rows.mapInArrow(run, "y int, features array<float>")


def train(docs: DataFrame, labels: DataFrame, usable: Column, context: np.ndarray, label: str = "quality", ident: str = "doc_id",
          text: str = "text") -> Network | Constant:
    """The network, from at most MAX_LABELLED rows of ``labels`` where ``usable`` holds."""
    known = labels.filter(F.col(label).isNotNull() & F.col(ident).isNotNull() & usable).groupBy(ident).agg(F.min(label).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64(ident), ident).limit(MAX_LABELLED)
    rows = docs.select(ident, text).join(F.broadcast(sample), ident)
    # of repeated ids the row with the smallest text hash, so that what is collected has at most MAX_LABELLED rows
    rows = rows.groupBy(ident).agg(F.first("y").alias("y"), F.min_by(text, F.xxhash64(text)).alias(text)).select("y", text)
    got = features(rows, context).orderBy("y", "features").collect()  # a defined order, for a defined result
    if not got:
        return Constant(0.5)
    return fit(np.array([r.features for r in got], np.float32), np.array([r.y for r in got]))


def score(docs: DataFrame, model: Network | Constant, context: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; all columns kept. A map over rows."""
    names = [c for c in docs.columns if c != out]
    at = names.index(text)
    sc = docs.sparkSession.sparkContext
    context_of, model_of = sc.broadcast(context), sc.broadcast(model)

    def run(batches):
        for batch in batches:
            data, offs = text_bytes(batch.column(at))
            got = [model_of.value.score(pooled(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], context_of.value)) for a, b in slices(offs)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())],
                                             names=[*names, out])

    schema = small_batches(docs).select(*names).schema
    return docs.select(*names).mapInArrow(run, schema.add(out, "double"))


def held_out(ident: str = "doc_id", fold: int = 1, folds: int = 3) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", out: str = "score") -> DataFrame:
    """``docs`` with a score: context vectors from all of ``docs``, the network from the labels outside the
    held-out fold."""
    context = context_table(docs, text)
    return score(docs, train(docs, labels, ~held_out(ident), context, ident=ident, text=text), context, text, out)

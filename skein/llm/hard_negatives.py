"""Hard negatives by lists that the members of an anchor cluster share (after MAXIMUS).

Anchors are clustered by direction (spherical k-means, fitted on at most ``FIT_ROWS`` anchors; every
anchor is then assigned). For a member u at most theta from its cluster's centre c, and a candidate v,
<u, v> <= |u| |v| cos(max(0, angle(v, c) - theta)): an upper bound, up to |u|, that all members share. Each
cluster's candidates are ordered by it once; every member walks that list with exact inner products until
the bound certifies that nothing better can follow:

* positives: the k-th best score found so far exceeds the bound;
* negatives of a positive: the k-th best accepted score exceeds the bound, or the lowest accepted score does.

A list is never laid out whole. One pass counts candidates per cluster and band of the bound (``BANDS`` bands, a
table of fixed size); then the list is walked in segments of bands, each ``GROW`` times as many candidates as the one
before, and a segment is shipped only to clusters with members that have not ended. Inside a segment
candidates are dealt by hash into cells of about ``CELL_ROWS`` rows and ``CELL_MEMBERS`` members, each
sorted by the bound and walked in blocks; a cell gives at most k rows for each question. Scores are sums of
products of whole numbers: by floating point where these are exact, else by Python's integers.

Copies: of equal vectors with equal labels only the k + 1 with the smallest ids can be among the first k of anything
(one of them may be the anchor itself), so the others leave the lists before any is built; this is exact.

Defined results: rows without an id or label, with a null or empty vector, or with null or non-finite components take no
part; rows of one id count as one record (the smallest vector, then label); vectors meet those of their own length only; zero
vectors take part with scores of 0; ties go to the smaller id; an empty table gives no rows; other columns are not
read. Scores beyond 64 bits fail on output with an overflow error.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import materialize

FIT_ROWS = 20_000  # anchors that the clustering is fitted on, the smallest id hashes
MEMBERS = 64  # anchors per cluster, about
MAX_CLUSTERS = 512
BANDS = 2_048  # bands of the bound per cluster
FIRST_ROWS = 2_048  # candidates of a cluster's first segment, about
GROW = 8
CELL_ROWS = 16_384
CELL_MEMBERS = 256
STEP_ROWS = 512  # candidates that are scored between two looks at the bound
_SLACK = 1e-9  # what rounding may take from an angular bound, relative


def usable(v: Column) -> Column:
    """Vectors that take part: some component, all finite."""
    return (F.coalesce(F.size(v), F.lit(0)) > 0) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers (rows of a x rows of b)."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    return np.array([[sum(int(x) * y for x, y in zip(row, other)) for other in whole] for row in a], dtype=object).reshape(len(a), len(b))


def unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(1))
    return x / np.maximum(length, 1e-300)[:, None]


def fit_centres(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Spherical k-means; centres of unit length."""
    x = unit(x)
    pick = np.random.default_rng(seed)
    centres = x[[int(pick.integers(len(x)))]]
    near = x @ centres[0]
    while len(centres) < k:  # far directions first
        far = np.maximum(1 - near, 0) ** 2
        if far.sum() <= 0:
            break
        centres = np.vstack([centres, x[int(pick.choice(len(x), p=far / far.sum()))]])
        near = np.maximum(near, x @ centres[-1])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        some = np.sqrt((sums * sums).sum(1)) > 1e-12
        centres = np.where(some[:, None], unit(sums), centres)
    return centres


def bounds(x: np.ndarray, centres: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Upper bound of <u, v> / |u| over all members u of each cluster, for each row v of x (rows x clusters)."""
    length = np.sqrt((x * x).sum(1))
    cos = np.clip((x @ centres.T) / np.maximum(length, 1e-300)[:, None], -1, 1)
    angle = np.maximum(np.arccos(cos) - theta[None, :] - 1e-7, 0)  # arccos loses half the digits near 1
    return np.where(length[:, None] > 0, length[:, None] * (np.cos(angle) + _SLACK), 0.0)


def band_of(bound: np.ndarray, top: float, bands: int) -> np.ndarray:
    """0 for the largest bounds up to bands - 1; monotone in the bound, which is within [-top, top]."""
    if top <= 0:
        return np.zeros(bound.shape, np.int64)
    return np.clip(((1 - bound / (top * (1 + 1e-6))) * (bands / 2)).astype(np.int64), 0, bands - 1)


def walk(members: list[dict], ids: np.ndarray, labels: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int, step: int = STEP_ROWS) -> list[tuple]:
    """The first k rows for each question of each member, from a list sorted by falling bound.

    A member has id, label, vector, length and questions: (positive id or None, lowest, highest, k-th score so far).
    Without a positive id the question is for rows of the member's label, else for those of other labels."""
    if not members or not len(ids):
        return []
    u = np.stack([m["vector"] for m in members])
    best: list[list[list]] = [[[] for _ in m["questions"]] for m in members]
    open_ = list(range(len(members)))
    for a in range(0, len(ids), step):
        going = []
        for i in open_:
            reach = members[i]["length"] * bound[a]
            reach += abs(reach) * _SLACK + 1e-6
            ask = []
            for j, (_, low, _, kth) in enumerate(members[i]["questions"]):
                heap = best[i][j]
                floor = max([s for s in (low, kth, heap[0][0] if len(heap) == k else None) if s is not None], default=None)
                if floor is None or reach >= floor:
                    ask.append((j, floor))
            if ask:
                going.append((i, ask))
        if not going:
            break
        open_ = [i for i, _ in going]
        part = slice(a, a + step)
        scores = products(u[open_], x[part])
        for row, (i, ask) in zip(scores, going):
            m = members[i]
            same = labels[part] == m["label"]
            other = ids[part] != m["id"]
            for j, floor in ask:
                positive, _, high, _ = m["questions"][j]
                take = (same & other) if positive is None else ~same
                if floor is not None:
                    take = take & (row >= floor)
                if high is not None:
                    take = take & (row <= high)
                heap = best[i][j]
                cand = np.flatnonzero(take)
                if len(cand) > 4 * k and row.dtype != object:
                    cand = cand[np.lexsort((ids[a + cand], -row[cand]))[:k]]
                for at in cand:
                    item = (row[at], -int(ids[a + at]))
                    if len(heap) < k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
    return [(m["id"], q[0], -n, int(s)) for m, heaps in zip(members, best) for q, heap in zip(m["questions"], heaps) for s, n in heap]


def prepare(df: DataFrame, k: int, vec_id: str, vector: str, label: str) -> DataFrame:
    """(id, label, x: whole numbers as doubles, dim) of the rows that take part, one per id."""
    scaled = lambda c: c.cast("double") * 256  # noqa: E731  beyond 2**53 every double is whole
    whole = F.transform(F.col("v"), lambda c: F.when(F.abs(c.cast("double")) < 2.0**44, F.floor(scaled(c)).cast("double")).otherwise(scaled(c)))
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"), F.col(label).cast("long").alias("label"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull()).filter(usable(F.col("v")))
    rows = rows.withColumn("x", whole)
    rows = rows.groupBy("id").agg(F.min(F.struct("x", "label")).alias("m"))
    return rows.select("id", F.col("m.label").alias("label"), F.col("m.x").alias("x"), F.size("m.x").alias("dim"))


def _cluster(anchors: DataFrame, n_anchors: int, dim: int):
    """(centres, clusters' theta, (id, cluster) of all anchors of this length)."""
    fit = anchors.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("x").toArrow()  # at most FIT_ROWS rows
    k = max(1, min(MAX_CLUSTERS, n_anchors // MEMBERS))
    centres = fit_centres(matrix(fit["x"], dim), k)
    sent = anchors.sparkSession.sparkContext.broadcast(centres)

    def assign(stream):
        for batch in stream:
            u = unit(matrix(batch.column(1), dim))
            cos = u @ sent.value.T
            own = cos.argmax(1)
            angle = np.arccos(np.clip(cos[np.arange(len(own)), own], -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32)), pa.array(angle)], names=["id", "cluster", "angle"])

    given = materialize(anchors.select("id", "x").mapInArrow(assign, "id long, cluster int, angle double"), "clusters")
    theta = np.zeros(len(centres))
    for r in given.groupBy("cluster").agg(F.max("angle").alias("a")).collect():  # at most MAX_CLUSTERS rows
        theta[r.cluster] = r.a
    return centres, theta, given.select("id", "cluster")


def _histogram(rows: DataFrame, centres: np.ndarray, theta: np.ndarray, dim: int) -> tuple[np.ndarray, float]:
    """(candidates per cluster and band, largest length): a table of fixed size, summed up by band."""
    spark = rows.sparkSession
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))
    top = rows.agg(F.max(length)).first()[0] or 0.0
    sent = spark.sparkContext.broadcast((centres, theta, top, BANDS))

    def count(stream):
        centres, theta, top, bands = sent.value
        seen = np.zeros(len(centres) * bands, np.int64)
        for batch in stream:
            band = band_of(bounds(matrix(batch.column(0), dim), centres, theta), top, bands)
            seen += np.bincount((band + np.arange(len(centres)) * bands).ravel(), minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["at", "n"])

    out = np.zeros(len(centres) * BANDS, np.int64)
    got = rows.select("x").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out[got["at"].to_numpy()] = got["n"].to_numpy()  # at most MAX_CLUSTERS * BANDS rows
    return out.reshape(len(centres), BANDS), top


def _segment(rows: DataFrame, state: DataFrame, centres, theta, top, spans: dict[int, tuple[int, int, int]], k: int, dim: int) -> DataFrame:
    """Walk one segment: spans is {cluster: (first band, end band, candidates)}. state: (cluster, id, label, x, questions).

    Gives (anchor, positive, id, score) of each cell's first k rows for each question."""
    spark = rows.sparkSession
    members = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    blocks = {r.cluster: -(-r.n // CELL_MEMBERS) for r in members.collect()}  # at most MAX_CLUSTERS rows
    plan = {c: (a, b, max(1, -(-n // CELL_ROWS)), blocks[c]) for c, (a, b, n) in spans.items() if c in blocks and n}
    sent = spark.sparkContext.broadcast((centres, theta, top, plan, BANDS))
    step = STEP_ROWS

    def ship(stream):
        centres, theta, top, plan, bands = sent.value
        names = ["cluster", "part", "block", "id", "label", "bound", "x"]
        use = np.array(sorted(plan), np.int64)
        for batch in stream:
            x = matrix(batch.column(2), dim)
            bound = bounds(x, centres[use], theta[use])
            band = band_of(bound, top, bands)
            ids = batch.column(0).to_numpy()
            lists = batch.column(2)
            for j, c in enumerate(use.tolist()):
                a, b, parts, n_blocks = plan[c]
                at = np.flatnonzero((band[:, j] >= a) & (band[:, j] < b))
                if not len(at):
                    continue
                part = (ids[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
                for block in range(n_blocks):
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), c, np.int32)), pa.array(part.astype(np.int32)), pa.array(np.full(len(at), block, np.int32)),
                        batch.column(0).take(take), batch.column(1).take(take), pa.array(bound[at, j]), lists.take(take)], names=names)

    shipped = rows.select("id", "label", "x").mapInArrow(ship, "cluster int, part int, block int, id long, label long, bound double, x array<double>")
    sizes = spark.createDataFrame([(int(c), int(p[2]), int(p[3])) for c, p in sorted(plan.items())] or [(-1, 1, 1)], "cluster int, parts int, blocks int")
    asked = state.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    asked = asked.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    asked = asked.select("cluster", "part", "block", "id", "label", "x", "questions")

    def cell(key, cands: pa.Table, asks: pa.Table) -> pa.Table:
        order = np.lexsort((cands["id"].to_numpy(), -cands["bound"].to_numpy())) if cands.num_rows else np.zeros(0, np.int64)
        got: list[tuple] = []
        if cands.num_rows and asks.num_rows:
            x = matrix(cands["x"], dim)[order]
            u = matrix(asks["x"], dim)
            members = [{"id": i, "label": lab, "vector": v, "length": float(np.sqrt((v * v).sum())),
                        "questions": [(q["positive"], q["low"], q["high"], q["kth"]) for q in qs]}
                       for i, lab, v, qs in zip(asks["id"].to_pylist(), asks["label"].to_pylist(), u, asks["questions"].to_pylist())]
            got = walk(members, cands["id"].to_numpy()[order], cands["label"].to_numpy()[order], x, cands["bound"].to_numpy()[order], k, step)
        cols = list(zip(*got)) or [(), (), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["anchor", "positive", "id", "score"])

    keys = ["cluster", "part", "block"]
    return shipped.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(cell, "anchor long, positive long, id long, score long")


def first_k(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each (anchor, positive), with their rank."""
    w = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


_ASK = "array<struct<positive:bigint,low:bigint,high:bigint,kth:bigint>>"


def _walked(rows: DataFrame, asked: DataFrame, centres, theta, counts: np.ndarray, top: float, k: int, dim: int) -> DataFrame:
    """Walk the shared lists segment by segment until every question of ``asked`` (cluster, id, label, x,
    anchor, positive, low, high) is certified; gives (anchor, positive, id, score, rank)."""
    spark = rows.sparkSession
    asked = materialize(asked.withColumn("kth", F.lit(None).cast("long")), "questions")
    found = None
    at = np.zeros(len(counts), np.int64)
    size = FIRST_ROWS
    sums = np.concatenate([np.zeros((len(counts), 1), np.int64), counts.cumsum(1)], axis=1)
    while True:
        live = {r.cluster for r in asked.select("cluster").distinct().collect()}  # at most MAX_CLUSTERS rows
        spans = {}
        for c in live:
            a = int(at[c])
            if sums[c, -1] > sums[c, a]:
                b = min(max(int(np.searchsorted(sums[c], sums[c, a] + size)), a + 1), BANDS)
                spans[c] = (a, b, int(sums[c, b] - sums[c, a]))
                at[c] = b
        if not spans:
            break
        state = asked.groupBy("cluster", "id", "label").agg(F.first("x").alias("x"), F.collect_list(F.struct("positive", "low", "high", "kth")).alias("questions"))
        state = state.filter(F.col("cluster").isin(list(spans)))
        got = _segment(rows, state, centres, theta, top, spans, k, dim)
        both = got if found is None else got.unionByName(found.drop("rank"))
        found = materialize(first_k(both, k), "found")
        if all(at[c] >= BANDS or sums[c, at[c]] == sums[c, -1] for c in live):
            break
        # the largest bound that the next segment can hold, per cluster
        ends = spark.createDataFrame([(int(c), float(top * (1 + 1e-6) * (1 - at[c] / (BANDS / 2)) + 1e-9), bool(sums[c, at[c]] == sums[c, -1])) for c in sorted(live)],
                                     "cluster int, bound double, over boolean")
        kth = found.filter(F.col("rank") == k).select(F.col("anchor").alias("id"), F.col("positive").alias("p"), F.col("score").alias("k2"))
        asked = asked.alias("q").join(kth.alias("f"), (F.col("q.id") == F.col("f.id")) & F.col("q.positive").eqNullSafe(F.col("f.p")), "left").select(
            "q.cluster", "q.id", "q.label", "q.x", "q.positive", "q.low", "q.high", F.col("k2").alias("kth"))
        reach = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c)) * F.col("bound")
        reach = reach + F.abs(reach) * _SLACK + 1e-6
        floor = F.greatest("low", "kth")  # null only if both are
        asked = asked.join(ends, "cluster").filter(~F.col("over") & (floor.isNull() | (reach >= floor))).drop("bound", "over")
        asked = materialize(asked, "questions")
        size *= GROW
    if found is None:
        return spark.createDataFrame([], "anchor long, positive long, id long, score long, rank int")
    return found


def mine_negatives(df: DataFrame, is_anchor: Column, k: int = 5, low: int = 80, high: int = 100, vec_id: str = "vec_id",
                   vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its first k other rows of the same label by inner product; the negatives of a positive are the first k rows
    of other labels with low * positive_score <= 100 * score <= high * positive_score. ``is_anchor`` is an expression over the id column."""
    rows = materialize(prepare(df, k, vec_id, vector, label), "vectors")
    flag = rows.withColumnRenamed("id", vec_id).filter(is_anchor).withColumnRenamed(vec_id, "id")
    out = None
    for dim, n in sorted((r.dim, r.n) for r in flag.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()):  # one row per vector length
        own = rows.filter(F.col("dim") == dim).select("id", "label", "x")
        anchors = materialize(flag.filter(F.col("dim") == dim).select("id", "label", "x"), "anchors")
        copies = Window.partitionBy("x", "label").orderBy("id")
        listed = materialize(own.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy"), "listed")
        centres, theta, given = _cluster(anchors, n, dim)
        counts, top = _histogram(listed, centres, theta, dim)
        asked = anchors.join(given, "id")
        null = F.lit(None).cast("long")
        positives = _walked(listed, asked.select("cluster", "id", "label", "x", null.alias("positive"), null.alias("low"), null.alias("high")),
                            centres, theta, counts, top, k, dim)
        ask = positives.select(F.col("anchor").alias("id"), F.col("id").alias("positive"), F.col("score").alias("s"))
        # the whole scores from ceil(low * s / 100) to floor(high * s / 100)
        lowest = F.expr(f"cast(ceil(cast({int(low)} as decimal(5,0)) * cast(s as decimal(19,0)) / cast(100 as decimal(3,0))) as long)")
        highest = F.expr(f"cast(floor(cast({int(high)} as decimal(5,0)) * cast(s as decimal(19,0)) / cast(100 as decimal(3,0))) as long)")
        ask = ask.select("id", "positive", "s", lowest.alias("low"), highest.alias("high")).filter("low <= high")
        ask = materialize(ask, "ask")
        questions = asked.join(ask, "id").select("cluster", "id", "label", "x", "positive", "low", "high")
        negatives = _walked(listed, questions, centres, theta, counts, top, k, dim)
        scores = ask.select(F.col("id").alias("anchor"), "positive", F.col("s").alias("positive_score"))
        one = negatives.join(scores, ["anchor", "positive"]).select(
            F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out

"""Approximate nearest neighbours by shifted Hilbert curves.

Every vector is projected to a few dimensions, several times with other axes and
another shift, and each projection is put into the order of a Hilbert curve.
Spark sorts each order by range partitioning; only keys and ids are sorted.  A
query meets the vectors within a fixed number of places around its own in every
order (the radius), as 8-bit codes; the best of all windows are merged and
reranked by the exact inner products of the original vectors.

The axes lie in the leading principal directions of a bounded sample, and cells
are quantiles of that sample.  The radius is measured: a bounded sample of
queries is answered exactly, and the radius is the distance on the curves within
which the wanted share of their true neighbours lies.  It does not follow from
the size of the table, but vectors without any structure need a large one.

Largest inner product is turned into nearness on a sphere by one more coordinate
that brings every vector to the largest length.  Equal vectors are one point of
the index, so a very common vector does not fill the windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import staged

CURVES = 12
AXES = 12
BITS = 5
RECALL = 0.92           # share of true neighbours that the radius must reach
MIN_RADIUS = 256
TOP = 20
SLACK = 12              # points kept beyond the top before the exact scores
FIT_VALUES = 2_000_000  # components of the sample that axes and cells are fitted on
VARIANCE = 0.8          # share of the variance in the leading directions
KNOTS = 256             # quantiles an axis is scaled by
MEASURED = 256          # queries that the radius is measured on
RUN = 8                 # places of a run of a curve, in radii
PART_ROWS = 65_536      # points met by one group
PAIRS = 4_000_000       # scores held at once
SALTS = 32
SEED = 31


@dataclass(frozen=True)
class Frame:
    """One curve: its axes, where their quantiles lie, and its shift."""

    centre: np.ndarray
    axes: np.ndarray
    knots: np.ndarray
    shift: np.ndarray


def fit_frames(
    sample: np.ndarray, curves: int, axes: int, seed: int, variance: float = VARIANCE
) -> list[Frame]:
    """Curves for vectors like those of ``sample``.

    Axes are a random rotation of the fewest principal directions that hold
    ``variance``, at least ``axes`` of them; each curve has its own rotation.
    """
    centre = sample.mean(axis=0)
    moved = sample - centre
    spread, directions = np.linalg.eigh(moved.T @ moved / len(moved))
    spread, directions = np.maximum(spread[::-1], 0), directions[:, ::-1]
    held = np.cumsum(spread) / max(spread.sum(), np.finfo(float).tiny)
    lead = min(max(int(np.searchsorted(held, variance)) + 1, axes), sample.shape[1])
    rng = np.random.default_rng(seed)
    frames = []
    for _ in range(curves):
        turn = np.linalg.qr(rng.normal(size=(lead, lead)))[0][:, : min(axes, lead)]
        chosen = directions[:, :lead] @ turn
        knots = np.quantile(moved @ chosen, np.linspace(0, 1, KNOTS + 1), axis=0)
        frames.append(Frame(centre, chosen, knots, rng.uniform(0, 0.5, chosen.shape[1])))
    return frames


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer cells ``(n, axes)`` on the Hilbert curve, as one integer.

    The curve is walked from the coarsest bit to the finest: the bits of a cell
    at one level, in Gray code order, pick the next sub-cube, and the frame is
    turned for the levels below.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(axes):
            inside = (x[i] & bit) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[axes - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(vectors: np.ndarray, frame: Frame, bits: int) -> np.ndarray:
    """Hilbert key of every vector on one curve."""
    at = (vectors - frame.centre) @ frame.axes
    steps = np.linspace(0, 1, KNOTS + 1)
    unit = np.stack([np.interp(at[:, i], frame.knots[:, i], steps) for i in range(at.shape[1])], axis=1)
    cells = ((unit / 2 + frame.shift) * (1 << bits)).astype(np.int64)
    return hilbert_keys(np.clip(cells, 0, (1 << bits) - 1), bits)


def lifted(x: np.ndarray, asks: np.ndarray, length: float) -> np.ndarray:
    """Vectors on the sphere of the largest length; a query has a direction only."""
    norm = np.sqrt((x * x).sum(1))
    rise = np.sqrt(np.maximum(length**2 - norm**2, 0))
    x = np.where(asks[:, None], x * (length / norm)[:, None], x)
    return np.concatenate([x, np.where(asks, 0, rise)[:, None]], axis=1)


def eight_bit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components as integers of -127 to 127 and the step of each vector."""
    step = np.abs(x).max(axis=1) / 127
    return np.rint(x / step[:, None]).astype(np.int8), step


def usable(vector: str):
    """Neither null nor zero, all components present and finite."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dimension)


def distinct_points(rows: DataFrame, keep: int) -> DataFrame:
    """``point_id, vector, ids``: equal vectors once, with their ``keep`` smallest ids.

    ``rows`` hold an id once.  No search of ``keep - 1`` neighbours can return a copy beyond those: each of
    them is as near and has a smaller id.  Copies are thinned per salt first.
    """
    hashed = rows.withColumns(
        {
            "h": F.xxhash64("vector"),
            "g": F.xxhash64(F.lit(1), "vector"),
            "salt": F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)),
        }
    )
    light = hashed.select("h", "g", "salt", "vec_id")
    first = Window.partitionBy("h", "g", "salt").orderBy("vec_id")
    thinned = light.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= keep)
    second = Window.partitionBy("h", "g").orderBy("vec_id")
    kept = thinned.withColumn("r", F.row_number().over(second)).filter(F.col("r") <= keep)
    grouped = kept.groupBy("h", "g").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = grouped.withColumn("point_id", F.element_at("ids", 1)).select("point_id", "ids")
    return points.join(rows.withColumnRenamed("vec_id", "point_id"), "point_id")


def best_of(scores: np.ndarray, keep: int) -> np.ndarray:
    """Columns of the ``keep`` largest scores of every row, in no order."""
    if scores.shape[1] <= keep:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.argpartition(-scores, keep - 1, axis=1)[:, :keep]


def true_neighbours(points: DataFrame, queries: DataFrame, dimension: int, top: int, measured: int) -> DataFrame:
    """``query_id, point_id``: the nearest points of at most ``measured`` queries, by all products.

    The sample is the queries whose ids have the smallest hashes.  It is handed to
    every task; a task returns its own best only.
    """
    rows = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(measured).collect()
    asking = np.array([r["vec_id"] for r in rows], np.int64)
    asked = np.array([r["vector"] for r in rows], np.float64).reshape(len(rows), dimension)

    def score(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("point_id").to_numpy()
            products = asked @ matrix(batch.column("vector"), dimension).T
            alone = batch.column("copies").to_numpy() == 1
            products[(asking[:, None] == ids[None, :]) & alone] = -np.inf
            ids = np.broadcast_to(ids, products.shape)
            if kept is not None:
                products = np.concatenate([kept[0], products], axis=1)
                ids = np.concatenate([kept[1], ids], axis=1)
            best = best_of(products, top)
            kept = np.take_along_axis(products, best, 1), np.take_along_axis(ids, best, 1)
        if kept is not None:
            there = np.isfinite(kept[0]).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(asking, kept[0].shape[1])[there]), pa.array(kept[1].ravel()[there]),
                 pa.array(kept[0].ravel()[there])],
                names=["query_id", "point_id", "score"],
            )

    found = points.select("point_id", "vector", F.size("ids").alias("copies")).mapInArrow(
        score, "query_id long, point_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "point_id")
    return (
        found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top)
        .select("query_id", "point_id")
    )


def measured_radius(places: DataFrame, truth: DataFrame, recall: float, least: int) -> int:
    """Distance on the nearest curve within which ``recall`` of the pairs of ``truth`` lie.

    ``truth`` is bounded (MEASURED queries, TOP points each), so it is broadcast and
    its distances are collected.
    """
    truth = F.broadcast(truth)
    asked = places.filter("asks").join(
        F.broadcast(truth.select("query_id").distinct()), F.col("id") == F.col("query_id")
    ).select("query_id", "curve", F.col("place").alias("q_place"))
    held = places.filter("not asks").join(truth, F.col("id") == F.col("point_id")).select(
        "query_id", "point_id", "curve", "place"
    )
    apart = held.join(asked, ["query_id", "curve"]).groupBy("query_id", "point_id").agg(
        F.min(F.abs(F.col("place") - F.col("q_place"))).alias("apart")
    )
    distances = np.sort([r["apart"] for r in apart.select("apart").collect()])
    if not len(distances):
        return least
    wanted = min(int(np.ceil(recall * len(distances))), len(distances))
    return max(least, int(distances[max(wanted, 1) - 1]))


@dataclass(frozen=True)
class CurveIndex:
    """Places of all points and queries on all curves, and the radius to search."""

    points: DataFrame     # point_id, ids, vector
    queries: DataFrame    # vec_id, vector
    coded: DataFrame      # id, asks, code, step, keys
    places: DataFrame     # id, asks, curve, place
    total: int            # places of a curve
    asked: int            # queries
    curves: int
    radius: int
    dimension: int
    top: int

    def scored_share(self) -> float:
        """Products within the windows, as a share of all pairs of query and place."""
        return min(2 * self.radius + 1, self.total) * self.curves / self.total


def build_index(
    embeddings: DataFrame,
    is_query,
    top: int = TOP,
    curves: int = CURVES,
    axes: int = AXES,
    bits: int = BITS,
    recall: float = RECALL,
    min_radius: int = MIN_RADIUS,
    measured: int = MEASURED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = SEED,
) -> CurveIndex | None:
    """Orders of all vectors and queries and the measured radius; None without vectors or queries.

    Axes and cells are fitted on at most FIT_VALUES components, of the points whose
    ids have the smallest hashes.  See ``nearest_neighbours`` for the rows taken.
    """
    source = (
        embeddings.select(
            F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")
        )
        .filter(F.col("vec_id").isNotNull() & usable("vector"))
    )
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = (
        source.groupBy(F.size("vector").alias("dimension"))
        .agg(F.count("*").alias("n"), F.max(square).alias("square"))
        .orderBy(F.desc("n"), F.desc("dimension")).first()
    )
    if facts is None:
        return None
    dimension, length = facts["dimension"], float(np.sqrt(facts["square"]))
    rows = source.filter(F.size("vector") == dimension).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = staged(rows, "vectors")
    points = staged(distinct_points(rows, top + 1), "points")
    queries = rows.filter(is_query(F.col("vec_id")))
    asked = queries.count()
    if not asked:
        return None
    sample = (
        points.orderBy(F.xxhash64("point_id"), "point_id").limit(max(1, FIT_VALUES // dimension))
        .select("vector").toArrow().column("vector").combine_chunks()
    )
    sample = matrix(sample, dimension)
    frames = fit_frames(lifted(sample, np.zeros(len(sample), bool), length), curves, axes, seed)
    everyone = points.select(
        F.col("point_id").alias("id"), F.lit(False).alias("asks"), "vector"
    ).unionByName(queries.select(F.col("vec_id").alias("id"), F.lit(True).alias("asks"), "vector"))

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("vector"), dimension)
            on_sphere = lifted(x, batch.column("asks").to_numpy(zero_copy_only=False), length)
            keys = np.stack([curve_keys(on_sphere, frame, bits) for frame in frames], axis=1)
            codes, steps = eight_bit(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("asks"),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(steps),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(frames)), pa.array(keys.ravel())
                 )],
                names=["id", "asks", "code", "step", "keys"],
            )

    coded = staged(
        everyone.mapInArrow(encode, "id long, asks boolean, code binary, step double, keys array<long>"), "codes"
    )
    order = ["curve", "key", "id", "asks"]
    placed = coded.select("id", "asks", F.posexplode("keys").alias("curve", "key"))
    in_order = staged(
        placed.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "id", "asks", "curve",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at"),
        ),
        "orders",
    )
    # one row per curve and partition: where it begins in the curve
    lengths = in_order.groupBy("curve", "part").agg(
        F.count("*").alias("n"), F.min("at").alias("first_at")
    )
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lengths.select(
        "curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_at")).alias("offset")
    )
    places = in_order.join(F.broadcast(offsets), ["curve", "part"]).select(
        "id", "asks", "curve", (F.col("offset") + F.col("at")).alias("place")
    )
    truth = staged(true_neighbours(points, queries, dimension, top, measured), "truth")
    radius = measured_radius(places, truth, recall, min_radius)
    total = in_order.filter("curve = 0").count()
    return CurveIndex(points, queries, coded, places, total, asked, curves, radius, dimension, top)


def window_hits(index: CurveIndex) -> DataFrame:
    """``query_id, point_id, score``: the best of every window, by the codes.

    A curve is cut into runs of RUN radii.  Points within a radius of a run belong
    to it too, so every query is answered in its own run; the points of a run are
    dealt into parts of at most about PART_ROWS.
    """
    radius, dimension, keep = index.radius, index.dimension, index.top + SLACK
    run = RUN * radius
    parts = -(-(run + 2 * radius) // PART_ROWS)
    shares = max(1, -(-run * index.asked // (index.total * PART_ROWS)))
    first = F.greatest(F.floor((F.col("place") - radius) / run), F.lit(0))
    final = F.least(F.floor((F.col("place") + radius) / run), F.lit((index.total - 1) // run))
    met = index.places.select(
        "id", "asks", "curve", "place",
        F.explode(
            F.when(F.col("asks"), F.array(F.floor(F.col("place") / run))).otherwise(F.sequence(first, final))
        ).alias("run"),
    )
    on = met.groupBy("id", "asks").agg(F.collect_list(F.struct("curve", "place", "run")).alias("at"))
    carried = index.coded.select("id", "asks", "code", "step").join(on, ["id", "asks"]).select(
        "id", "asks", "code", "step", F.inline("at")
    )
    by_place = F.pmod("place", F.lit(parts)).cast("int")
    by_share = F.pmod("place", F.lit(shares)).cast("int")
    everything = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    groups = carried.select(
        "*", F.explode(F.when(F.col("asks"), everything(parts)).otherwise(F.array(by_place))).alias("part")
    ).select(
        "*", F.explode(F.when(F.col("asks"), F.array(by_share)).otherwise(everything(shares))).alias("share")
    )

    def unpacked(rows: pa.Table):
        place = rows.column("place").to_numpy()
        order = np.argsort(place, kind="stable")
        flat = b"".join(rows.column("code").to_pylist())
        codes = np.frombuffer(flat, np.int8).reshape(-1, dimension)[order].astype(np.float32)
        return place[order], rows.column("id").to_numpy()[order], codes, rows.column("step").to_numpy()[order]

    def meet(rows: pa.Table) -> pa.Table:
        asks = rows.column("asks").to_numpy()
        q_place, q_ids, q, q_step = unpacked(rows.filter(pa.array(asks)))
        place, ids, x, step = unpacked(rows.filter(pa.array(~asks)))
        found = []
        at = 0
        while at < len(q_ids) and len(ids):
            # queries that stand close together share their window
            low = np.searchsorted(place, q_place[at] - radius)
            end = min(np.searchsorted(q_place, q_place[at] + radius // 4, side="right"), len(q_ids))
            end = max(at + 1, min(end, at + PAIRS // (3 * radius)))
            high = np.searchsorted(place, q_place[end - 1] + radius, side="right")
            if high > low:
                scores = (q[at:end] @ x[low:high].T) * step[None, low:high] * q_step[at:end, None]
                best = best_of(scores, keep)
                found.append(
                    (np.repeat(q_ids[at:end], best.shape[1]), ids[low:high][best].ravel(),
                     np.take_along_axis(scores, best, 1).ravel())
                )
            at = end
        types = {"query_id": np.int64, "point_id": np.int64, "score": np.float64}
        return pa.table(
            {n: np.concatenate([np.empty(0, t)] + [f[i] for f in found]) for i, (n, t) in enumerate(types.items())}
        )

    return groups.groupBy("curve", "run", "part", "share").applyInArrow(
        meet, "query_id long, point_id long, score double"
    )


def search_index(index: CurveIndex) -> DataFrame:
    """``query_id, rank, vec_id, score``: windows merged, best points reranked exactly."""
    # the same point from several windows has the same score
    merged = window_hits(index).groupBy("query_id", "point_id").agg(F.max("score").alias("score"))
    best_points = Window.partitionBy("query_id").orderBy(F.desc("score"), "point_id")
    few = (
        merged.withColumn("r", F.row_number().over(best_points))
        .filter(F.col("r") <= index.top + SLACK).select("query_id", "point_id")
    )
    double = "array<double>"
    products = F.zip_with(
        F.col("q_vector").cast(double), F.col("vector").cast(double), lambda a, b: a * b
    )
    asked = index.queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q_vector"))
    listed = few.join(asked, "query_id").join(index.points, "point_id").select(
        "query_id", F.explode("ids").alias("vec_id"),
        F.aggregate(products, F.lit(0.0), lambda total, x: total + x).alias("score"),
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        listed.filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= index.top)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_neighbours(embeddings: DataFrame, is_query, **options) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest vectors found.

    ``is_query`` is a condition on ``vec_id``; all rows are candidates, a query's
    own row excepted.  ``score`` is the inner product of the original vectors in
    double precision, summed from the first component to the last; ties go to the
    smaller id.  ``options`` are those of ``build_index``.

    Vectors that are null, zero or hold null or non-finite components take no part,
    nor do null ids, nor vectors of another length than the most frequent one (of
    equally frequent lengths, the largest).  Of rows with one id and several
    vectors the smallest vector counts.  An empty table gives no rows, other
    columns are not read.
    """
    index = build_index(embeddings, is_query, **options)
    if index is None:
        return embeddings.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double"
        )
    return search_index(index)

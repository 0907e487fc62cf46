"""Many K-means models fitted by the same scans, and silhouettes on a sample.

A table of points has ``z`` (array of doubles) and ``draw`` (long, what random choices of a row hang on).
Centres travel to the tasks and sums per centre come back, so what passes the driver has the size of
the models. Repeated points count each.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.frames import top_per_group

_BLOCK = 4096  # points that are compared with all centres at once
_EPSILON = 1e-12

Models = Mapping[tuple[int, int], np.ndarray]  # (k, restart) to centres, one in a row


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres; what rounding alone may leave is 0."""
    own = (x * x).sum(axis=1)[:, None]
    far = own - 2.0 * x @ centres.T + (centres * centres).sum(axis=1)
    far[far < _EPSILON * (1.0 + own)] = 0.0
    return far


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    for batch in batches:
        for low in range(0, batch.num_rows, _BLOCK):
            piece = batch.slice(low, _BLOCK)
            values = piece.column("z").flatten().to_numpy(zero_copy_only=False)
            yield values.reshape(piece.num_rows, width), piece


def _lists(values: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), pa.float64()))


def drawn(
    points: DataFrame, chosen: Sequence[np.ndarray], n: int, seed: int, turn: int, width: int
) -> list[np.ndarray]:
    """n points per restart, without replacement, weighted by the squared distance to the restart's chosen ones.

    Every point runs an exponential race of that rate, so the n first ones are the draw and no total is
    needed. Without chosen points all weigh the same.
    """
    chances = F.array(*[F.xxhash64("draw", F.lit(seed + r), F.lit(turn)) for r in range(len(chosen))])

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = [(np.empty(0), np.empty((0, width))) for _ in chosen]
        for x, piece in _blocks(batches, width):
            hashes = piece.column("u").flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            uniform = ((hashes.view(np.uint64) >> np.uint64(11)) + 0.5) / 2.0**53
            for r, centres in enumerate(chosen):
                rate = squared_distances(x, centres).min(axis=1) if len(centres) else np.ones(len(x))
                runs = rate > 0
                time = np.concatenate((first[r][0], -np.log(uniform[runs, r]) / rate[runs]))
                rows = np.concatenate((first[r][1], x[runs]))
                best = np.argsort(time, kind="stable")[:n]
                first[r] = time[best], rows[best]
        for r, (time, rows) in enumerate(first):
            if len(time):
                columns = [pa.array(np.full(len(time), r, np.int32)), pa.array(time), _lists(rows)]
                yield pa.RecordBatch.from_arrays(columns, names=["restart", "time", "z"])

    found = points.select("z", chances.alias("u")).mapInArrow(race, "restart int, time double, z array<double>")
    # n rows per restart
    rows = top_per_group(found, ["restart"], [F.col("time"), F.col("z")], n).collect()
    out = [np.array([x["z"] for x in rows if x["restart"] == r], float) for r in range(len(chosen))]
    return [x.reshape(-1, width) for x in out]


def _totals(points: DataFrame, centres: Sequence[np.ndarray], width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(points, cost, sums) per centre of every model, in one scan."""
    all_centres = np.concatenate(centres)
    ends = np.cumsum([0, *map(len, centres)])
    spans = list(zip(ends[:-1], ends[1:]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, cost = np.zeros(len(all_centres)), np.zeros(len(all_centres))
        sums = np.zeros((len(all_centres), width))
        for x, _ in _blocks(batches, width):
            far = squared_distances(x, all_centres)
            for low, high in spans:
                own = far[:, low:high]
                label = own.argmin(axis=1)
                count[low:high] += np.bincount(label, minlength=high - low)
                cost[low:high] += np.bincount(label, own.min(axis=1), high - low)
                belongs = np.zeros_like(own)
                belongs[np.arange(len(x)), label] = 1.0
                sums[low:high] += belongs.T @ x
        used = np.flatnonzero(count)
        columns = [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(cost[used]), _lists(sums[used])]
        yield pa.RecordBatch.from_arrays(columns, names=["centre", "n", "cost", "sums"])

    found = points.select("z").mapInArrow(summed, "centre int, n double, cost double, sums array<double>")
    totals = found.groupBy("centre").agg(
        F.sum("n").alias("n"),
        F.sum("cost").alias("cost"),
        F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"),
    )
    count, cost = np.zeros(len(all_centres)), np.zeros(len(all_centres))
    sums = np.zeros((len(all_centres), width))
    for row in totals.collect():  # one row per centre
        count[row["centre"]], cost[row["centre"]], sums[row["centre"]] = row["n"], row["cost"], row["sums"]
    return [(count[low:high], cost[low:high], sums[low:high]) for low, high in spans]


def spread_out(candidates: np.ndarray, weights: np.ndarray, k: int, dice: np.random.Generator) -> np.ndarray:
    """k of the weighted candidates, each next one drawn by its squared distance to those before; fewer if no other is left."""
    picked, near = [], np.ones(len(candidates))
    while len(picked) < k and (weights * near).sum() > 0:
        chance = weights * near
        picked.append(int(dice.choice(len(candidates), p=chance / chance.sum())))
        near = squared_distances(candidates, candidates[picked]).min(axis=1)
    return candidates[picked]


def starting_centres(
    points: DataFrame, ks: Sequence[int], restarts: int, seed: int, width: int, rounds: int = 5
) -> dict[tuple[int, int], np.ndarray]:
    """Centres to start all models from: oversampled candidates per restart, weighed by the points nearest to them.

    Each of the ``rounds`` scans draws twice the largest k for every restart, one more scan weighs
    them. A model has fewer centres than its k if there are fewer distinct points.
    """
    chosen = drawn(points, [np.empty((0, width))] * restarts, 1, seed, 0, width)
    for turn in range(1, rounds + 1):
        more = drawn(points, chosen, 2 * max(ks), seed, turn, width)
        chosen = [np.concatenate(both) for both in zip(chosen, more)]
    if not len(chosen[0]):
        return {}
    weights = [count for count, _, _ in _totals(points, chosen, width)]
    return {
        (k, r): spread_out(chosen[r], weights[r], k, np.random.default_rng((seed + r, k)))
        for k in ks
        for r in range(restarts)
    }


def fitted(
    points: DataFrame, starts: Models, width: int, max_iter: int = 300, tolerance: float = 1e-4
) -> tuple[dict[tuple[int, int], np.ndarray], dict[tuple[int, int], float], int]:
    """(centres, cost, scans) of all models; a scan serves every model that still moves.

    A model stops when the squared steps of its centres sum to ``tolerance`` at most. A centre without
    points stays where it is. Costs are those of the last scan's assignment.
    """
    centres, costs, moving, scans = dict(starts), {}, list(starts), 0
    while moving and scans < max_iter:
        scans += 1
        still = []
        for model, (count, cost, sums) in zip(moving, _totals(points, [centres[m] for m in moving], width)):
            new = np.where(count[:, None] > 0, sums / np.maximum(count, 1.0)[:, None], centres[model])
            if ((new - centres[model]) ** 2).sum() > tolerance:
                still.append(model)
            centres[model], costs[model] = new, float(cost.sum())
        moving = still
    return centres, costs, scans


def silhouettes(
    spark: SparkSession, sample: np.ndarray, models: Mapping[int, np.ndarray], rows_per_task: int = 256
) -> dict[int, float]:
    """Mean Euclidean silhouette of the sample per model; without those that have all of it in one cluster.

    The sample travels to the tasks, each of which compares some of it with all of it.
    """
    labels = {k: squared_distances(sample, c).argmin(axis=1) for k, c in models.items()}
    labels = {k: label for k, label in labels.items() if len(np.unique(label)) > 1}
    if not labels:
        return {}

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column("id").to_numpy()
            for low in range(0, len(all_ids), rows_per_task):
                ids = all_ids[low : low + rows_per_task]
                far = np.sqrt(np.maximum(squared_distances(sample[ids], sample), 0.0))
                far[np.arange(len(ids)), ids] = 0.0
                sums = [_widths(far, label, ids).sum() for label in labels.values()]
                columns = [pa.array(list(labels), pa.int32()), pa.array(sums, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "s"])

    tasks = max(1, -(-len(sample) // rows_per_task))
    found = spark.range(0, len(sample), 1, tasks).mapInArrow(compared, "k int, s double")
    return {r["k"]: r["s"] / len(sample) for r in found.groupBy("k").agg(F.sum("s").alias("s")).collect()}


def _widths(far: np.ndarray, label: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Silhouettes of the points ``ids`` from their distances to all; 0 for a point alone in its cluster."""
    belongs = np.zeros((len(label), label.max() + 1))
    belongs[np.arange(len(label)), label] = 1.0
    sizes, rows = belongs.sum(axis=0), np.arange(len(ids))
    sums, own = far @ belongs, label[ids]
    inside = sums[rows, own] / np.maximum(sizes[own] - 1.0, 1.0)
    means = np.where(sizes > 0, sums / np.maximum(sizes, 1.0), np.inf)
    means[rows, own] = np.inf
    outside = means.min(axis=1)
    largest = np.maximum(inside, outside)
    return np.where((sizes[own] > 1) & (largest > 0), (outside - inside) / np.where(largest > 0, largest, 1.0), 0.0)

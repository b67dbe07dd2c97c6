"""Centroid clustering by equal-average equal-variance search (operator 12).

Vectors become integers, floor(64 * x). Centroids are sorted by component sum. A vector starts at the centroid whose sum is
nearest to its own and scans outward on both sides; with S the sum, V the length of the rest beyond the mean, and k
components, a centroid's squared distance is at least (S - S')^2 / k + (V - V')^2. The first term ends a side's scan, both
together reject a centroid, and what remains is measured in exact integers. The bounds are floating-point, with a margin
for their rounding; distances, sums and floors are integers.

Each round every task searches its own batches and sends one row a centroid (count and component sums); those are added up
exactly as decimals, and only centroids (a stated number of rows, whatever the table) pass the driver.

Defined results: vectors of another length, or with a null, NaN or infinite component, are left out, as null vectors are;
repeated rows count each time, and as starting centroids too (equal hashes are ordered by the vector); a null id is
clustered but never a starting centroid; fewer vectors than centroids give fewer centroids; an empty table gives no row;
columns beside those named are left out. A component beyond 2^27 after scaling ends in an error: its distance may not fit a
long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import staged

#: Components beyond this do not fit: 64 squares of differences must stay below 2^63.
LARGEST = 2**27
#: Vectors that a task searches at once.
BATCH = 8192
PACKED = "vec_id long, vector binary"
ASSIGNED = "vec_id long, cluster int, distance long"
SUMS = "cluster int, n long, sums array<long>"


def integer_vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are kept, and their components as integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (lengths == dims)
    values = column.values
    usable = values.is_valid().to_numpy(zero_copy_only=False)
    numbers = np.where(usable, values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False), np.nan)
    starts = column.offsets.to_numpy()[:-1][valid] if len(column) else np.zeros(0, np.int64)
    rows = numbers[starts[:, None] + np.arange(dims)[None, :]] if len(starts) else np.zeros((0, dims))
    finite = np.isfinite(rows).all(axis=1)
    valid[np.flatnonzero(valid)[~finite]] = False
    made = np.floor(rows[finite] * scale)
    if len(made) and np.abs(made).max() > LARGEST:
        raise OverflowError(f"a component beyond {LARGEST} after scaling")
    return valid, made.astype(np.int32)


def kept_vectors(table: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """``vec_id`` and the integers of each kept vector (32-bit, little-endian), written once."""

    def run(batches):
        for batch in batches:
            valid, made = integer_vectors(batch.column(1), dims, scale)
            vectors = pa.Array.from_buffers(pa.binary(4 * dims), len(made), [None, pa.py_buffer(made.astype("<i4").tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(valid)), vectors], names=["vec_id", "vector"])

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return staged(rows.mapInArrow(run, PACKED), "vectors")


def starting_centroids(vectors: DataFrame, count: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``1:<vec_id>``: one bounded top-k, no sort of all."""
    first = vectors.where("vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "vector")
    rows = first.orderBy("h", "vector").limit(count).collect()
    return np.array([np.frombuffer(r["vector"], "<i4") for r in rows], np.int64)


def _spread(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Component sums, the length of what is left of each row without its mean, and how far rounding may put that off."""
    sums, k = rows.sum(axis=1, dtype=np.int64), max(1, rows.shape[1])
    squares = (rows.astype(np.float64) ** 2).sum(axis=1)
    return sums, np.sqrt(np.maximum(0.0, squares - sums.astype(np.float64) ** 2 / k)), 1e-3 + 1e-6 * np.sqrt(squares)


class Search:
    """Nearest centroids; ties go to the smaller number."""

    def __init__(self, centroids: np.ndarray):
        self.order = np.argsort(centroids.sum(axis=1), kind="stable")
        self.centroids = centroids[self.order]
        self.sums, self.rest, self.margin = _spread(self.centroids)
        self.measured = 0

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row.

        All rows step outward together: in step j each takes its next centroid on either side, unless that side has ended.
        """
        n, k, count = len(rows), rows.shape[1], len(self.order)
        sums, rest, margin = _spread(rows)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, count, np.int64)
        for _ in range(count):
            active = False
            for side, step in ((right, 1), (left, -1)):
                going = np.flatnonzero((side >= 0) & (side < count))
                if not len(going):
                    continue
                active = True
                at = side[going]
                limit = best[going].astype(np.float64) * (1 + 1e-9) + 1
                mean_part = (sums[going] - self.sums[at]).astype(np.float64) ** 2 / k
                ended = mean_part > limit
                side[going[ended]] = count if step > 0 else -1
                rest_part = np.maximum(0.0, np.abs(rest[going] - self.rest[at]) - margin[going] - self.margin[at]) ** 2
                hopeful = ~ended & (mean_part + rest_part <= limit)
                who, which = going[hopeful], at[hopeful]
                distance = ((rows[who].astype(np.int64) - self.centroids[which]) ** 2).sum(axis=1)
                self.measured += len(who)
                own = self.order[which]
                better = (distance < best[who]) | ((distance == best[who]) & (own < number[who]))
                best[who[better]], number[who[better]] = distance[better], own[better]
                side[going[~ended]] += step
            if not active:
                break
        return number, best


def _rows(batch: pa.RecordBatch, dims: int):
    for at in range(0, batch.num_rows, BATCH):
        part = batch.slice(at, BATCH)
        yield part.column(0), np.frombuffer(b"".join(part.column(1).to_pylist()), "<i4").reshape(-1, dims)


def _round(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each non-empty centroid replaced by the exact floored mean of its vectors."""
    count, dims = centroids.shape

    def run(batches):
        search = Search(centroids)
        n, sums = np.zeros(count, np.int64), np.zeros((count, dims), np.int64)
        for batch in batches:
            for _, rows in _rows(batch, dims):
                numbers, _ = search.nearest(rows)
                order = np.argsort(numbers, kind="stable")
                found, starts = np.unique(numbers[order], return_index=True)
                n[found] += np.diff(np.r_[starts, len(order)])
                sums[found] += np.add.reduceat(rows[order].astype(np.int64), starts, axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(n[some], pa.int64()), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = vectors.mapInArrow(run, SUMS).select("cluster", "n", F.posexplode("sums").alias("component", "part"))
    totals = parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(20,0)")).alias("total"))
    new = centroids.copy()
    for row in totals.collect():  # one row a centroid and component
        new[row["cluster"], row["component"]] = int(row["total"]) // row["n"]
    return new


def clustered(table: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of each kept vector, written once, and the final centroids."""
    vectors = kept_vectors(table, dims, scale)
    centroids = starting_centroids(vectors, clusters).reshape(-1, dims)
    if len(centroids) == 0:
        return vectors.sparkSession.createDataFrame([], ASSIGNED), centroids
    for _ in range(rounds):
        centroids = _round(vectors, centroids)

    def run(batches):
        search = Search(centroids)
        for batch in batches:
            for ids, rows in _rows(batch, dims):
                numbers, distances = search.nearest(rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(numbers, pa.int32()), pa.array(distances, pa.int64())], names=["vec_id", "cluster", "distance"])

    return staged(vectors.mapInArrow(run, ASSIGNED), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each vector beside its cluster's and the whole inertia, and the digest of its centroid.

    One row a centroid passes the driver and is joined.
    """
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    named = [
        (i, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[i].tolist())).encode()).hexdigest())
        for i, d in sorted(inertia.items())]
    clusters = assigned.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

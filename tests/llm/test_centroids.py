"""Clusters against a plain k-means in Python integers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np

from tests.conftest import SF_DIR
from tidewatch.llm import centroids
from tidewatch.llm.queries import QUERIES


def plain(rows, count=16, rounds=3, dims=64):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v) for i, v in kept if i is not None)
    centres = [v for *_, v in order[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for k, vs in members.items():
            centres[k] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    of = defaultdict(int)
    for _, k, d in found:
        of[k] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, of[k], sum(of.values()), names[k]) for i, k, d in found), key=repr)


def got(frame):
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in frame.collect()), key=repr)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(QUERIES["op12_centroid_clusters"](spark, SF_DIR)) == plain(rows)


def test_edges(spark):
    rng = np.random.default_rng(3)
    made = [(i, rng.normal(0, 2, 64).round(1).tolist(), "x") for i in range(60)]
    made += [(7, made[7][1], "x"), (7, made[8][1], "x"), (None, made[9][1], "x"), (70, None, "x"), (71, [], "x"), (72, [1.0] * 63, "x"), (73, [1.0] * 65, "x")]
    made += [(74, [None, *[1.0] * 63], "x"), (75, [float("nan"), *[1.0] * 63], "x"), (76, [float("inf"), *[1.0] * 63], "x"), (77, [-0.001] * 64, "x"), (78, [0.0] * 64, "x")]
    frame = spark.createDataFrame(made, "vec_id long, embedding array<double>, cluster string")
    for part, rows in ((frame, made), (frame.where("vec_id < 5"), made[:5])):
        assert got(centroids.with_inertia(*centroids.clustered(part))) == plain([r[:2] for r in rows])
    assert centroids.with_inertia(*centroids.clustered(frame.limit(0))).count() == 0


def test_search_is_exact_and_rejects():
    rng = np.random.default_rng(4)
    spread = rng.integers(-40, 40, (40, 1))
    for scale in (3, 2**20):
        centres = (rng.integers(-9, 9, (40, 64)) + spread) * scale
        centres[5] = centres[17]
        rows = (rng.integers(-9, 9, (500, 64)) + rng.integers(-40, 40, (500, 1))) * scale
        search = centroids.Search(centres.astype(np.int64))
        number, distance = search.nearest(rows.astype(np.int32))
        every = ((rows[:, None, :].astype(np.int64) - centres[None]) ** 2).sum(axis=2)
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
        assert search.measured < 500 * 40 / 2

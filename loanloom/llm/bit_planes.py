"""Centroid clustering of integer vectors by bit planes.

A vector of 64 components becomes integers floor(scale * x). Bit b of all 64
components is packed into one 64-bit word, the vector's plane b; the last plane is
the sign of a two's complement number, so it weighs -2^b and can be repeated
without changing a value. Then

    x . y = sum over planes i, j of weight_i * weight_j * popcount(X_i AND Y_j)

is exact, and so are the squared distances |x|^2 - 2 x . c + |c|^2. Sums of the
vectors of a cluster count the bits of each plane by component. Up to
``FAST_PLANES`` planes every number fits 64 bits; vectors or centroids that need
more are counted with Python's integers, by the same formulas.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.arrays import released
from loanloom.llm.scratch import Scratch
from loanloom.llm.vectors import matrix, usable

WIDTH = 64
#: 64 * (2 * 2^27)^2 = 2^62 still fits a signed 64-bit number.
FAST_PLANES = 28
#: Sums travel in pieces of so many bits, so that adding them cannot overflow.
LIMB = 30

_LARGEST = (1 << 63) - 1


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exact for any finite x: as 64-bit integers where they
    all fit ``FAST_PLANES`` planes, as Python's integers otherwise."""
    limit = float(1 << (FAST_PLANES - 1))
    if not values.size or np.abs(values).max() < limit / scale:
        return np.floor(values * scale).astype(np.int64)
    exact = [
        math.floor(x * scale) if abs(x) < 2.0**52 / scale else int(x) * scale
        for x in values.ravel().tolist()
    ]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(values.shape)


def pack(ints: np.ndarray) -> np.ndarray:
    """The planes (vectors, planes) of integer vectors (vectors, 64)."""
    low, high = (int(ints.min()), int(ints.max())) if ints.size else (0, 0)
    n_planes = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    planes = np.empty((len(ints), n_planes), "<u8")
    for b in range(n_planes):
        bits = ((ints >> b) & 1).astype(np.uint8)
        planes[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return planes


def weights(n_planes: int) -> list[int]:
    return [1 << b for b in range(n_planes - 1)] + [-(1 << (n_planes - 1))]


def _kind(*n_planes: int):
    return np.int64 if max(n_planes) <= FAST_PLANES else object


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``left`` with all rows of ``right``."""
    kind = _kind(left.shape[1], right.shape[1])
    total = np.zeros((len(left), len(right)), kind)
    for i, a in enumerate(weights(left.shape[1])):
        for j, b in enumerate(weights(right.shape[1])):
            ones = np.bitwise_count(left[:, i, None] & right[None, :, j])
            total += ones.astype(kind) * (a * b)
    return total


def squares(planes: np.ndarray) -> np.ndarray:
    """The inner product of every row with itself."""
    kind = _kind(planes.shape[1])
    total = np.zeros(len(planes), kind)
    for i, a in enumerate(weights(planes.shape[1])):
        for j, b in enumerate(weights(planes.shape[1])):
            total += np.bitwise_count(planes[:, i] & planes[:, j]).astype(kind) * (a * b)
    return total


def distances(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (vectors, centroids)."""
    return (
        squares(planes)[:, None] - 2 * products(planes, centroids) + squares(centroids)[None, :]
    )


def bit_sums(planes: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Exact sums (k, 64) of the vectors of every cluster."""
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
    total = np.zeros((k, WIDTH), object)
    for b, weight in enumerate(weights(planes.shape[1])):
        words = np.ascontiguousarray(planes[:, b]).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(words, axis=1, bitorder="little")
        total += (member @ bits).astype(np.int64).astype(object) * weight
    return total


def _batch_planes(column: pa.Array) -> np.ndarray:
    """Planes of a binary column; rows with fewer planes repeat their sign."""
    rows = column.to_pylist()
    most = max((len(r) for r in rows), default=8)
    data = b"".join(r + r[-8:] * ((most - len(r)) // 8) for r in rows)
    return np.frombuffer(data, "<u8").reshape(len(rows), -1)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, rest, at = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield at, sign * (rest & ((1 << LIMB) - 1))
        rest >>= LIMB
        at += 1


def _packed(rows: DataFrame, scale: int) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = scaled(matrix(batch.column(1), WIDTH), scale)
            planes = pack(ints)
            size = 8 * planes.shape[1]
            data = planes.tobytes()
            packed = [data[i : i + size] for i in range(0, len(data), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], ["id", "planes"]
            )

    return rows.mapInArrow(run, f"id {kind}, planes binary")


def _assigned(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector (ties: the smaller number) and its
    squared distance."""
    found = distances(planes, centroids)
    nearest = found.argmin(axis=1)
    return nearest, found[np.arange(len(found)), nearest]


def _round(packed: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids moved to the floor of their vectors' means; without vectors they
    stay. A task sends one sum a cluster and component."""
    fixed, k = pack(_integers(centroids)), len(centroids)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, WIDTH), object), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            planes = _batch_planes(batch.column(0))
            cluster, _ = _assigned(planes, fixed)
            sums += bit_sums(planes, cluster, k)
            counts += np.bincount(cluster, minlength=k)
        rows = [
            (c, at, limb, part)
            for c in range(k)
            for at, value in enumerate([*sums[c].tolist(), int(counts[c])])
            for limb, part in _limbs(value)
        ]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(v, t)
                for v, t in zip(columns, [pa.int32(), pa.int32(), pa.int32(), pa.int64()], strict=True)
            ],
            ["cluster", "at", "limb", "part"],
        )

    parts = packed.select("planes").mapInArrow(run, "cluster int, at int, limb int, part long")
    totals: dict[tuple[int, int], int] = defaultdict(int)
    for r in parts.groupBy("cluster", "at", "limb").agg(F.sum("part").alias("part")).collect():
        totals[r.cluster, r.at] += r.part << (LIMB * r.limb)
    moved = []
    for c, old in enumerate(centroids):
        n = totals[c, WIDTH]
        moved.append([totals[c, at] // n for at in range(WIDTH)] if n else old)
    return moved


def _integers(rows: list[list[int]]) -> np.ndarray:
    fits = all(abs(v) < 1 << 62 for r in rows for v in r)
    return np.array(rows, np.int64 if fits else object).reshape(len(rows), WIDTH)


def _unpacked(planes: bytes) -> list[int]:
    words = [int.from_bytes(planes[i : i + 8], "little") for i in range(0, len(planes), 8)]
    scale = weights(len(words))
    return [sum(w * (v >> at & 1) for w, v in zip(scale, words, strict=True)) for at in range(WIDTH)]


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    seed: int = 1,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per kept vector: id, cluster int, distance long (squared, in scaled
    integers), cluster_inertia and inertia long, centroid_sha256, centroid
    (array of decimal strings).

    Kept are vectors of exactly 64 components, none null, NaN or infinite. The
    first centroids are the ``k`` kept vectors with the smallest SHA-256 of
    ``<seed>:<id>`` (equal ids: the smaller planes first); there are fewer where
    fewer vectors are kept. A vector without id is clustered, but does not start
    a centroid; if no kept vector has an id there is no result. Repeated rows
    count each, and are returned each. Other columns are ignored, whatever
    their names. A distance or sum beyond 64 bits is null.

    The packed vectors are written once. A round reads them, sends 65 sums a
    cluster and task to one small aggregate, and brings at most ``k`` centroids to
    the driver; nothing else is shuffled, so a cluster that holds a third of all
    vectors costs what others cost.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "bit-planes")
    rows = vectors.select(vectors[id_column].alias("id"), vectors[vector_column].alias("vector"))
    kept = rows.where((F.size("vector") == WIDTH) & usable(F.col("vector")))
    packed = scratch.store(_packed(kept, scale), "planes")
    kind = packed.schema["id"].dataType.simpleString()
    name = F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))
    first = (
        packed.where("id IS NOT NULL")
        .orderBy(F.sha2(name, 256), F.col("planes"))
        .limit(k)
        .collect()
    )
    centroids = [_unpacked(r.planes) for r in first]
    schema = f"id {kind}, cluster int, distance long"
    if not centroids:
        centroids, packed = [[0] * WIDTH], packed.where("false")
    for _ in range(rounds):
        centroids = _round(packed, centroids)
    fixed = pack(_integers(centroids))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nearest, distance = _assigned(_batch_planes(batch.column(1)), fixed)
            fitting = [d if d <= _LARGEST else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(nearest.astype(np.int32), pa.int32()),
                    pa.array(fitting, pa.int64()),
                ],
                ["id", "cluster", "distance"],
            )

    assigned = scratch.store(packed.mapInArrow(run, schema), "assigned")
    scratch.drop("planes")
    totals = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"),
        F.count_if(F.col("distance").isNull()).alias("beyond"),
    )
    sums = {r.cluster: _LARGEST + 1 if r.beyond else int(r.total) for r in totals.collect()}
    inertia = sum(sums.values())
    described = spark.createDataFrame(
        [
            (
                c,
                _fitting(sums.get(c, 0)),
                _fitting(inertia),
                hashlib.sha256(",".join(map(str, values)).encode()).hexdigest(),
                [str(v) for v in values],
            )
            for c, values in enumerate(centroids)
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string,"
        " centroid array<string>",
    )
    return assigned.join(F.broadcast(described), "cluster").select(
        F.col("id").alias(id_column),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
        "centroid",
    )


def _fitting(value: int) -> int | None:
    return value if value <= _LARGEST else None

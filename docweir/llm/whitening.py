"""Whitening of embeddings by hierarchical SVD merging.

A summary of some rows is their number, the exact sums of their integer coordinates, and the singular values
with the right singular vectors of the centred rows, as one small matrix: singular values times vectors.
Two summaries merge by the SVD of both matrices, one above the other, and of one more row that corrects the mean.
No singular value is dropped, so a summary has all that the covariance of its rows holds, in any order of merging.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm.common import checkpointed, read, tidy

#: A coordinate c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Components of the registered query.
COMPONENTS = 8
#: How many summaries one merging task joins, and rows of which one SVD is taken.
FAN_IN, ROWS = 16, 8192
#: Magnitude from which a coordinate isn't an exact integer any more; such a vector counts as not finite.
LARGEST = 2.0**36
#: An eigenvalue below this part of the largest one is rounding: the data don't reach into its direction.
RANK = 1e-13


class Summary(NamedTuple):
    """n rows: the exact sums of their coordinates, and singular values times right singular vectors of the centred rows."""

    n: int
    sums: np.ndarray
    factor: np.ndarray


def svd_factor(rows: np.ndarray) -> np.ndarray:
    """Singular values times right singular vectors, all of them; rows are first reduced to a triangle."""
    reduced = np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows
    _, values, vectors = np.linalg.svd(reduced, full_matrices=False)
    return values[:, None] * vectors


def summarised(x: np.ndarray) -> Summary:
    """The summary of some rows of integers."""
    sums = x.sum(axis=0)
    return Summary(len(x), sums, svd_factor((x * len(x) - sums) / len(x)))


def merged(one: Summary, two: Summary) -> Summary:
    """The summary of the rows of both: the correction row is the difference of means, times sqrt(n m / (n + m)); nothing is dropped."""
    n, m = one.n, two.n
    gap = np.array([a * m - b * n for a, b in zip(one.sums.tolist(), two.sums.tolist())], float) / (n * m)  # exact up to the division
    return Summary(n + m, one.sums + two.sums, svd_factor(np.vstack([one.factor, two.factor, gap * np.sqrt(n * m / (n + m))])))


def _packed(keys: list[int], found: list[Summary]) -> pa.RecordBatch:
    flat = lambda rows, kind: pa.array([r.reshape(-1) for r in rows], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([s.n for s in found], pa.int64()), flat([s.sums for s in found], pa.int64()), flat([s.factor for s in found], pa.float64())],
        names=["node", "n", "sums", "factor"],
    )


def _unpacked(row: dict) -> Summary:
    sums = np.array(row["sums"], np.int64)
    return Summary(row["n"], sums, np.array(row["factor"], float).reshape(-1, len(sums)))


_SCHEMA = "node long, n long, sums array<long>, factor array<double>"


def valid(rows: DataFrame, vector_col: str = "embedding", width: int | None = None) -> DataFrame:
    """Rows whose vector is there and has only finite entries (below LARGEST), and width of them, where that is given; others go."""
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return rows.where(fine & (F.size(v) > 0 if width is None else F.size(v) == width))


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0])
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float) * SCALE).astype(np.int64).reshape(len(column), width) + OFFSET


def summary(vectors: DataFrame) -> Summary | None:
    """The summary of all rows of one column of vectors of one width, by a tree of merging tasks; None of no rows.

    A task sends one summary of the rows that it read; each level of the tree merges up to FAN_IN, and
    what comes to the driver is the root.
    """

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = summarised(_matrix(batch.column(0).slice(at, ROWS)))
                found = own if found is None else merged(found, own)
        if found is not None:
            yield _packed([TaskContext.get().partitionId()], [found])

    def join(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in tables:
            for row in batch.select(["node", "n", "sums", "factor"]).to_pylist():
                found = _unpacked(row) if found is None else merged(found, _unpacked(row))
        yield _packed([key[0].as_py()], [found])

    nodes = checkpointed(vectors.mapInArrow(tidy(start), _SCHEMA))
    most = nodes.agg(F.max("node")).head()[0]
    if most is None:
        return None
    while most > 0:
        most //= FAN_IN
        level = nodes.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
        nodes = level.groupBy("node").applyInArrow(join, _SCHEMA)
    return _unpacked(nodes.head().asDict())


class Axes(NamedTuple):
    """The components of a summary: unit eigenvectors of its covariance in rows, their eigenvalues, falling, and the covariance's trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def axes(found: Summary, components: int) -> Axes:
    """As many components as are asked for and as the data reach; the entry of largest magnitude of each is positive."""
    _, singular, vectors = np.linalg.svd(found.factor, full_matrices=False)
    values = singular**2 / found.n
    kept = min(components, int((values > RANK * values[0]).sum()))
    vectors = vectors[:kept]
    signs = np.sign(vectors[np.arange(kept), np.abs(vectors).argmax(axis=1)]) if kept else np.ones(0)
    return Axes(found.n, found.sums, vectors * signs[:, None], values[:kept], float(values.sum()))


def common_width(rows: DataFrame, vector_col: str) -> int | None:
    """The number of entries that most vectors have; of several, the largest."""
    found = valid(rows, vector_col).groupBy(F.size(vector_col).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).head()
    return found["width"] if found else None


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", width: int | None = None) -> DataFrame:
    """One row per valid vector and component, from 1 by falling eigenvalue: id, component, n, deviation, whitened, explained, identity_error.

    A vector is valid if it isn't null, has width entries (as most of the table have, where width isn't
    given; of several, the largest), and all of them are finite numbers. Coordinates become the integers
    floor(1024 c) + 100000, sums and deviations of which are exact: deviation is the sum over dimensions
    of (n x - S)^2, as decimal(38, 0). whitened is x - S / n projected on the component, over the root of
    its eigenvalue. Components are fewer where the data reach fewer dimensions; if all vectors are
    equal, there is none, and no row. Rows that repeat, or share an id, or whose id is null, each count and
    each return. An empty table gives no rows. Other columns are not read.

    identity_error is measured on what is returned: the whitened rows are stored once, their Gram
    matrix is summed by task, and its largest difference from the identity is one value for all rows.
    """
    spark = rows.sparkSession
    kind = dict(rows.select(F.col(id_col).alias("id")).dtypes)["id"]
    out_schema = f"id {kind}, deviation decimal(38,0), whitened array<double>"
    width = width or common_width(rows, vector_col)
    given = valid(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v", width or 0)
    found = summary(given.select("v")) if width else None
    known = axes(found, components) if found else None
    if not known or not len(known.values):
        return spark.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    n, sums = known.n, known.sums
    turn = (known.vectors / np.sqrt(known.values)[:, None]).T

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = _matrix(batch.column(1))
                centred = (x.astype(object) * n - sums.tolist()) if n * (int(np.abs(x).max()) + int(np.abs(sums).max()) // n + 1) >= 1 << 62 else x * n - sums
                bound = int(np.abs(centred).max())
                squares = (centred.astype(object) ** 2 if bound * bound * x.shape[1] >= 1 << 62 else centred**2).sum(axis=1)
                white = (centred / n).astype(float) @ turn
                deviation = pa.array([int(s) for s in squares.tolist()], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([batch.column(0), deviation, pa.array(list(white), pa.list_(pa.float64()))], names=["id", "deviation", "whitened"])

    stored = checkpointed(given.mapInArrow(tidy(project), out_schema))

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(known.values),) * 2)
        means = np.zeros(len(known.values))
        for batch in batches:
            white = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            total += white.T @ white
            means += white.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size + means.size), pa.int32()), pa.array(np.append(total, means))], names=["at", "total"])

    sums_of = stored.select("whitened").mapInArrow(gram, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    flat = np.array([r["total"] for r in sums_of.orderBy("at").collect()]) / n  # components squared, and components
    k = len(known.values)
    covariance = flat[: k * k].reshape(k, k) - np.outer(flat[k * k :], flat[k * k :])
    error = float(np.abs(covariance - np.eye(k)).max())
    share = F.array(*(F.lit(float(v / known.trace)) for v in known.values))
    exploded = stored.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return exploded.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every embedding."""
    return whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))

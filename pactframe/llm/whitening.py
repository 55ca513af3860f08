"""Whitening of embeddings by a bidiagonal qd solver.

Entries are scaled to integers, so that sums per dimension are exact and rows are centred without cancellation. Each task
reduces its centred rows to a triangular factor by QR, a fixed number of rows at a time; factors are stacked and reduced
again in rounds of `FAN` until few are left. Householder reflections, the dqds recurrence and twisted factorisations
(`bidiagonal`) then turn the last factor, as wide as a vector, into directions and values.

What reaches the driver, and the tasks from it, is one row of sums, at most `FAN` factors of the width of a vector, and
one matrix of second moments: never more with more rows. Factors are written to the shared folder between rounds.

Defined results: a vector that is null or empty, or holds a null or non-finite entry, is dropped, and so is one whose
length is not the commonest (of equally common ones the greatest); repeated rows and ids count and come back as often as
they occur; a null id is kept; directions without spread have no component, so one row alone, or equal rows, give none;
an empty table gives no rows; further columns are ignored. An entry that is too large to be scaled to an exact integer,
or a deviation beyond 64 bits, is an error, not a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactframe.llm.bidiagonal import right_singular
from pactframe.llm.common import stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Factors stacked in one task, and the most the driver takes.
FAN = 64
#: Rows of one QR or product, and rows times components of one batch of results.
BLOCK_ROWS, BATCH_CELLS = 4_096, 131_072
EXACT = 2.0**52

FACTOR = "round_key long, place long, factor binary"
OUT = "vec_id long, component int, n long, deviation long, whitened double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    sound = plain.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)
    sizes = sound.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    commonest = sizes.agg(F.max_by("d", F.struct("n", "d"))).first()[0]
    return sound.filter(F.size("embedding") == F.lit(commonest or 0))


def integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """Scaled entries of a batch's vectors, one row each."""
    flat = batch.column(batch.schema.get_field_index("embedding")).flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(SCALE * flat)
    if len(scaled) and np.abs(scaled).max() >= EXACT:
        raise ArithmeticError("an entry is too large to be scaled to an exact integer")
    return scaled.astype(np.int64).reshape(-1, d) + OFFSET


def sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and the exact sum of each dimension, as Python integers."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                own = integers(batch, len(batch.column(1)[0]))
                added = own.astype(object).sum(axis=0) if np.abs(own).max() > 2**62 // max(len(own), 1) else own.sum(axis=0).astype(object)
                n, total = n + len(own), added if total is None else total + added
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([[str(t) for t in total]], pa.list_(pa.string()))], ["n", "total"]
            )

    parts = vectors.mapInArrow(partial, "n long, total array<string>")
    each = parts.select("n", F.posexplode("total").alias("at", "total"))
    found = each.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    got = sorted(found.collect())  # one row per dimension
    return (got[0].n if got else 0), np.array([int(r.total) for r in got], object)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n * x - S, exact: 64-bit integers where they hold it, Python's otherwise."""
    if float(np.abs(x).max(initial=0)) * n < 2.0**61 and max(map(abs, total.tolist()), default=0) < 2**61:
        return n * x - total.astype(np.int64)
    return n * x.astype(object) - total


def deviations(gap: np.ndarray) -> np.ndarray:
    if gap.dtype != object and float(np.abs(gap).max(initial=0)) ** 2 * gap.shape[1] < 2.0**62:
        return (gap * gap).sum(axis=1)
    whole = (gap.astype(object) ** 2).sum(axis=1)
    if any(w >= 2**63 for w in whole):
        raise ArithmeticError("a deviation does not fit 64 bits")
    return whole.astype(np.int64)


def triangle(stack: np.ndarray) -> np.ndarray:
    """Factor of stacked rows, as wide as they are."""
    d = stack.shape[1]
    r = np.linalg.qr(stack, mode="r")
    return r if len(r) == d else np.vstack([r, np.zeros((d - len(r), d))])


def factor_of(vectors: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """Triangular factor of all centred rows: R'R is n times their covariance."""
    d = len(total)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting, held = np.zeros((0, d)), [], 0
        for batch in batches:
            x = integers(batch, d)
            waiting.append(centred(x, n, total).astype(np.float64) / n)
            held += len(x)
            if held >= BLOCK_ROWS:
                own, waiting, held = triangle(np.vstack([own, *waiting])), [], 0
        if held:
            own = triangle(np.vstack([own, *waiting]))
        if len(own):
            place = TaskContext.get().partitionId()
            row = [pa.array([v]) for v in (place // FAN, place)] + [pa.array([own.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, ["round_key", "place", "factor"])

    def reduce_factors(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        own = triangle(np.vstack([np.frombuffer(f).reshape(-1, d) for f in part.factor]))
        key = int(part.round_key.iloc[0])
        return pd.DataFrame({"round_key": [key // FAN], "place": [key], "factor": [own.tobytes()]})

    factors = stage(vectors.mapInArrow(reduce_rows, FACTOR), "white-factors")
    while factors.limit(FAN + 1).count() > FAN:
        factors = stage(factors.groupBy("round_key").applyInPandas(reduce_factors, FACTOR), "white-factors")
    last = factors.orderBy("place").collect()  # at most FAN factors of d x d
    return triangle(np.vstack([np.zeros((0, d)), *[np.frombuffer(r.factor).reshape(-1, d) for r in last]]))


def moments_gap(vectors: DataFrame, n: int, total: np.ndarray, to_white: np.ndarray) -> float:
    """Largest entry of the covariance of the whitened rows less the identity, measured on all rows."""
    d, k = len(total), len(to_white)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            white = (centred(integers(batch, d), n, total).astype(np.float64) / n) @ to_white.T
            first += white.sum(axis=0)
            second += white.T @ white
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "value"])

    parts = vectors.mapInArrow(partial, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.array([r.value for r in sorted(parts.collect())])  # k + k * k numbers
    mean = flat[:k] / n
    return float(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per kept vector and component."""
    kept = usable(vectors)
    n, total = sums(kept)
    d = len(total)
    shape = vectors.sparkSession.createDataFrame([], OUT + ", explained double, identity_error double")
    if not n:
        return shape
    factor = factor_of(kept, n, total)
    values, directions = right_singular(factor, components)
    if not len(values):
        return shape
    to_white = directions * np.sqrt(n / values)[:, None]
    k, rest = len(values), [float(v) for v in values / (factor * factor).sum()]
    gap = moments_gap(kept, n, total, to_white)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BATCH_CELLS // k)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                far = centred(integers(batch, d), n, total)
                m = len(far)
                white = (far.astype(np.float64) / n) @ to_white.T
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(np.repeat(deviations(far), k)),
                        pa.array(white.ravel()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened"],
                )

    share = F.element_at(F.array(*[F.lit(v) for v in rest]), F.col("component"))
    return kept.mapInArrow(project, OUT).select("*", share.alias("explained"), F.lit(gap).alias("identity_error"))

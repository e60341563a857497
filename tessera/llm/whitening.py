"""Whitening of embeddings: MLlib's Gramian of exactly centred rows, its eigenvectors, and whitened rows.

Entries are made whole numbers first, so counts, sums and the distances from the mean are exact at
every size. The covariance comes from RowMatrix.computeGramianMatrix over rows (n * x - sum) / n, whose
numerators are exact; only the Gramian (dimensions squared) reaches the driver, where eigh takes it
apart, and the components go back to the tasks as a broadcast of the same size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import written

#: Entries are counted in parts of one 1024th, from this far below zero.
PARTS, SHIFT = 1024, 100_000
#: Entries beyond this many parts count as so many: longs hold no more.
_MOST = 2**60
_LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its length, sums by dimension, eigenvalues (falling) and unit eigenvectors (columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def varies(self) -> np.ndarray:
        """Components with variance beyond rounding; the others are whitened to zero."""
        top = self.values[0] if len(self.values) else 0.0
        return self.values > max(top, 0.0) * len(self.sums) * 4 * np.finfo(float).eps


def whole_numbers(vector: Column) -> Column:
    """floor(1024 * entry) + 100000 as long, of an array of numbers; beyond 2**60 parts they count as so many."""

    def whole(c: Column) -> Column:
        parts = F.greatest(F.least(c.cast("double") * PARTS, F.lit(float(_MOST))), F.lit(-float(_MOST)))
        return F.floor(parts).cast("long") + F.lit(SHIFT).cast("long")

    return F.when(usable(vector), F.transform(vector, whole))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(vector) > 0)


def fit_list(df: DataFrame, vector: str, key: str) -> DataFrame:
    """(key, x): the vectors that take part, as whole numbers.

    Left out are rows whose vector is null, empty or holds null or non-finite entries, and, where
    lengths differ, those of another length than the commonest (of equally common ones the longest).
    """
    rows = df.select(F.col(key).alias("key"), whole_numbers(F.col(vector)).alias("x")).filter("x is not null")
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.filter(F.size("x") == (sizes[0]["size"] if sizes else 0))


def fit(rows: DataFrame, components: int) -> Whitening | None:
    """The whitening of a fit list; None if it is empty.

    Sums are exact (decimals beyond a long). Three passes: sums, Gramian, and the caller's own.
    """
    sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"), F.max(F.abs("v")).alias("most")).orderBy("i").collect()
    if not sums:
        return None
    n, total = sums[0]["n"], [int(r["s"]) for r in sums]
    if max(r["most"] for r in sums) * n < 2**62:
        centred = F.zip_with("x", F.lit(total).cast("array<bigint>"), lambda v, s: (v * n - s).cast("double") / n)
    else:
        wide = F.lit([str(s) for s in total]).cast("array<decimal(38,0)>")
        centred = F.zip_with("x", wide, lambda v, s: (v.cast("decimal(19,0)") * F.lit(n).cast("decimal(18,0)") - s).cast("double") / n)
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(centred).alias("row")), "row"), n, len(total))
    cov = matrix.computeGramianMatrix().toArray() / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(cov))
    values = values[order]
    return Whitening(n, total, values, vectors[:, order], values / trace if trace > 0 else np.zeros(len(order)))


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum((n * x - S)^2) of every row, exactly; None where a long can't hold it."""
    s = np.array(sums, float)
    rough = ((x.astype(float) * n - s) ** 2).sum(1)
    small = (rough < 2.0**62) & (np.abs(x).max(1).astype(float) * n < 2.0**62) & bool(np.abs(s).max() < 2.0**62)
    out: list[int | None] = [None] * len(x)
    if small.any():
        fits = ((x[small] * n - np.array(sums, np.int64)) ** 2).sum(1)
        for i, v in zip(np.flatnonzero(small), fits.tolist(), strict=True):
            out[i] = v
    for i in np.flatnonzero(~small):
        v = sum((n * int(a) - b) ** 2 for a, b in zip(x[i], sums, strict=True))
        out[i] = v if v <= _LONG else None
    return out


def whitened_rows(rows: DataFrame, model: Whitening) -> DataFrame:
    """(key, deviation, whitened array) of every row of the fit list; the model is broadcast."""
    varies = model.varies
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, model.values, 1)), 0)
    shared = rows.sparkSession.sparkContext.broadcast((model.n, model.sums, model.vectors * scale))

    def go(batches):
        n, sums, directions = shared.value
        whole = np.array([s // n for s in sums], np.int64)  # x - S/n as whole part and rest: nothing large is subtracted in doubles
        rest = np.array([(s % n) / n for s in sums])
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["x"].to_numpy())
            w = ((x - whole).astype(float) - rest) @ directions
            yield pd.DataFrame({"key": batch["key"], "deviation": pd.array(_deviation(x, n, sums), dtype="Int64"), "w": list(w)})

    schema = StructType([rows.schema["key"], StructField("deviation", LongType()), *StructType.fromDDL("w array<double>")])
    return rows.mapInPandas(go, schema)


def identity_error(rows: DataFrame, components: int) -> float:
    """The largest entry, in size, of the covariance of whitened rows minus the identity; 0 without components."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    if not pairs:
        return 0.0
    found = rows.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs((found[f"c{i}_{j}"] or 0.0) - (i == j)) for i, j in pairs)


def whitened(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 8) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component.

    Rows of null, empty or non-finite vectors are dropped (and of another length than the commonest, see
    fit_list); the rest are the fit list and are all returned, repeated rows and null keys too. Fewer
    dimensions give fewer components. A component without variance (one row, equal rows, fewer rows than
    components) is whitened to 0 and stays out of identity_error, which is 0 if there is no other;
    explained is then 0. deviation is null where a long can't hold it. An empty table gives no rows.
    Other columns of df, of whatever name, play no part.
    """
    rows = fit_list(df, vector, key)
    model = fit(rows, components)
    kind = df.schema[key].dataType.simpleString()
    if model is None:
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    made = written(whitened_rows(rows, model), "whitened")
    error = identity_error(made, int(model.varies.sum()))
    each = made.select("key", "deviation", F.posexplode("w").alias("i", "whitened"))
    share = F.lit([float(e) for e in model.explained])
    return each.select(
        F.col("key").alias(key), (F.col("i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", share[F.col("i")].alias("explained"), F.lit(float(error)).alias("identity_error")
    )

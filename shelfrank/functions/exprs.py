"""F1, F2, F6 and deterministic draws as Column expressions (JVM-side, codegen)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's scoring
DISCOUNT = 0.85          # positional discount base of the gain metric
BACKOFF_BASE = 0.5       # n-gram back-off weight base
SMOOTHING = 1.0          # additive smoothing of the n-gram recommender
DEFAULT_PRICE = 1.0      # price used when an item has none


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c) -> Column:
    """Round a double to 6 digits (both sides of every float oracle do this)."""
    return F.round(col(c).cast("double"), 6)


def lr_shaping(prob, price) -> Column:
    """(sin p + 1) * exp(p - 1) * log1p(price) * cos(price/100) * (1 + tan(p*pi/4))."""
    p, q = col(prob), col(price)
    return ((F.sin(p) + 1) * F.exp(p - 1) * F.log1p(q) * F.cos(q / 100)
            * (1 + F.tan(p * F.lit(math.pi / 4))))


def sigmoid(x) -> Column:
    """F2 inner part."""
    return 1.0 / (1.0 + F.exp(-col(x)))


def position_discount(rank, base: float = DISCOUNT) -> Column:
    """base ** (rank - 1), rank 1-based, in double precision at every rank."""
    return F.pow(F.lit(float(base)), (col(rank) - 1).cast("double"))


def unit_draw(seed: int, *cols) -> Column:
    """Deterministic uniform [0, 1) draw from a hash of (seed, cols).

    Partition-independent, unlike ``rand()``; the same row always gets the same
    draw, so recomputation after an executor loss gives identical results.
    """
    h = F.xxhash64(F.lit(seed), *[col(c) for c in cols])
    return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)


def sum_named_arrays(parts, chunk: int = 65536) -> dict:
    """Sum equally-shaped numeric arrays emitted by many tasks, inside Spark.

    ``parts`` is a DataFrame (name string, idx int, val array<double>) where
    each task emits its partial arrays cut into ``chunk``-long pieces; the
    pieces are summed by a grouped vector sum (partial aggregation per task),
    so the driver receives one summed copy, not one copy per partition.
    Returns {name: flat numpy array}.
    """
    import numpy as np
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = (parts.groupBy("name", "idx").agg(Summarizer.sum(array_to_vector("val")).alias("s"))
            .select("name", "idx", vector_to_array("s").alias("s")).collect())
    out: dict = {}
    for r in sorted(rows, key=lambda x: (x["name"], x["idx"])):
        out.setdefault(r["name"], []).append(np.asarray(r["s"]))
    return {k: np.concatenate(v) for k, v in out.items()}


def chunk_rows(name: str, arr, chunk: int = 65536):
    """(name, idx, piece) rows of a flat array, for ``sum_named_arrays``."""
    flat = arr.ravel()
    return [(name, i // chunk, flat[i:i + chunk].tolist()) for i in range(0, max(flat.size, 1), chunk)]

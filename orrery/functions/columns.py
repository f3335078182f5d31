"""Column-expression helpers. All return ``Column`` objects that stay inside
whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the catalog domain.
DEFAULT_BANDS = ["u", "g", "r", "i", "z"]
DEFAULT_CLASS_MAP = {"GALAXY": 0, "STAR": 1, "QSO": 2}
CONFIDENCE_HIGH = 0.8
CONFIDENCE_MEDIUM = 0.6


def adjacent_differences(bands: Sequence[str] = DEFAULT_BANDS,
                         sep: str = "_", suffix: str = "") -> list[Column]:
    """``b[k] - b[k+1]`` for consecutive bands, named ``u_g``, ``g_r``, ..."""
    return [(F.col(a) - F.col(b)).alias(f"{a}{sep}{b}{suffix}")
            for a, b in zip(bands[:-1], bands[1:])]


def map_encode(col: str, mapping: Mapping[str, int]) -> Column:
    """Explicit label map as a CASE chain; unmapped (and NULL) values give NULL."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(F.col(col) == F.lit(k), F.lit(v)))
    return expr if expr is not None else F.lit(None).cast("int")


def default_encode(col: str, first: str = "GALAXY", second: str = "STAR") -> Column:
    """Notebook rule: ``first`` -> 0, ``second`` -> 1, anything else (NULL too) -> 2."""
    return (F.when(F.col(col) == first, 0)
             .when(F.col(col) == second, 1)
             .otherwise(2))


def confidence_band(p: Column | str) -> Column:
    """>0.8 High, >0.6 Medium, else Low."""
    p = F.col(p) if isinstance(p, str) else p
    return (F.when(p > CONFIDENCE_HIGH, "High")
             .when(p > CONFIDENCE_MEDIUM, "Medium")
             .otherwise("Low"))


def key_hash(key_cols: Sequence[str], seed: int | str) -> Column:
    """``md5(k1:k2:...:seed)`` as hex. The same text hashes identically in
    DuckDB, which keeps every random choice reproducible across engines and
    independent of partitioning."""
    parts = [F.col(c).cast("string") for c in key_cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *parts))


def hex_prefix_int(h: Column, n_hex: int) -> Column:
    """Integer value of the first ``n_hex`` hex digits of ``h`` (n_hex <= 15)."""
    return F.conv(F.substring(h, 1, n_hex), 16, 10).cast("long")


def hash_unit(h: Column) -> Column:
    """Uniform double in [0, 1) from the first 52 bits of a hex hash."""
    return hex_prefix_int(h, 13) / F.lit(float(1 << 52))

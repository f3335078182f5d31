"""Exact quantiles without holding a column in one task.

Spark's exact ``percentile`` keeps a value->count map per group, which for a
global aggregate over continuous data is the whole column in one task. Here
each order statistic is bracketed by ``percentile_approx`` rounds (distributed
sketches; each round shrinks the bracket by about ``accuracy / 4``) until at
most ``max_exact`` values lie strictly inside, or the statistic is one of the
bracket's ends, which are counted in every round: a column of few values ends
there. What is left inside is ranked per statistic. Interpolation is linear
between the order statistics at ``p * (n - 1)`` (the definition used by pandas
``median``/``quantile`` and DuckDB ``quantile_cont``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.session import ship_package


def _val(c: str):
    return F.col(f"`{c}`").cast("double")


@dataclass
class _Statistic:
    """The k-th smallest value (from 0) of a column; ``lo`` and ``hi`` are
    exclusive bounds, ``below`` values lie at or below ``lo``, ``inside``
    between the two."""

    col: str
    k: int
    inside: int
    margin: float
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    value: float | None = None
    done: bool = False

    def bracket(self):
        return _in_bracket(self.col, self.lo, self.hi)

    def narrow(self, lo, hi, less, at_lo, between, at_hi) -> None:
        """Use the counts, inside the bracket, of values below ``lo``, equal
        to it, between the two, and equal to ``hi``."""
        first = self.below + less
        if lo == hi:
            between = at_hi = 0
        if first <= self.k < first + at_lo:
            self.value, self.done = lo, True
        elif first + at_lo <= self.k < first + at_lo + between:
            self.lo, self.hi, self.below, self.inside = lo, hi, first + at_lo, between
        elif first + at_lo + between <= self.k < first + at_lo + between + at_hi:
            self.value, self.done = hi, True
        else:  # the sketch missed it: ask for a wider bracket
            self.margin *= 4


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    accuracy: int = 10000, max_exact: int = 200_000,
                    counts: dict | None = None) -> dict:
    """Return ``{(col, p): value or None}``; NULLs are skipped, all-NULL -> None.
    ``counts`` (non-NULL count per column) saves a pass when already known."""
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}
    if counts is None:
        row = df.agg(*[F.count(_val(c)).alias(f"n{j}") for j, c in enumerate(cols)]).first()
        counts = {c: row[f"n{j}"] for j, c in enumerate(cols)}
    wanted, stats = {}, {}
    for c in cols:
        n = counts[c]
        for p in probs:
            if n:
                pos = p * (n - 1)
                lo = int(math.floor(pos))
                hi = min(lo + 1, n - 1) if pos > lo else lo
                wanted[c, p] = (lo, hi, pos - lo)
                for k in (lo, hi):
                    stats[c, k] = _Statistic(c, k, n, 2.0 / accuracy)
    while active := [s for s in stats.values() if not s.done and s.inside > max_exact]:
        _round(df, active, accuracy)
    _rank(df, [s for s in stats.values() if not s.done])
    out = {(c, p): None for c in cols for p in probs}
    for (c, p), (lo, hi, frac) in wanted.items():
        a, b = stats[c, lo].value, stats[c, hi].value
        out[c, p] = a if frac == 0 else a + (b - a) * frac
    return out


def _round(df: DataFrame, active: list[_Statistic], accuracy: int) -> None:
    """Narrow the brackets: one pass of sketches, one for each column and
    bracket, and one pass that counts the values between all their ends."""
    asked: dict[tuple, list[float]] = {}
    place = []
    for s in active:
        at = (s.k - s.below + 0.5) / s.inside
        key = (s.col, s.lo, s.hi)
        ends = [max(0.0, at - s.margin), min(1.0, at + s.margin)]
        asked[key] = sorted({*asked.get(key, []), *ends})
        place.append((key, ends))
    keys = list(asked)
    row = df.agg(*[F.percentile_approx(_in_bracket(*key), asked[key], accuracy).alias(f"a{j}")
                   for j, key in enumerate(keys)]).first()
    value = {(key, p): v for j, key in enumerate(keys) for p, v in zip(asked[key], row[j])}
    found = [(value[key, ends[0]], value[key, ends[1]]) for key, ends in place]
    edges: dict[str, list[float]] = {}
    for s, pair in zip(active, found):
        edges[s.col] = sorted({*edges.get(s.col, []), *pair})
    less, equal = _counts_at(df, edges)
    for s, (lo, hi) in zip(active, found):
        a, b = (s.col, lo), (s.col, hi)
        s.narrow(lo, hi, less[a] - s.below, equal[a], less[b] - less[a] - equal[a], equal[b])


def _counts_at(df: DataFrame, edges: dict[str, list[float]]) -> tuple[dict, dict]:
    """For each (column, edge): how many values lie below it, and at it. Each
    task sorts its values into the cells between the edges of a column."""
    cols = list(edges)
    tables = [np.array(edges[c], np.float64) for c in cols]

    def run(it):
        total = [np.zeros(2 * len(e) + 1, np.int64) for e in tables]
        for b in it:
            for j, e in enumerate(tables):
                v = b.column(j).drop_null().to_numpy(zero_copy_only=False)
                i = np.searchsorted(e, v, "left")
                at = e[np.minimum(i, len(e) - 1)] == v  # cells 2i: below edge i, 2i + 1: at it
                total[j] += np.bincount(2 * i + at, minlength=len(total[j]))
        j = np.repeat(np.arange(len(tables)), [len(t) for t in total])
        cell = np.concatenate([np.arange(len(t)) for t in total])
        yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), pa.array(cell, pa.int32()), pa.array(np.concatenate(total))],
                                         names=["j", "cell", "n"])

    ship_package(df.sparkSession)
    rows = (df.select(*[_val(c).alias(f"v{j}") for j, c in enumerate(cols)]).mapInArrow(run, "j int, cell int, n long")
            .groupBy("j", "cell").agg(F.sum("n").alias("n")).collect())
    got = [np.zeros(2 * len(e) + 1, np.int64) for e in tables]
    for r in rows:
        got[r.j][r.cell] = r.n
    less, equal = {}, {}
    for c, e, n in zip(cols, tables, got):
        before = np.cumsum(n) - n
        for i, x in enumerate(e.tolist()):
            less[c, x], equal[c, x] = int(before[2 * i + 1]), int(n[2 * i + 1])
    return less, equal


def _rank(df: DataFrame, left: list[_Statistic]) -> None:
    """Pick each statistic among the values inside its bracket: a cumulative
    count over at most ``max_exact`` distinct values for each."""
    if not left:
        return
    structs = [F.struct(F.lit(j).alias("item"), s.bracket().alias("v")) for j, s in enumerate(left)]
    w = Window.partitionBy("item").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    need = df.sparkSession.createDataFrame([(j, s.k - s.below) for j, s in enumerate(left)], "item int, k long")
    picked = (df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
                .where(F.col("v").isNotNull())
                .groupBy("item", "v").agg(F.count("*").alias("cnt"))
                .withColumn("cum", F.sum("cnt").over(w))
                .join(F.broadcast(need), "item")
                .where((F.col("k") < F.col("cum")) & (F.col("k") >= F.col("cum") - F.col("cnt")))
                .select("item", "v").collect())
    for r in picked:
        left[r["item"]].value = r["v"]


def _in_bracket(c, lo, hi):
    v = _val(c)
    if lo is None:
        return v
    return F.when((v > lo) & (v < hi), v)


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10000) -> dict:
    """Opt-in one-pass sketch (rank error <= n / accuracy)."""
    row = df.agg(*[F.percentile_approx(_val(c), list(probs), accuracy).alias(f"q{j}")
                   for j, c in enumerate(cols)]).first()
    out = {}
    for j, c in enumerate(cols):
        vals = row[f"q{j}"]
        for k, p in enumerate(probs):
            out[(c, float(p))] = None if vals is None else vals[k]
    return out

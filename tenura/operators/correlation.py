"""Absolute correlations, mean redundancy and the greedy drop list."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.operators.prep import keep_present, split_feature_types
from tenura.operators.ranking import bucket_of, running_totals, value_cuts
from tenura.session import materialise

PAIRS_PER_PASS = 64
SCHEMA = "col_i string, col_j string, abs_corr double"
PAIR = ["i", "j"]


def _pearson(a: str, b: str) -> Column:
    """Correlation over rows where both are known; null if one is constant there."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def pearson_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass over the data for every 64 pairs, all pairs of a pass side by side."""
    pairs = list(combinations(columns, 2))
    parts = []
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        some = pairs[start : start + PAIRS_PER_PASS]
        wide = df.agg(*[F.abs(_pearson(a, b)).alias(f"p{i}") for i, (a, b) in enumerate(some)])
        rows = [
            F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), F.col(f"p{i}").alias("abs_corr"))
            for i, (a, b) in enumerate(some)
        ]
        parts.append(wide.select(F.inline(F.array(*rows))))
    return _union(df, parts)


def _union(df: DataFrame, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return df.sparkSession.createDataFrame([], SCHEMA)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _counted_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(i, j, x, y, w)``: how many rows hold x in column i and y in column j, both known, for all i < j.

    One pass for all pairs, written once; all later work is on these counts.
    """
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    first = values.select(F.posexplode("v").alias("i", "x"), "v").where(F.col("x").isNotNull())
    later = F.slice("v", F.col("i") + 2, len(columns))
    both = first.select("i", "x", F.posexplode(later).alias("k", "y")).where(F.col("y").isNotNull())
    j = (F.col("i") + F.col("k") + 1).alias("j")
    return materialise(both.groupBy("i", j, "x", "y").agg(F.count("*").alias("w")), "value-pairs")


def _centred_ranks(pairs: DataFrame, side: str) -> DataFrame:
    """Average rank of every value among the rows of its pair of columns, less the mean rank."""
    counts = pairs.groupBy(*PAIR, side).agg(F.sum("w").alias("c"))
    placed = running_totals(counts, side, ["c"], groups=PAIR)
    rank = F.col("cum_c") - (F.col("c") - 1) / F.lit(2)
    return placed.select(*PAIR, side, (rank - (F.col("all_c") + 1) / F.lit(2)).alias(f"rank_{side}"))


def spearman_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(i, j, corr)``: correlation of average ranks over the rows where both columns are known.

    The number of jobs does not depend on the number of columns.
    """
    pairs = _counted_pairs(df, columns)
    ranked = pairs.join(_centred_ranks(pairs, "x"), [*PAIR, "x"]).join(_centred_ranks(pairs, "y"), [*PAIR, "y"])
    product = lambda p, q: F.sum(F.col("w") * F.col(p) * F.col(q))
    spread = F.sqrt(product("rank_x", "rank_x")) * F.sqrt(product("rank_y", "rank_y"))
    return ranked.groupBy(*PAIR).agg(F.try_divide(product("rank_x", "rank_y"), spread).alias("corr"))


def _discordant_weight(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Sum of w_i*w_j over pairs with x_i < x_j and y_i > y_j.

    Elements stand in order of (x, y).  A pair is counted at the highest bit in which the ranks
    of y differ: the earlier one has the bit, the later one has not.
    """
    order = np.lexsort((y, x))
    rank = np.unique(y[order], return_inverse=True)[1].astype(np.int64)
    weight = w[order].astype(np.float64)
    total = 0.0
    for bit in range(int(rank.max()).bit_length()):
        block = rank >> (bit + 1)
        place = np.argsort(block, kind="stable")
        high = ((rank[place] >> bit) & 1).astype(bool)
        wt = weight[place]
        seen = np.cumsum(np.where(high, wt, 0.0))
        first = np.searchsorted(block[place], block[place], side="left")
        before_block = np.where(first > 0, seen[first - 1], 0.0)
        total += float(np.sum(np.where(high, 0.0, wt * (seen - before_block))))
    return total


def _strip_discordance(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    found = _discordant_weight(pdf["p"].to_numpy(), pdf["q"].to_numpy(), pdf["w"].to_numpy())
    return pd.DataFrame({"i": [key[0]], "j": [key[1]], "d": [found]})


def _far_discordance(cells: DataFrame, y_buckets: int) -> DataFrame:
    """``(i, j, d)``: discordant weight of the cells that differ in both buckets.

    The axis of y is halved again and again: two y buckets are told apart at the highest bit in which they
    differ.  At each bit, an earlier x bucket with the bit is discordant with a later one without it.  Sums by
    x bucket come first, so a window holds at most one row for each x bucket.
    """
    bits = F.explode(F.sequence(F.lit(0), F.lit(max(0, y_buckets.bit_length() - 1)))).alias("bit")
    levels = cells.groupBy(*PAIR, "bx", "by").agg(F.sum("w").cast("double").alias("w")).select("*", bits)
    has_bit = F.expr("(shiftright(by, bit) & 1) = 1")
    sides = levels.groupBy(*PAIR, "bit", F.expr("shiftright(by, bit + 1)").alias("block"), "bx").agg(
        F.sum(F.when(has_bit, F.col("w")).otherwise(0.0)).alias("with_bit"),
        F.sum(F.when(has_bit, 0.0).otherwise(F.col("w"))).alias("without"),
    )
    earlier = Window.partitionBy(*PAIR, "bit", "block").orderBy("bx").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("with_bit").over(earlier), F.lit(0.0))
    return sides.select(*PAIR, (F.col("without") * seen).alias("d")).groupBy(*PAIR).agg(F.sum("d").alias("d"))


def kendall_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(i, j, corr)``: Kendall's tau-b over the rows where both columns are known, exact for any number of rows.

    Both axes are cut into buckets, for all pairs of columns at once.  Pairs that differ in both buckets are
    counted from the bucket counts; pairs inside one x bucket, and pairs of different x buckets inside one y
    bucket, are counted strip by strip.  A strip holds a bounded share of the distinct value pairs: a value heavy
    enough to fill a bucket is alone in it and then has no discordant pair there, so its strip is left out.
    """
    pairs = _counted_pairs(df, columns)
    n_pairs = pairs.count()
    (sx, heavy_x), (sy, heavy_y) = value_cuts(pairs, "x", n_pairs), value_cuts(pairs, "y", n_pairs)
    cells = pairs.withColumn("bx", bucket_of(F.col("x"), sx)).withColumn("by", bucket_of(F.col("y"), sy))

    inside_x = cells.where(~F.col("x").isin(sorted(heavy_x))) if heavy_x else cells
    inside_y = cells.where(~F.col("y").isin(sorted(heavy_y))) if heavy_y else cells
    strips = inside_x.select(*PAIR, F.lit("x").alias("axis"), F.col("bx").alias("strip"), F.col("x").alias("p"),
                             F.col("y").alias("q"), "w").unionByName(
        inside_y.select(*PAIR, F.lit("y").alias("axis"), F.col("by").alias("strip"),
                        F.col("bx").cast("double").alias("p"), F.col("y").alias("q"), "w")
    )
    near = strips.groupBy(*PAIR, "axis", "strip").applyInPandas(_strip_discordance, "i int, j int, d double")
    discordant = near.unionByName(_far_discordance(cells, len(sy))).groupBy(*PAIR).agg(F.sum("d").alias("d"))

    tied = lambda c: F.sum(F.col(c) * (F.col(c) - 1.0)) / 2

    def ties(side: str, name: str) -> DataFrame:
        counts = pairs.groupBy(*PAIR, side).agg(F.sum("w").cast("double").alias("c"))
        return counts.groupBy(*PAIR).agg(tied("c").alias(name))

    totals = pairs.groupBy(*PAIR).agg(tied("w").alias("n3"), F.sum("w").cast("double").alias("n"))
    parts = totals.join(ties("x", "n1"), PAIR).join(ties("y", "n2"), PAIR).join(discordant, PAIR, "left")
    d = F.coalesce("d", F.lit(0.0))
    n0 = F.col("n") * (F.col("n") - 1) / 2
    concordant = n0 - F.col("n1") - F.col("n2") + F.col("n3") - d
    spread = F.sqrt(n0 - F.col("n1")) * F.sqrt(n0 - F.col("n2"))
    return parts.select(*PAIR, F.try_divide(concordant - d, spread).alias("corr"))


RANKED = {"spearman": spearman_pairs, "kendall": kendall_pairs}


def correlation_pairs(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """``(col_i, col_j, abs_corr)`` for every pair, each once, columns in the given order."""
    columns = list(columns)
    if method == "pearson" or len(columns) < 2:
        return pearson_pairs(df, columns)
    names = [(i, j, columns[i], columns[j]) for i, j in combinations(range(len(columns)), 2)]
    # One row for each pair of columns; a pair that is never known together has no correlation.
    named = df.sparkSession.createDataFrame(names, "i int, j int, col_i string, col_j string")
    found = RANKED[method](df, columns)
    return named.join(found, PAIR, "left").select("col_i", "col_j", F.abs("corr").alias("abs_corr"))


def mean_abs_correlation(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of a column's absolute correlations, its own zero on the diagonal included."""
    ends = pairs.select(F.explode(F.array("col_i", "col_j")).alias("column"), "abs_corr")
    own = df_of_names(pairs, columns).select("column", F.lit(0.0).alias("abs_corr"))
    return ends.unionByName(own).groupBy("column").agg(F.avg("abs_corr").alias("mean_abs"))


def df_of_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(c,) for c in columns], "column string")


def suggest_correlated(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    *,
    threshold: float = 0.90,
    method: str = "pearson",
    protect: Iterable[str] = (),
) -> tuple[list[str], list[tuple[str, str, float]]]:
    """Columns to drop, and the pairs at or above the threshold, strongest first.

    From each such pair the column with the larger mean correlation goes, the first one if equal;
    protected columns stay.  Only the matrix, columns squared, reaches the driver.
    """
    columns = split_feature_types(df, "")[0] if columns is None else columns
    columns = keep_present(df.columns, columns)
    if len(columns) < 2:
        return [], []
    matrix = [tuple(r) for r in correlation_pairs(df, columns, method).collect()]
    known: dict[str, list[float]] = {c: [0.0] for c in columns}
    for i, j, value in matrix:
        if value is not None:
            known[i].append(value)
            known[j].append(value)
    redundancy = {c: sum(v) / len(v) for c, v in known.items()}
    strong = sorted(
        (p for p in matrix if p[2] is not None and p[2] >= threshold), key=lambda p: (-p[2], p[0], p[1])
    )
    guarded, gone = set(protect), set()
    for i, j, _ in strong:
        free = [c for c in (i, j) if c not in guarded]
        if gone.intersection((i, j)) or not free:
            continue
        gone.add(max(free, key=lambda c: redundancy[c]))
    return [c for c in columns if c in gone], strong

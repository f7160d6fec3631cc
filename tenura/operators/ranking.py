"""Exact ranks and running totals without sorting everything in one task.

The order is cut into buckets.  Rows are numbered inside their bucket by an ordinary window, and
the totals of the buckets before are added.  Only the bucket totals (one row per bucket, thousands
at most) are ever summed in one place.  The result is exact wherever the cuts lie; the cuts only
decide how even the buckets are:

* a value that alone holds a large part of the rows gets a bucket of its own, which is divided
  further by the hash of the row key;
* order by hash needs no quantiles, the leading hex digits are even by design.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.hashing import hash_text
from tenura.session import materialise

ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS, MAX_BUCKETS = 8, 4_000
TIE_SEED = 0


def bucket_count(n_rows: int) -> int:
    return max(MIN_BUCKETS, min(MAX_BUCKETS, math.ceil(n_rows / ROWS_PER_BUCKET)))


def hash_digits(n_rows: int) -> int:
    """Leading hex digits that split ``n_rows`` into buckets of about the wanted size."""
    wanted = max(MIN_BUCKETS, n_rows / ROWS_PER_BUCKET)
    return max(1, math.ceil(math.log(wanted, 16)))


def value_cuts(df: DataFrame, column: str, n_rows: int) -> tuple[list[float], set[float]]:
    """Bucket starts for a numeric column, and the starts of single-value buckets."""
    n = bucket_count(n_rows)
    probs = [i / n for i in range(1, n)]
    cuts = df.stat.approxQuantile(column, probs, 1.0 / (4 * n)) or []
    heavy = {a for a, b in zip(cuts, cuts[1:]) if a == b}
    starts = set(cuts) | {math.nextafter(v, math.inf) for v in heavy}
    return sorted(starts), heavy


def bucket_of(value: Column, starts: Sequence[float]) -> Column:
    """Number of starts at or below the value, by binary search in nested conditions."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= starts[mid], search(mid + 1, hi)).otherwise(search(lo, mid))

    if len(starts) <= 64:
        return search(0, len(starts))
    # Two levels keep the generated code small: a coarse search, then one over a short slice.
    step = math.ceil(math.sqrt(len(starts)))
    coarse = list(starts[::step])
    block = F.size(F.filter(F.array(*map(F.lit, coarse)), lambda s: s <= value)) - 1
    slices = F.array(*[F.array(*map(F.lit, starts[i : i + step])) for i in range(0, len(starts), step)])
    inner = F.size(F.filter(F.get(slices, block), lambda s: s <= value))
    return F.when(block < 0, 0).otherwise(block * step + inner).cast("int")


def _with_offsets(
    df: DataFrame, groups: list[str], buckets: list[str], sums: dict[str, Column], descending: bool = False
) -> DataFrame:
    """Add ``before_<name>``, the total of the group's earlier buckets, and ``all_<name>``.

    The join and the window that follows it share their keys, so the rows are shuffled once.
    Groups are compared as a struct ``_g``, in which a null equals a null.
    """
    df = df.withColumn("_g", F.struct(*groups) if groups else F.struct(F.lit(0).alias("all")))
    keys = ["_g", *buckets]
    totals = df.groupBy(*keys).agg(*[e.alias(f"t_{n}") for n, e in sums.items()])
    order = [F.desc(buckets[0]) if descending else F.asc(buckets[0]), *map(F.asc, buckets[1:])]
    group = Window.partitionBy("_g")
    earlier = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"t_{n}").over(earlier), F.lit(0)).alias(f"before_{n}") for n in sums],
        *[F.sum(f"t_{n}").over(group).alias(f"all_{n}") for n in sums],
    )
    return df.join(offsets, keys)


def running_totals(
    df: DataFrame,
    value: str,
    measures: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Inclusive running totals ``cum_<measure>`` over distinct values, and ``all_<measure>``.

    ``df`` has one row per (group, value), so no bucket can be filled by one value.  It is
    written once, because it is an aggregate and several passes read it.
    """
    groups = list(groups)
    df = materialise(df, "per-value")
    starts, _ = value_cuts(df, value, df.count())
    bucketed = df.withColumn("_b", bucket_of(F.col(value).cast("double"), starts))
    placed = _with_offsets(bucketed, groups, ["_b"], {m: F.sum(m) for m in measures}, descending)
    order = F.desc(value) if descending else F.asc(value)
    upto = Window.partitionBy("_g", "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        *df.columns,
        *[(F.sum(m).over(upto) + F.col(f"before_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"all_{m}") for m in measures],
    )


def rank_by_hash(
    df: DataFrame, key: str, seed: int | str, groups: Sequence[str] = (), out: str = "rank", n_rows: int | None = None
) -> DataFrame:
    """Random but repeatable rank 1..n of the rows of each group (order: hash of seed and key, key)."""
    groups = list(groups)
    n_rows = df.count() if n_rows is None else n_rows
    hashed = df.withColumn("_h", hash_text(F.col(key), seed))
    bucketed = hashed.withColumn("_b", F.substring("_h", 1, hash_digits(n_rows)))
    placed = _with_offsets(bucketed, groups, ["_b"], {"n": F.count("*")})
    inside = Window.partitionBy("_g", "_b").orderBy("_h", key)
    return placed.select(*df.columns, (F.row_number().over(inside) + F.col("before_n")).alias(out))


def rank_by_value(
    df: DataFrame,
    value: str,
    key: str,
    groups: Sequence[str] = (),
    descending: bool = True,
    out: str = "rank",
) -> DataFrame:
    """Exact rank 1..n by value inside each group; ties by the hash of the key, then the key."""
    groups = list(groups)
    n_rows = df.count()
    starts, heavy = value_cuts(df, value, n_rows)
    number = F.col(value).cast("double")
    # Nulls have a bucket of their own below all others.
    tied = F.col(value).isNull()
    if heavy:
        tied = tied | F.col(value).isin(sorted(heavy))
    bucketed = (
        df.withColumn("_h", hash_text(F.col(key), TIE_SEED))
        .withColumn("_b", F.when(number.isNull(), -1).otherwise(bucket_of(number, starts)))
        .withColumn("_s", F.when(tied, F.substring("_h", 1, hash_digits(n_rows))).otherwise(""))
    )
    placed = _with_offsets(bucketed, groups, ["_b", "_s"], {"n": F.count("*")}, descending)
    order = F.desc(value) if descending else F.asc(value)
    inside = Window.partitionBy("_g", "_b", "_s").orderBy(order, "_h", key)
    return placed.select(*df.columns, (F.row_number().over(inside) + F.col("before_n")).alias(out))

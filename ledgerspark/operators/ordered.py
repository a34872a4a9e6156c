"""Order-dependent work over keys of any size: rows sorted over parts, with what a part needs of those before or after it.

A key that fills several parts is worked on in each of them. Between parts go one row for each of them and such a key, of
which there are at most two for each part, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

PART, AT = "__part", "__at"


def ordered(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` dealt by range of (keys, order) and sorted, written once, with each row's part and place. Rows that are equal
    in all of keys and order share a part."""
    by = [*(F.col(k).asc_nulls_first() for k in keys), *order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    return staged(rows, "ordered").withColumn(PART, F.shiftright(AT, 33))


def carried(
    rows: DataFrame, keys: list[str], last: dict[str, Column] | None = None, before: dict[str, Column] | None = None, total: dict[str, Column] | None = None, following: dict[str, Column] | None = None
) -> DataFrame:
    """Columns by the order of ``ordered`` within each key, of which some rows may be gone since:

    ``last``: the last value that isn't null up to and with the row; ``before``: without the row; ``total``: the sum up to
    and with the row, null as 0; ``following``: the value of the next row, null at the key's end.
    """
    last, before, total, following = last or {}, before or {}, total or {}, following or {}
    here = Window.partitionBy(*keys, PART).orderBy(AT)
    upto, earlier = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    inner = {n: F.last(c, ignorenulls=True).over(upto) for n, c in last.items()}
    inner |= {n: F.last(c, ignorenulls=True).over(earlier) for n, c in before.items()}
    inner |= {n: F.coalesce(F.sum(c).over(upto), F.lit(0)) for n, c in total.items()}
    inner |= {n: F.lead(F.struct(c.alias("v"))).over(here) for n, c in following.items()}
    parts = rows.groupBy(*keys, PART).agg(
        F.lit(0).alias("__none"),
        *[F.max_by(c, F.when(c.isNotNull(), F.col(AT))).alias(n) for n, c in (last | before).items()],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in total.items()],
        *[F.min_by(F.struct(c.alias("v")), AT).alias(n) for n, c in following.items()],
    )
    over = Window.partitionBy(*keys).orderBy(PART)
    ahead = over.rowsBetween(Window.unboundedPreceding, -1)
    outer = {n: F.last(n, ignorenulls=True).over(ahead) for n in last | before} | {n: F.sum(n).over(ahead) for n in total} | {n: F.lead(n).over(over) for n in following}
    several = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    carry = parts.withColumn("__several", several).where("__several > 1").select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.col(PART).alias("__of"), *[c.alias(f"__carry_{n}") for n, c in outer.items()])
    same = F.col(PART) == F.col("__of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    out = rows.withColumns(inner).join(F.broadcast(carry), same, "left")
    own = {n: F.coalesce(n, f"__carry_{n}") for n in last | before} | {n: F.col(n) + F.coalesce(f"__carry_{n}", F.lit(0)) for n in total} | {n: F.coalesce(n, f"__carry_{n}")["v"] for n in following}
    return out.withColumns(own).select(*rows.columns, *own)


def without_order(df: DataFrame) -> DataFrame:
    return df.drop(PART, AT)

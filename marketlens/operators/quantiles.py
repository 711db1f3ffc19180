"""Exact percentiles and outlier fences without a per-group value list.

``percentile`` keeps every distinct value of a group in one aggregation buffer,
which a variety holding a third of all quotes would overflow. Here the values
of a group are counted in ordered cells, the cells holding the wanted ranks are
found from the cell counts, and only the values inside those cells are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.settle import settle

_FINE = 4096
_COARSE = 64
_OFFSET = 1100


def _cell(value: Column, per_octave: int) -> Column:
    """An integer that never decreases as the value grows, ``per_octave`` steps per doubling.

    It does not depend on the group, so no group needs to be scanned first.
    """
    step = lambda x: F.floor(F.log2(x) * per_octave) + _OFFSET * per_octave
    signed = F.when(value > 0, step(value)).when(value < 0, -step(-value) - 1)
    return F.coalesce(signed.cast("bigint"), F.lit(0).cast("bigint"))


def _holding_ranks(cells: DataFrame, keys: list[str], order: str, ranks: list[str]) -> DataFrame:
    """Add ``upto`` (rows through this cell) and keep cells that hold a wanted rank.

    ``base`` rows of the group come before the cells considered.
    """
    running = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = cells.withColumn("upto", F.col("base") + F.sum("n").over(running))
    wanted = F.lit(False)
    for r in ranks:
        wanted = wanted | ((F.col(r) >= F.col("upto") - F.col("n")) & (F.col(r) < F.col("upto")))
    return counted.where(wanted)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated percentiles per group, one column per entry of ``probs``.

    First scan: rows per (group, cell), folded map-side to a few thousand rows
    per group. The cells holding wanted ranks, at most two per percentile and
    group, are settled. Second scan: only values inside those cells are kept
    (about one in a hundred), counted per distinct value, narrowed once more by
    finer cells, and ranked. No shuffle is keyed by the group alone until the
    rows are that few. Rows with a NULL key or value do not count.
    """
    rows = df.where(F.col(value).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    rows = rows.select(*keys, F.col(value).cast("double").alias("v")).withColumn("cell", _cell(F.col("v"), _COARSE))

    cells = rows.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.withColumn("size", F.sum("n").over(W.partitionBy(*keys)))
    ranks, at = [], {}
    for name, p in probs.items():
        at[name] = (F.col("size") - 1) * F.lit(float(p))
        sizes = sizes.withColumn(f"lo_{name}", F.floor(at[name])).withColumn(f"hi_{name}", F.ceil(at[name]))
        ranks += [f"lo_{name}", f"hi_{name}"]
    carried = ["size", *ranks]
    coarse = settle(
        _holding_ranks(sizes.withColumn("base", F.lit(0).cast("bigint")), keys, "cell", ranks).select(
            *keys, "cell", (F.col("upto") - F.col("n")).alias("base"), *carried
        ),
        "percentile-cells",
    )

    inside = (
        rows.join(coarse.select(*keys, "cell"), [*keys, "cell"], "left_semi")
        .groupBy(*keys, "cell", "v").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("sub", _cell(F.col("v"), _COARSE * _FINE))
    )
    subs = inside.groupBy(*keys, "cell", "sub").agg(F.sum("n").alias("n")).join(coarse, [*keys, "cell"])
    fine = _holding_ranks(subs, [*keys, "cell"], "sub", ranks).select(
        *keys, "cell", "sub", (F.col("upto") - F.col("n")).alias("base"), *carried
    )
    placed = _holding_ranks(inside.join(fine, [*keys, "cell", "sub"]), [*keys, "cell", "sub"], "v", ranks)
    holds = lambda r: F.max(
        F.when((F.col(r) >= F.col("upto") - F.col("n")) & (F.col(r) < F.col("upto")), F.col("v"))
    )
    found = placed.groupBy(*keys).agg(F.first("size").alias("size"), *[holds(r).alias(f"v_{r}") for r in ranks])
    columns = []
    for name in probs:
        lo, hi = F.col(f"v_lo_{name}"), F.col(f"v_hi_{name}")
        columns.append((lo + (hi - lo) * (at[name] - F.floor(at[name]))).alias(name))
    return found.select(*keys, *columns)


def percentile_bounds(prices: DataFrame, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Quartiles and 1.5-IQR fences per variety; sketch-based when not exact."""
    rows = prices.where(F.col("variety").isNotNull())
    if exact:
        quartiles = exact_percentiles(rows, ["variety"], "avg_price", {"q1": 0.25, "q3": 0.75})
    else:
        sketch = rows.groupBy("variety").agg(
            F.percentile_approx("avg_price", [0.25, 0.75], accuracy).alias("q")
        )
        quartiles = sketch.select("variety", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return quartiles.withColumn("lower_fence", F.col("q1") - reach).withColumn("upper_fence", F.col("q3") + reach)


def group_transform(prices: DataFrame, exact: bool = True) -> DataFrame:
    """Quotes with the quartiles and fences of their variety on every row.

    The fences are settled to a table first: the join is then a broadcast when
    their measured size allows, and a skew-split sort-merge join otherwise.
    """
    return prices.join(settle(percentile_bounds(prices, exact), "fences"), "variety")


def iqr_filter(prices: DataFrame, exact: bool = True) -> DataFrame:
    """Quotes inside their own variety's fences, ends included."""
    fenced = group_transform(prices, exact)
    inside = F.col("avg_price").between(F.col("lower_fence"), F.col("upper_fence"))
    return fenced.where(inside).select(*prices.columns)

"""Running sums and ranks over a whole table, whatever its size: no task holds more than a range of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.shared import written


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """`rows` with a column for each of `sums`: the sum of its values over all rows up to and with this one in `order`.

    Rows are dealt by ranges of `order`; a range adds what the ranges before it hold, one number for each range, to sums of
    its own. `order` should leave no ties between rows that differ: ties take any order. A sum's type is that of F.sum;
    null values add nothing. An empty table gives an empty result.
    """
    values = {name: f"_value_of_{name}" for name in sums}
    valued = rows.select("*", *[value.alias(values[name]) for name, value in sums.items()])
    ranged = written(valued.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"{v}_total") for v in values.values()])
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over as many rows as there are partitions
    before = totals.select("_range", *[F.coalesce(F.sum(f"{v}_total").over(ahead), F.lit(0)).alias(f"{v}_before") for v in values.values()])
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = {name: F.coalesce(F.sum(v).over(within), F.lit(0)) for name, v in values.items()}
    summed = ranged.join(F.broadcast(before), "_range").withColumns({name: own[name] + F.col(f"{v}_before") for name, v in values.items()})
    return summed.select(*rows.columns, *values)

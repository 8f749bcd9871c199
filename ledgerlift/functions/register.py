"""The library's functions by name in SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ledgerlift.functions.text import PLACEHOLDERS, UNITS, count_pattern

SQL_FUNCTIONS = {
    "to_int(t STRING) RETURNS DECIMAL(38,0)": "try_cast(regexp_replace(t, '[^0-9]', '') AS DECIMAL(38,0))",
    "is_number(t STRING) RETURNS BOOLEAN": "regexp_replace(lower(t), '[^0-9a-z]', '') RLIKE '^[0-9]+$'",
    "normalise(t STRING) RETURNS STRING": "regexp_replace(lower(t), '[^0-9a-z]', '')",
    "source_id(f STRING) RETURNS STRING": r"CASE WHEN f RLIKE r'^(.*?)_jpg\.rf\.' THEN regexp_extract(f, r'^(.*?)_jpg\.rf\.', 1) ELSE f END",
    "cer(pred STRING, gold STRING) RETURNS DOUBLE": "levenshtein(pred, gold) / greatest(length(gold), 1)",
    "thousands(n BIGINT) RETURNS STRING": "translate(format_number(n, 0), ',', '.')",
    "page_angle(quads ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>) RETURNS DOUBLE": """
        aggregate(
          transform(quads, q -> array_max(transform(sequence(0, 3), i -> named_struct(
            'size', pow(q[(i + 1) % 4].x - q[i].x, 2) + pow(q[(i + 1) % 4].y - q[i].y, 2), 'first', -i,
            'dx', q[(i + 1) % 4].x - q[i].x, 'dy', q[(i + 1) % 4].y - q[i].y)))),
          named_struct('s', 0D, 'c', 0D),
          (a, e) -> named_struct('s', a.s + sqrt(e.size) * sin(2 * atan2(e.dy, e.dx)), 'c', a.c + sqrt(e.size) * cos(2 * atan2(e.dy, e.dx))),
          a -> degrees(atan2(a.s, a.c)) / 2)""",
    "is_label(t STRING) RETURNS BOOLEAN": f"trim(t) <> '' AND trim(t) NOT IN {PLACEHOLDERS}",
    "split_count(t STRING) RETURNS STRUCT<count: INT, name: STRING>": f"""
        CASE WHEN t RLIKE r'{count_pattern()}' AND trim(regexp_extract(t, r'{count_pattern()}', 3)) RLIKE r'^\\p{{L}}'
          AND length(regexp_replace(lower(regexp_extract(t, r'{count_pattern()}', 3)), '[^a-z]', '')) >= 3
          AND lower(trim(regexp_extract(t, r'{count_pattern()}', 3))) NOT IN {UNITS}
        THEN named_struct('count', try_cast(regexp_extract(t, r'{count_pattern()}', 1) AS INT), 'name', trim(regexp_extract(t, r'{count_pattern()}', 3))) END""",
}


class Cluster1D:
    """cluster_1d(TABLE(..) PARTITION BY key ORDER BY (v, idx)): rows (key, idx, v, gap) give (key, idx, cluster).

    A value joins the current cluster if it is at most `gap` above its running mean; clusters count from 0. The state is a
    mean and two counts, whatever the partition's size. A null value is in no cluster.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        kinds = {f.name: f.dataType for f in table.dataType.fields}
        if not {"key", "idx", "v", "gap"} <= set(kinds):
            raise ValueError("cluster_1d takes columns key, idx, v and gap")
        return AnalyzeResult(StructType().add("key", kinds["key"]).add("idx", kinds["idx"]).add("cluster", IntegerType()))

    def __init__(self) -> None:
        self.mean, self.n, self.cluster = 0.0, 0, -1

    def eval(self, row: Row) -> Iterator[tuple]:
        v = row["v"]
        if v is None:
            yield row["key"], row["idx"], None
            return
        if self.n and v - self.mean <= row["gap"]:
            self.n += 1
            self.mean += (v - self.mean) / self.n
        else:
            self.mean, self.n, self.cluster = float(v), 1, self.cluster + 1
        yield row["key"], row["idx"], self.cluster


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session as temporary SQL functions, which the optimizer inlines; their names."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    spark.udtf.register("cluster_1d", udtf(Cluster1D))
    return [*(signature.split("(")[0] for signature in SQL_FUNCTIONS), "cluster_1d"]

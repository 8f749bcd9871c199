"""Receipt-like, annotation-like and demand-like views over the star-schema tables, as SQL that Spark and DuckDB both run.

Every view is deterministic arithmetic on whole tables.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark")

LINE_ORDER = """l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""
LINE_VALUES = """CAST(l_quantity AS BIGINT) AS qty, p_name AS nama, CAST(500 * (1 + p_partkey % 40) AS BIGINT) AS harga,
  CAST(CAST(l_quantity AS BIGINT) * 500 * (1 + p_partkey % 40) / CASE WHEN p_partkey % 13 = 0 THEN 10 ELSE 1 END AS BIGINT) AS jumlah"""

LINES = f"""
SELECT l_orderkey AS doc_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS INT) AS r,
  {LINE_VALUES}
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

#: Role and column by column order (doc_id % 5); role_col is null where the form lacks the role.
ORDERS = """
SELECT * FROM (VALUES (0,'qty',0),(0,'nama',1),(0,'harga',2),(0,'jumlah',3), (1,'nama',0),(1,'qty',1),(1,'harga',2),(1,'jumlah',3),
 (2,'qty',0),(2,'nama',1),(2,'jumlah',2), (3,'nama',0),(3,'harga',1),(3,'qty',2),(3,'jumlah',3),
 (4,'no',0),(4,'nama',1),(4,'qty',2),(4,'harga',3),(4,'jumlah',4)) AS t(ord, role, c)
"""

#: One text per row, column and document; row 0 is the header, the last row holds the total.
CELLS = f"""
SELECT doc_id, r, c, role, CASE role WHEN 'qty' THEN CAST(qty AS STRING) WHEN 'nama' THEN nama WHEN 'harga' THEN CAST(harga AS STRING)
  WHEN 'jumlah' THEN CAST(jumlah AS STRING) ELSE CAST(r AS STRING) END AS text
FROM ({LINES}) l JOIN ({ORDERS}) o ON l.doc_id % 5 = o.ord
UNION ALL
SELECT doc_id, 0 AS r, c, 'header_' || role AS role, CASE role WHEN 'qty' THEN 'BANYAKNYA' WHEN 'nama' THEN 'NAMA BARANG' WHEN 'harga' THEN 'HARGA'
  WHEN 'jumlah' THEN 'JUMLAH' ELSE 'NO' END AS text
FROM (SELECT DISTINCT doc_id FROM ({LINES}) x) d JOIN ({ORDERS}) o ON d.doc_id % 5 = o.ord
UNION ALL
SELECT doc_id, CAST(n + 1 AS INT) AS r, c, 'total_value' AS role, CAST(total + CASE WHEN doc_id % 7 = 0 THEN 500 ELSE 0 END AS STRING) AS text
FROM (SELECT doc_id, max(r) AS n, CAST(sum(jumlah) AS BIGINT) AS total FROM ({LINES}) y GROUP BY doc_id) t JOIN ({ORDERS}) o ON t.doc_id % 5 = o.ord AND o.role = 'jumlah'
"""

#: LINES with how many lines their document has and what they sum to. The key has its name before the window, else Spark
#: forgets that rows are dealt by it, and deals them anew.
COUNTED_LINES = f"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY {LINE_ORDER}) AS INT) AS r, qty, nama, harga, jumlah,
  CAST(count(*) OVER (PARTITION BY doc_id) AS INT) AS n, CAST(sum(jumlah) OVER (PARTITION BY doc_id) AS BIGINT) AS sold
FROM (SELECT l_orderkey AS doc_id, {LINE_ORDER}, {LINE_VALUES} FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey IS NOT NULL) x
"""

#: The rows of CELLS with their line's qty, for Spark: lines are joined and numbered once, and a document's first and last line
#: bring its header and total along, where CELLS reads the lines three times.
COUNTED_CELLS = f"""
SELECT doc_id, qty, inline(CASE WHEN r = 1 AND r = n AND role = 'jumlah' THEN array(cell, header, total) WHEN r = 1 THEN array(cell, header) WHEN r = n AND role = 'jumlah' THEN array(cell, total) ELSE array(cell) END) AS (r, c, role, text)
FROM (
  SELECT doc_id, qty, r, n, role,
    struct(r, c, role, CASE role WHEN 'qty' THEN CAST(qty AS STRING) WHEN 'nama' THEN nama WHEN 'harga' THEN CAST(harga AS STRING) WHEN 'jumlah' THEN CAST(jumlah AS STRING) ELSE CAST(r AS STRING) END AS text) AS cell,
    struct(0 AS r, c, 'header_' || role AS role, CASE role WHEN 'qty' THEN 'BANYAKNYA' WHEN 'nama' THEN 'NAMA BARANG' WHEN 'harga' THEN 'HARGA' WHEN 'jumlah' THEN 'JUMLAH' ELSE 'NO' END AS text) AS header,
    struct(CAST(n + 1 AS INT) AS r, c, 'total_value' AS role, CAST(sold + CASE WHEN doc_id % 7 = 0 THEN 500 ELSE 0 END AS STRING) AS text) AS total
  FROM ({COUNTED_LINES}) l JOIN ({ORDERS}) o ON l.doc_id % 5 = o.ord) k
"""

BOXES = f"""
SELECT doc_id, CAST(r * 8 + c AS INT) AS box_idx, CAST(90 + 300 * c + (doc_id * 31 + r * 17 + c * 7) % 11 - 5 AS DOUBLE) AS x,
  CAST(200 + 63 * r + (doc_id * 13 + r * 5 + c * 3) % 11 - 5 AS DOUBLE) AS y, CAST(120 AS DOUBLE) AS w, CAST(74 AS DOUBLE) AS h, text,
  CAST(0.60 + (doc_id * 7 + r * 3) % 40 / 100.0 AS DOUBLE) AS conf, role, r AS row
FROM ({CELLS}) c
"""

DOCS = "SELECT DISTINCT l_orderkey AS doc_id, 1536 AS width, 2048 AS height FROM lineitem"

#: The same for Spark, which would deal the documents out by all three columns, and then anew by the first.
KEYED_DOCS = "SELECT doc_id, 1536 AS width, 2048 AS height FROM (SELECT DISTINCT l_orderkey AS doc_id FROM lineitem) keys"

IMAGES = "SELECT o_orderkey AS id, concat('nota', CAST(o_custkey AS STRING), '_jpg.rf.', CAST(o_orderkey AS STRING), '.jpg') AS file_name, 1536 AS width, 2048 AS height FROM orders"

ANNOTATIONS = """
SELECT l_orderkey AS image_id, l_partkey AS category_id, CAST(l_linenumber * 190 + l_suppkey % 17 - 8 AS DOUBLE) AS x, CAST(l_partkey % 2000 - 4 AS DOUBLE) AS y,
  CAST(l_quantity * 3 - 6 AS DOUBLE) AS w, CAST(l_suppkey % 60 AS DOUBLE) AS h
FROM lineitem
"""

CATEGORIES = "SELECT p_partkey AS id, CASE WHEN p_partkey % 97 = 0 THEN 'objects' ELSE p_name END AS name FROM part"

PREDICTIONS = """
SELECT p_partkey AS id, gold, CASE WHEN p_partkey % 5 = 0 THEN replace(gold, 'a', 'o') WHEN p_partkey % 11 = 0 THEN substr(gold, 2) WHEN p_partkey % 17 = 0 THEN concat(gold, '0') ELSE gold END AS pred
FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(500 * (1 + p_partkey % 40) AS STRING) ELSE p_name END AS gold FROM part) g
"""

#: Daily units by user over the 30 days of events: demand of a shop with few items.
PANEL = """
SELECT user_id AS unique_id, CAST(ts AS DATE) AS ds, CAST(count(*) AS BIGINT) AS y FROM events GROUP BY user_id, CAST(ts AS DATE)
"""

QUADS = """
SELECT l_orderkey AS doc_id, l_linenumber AS n, l_partkey AS k, CAST(l_suppkey % 900 AS DOUBLE) AS x0, CAST(l_partkey % 1500 AS DOUBLE) AS y0,
  CAST(l_quantity * 4 + 20 AS DOUBLE) AS dx, CAST(l_linenumber * 3 - 6 AS DOUBLE) AS dy, CAST(12 + l_suppkey % 9 AS DOUBLE) AS t
FROM lineitem
"""

SCAN = """
SELECT CAST(o_custkey AS BIGINT) AS page_id, CAST(o_orderkey % 400 AS INT) AS y FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_custkey, o_orderkey % 400
"""


def for_duckdb(sql: str) -> str:
    return re.sub(r"\bAS STRING\b", "AS VARCHAR", sql)


def parts(spark: SparkSession, sf_dir: str, table: str, each: int) -> int:
    """How many parts of about `each` rows a table makes; two for each core at least."""
    return max(2 * spark.sparkContext.defaultParallelism, math.ceil(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / each))


def view(spark: SparkSession, sf_dir: str, sql: str, dealt: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """The view's frame over the tables of a folder; only those it names are opened. CELLS are worked out in one pass,
    DOCS dealt by document.

    dealt: (key, number of parts) of tables that are dealt out by a key as they are read, because a view makes many rows of
    each of theirs: a small file is one task otherwise, and what it makes would be shuffled afterwards. A stated number is
    not put together again by size.
    """
    sql = sql.replace(DOCS, KEYED_DOCS).replace(CELLS, f"SELECT doc_id, r, c, role, text FROM ({COUNTED_CELLS}) one")
    named = [t for t in TABLES if re.search(rf"\b(FROM|JOIN)\s+{t}\b", sql)]
    for t in named:
        sql = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", sql)
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in named}
    return spark.sql(sql, **{t: read[t].repartition(dealt[t][1], dealt[t][0]) if t in (dealt or {}) else read[t] for t in named})

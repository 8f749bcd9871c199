"""Readers and writers of annotation exports, label files, manifests, catalogues and receipts (S-01 to S-16)."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.functions.text import normalise
from ledgerlift.sources.exports import CocoExports

COCO_SCHEMAS = {
    "images": "id bigint, file_name string, width int, height int",
    "annotations": "id bigint, image_id bigint, category_id bigint, bbox array<double>, area double",
    "categories": "id bigint, name string",
}
CATALOGUE_SCHEMA = "product_name string, unit_price int, archetype string, corpus_count int"
BOXES_SCHEMA = "doc_id string, box_idx int, x double, y double, w double, h double, text string, conf double"
RECEIPT_SCHEMA = "items array<struct<nama string, qty bigint, harga bigint, jumlah bigint, confidence double, reconciled boolean, warnings array<string>>>, total struct<computed bigint, stated bigint, matches boolean>, warnings array<string>, needs_review boolean, ms int"
LARGEST_UPLOAD = 12 * 1024 * 1024


def _find(spark: SparkSession, roots: tuple[str, ...], name: str) -> list[str]:
    """Paths of the files of that name below the roots: names only, one per export."""
    found, conf = [], spark._jsc.hadoopConfiguration()
    for root in roots:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            at = files.next().getPath()
            if at.getName() == name:
                found.append(re.sub("^file:/+", "file:///", at.toString()))
    return sorted(found)


def read_coco(spark: SparkSession, *roots: str, name: str = "_annotations.coco.json") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, categories) of every export below the roots; `split` is the name of its folder.

    Spark's file sources pass over names that begin with an underscore, as exports' do. Their paths are listed by the
    file system's own interface; `exports.CocoExports` plans a task an export and reads it element by element, so an
    export may be larger than a task's memory.
    """
    spark.dataSource.register(CocoExports)
    paths = json.dumps(_find(spark, roots, name))

    def part(of: str) -> DataFrame:
        raw = spark.read.format(CocoExports.name()).option("paths", paths).option("part", of).load()
        return raw.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("split"), F.from_json("value", COCO_SCHEMAS[of]).alias("d")).select("split", "d.*")

    boxes = part("annotations")
    boxes = boxes.select("split", "id", "image_id", "category_id", "area", *[F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate("xywh")])
    return part("images"), boxes, part("categories")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of a recognition label file; quotes are ordinary characters."""
    return spark.read.schema("path string, text string").option("sep", "\t").option("quote", "").csv(path)


def write_labels(labels: DataFrame, path: str, split: str | None = None) -> None:
    """Tab-separated label files, one folder per split if a column is named."""
    writer = labels.write.option("sep", "\t").option("quote", "").option("emptyValue", "")
    (writer.partitionBy(split) if split else writer).csv(path)


def read_detection_labels(spark: SparkSession, path: str) -> DataFrame:
    """(path, polys) of a detection label file."""
    kind = "array<struct<transcription string, points array<array<int>>>>"
    rows = spark.read.text(path)
    return rows.select(F.substring_index("value", "\t", 1).alias("path"), F.from_json(F.regexp_extract("value", r"^[^\t]*\t(.*)$", 1), kind).alias("polys"))


#: Names and prices where no catalogue is given.
CATALOGUE_DEFAULT = (
    ("es teh", 5000), ("air es", 2000), ("teh hangat", 5000), ("gorengan", 2000), ("kopi", 2000), ("es jeruk", 7000), ("risoles", 2500),
    ("nasi goreng", 15000), ("snack", 15000), ("gula", 17000), ("garam", 6000), ("pulpen", 5000), ("nasi kotak", 25000), ("buku gambar", 12000),
    ("hvs a4 sidu", 55000), ("indomie", 3000), ("minyak goreng", 35000), ("beras 5kg", 68000), ("telur 1kg", 28000), ("sabun cuci", 12000),
)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE_SCHEMA).option("header", True).csv(path)


def read_vocabulary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(product_name, unit_price) of a catalogue, by the names in its header whatever their order; without one, the default list."""
    if path is None:
        return spark.createDataFrame(CATALOGUE_DEFAULT, "product_name string, unit_price int")
    return spark.read.option("header", True).csv(path).select("product_name", F.col("unit_price").cast("int").alias("unit_price"))


def read_word_index(spark: SparkSession, path: str) -> DataFrame:
    """(word, file) of a JSON object from words to lists of files."""
    raw = spark.read.option("wholetext", True).text(path)
    lists = raw.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("word", "files"))
    return lists.select("word", F.explode("files").alias("file"))


def read_word_pool(spark: SparkSession, folder: str) -> DataFrame:
    """(word, file) of a pool: its verified index, else its index, else nothing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in ("verified.json", "index.json"):
        if store.exists(spark._jvm.org.apache.hadoop.fs.Path(at, name)):
            return read_word_index(spark, f"{folder}/{name}")
    return spark.createDataFrame([], "word string, file string")


def drawn_words(texts: DataFrame, pool: DataFrame, seed: int = 0) -> DataFrame:
    """`texts` (id, text, ..) with `file`: a drawn rendering of the text's normalised form from `pool` (word, file), null where
    the pool has none; a column `file` of `texts` is replaced. The draw is settled by (seed, id); a word's files are ordered by name, so any partitioning agrees.

    Words are joined with a count of their files, then with the file of the drawn number: no word's files are gathered.
    """
    files = pool.select(F.col("word").alias("_pool"), F.col("file").alias("_file")).distinct()
    numbered = files.withColumn("_nth", F.row_number().over(Window.partitionBy("_pool").orderBy("_file")))
    many = files.groupBy(F.col("_pool").alias("_word")).agg(F.count(F.lit(1)).alias("_many"))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id").cast("string")), F.col("_many")) + 1
    asked = texts.withColumn("_word", normalise(F.col("text"))).join(many, "_word", "left").withColumn("_draw", draw)
    found = asked.join(numbered, (F.col("_word") == F.col("_pool")) & (F.col("_draw") == F.col("_nth")), "left")
    return found.select(*[c for c in texts.columns if c != "file"], F.col("_file").alias("file"))


def read_receipts(spark: SparkSession, path: str, ms: int | None = None) -> DataFrame:
    """Stored responses; `ms` overwrites their time."""
    out = spark.read.schema(RECEIPT_SCHEMA).option("multiLine", True).json(path)
    return out if ms is None else out.withColumn("ms", F.lit(ms))


def receipt_json(receipts: DataFrame) -> DataFrame:
    """(doc_id, json) of the response of each receipt."""
    items = F.transform("items", lambda i: i.dropFields("row_id"))
    total = F.struct("computed", "stated", "matches")
    return receipts.select("doc_id", F.to_json(F.struct(items.alias("items"), total.alias("total"), "warnings", "needs_review"), {"ignoreNullFields": "false"}).alias("json"))


def upload_status(length: Column, decodable: Column, has_text: Column, largest: int = LARGEST_UPLOAD) -> Column:
    """The code that an upload gets: empty, too large, undecodable, without text, in this order."""
    return F.when(length == 0, 400).when(length > largest, 413).when(~decodable, 415).when(~has_text, 422).otherwise(200)


def read_uploads(spark: SparkSession, path: str, largest: int = LARGEST_UPLOAD) -> DataFrame:
    """(path, width, height, status) of image files; pixels are not kept. A text check is left to the model tier."""
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    pages = spark.read.format("image").option("recursiveFileLookup", True).load(path).select("image.origin", "image.width", "image.height")
    both = sizes.join(pages, F.regexp_replace("path", "^file:/+", "/") == F.regexp_replace("origin", "^file:/+", "/"), "left")
    return both.select("path", "width", "height", upload_status(F.col("length"), F.coalesce(F.col("height") > 0, F.lit(False)), F.lit(True), largest).alias("status"))


def write_manifest(splits: DataFrame, path: str, seed: int, grouped_by: str = "source") -> None:
    """One JSON object a source: which split it is in, with the seed and the grouping. No task holds a split's sources."""
    splits.select(F.lit(seed).alias("seed"), F.lit(grouped_by).alias("grouped_by"), "split", "source").distinct().write.json(path)


def write_charset(characters: DataFrame, path: str) -> None:
    """Distinct characters in order, one a line."""
    characters.select("ch").orderBy("ch").coalesce(1).write.text(path)

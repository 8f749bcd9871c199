"""Sources, sinks and streams on files of a temporary folder."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import models
from ledgerlift.plans import queries as Q
from ledgerlift.sources import corpus
from ledgerlift.streaming import streams

SF = "/root/testdata/sf0.001"


def test_coco(spark, tmp_path):
    for split in ("train", "valid"):
        (tmp_path / split).mkdir()
        (tmp_path / split / "_annotations.coco.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "n1_jpg.rf.a.jpg", "width": 10, "height": 20}], "annotations": [{"id": 5, "image_id": 1, "category_id": 2, "bbox": [1, 2, 3, 4], "area": 12}], "categories": [{"id": 2, "name": "es"}]}))
    images, boxes, categories = corpus.read_coco(spark, str(tmp_path))
    assert {(r["split"], r["id"]) for r in images.collect()} == {("train", 1), ("valid", 1)}
    assert boxes.select("x", "y", "w", "h").first() == (1.0, 2.0, 3.0, 4.0) and categories.count() == 2


def test_labels(spark, tmp_path):
    df = spark.createDataFrame([("a.jpg", 'say "hi"'), ("b.jpg", "2 kg")], "path string, text string")
    corpus.write_labels(df, str(tmp_path / "l"))
    assert sorted(corpus.read_labels(spark, str(tmp_path / "l")).collect()) == sorted(df.collect())
    (tmp_path / "d.txt").write_text('p.jpg\t[{"transcription": "es", "points": [[0, 0], [1, 0], [1, 1], [0, 1]]}]\n')
    assert corpus.read_detection_labels(spark, str(tmp_path / "d.txt")).select("polys.transcription").first()[0] == ["es"]


def test_word_index_and_manifest(spark, tmp_path):
    (tmp_path / "index.json").write_text(json.dumps({"teh": ["1.png", "2.png"], "es": ["3.png"]}))
    assert corpus.read_word_index(spark, str(tmp_path / "index.json")).count() == 3
    corpus.write_manifest(spark.createDataFrame([("a", "train"), ("b", "val")], "source string, split string"), str(tmp_path / "m"), 42)
    assert sorted((r["split"], r["source"], r["seed"], r["grouped_by"]) for r in spark.read.json(str(tmp_path / "m")).collect()) == [("train", "a", 42, "source"), ("val", "b", 42, "source")]


def test_upload_status(spark):
    df = spark.createDataFrame([(0, True, True), (20_000_000, True, True), (10, False, True), (10, True, False), (10, True, True)], "n long, d boolean, t boolean")
    assert [r[0] for r in df.select(corpus.upload_status(F.col("n"), F.col("d"), F.col("t"))).collect()] == [400, 413, 415, 422, 200]


def test_recognise(spark):
    df = spark.createDataFrame([("a", bytearray(b"teh"))], "path string, content binary")
    assert models.recognise(df).first() == ("a", "teh", 1.0)


def drain(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streams(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    assert drain(spark, streams.windowed_demand(stream), "win", "complete").agg(F.sum("n")).first()[0] == events.count()
    sales = spark.createDataFrame([(1, d, 4) for d in range(10)], "sku_id long, day int, qty int")
    sales.write.parquet(str(tmp_path / "s"))
    out = drain(spark, streams.stream_ledger(spark.readStream.schema(sales.schema).parquet(str(tmp_path / "s"))), "led", "append")
    assert out.count() == 10 and out.where("closing <> opening - sold").count() == 0


def test_sessions_end_at_a_pause(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 05:00:00"), (1, "2024-01-01 12:00:00"), (2, "2024-01-01 01:00:00")]
    events = spark.createDataFrame(rows, "user_id bigint, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "e"))
    out = drain(spark, streams.sessions(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))), "runs", "complete")
    assert sorted((r["user_id"], r["n"]) for r in out.collect()) == [(1, 1), (1, 2), (2, 1)]


@pytest.mark.parametrize("counted", [True, False])
def test_receipts_whose_boxes_span_batches(spark, tmp_path, counted):
    """A stream dealt at random gives the receipts of the batch, by counts or by timers."""
    from ledgerlift.operators.receipts import extract_receipts
    from ledgerlift.plans import views as V

    boxes, docs = V.view(spark, SF, V.BOXES).where("doc_id < 16"), V.view(spark, SF, V.DOCS)
    many = boxes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_boxes"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("doc_id", "box_idx"), F.lit(1800)) + F.lit(0.123456))
    sent = boxes.join(many, "doc_id").withColumn("ts", at).withColumn("n_boxes", F.col("n_boxes") if counted else F.lit(None).cast("long"))
    for part in range(4):
        sent.where(F.pmod(F.xxhash64("box_idx", "doc_id"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "b"))
    bell = sent.limit(1).withColumn("doc_id", F.lit(10**9).cast(sent.schema["doc_id"].dataType)).withColumn("ts", F.timestamp_seconds(F.lit(1_800_000_000)))
    stream = lambda: spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "b"))

    def run():
        q = streams.stream_receipts(streams.whole_documents(stream()).drop("ts", "n_boxes"), docs, str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination(240)
        assert q.exception() is None

    run()
    if not counted:  # a late box moves the watermark past all others
        bell.coalesce(1).write.mode("append").parquet(str(tmp_path / "b"))
        run()
    flat = lambda df: sorted((r["doc_id"], str(r)) for r in df.drop("epoch").where("doc_id < 16").collect())
    want = extract_receipts(boxes, docs.where("doc_id < 16"))
    assert flat(spark.read.parquet(str(tmp_path / "out")).select(*want.columns)) == flat(want)


def test_stream_receipts(spark, tmp_path):
    from ledgerlift.plans import views as V

    boxes, docs = V.view(spark, SF, V.BOXES).where("doc_id < 200"), V.view(spark, SF, V.DOCS)
    boxes.write.parquet(str(tmp_path / "b"))
    q = streams.stream_receipts(spark.readStream.schema(boxes.schema).parquet(str(tmp_path / "b")), docs, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(180)
    assert spark.read.parquet(str(tmp_path / "out")).count() == boxes.select("doc_id").distinct().count()
    assert Q.queries()

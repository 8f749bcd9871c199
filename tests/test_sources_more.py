"""Exports read by elements, pools, vocabularies and functions of SQL text."""

import io
import json

import pytest
from pyspark.sql import functions as F

from ledgerlift.functions import geometry as G
from ledgerlift.functions.register import register_functions
from ledgerlift.plans import queries as Q
from ledgerlift.plans import views as V
from ledgerlift.sources import corpus
from ledgerlift.sources.exports import elements

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_elements_across_any_chunks(chunk):
    doc = {"info": {"images": [9], "t": 'a "]}'}, "licenses": [], "n": 12.5, "images": [{"id": i, "file_name": "é]}\\\"," * 3, "box": [1, [2]]} for i in range(20)], "annotations": [12345, "x", None], "z": None}
    for indent in (None, 2):
        raw = json.dumps(doc, indent=indent, ensure_ascii=False).encode()
        for part in ("images", "annotations", "licenses", "info", "none"):
            want = doc.get(part) if isinstance(doc.get(part), list) else []
            assert [json.loads(v) for v in elements(io.BytesIO(raw), part, chunk)] == want
    assert list(elements(io.BytesIO(b" {} "), "images", chunk)) == []
    with pytest.raises(ValueError):
        list(elements(io.BytesIO(b'{"images": [{"id": 1}, {"id"'), "images", chunk))


class Endless:
    """A stream of `n` elements that is never whole in memory."""

    def __init__(self, n):
        self.n, self.at, self.left = n, 0, b'{"images": ['

    def read(self, size):
        while len(self.left) < size and self.at < self.n:
            self.at += 1
            self.left += b'{"id": %d, "file_name": "%s"}' % (self.at, b"x" * 200) + (b"," if self.at < self.n else b"]}")
        out, self.left = self.left[:size], self.left[size:]
        return out


def test_an_export_is_held_by_chunks_only():
    import tracemalloc

    tracemalloc.start()
    assert sum(1 for _ in elements(Endless(100_000), "images", 1 << 16)) == 100_000  # 23 MB
    assert tracemalloc.get_traced_memory()[1] < 3_000_000
    tracemalloc.stop()


def test_coco_of_several_exports(spark, tmp_path):
    for k, split in enumerate(("train", "valid", "test")):
        (tmp_path / "r" / split).mkdir(parents=True)
        notes = [{"id": i, "image_id": 1, "category_id": 2, "bbox": [1, 2.5, 3, 4], "segmentation": [[0, 1]]} for i in range(5000 * k)]
        (tmp_path / "r" / split / "_annotations.coco.json").write_text(json.dumps({"categories": [{"id": 2, "name": "es"}], "annotations": notes, "images": []}))
    images, boxes, categories = corpus.read_coco(spark, str(tmp_path))
    assert images.count() == 0 and categories.count() == 3
    assert {r["split"]: r["count"] for r in boxes.groupBy("split").count().collect()} == {"valid": 5000, "test": 10000}
    assert boxes.where("y = 2.5 AND area IS NULL").count() == 15000
    (tmp_path / "none").mkdir()
    assert corpus.read_coco(spark, str(tmp_path / "none"))[1].count() == 0


def test_pool_prefers_the_verified_index(spark, tmp_path):
    assert corpus.read_word_pool(spark, str(tmp_path)).count() == 0
    (tmp_path / "index.json").write_text(json.dumps({"esteh": ["1.png", "2.png"], "kopi": ["3.png"]}))
    assert corpus.read_word_pool(spark, str(tmp_path)).count() == 3
    (tmp_path / "verified.json").write_text(json.dumps({"esteh": ["2.png", "4.png"]}))
    pool = corpus.read_word_pool(spark, str(tmp_path))
    assert sorted(r["file"] for r in pool.collect()) == ["2.png", "4.png"]
    texts = spark.createDataFrame([(i, "Es Teh!", "c") for i in range(40)] + [(99, "kopi", "c"), (100, None, "c")], "id long, text string, word string")
    got = [{r["id"]: r["file"] for r in corpus.drawn_words(texts.repartition(k), pool).collect()} for k in (1, 4)]
    assert got[0] == got[1] and len(got[0]) == 42 and got[0][99] is None and got[0][100] is None
    assert {got[0][i] for i in range(40)} == {"2.png", "4.png"}


def test_vocabulary(spark, tmp_path):
    (tmp_path / "c.csv").write_text("unit_price,product_name,more\n5000,es teh,1\n")
    assert [tuple(r) for r in corpus.read_vocabulary(spark, str(tmp_path / "c.csv")).collect()] == [("es teh", 5000)]
    assert corpus.read_vocabulary(spark).count() == 20


def test_sql_text_clusters_as_the_grid_does(spark):
    register_functions(spark)
    V.view(spark, SF, V.BOXES).where("doc_id < 400").join(V.view(spark, SF, V.DOCS), "doc_id").createOrReplaceTempView("sized_boxes")
    got = spark.sql("""
        WITH gaps AS (SELECT doc_id, greatest(sort_array(collect_list(w))[CAST(floor(count(w) / 2) AS INT)] * 0.6, max(width) * 0.02) AS gap FROM sized_boxes GROUP BY doc_id),
        points AS (SELECT s.doc_id AS key, box_idx AS idx, x + w / 2 AS v, gap FROM sized_boxes s JOIN gaps g ON s.doc_id = g.doc_id)
        SELECT key AS doc_id, idx AS box_idx, cluster AS col_id FROM cluster_1d(TABLE(points) PARTITION BY key ORDER BY (v, idx))""")
    want = Q.grid_cells(spark, SF).where("doc_id < 400").select("doc_id", "box_idx", "col_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 100


def test_page_angle_in_sql(spark):
    register_functions(spark)
    corner = lambda p: F.struct(p[0].cast("double").alias("x"), p[1].cast("double").alias("y"))
    q = spark.range(40).select((F.col("id") % 5).alias("page"), F.array(*[corner(p) for p in ((F.lit(0), F.col("id")), (F.lit(90), F.col("id") * 3), (F.lit(88), F.col("id") * 3 + 9), (F.lit(-2), F.col("id") + 9))]).alias("quad"))
    q.createOrReplaceTempView("quads")
    got = {r[0]: r[1] for r in spark.sql("SELECT page, page_angle(collect_list(quad)) FROM quads GROUP BY page").collect()}
    want = {r[0]: r[1] for r in q.groupBy("page").agg(G.page_angle(F.col("quad"))).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert spark.sql("SELECT page_angle(array())").first()[0] == 0

"""Exact deduplication by progressive refinement, in DataFrame functions only.

Three passes narrow the rows down: all rows by the length of the normalised text, those that share a length by the hash
of a prefix, those that share both by the hash of the full text. What a pass leaves over is handed to the next one as
a bit set of occupied buckets, of 2**20 to 2**27 bits by how much there is, so that at most 16 MB are broadcast; a bucket
hit by chance only costs one more hash. Text itself is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.bits import MOST_BITS, bits_of, marked
from ledgerlift.llm.common import cut_lineage, whole_text

WHITE_SPACE = r"[\x20\x09-\x0D]+"
BROADCAST_GROUPS = 1_000_000  # more groups of copies than this are joined by shuffling the rows that may be copies


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes the empty text."""
    return F.regexp_replace(whole_text(text), WHITE_SPACE, " ")


def occupied(rows: DataFrame, keys: list[str], most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """A bit set of the keys that more than one row has, and its number of bits as a power of two."""
    shared = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(*keys))
    return bits_of(shared, keys, most_bits)


def refined(docs: DataFrame, text_col: str, prefix_chars: int, most_bits: int) -> DataFrame:
    """`docs` with _size, _head and _full: the length, the prefix hash of rows that share their length (else 0), and the
    full hash of rows that share both (else the empty string). (_size, _head, _full) tells rows with different texts apart.
    """
    norm = normalised(F.col(text_col))
    sized = docs.withColumn("_norm", norm).withColumn("_size", F.length("_norm"))
    lengths = occupied(sized.select("_size"), ["_size"], most_bits)
    headed = marked(sized, ["_size"], lengths, "_near")
    headed = headed.withColumn("_head", F.when(F.col("_near"), F.xxhash64(F.substring("_norm", 1, prefix_chars))).otherwise(F.lit(0)))
    heads = occupied(headed.where("_near").select("_size", "_head"), ["_size", "_head"], most_bits)
    closer = marked(headed, ["_size", "_head"], heads, "_nearer")
    full = F.when(F.col("_near") & F.col("_nearer"), F.sha2(F.col("_norm").cast("binary"), 256)).otherwise(F.lit(""))
    return closer.withColumn("_full", full).drop("_near", "_nearer")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, most_bits: int = MOST_BITS, digest_all: bool = False) -> DataFrame:
    """One row per row of `docs`: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal if they are identical after `normalised`. The row with the smallest doc_id of a group stays.
    text_sha256 is the lowercase hex SHA-256 of the normalised text; rows that no other row can equal have none unless
    `digest_all` asks for it as output. Null texts are empty texts and equal one another. Rows that repeat a doc_id
    with the same text count towards group_size and all carry that doc_id's decision. A null doc_id is never smallest
    unless its group has no other. An empty table gives an empty result; other columns are not looked at.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.sha2(F.col("_norm").cast("binary"), 256) if digest_all else F.nullif(F.col("_full"), F.lit(""))
    keyed = cut_lineage(refined(base, "text", prefix_chars, most_bits).select("doc_id", "_size", "_head", "_full", digest.alias("text_sha256")))
    kept = keyed.groupBy("_size", "_head", "_full").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Written out, so that the join deals both sides anew and a hot group of copies can be split among tasks.
    joined = keyed.join(cut_lineage(kept), ["_size", "_head", "_full"])
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, most_bits: int = MOST_BITS, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """`docs`, all columns, with one row of each group of equal texts: the one with the smallest doc_id.

    Of rows that repeat that doc_id and the text one stays, whichever; a null doc_id stays only if its group has no other;
    null texts are empty texts. An empty table gives an empty result. Text passes through: it is in no shuffle, unless
    there are more than `broadcast_groups` groups of copies, when the rows that may be copies are joined by their hash, or
    rows that repeat a doc_id with its text, which alone are then brought together.
    """
    rows = refined(docs, text_col, prefix_chars, most_bits).drop("_norm").withColumn("_full", F.nullif(F.col("_full"), F.lit("")))
    narrow = rows.where("_full IS NOT NULL").groupBy("_full", F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_n").alias("n"))).alias("first")
    groups = narrow.groupBy("_full").agg(first, F.sum("_n").alias("rows")).where("rows > 1")
    groups = cut_lineage(groups.select("_full", F.col("first.id").alias("_keep_id"), (F.col("first.n") > 1).alias("_twice")))
    facts = groups.agg(F.count(F.lit(1)).alias("n"), F.max("_twice").alias("twice")).first()
    known = F.broadcast(groups) if facts["n"] <= broadcast_groups else groups
    parts = [rows.join(known, "_full", "left")] if facts["n"] <= broadcast_groups else [rows.where("_full IS NOT NULL").join(known, "_full", "left"), rows.where("_full IS NULL").withColumns({"_keep_id": F.lit(None), "_twice": F.lit(None)})]
    left = None
    for part in parts:
        part = part.where(F.col("_twice").isNull() | F.col(id_col).eqNullSafe(F.col("_keep_id"))).select(*[F.col(c) for c in docs.columns], "_full", "_twice")
        left = part if left is None else left.unionByName(part)
    if not facts["twice"]:
        return left.select(*docs.columns)
    single = left.where("_twice").dropDuplicates(["_full"])
    return left.where("_twice IS NULL OR NOT _twice").unionByName(single).select(*docs.columns)

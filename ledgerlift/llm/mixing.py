"""Mixing sources to target weights by weighted fair queueing.

Each source's documents queue in a shuffled order. A document's virtual finish time is what its source has served up to its
end, divided by the source's target; all queues are merged by that time, and the mix ends where the total budget is used up.
Only DataFrame functions are used. A source of any size is dealt by ranges: cumulative sizes come from running sums over the
whole table, so neither a source nor the merged order is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import written
from ledgerlift.operators.ranks import running

WEIGHTS, MOST, SEED = (1, 2, 3), 3, "mix"
WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what counts as a word


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, source_end, source_rank, target) of sizes (source, source_size), a row for each source.

    Sources by code point, null last, take `weights` in turn and share the total of all sizes by them; a target stops at
    `most` times its source's size, and the excess is shared again by weight until none is above. That is a common level:
    each target is the lesser of its cap and level x weight. source_end: the sizes of the sources up to this one.
    """
    ranked = running(sizes, [F.col("source").asc_nulls_last()], {"source_rank": F.lit(1), "source_end": F.col("source_size")})
    turn = ((F.col("source_rank") - 1) % len(weights) + 1).cast("int")
    ranked = written(ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long")).withColumn("cap", most * F.col("source_size")))
    # by cap / weight: the first source whose cap is not below the level that those before it leave, sets the level
    fill = F.col("cap") / F.col("weight")
    filled = running(ranked.select("source_rank", "cap", "weight", fill.alias("fill")), [F.col("fill"), F.col("source_rank")], {"caps": F.col("cap"), "weights": F.col("weight")})
    total = ranked.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("all_weights"))
    left = (F.col("total") - (F.col("caps") - F.col("cap"))) / (F.col("all_weights") - (F.col("weights") - F.col("weight")))
    level = filled.crossJoin(F.broadcast(total)).select(left.alias("level"), "fill").where("level <= fill").agg(F.max("level").alias("level"))  # one row each
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return ranked.crossJoin(F.broadcast(level)).select("source", "source_size", "source_end", "source_rank", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for each row of `docs`.

    size is the number of words (what ASCII white space separates) of the whole text; target is the words that the mix
    should take from the row's source (`source_targets`); copies, 0 to `most`, is how often it takes the document; taken
    is size x copies. Each source's queue is its documents by MD5 of seed and doc_id, then once more and so on until
    `most`; the merged order is by finish time, sources in their order among equal ones, and is cut where the total of all
    sizes is used up. Per source, taken misses the target by less than the documents that stand at the cut.

    A null text and one of white space have size 0 and are never taken (copies 0). A null source is a source, the last one.
    Rows without a doc_id queue as equal ids do; rows that repeat a doc_id queue each on their own. No result depends on the
    order of rows or on partitions. An empty table gives an empty result; other columns are not looked at.
    """
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")))
    sources = written(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    named = sources.withColumnRenamed("source", "_source")
    queued = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    queued = queued.withColumn("place", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    queue = [F.col(c) for c in ("source_rank", "place", "doc_id", "size")]
    placed = running(queued, queue, {"served": F.col("size")}).drop("place")
    placed = written(placed.withColumn("served", F.col("served") - (F.col("source_end") - F.col("source_size"))))

    def finish(turn):
        """The virtual finish time of a document's copy in the given turn, and the source's rank: the merged order."""
        return (F.col("served") + turn * F.col("source_size")) / F.nullif(F.col("target"), F.lit(0.0))

    turns = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn")
    copies = placed.where("size > 0 AND target > 0").select("size", "source_rank", "served", "source_size", "target", turns)
    copies = copies.select(finish(F.col("turn")).alias("finish"), "source_rank", "size")
    merged = running(copies, [F.col("finish"), F.col("source_rank")], {"used": F.col("size")})
    budget = sources.agg(F.sum("source_size").alias("budget"))  # one row, as is the cut
    cut = merged.crossJoin(F.broadcast(budget)).where("used <= budget").agg(F.max(F.struct("finish", "source_rank")).alias("cut"))
    within = [(F.struct(finish(F.lit(turn)).alias("finish"), F.col("source_rank")) <= F.col("cut")).cast("int") for turn in range(most)]
    taken = sum((F.coalesce(w, F.lit(0)) for w in within[1:]), F.coalesce(within[0], F.lit(0)))
    counted = placed.crossJoin(F.broadcast(cut)).withColumn("copies", F.when(F.col("size") > 0, taken).otherwise(0))
    return counted.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS place FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS source_rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, (source_rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / ((source_rank - 1) % 3 + 1) AS fill FROM sources
), filled AS (
  SELECT fill, CAST(sum(source_size) OVER () - (sum(cap) OVER w - cap) AS DOUBLE) / CAST(sum(weight) OVER () - (sum(weight) OVER w - weight) AS DOUBLE) AS level
  FROM weighed WINDOW w AS (ORDER BY fill, source_rank ROWS UNBOUNDED PRECEDING)
), targets AS (
  SELECT source, source_rank, source_size, least(CAST(cap AS DOUBLE), (SELECT max(level) FROM filled WHERE level <= fill) * weight) AS target FROM weighed
), queued AS (
  SELECT sized.doc_id, size, source_rank, source_size, target,
    sum(size) OVER (PARTITION BY source_rank ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS served
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), copies AS (
  SELECT size, source_rank, CAST(served + turn * source_size AS DOUBLE) / target AS finish
  FROM queued, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0 AND target > 0
), merged AS (
  SELECT finish, source_rank, sum(size) OVER (ORDER BY finish, source_rank ROWS UNBOUNDED PRECEDING) AS used FROM copies
), cut AS (
  SELECT finish AS cut_finish, source_rank AS cut_rank FROM merged
  WHERE used <= (SELECT sum(source_size) FROM sources) ORDER BY finish DESC, source_rank DESC LIMIT 1
), counted AS (
  SELECT queued.*, list_sum(list_transform([0, 1, 2], lambda turn: CASE WHEN size = 0 OR target = 0 THEN 0
    WHEN CAST(served + turn * source_size AS DOUBLE) / target < cut_finish THEN 1
    WHEN CAST(served + turn * source_size AS DOUBLE) / target = cut_finish AND source_rank <= cut_rank THEN 1 ELSE 0 END)) AS n
  FROM queued LEFT JOIN cut ON true
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * n AS BIGINT) AS taken FROM counted
"""

"""URL filtering by a cascade of Bloom filters that is exact over the corpus's keys.

Level 0 encodes the listed keys. Level 1 encodes those other keys of the universe that level 0 wrongly lets through,
level 2 the listed keys that level 1 wrongly lets through, and so on until a level lets nothing through wrongly. A key of
the universe is then judged by the first level that lacks it, without a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.bits import BITMAP
from ledgerlift.llm.common import cut_lineage

#: Fixed values: (verdict, host, path start). The longest rule that fits decides.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: The default block list; a key stands for its host and all subdomains.
LISTED_HOSTS = ("casino-win.example.com", "cheap-pills.example.com", "free-bets.example.com")
LISTED_DIGITS = "0123"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: `bits` bits, `hashes` probes a key, seeded by its place in the cascade."""

    seed: int
    bits: int
    hashes: int
    data: bytes = b""

    def places(self, key: str) -> list[int]:
        value = xxhash.xxh128_intdigest(key.encode("utf-8", "surrogatepass"), self.seed)
        first, step = value >> 64, (value & 0xFFFFFFFFFFFFFFFF) | 1
        return [(first + i * step) % self.bits for i in range(self.hashes)]

    def has(self, key: str) -> bool:
        return all(self.data[place >> 3] >> (place & 7) & 1 for place in self.places(key))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...] = field(default_factory=tuple)

    def has(self, key: str) -> bool:
        """Whether the key is listed; exact for keys of the universe that the cascade was built over."""
        for place, level in enumerate(self.levels):
            if not level.has(key):
                return place % 2 == 1
        return len(self.levels) % 2 == 1


def _level(keys: DataFrame, count: int, seed: int, bits_per_key: int, max_bits: int) -> Level:
    """Set the bits of all keys: positions are made in tasks, Spark joins them to bitmaps of 4 KB, max_bits / 8 bytes return."""
    bits = min(max_bits, max(64, bits_per_key * count))
    shape = Level(seed, bits, max(1, round(bits / count * math.log(2))) if count else 1)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"bit": np.array([p for key in batch["key"] for p in shape.places(key)], dtype=np.int64)})

    at = keys.mapInPandas(places, "bit long").groupBy(F.expr(f"bit div {BITMAP}").alias("block"))
    data = bytearray(-(-bits // BITMAP) * BITMAP // 8)
    for row in at.agg(F.bitmap_construct_agg(F.col("bit") % BITMAP).alias("bitmap")).collect():  # at most max_bits / BITMAP rows
        data[row["block"] * BITMAP // 8 : (row["block"] + 1) * BITMAP // 8] = row["bitmap"]
    return Level(seed, bits, shape.hashes, bytes(data))


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 10, max_bits: int = 2**27, max_levels: int = 64) -> Cascade:
    """The cascade for the keys of `listed` over those of `universe` (one string column `key` each; nulls are left out).

    A filter has bits_per_key bits a key but never more than max_bits, the bound of what is broadcast; fuller filters
    let more through wrongly, which the next levels mend. Empty inputs give a cascade that lists nothing.
    """
    keys = cut_lineage(listed.select("key").where("key is not null").distinct())
    others = universe.select("key").where("key is not null").distinct().join(keys, "key", "left_anti")
    others = cut_lineage(others)
    levels: list[Level] = []
    inside, outside = keys, others  # inside: to be encoded by this level; outside: to be tested against it
    while (count := inside.count()) and len(levels) < max_levels:
        level = _level(inside, count, len(levels), bits_per_key, max_bits)
        levels.append(level)
        passed = _passing(outside, level)
        inside, outside = cut_lineage(passed), inside
    if count:
        raise RuntimeError("the cascade did not end; give it more bits")
    return Cascade(tuple(levels))


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[shared.value.has(key) for key in batch["key"]]]

    return keys.select("key").mapInPandas(test, "key string")


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty for null or no '://'."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to '?', '#' or the end; empty for null or no '://'."""
    at = F.instr(url, "://")
    path = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, path).otherwise(F.lit(""))


def rule_columns(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def suffixes(host: str) -> list[str]:
    """The host and its parent domains."""
    parts = host.split(".")
    return [".".join(parts[i:]) for i in range(len(parts))]


def listed_hosts(pages: DataFrame, url_col: str = "url", digits: str = LISTED_DIGITS) -> DataFrame:
    """(key): LISTED_HOSTS, and the hosts of `pages` whose MD5 starts with one of `digits`: a list that grows with the table."""
    hosts = pages.select(host_of(F.col(url_col)).alias("key")).where("key <> ''").distinct()
    named = pages.sparkSession.createDataFrame([(key,) for key in LISTED_HOSTS], "key string")
    return hosts.where(F.substring(F.md5(F.col("key").cast("binary")), 1, 1).isin(*digits)).unionAll(named)


def filter_urls(pages: DataFrame, listed: DataFrame | Iterable[str] = LISTED_HOSTS, rules: Iterable[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", bits_per_key: int = 10, max_bits: int = 2**27) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of `pages`.

    The longest rule that fits decides; else the cascade does: block if the host or a parent domain is listed, allow if
    not. The universe of keys is every host of the table with its parent domains. Null and malformed urls have an empty
    host and path, fit no rule and are allowed unless the empty key is listed. Repeated rows are judged alike; an empty
    table gives an empty result; other columns are not looked at.
    """
    spark = pages.sparkSession
    if not isinstance(listed, DataFrame):
        listed = spark.createDataFrame([(key,) for key in listed], "key string")
    split = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    parents = F.expr(r"transform(sequence(1, size(split(host, '[.]'))), n -> substring_index(host, '.', -n))")
    universe = split.select("host").distinct().select(F.explode(parents).alias("key"))
    shared = spark.sparkContext.broadcast(build_cascade(listed, universe, bits_per_key, max_bits))

    @F.pandas_udf("string")
    def judged(hosts: pd.Series) -> pd.Series:
        cascade = shared.value
        known = {host: "block" if any(map(cascade.has, suffixes(host))) else "allow" for host in set(hosts)}
        return hosts.map(known)

    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return split.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, judged("host")).alias("verdict"))


ORACLE_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts
), listed AS (
  SELECT host AS key FROM parts WHERE host <> '' AND substr(md5(host), 1, 1) IN ({", ".join(f"'{d}'" for d in LISTED_DIGITS)})
  UNION SELECT unnest([{", ".join(f"'{h}'" for h in LISTED_HOSTS)}])
), suffixes AS (
  SELECT host, array_to_string(string_split(host, '.')[n:], '.') AS key
  FROM (SELECT host, unnest(range(1, len(string_split(host, '.')) + 1)) AS n FROM (SELECT DISTINCT host FROM parts))
), bad AS (SELECT DISTINCT host FROM suffixes WHERE key IN (SELECT key FROM listed))
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN host IN (SELECT host FROM bad) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

"""Op 5, sharding by extendible hashing (DataFrame functions only).

Every row has a 60-bit key hash.  A shard is a hash prefix of some depth: the
directory starts with one shard of depth 0, and only a shard over the byte
limit splits on its next bit.  The final directory depends only on the byte
sums per prefix, so it is computed from one grouped table of prefix sums
instead of by moving rows at every split:

1. bytes and rows per fine prefix (a few bits deeper than the average shard
   needs), pre-aggregated before the shuffle;
2. sums of all ancestors of the fine prefixes;
3. a prefix is a shard when it fits the limit and its parent does not;
4. fine prefixes that are still too large are refined with further bits, and
   only their rows are read into the next round.

A document larger than the limit gets a shard of its own, marked
``over_limit``: rows are not cut.  Repeated rows (same id and text) are counted
as copies and numbered, and the number is part of the key, so a group of copies
that holds a third of all rows spreads over shards like other rows.  Null ids
and null texts are values like others (a null text has 0 bytes).  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.session import scratch_path

HASH_BITS = 60
DEFAULT_LIMIT = 1 << 20
EXTRA_BITS = 6


def key_hash(*parts: Column) -> Column:
    """The first 60 bits of an md5 over the parts, as a non-negative long."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(depth) -> Column:
    return F.expr(f"shiftright(h, {HASH_BITS} - {depth})")


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_bytes, copy, h) for every input row."""
    text = F.col(text_col).cast("string")
    grouped = (df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                         F.md5(F.coalesce(text, F.lit("~"))).alias("digest"))
                 .groupBy("doc_id", "n_bytes", "digest").agg(F.count(F.lit(1)).alias("copies")))
    return (grouped.select("doc_id", "n_bytes", "digest", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
                   .select("doc_id", "n_bytes", "copy", key_hash(F.col("doc_id"), F.col("digest"), F.col("copy")).alias("h")))


def _leaves(fine: DataFrame, low: int, depth: int, limit: int) -> DataFrame:
    """Shards among the prefixes of depths ``low``..``depth``, from sums at
    ``depth``.  All of them lie under an oversized (or the root) prefix of
    depth ``low`` - 1."""
    every = (fine.select("n_bytes", "n_rows", "h0", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth"))
                 .withColumn("prefix", F.expr(f"shiftright(h0, {depth} - depth)"))
                 .groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows")))
    fits = (F.col("n_bytes") <= limit) | (F.col("n_rows") == 1)
    parent = every.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), fits.alias("up_fits"))
    return (every.withColumn("up", F.expr("shiftright(prefix, 1)"))
                 .join(parent, ["depth", "up"], "left")
                 .withColumn("fits", fits)
                 .where(~F.coalesce("up_fits", F.lit(False)))
                 .where(F.col("fits") | (F.col("depth") == depth))
                 .select("depth", "prefix", "n_bytes", "n_rows", "fits"))


def assign(df: DataFrame, limit: int = DEFAULT_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its shard (``depth``, ``prefix``), the shard's
    bytes and rows, and whether a single row is over the limit."""
    spark = df.sparkSession
    path = scratch_path(spark, "shard-keys")
    _rows(df, id_col, text_col).write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    todo, low = rows, 0
    depth = min(HASH_BITS, max(0, math.ceil(math.log2(max(total, 1) / limit))) + EXTRA_BITS if total > limit else 0)
    done = None
    while True:
        fine = (todo.withColumn("h0", _prefix(depth)).groupBy("h0")
                    .agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows")))
        found = scratch_path(spark, "shard-directory")
        _leaves(fine, low, depth, limit).write.parquet(found)
        leaves = spark.read.parquet(found)
        settled = leaves if depth == HASH_BITS else leaves.where("fits")
        part = _attach(todo, settled, low, depth)
        done = part if done is None else done.unionByName(part)
        if depth == HASH_BITS or leaves.where("not fits").isEmpty():
            break
        # only the rows of buckets that are still too large go on
        heavy = leaves.where("not fits").select(F.col("prefix").alias("h0"))
        todo = todo.withColumn("h0", _prefix(depth)).join(heavy, "h0", "left_semi").drop("h0")
        low, depth = depth + 1, min(HASH_BITS, depth + 8)
    return done.select("doc_id", "n_bytes", "depth", "prefix",
                       F.concat_ws("-", F.lpad(F.col("depth").cast("string"), 2, "0"), F.lpad(F.hex("prefix"), 15, "0")).alias("shard_id"),
                       "shard_bytes", "shard_rows", (F.col("shard_bytes") > limit).alias("over_limit"))


def _attach(rows: DataFrame, leaves: DataFrame, low: int, depth: int) -> DataFrame:
    """Directory lookup: slot (prefix at the deepest depth) to shard.  Shards
    are expanded to the slots that exist, so the lookup is one equi-join whose
    key is spread evenly by the hash."""
    slots = rows.select(_prefix(depth).alias("slot")).distinct()
    ranked = (slots.select("slot", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth"))
                   .withColumn("prefix", F.expr(f"shiftright(slot, {depth} - depth)"))
                   .join(leaves.select("depth", "prefix", F.col("n_bytes").alias("shard_bytes"),
                                       F.col("n_rows").alias("shard_rows")), ["depth", "prefix"]))
    return rows.withColumn("slot", _prefix(depth)).join(ranked, "slot").drop("slot", "h", "copy")


def directory(assigned: DataFrame) -> DataFrame:
    """The directory: one row per shard."""
    return assigned.select("shard_id", "depth", "prefix", "shard_bytes", "shard_rows", "over_limit").distinct()


def oracle_sql(limit: int = DEFAULT_LIMIT) -> str:
    """DuckDB SQL for :func:`assign` over ``documents`` (all 60 depths)."""
    return f"""
WITH rows0 AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes, md5(coalesce(text, '~')) AS digest,
         row_number() OVER (PARTITION BY doc_id, md5(coalesce(text, '~'))) AS copy
  FROM documents),
keyed AS (
  SELECT doc_id, n_bytes,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || digest || '|' || CAST(copy AS VARCHAR)), 1, 15)) AS BIGINT) AS h
  FROM rows0),
nodes AS (
  SELECT CAST(d AS INTEGER) AS depth, h >> CAST({HASH_BITS} - d AS INTEGER) AS prefix, sum(n_bytes) AS b, count(*) AS n
  FROM keyed, range(0, 61) t(d) GROUP BY 1, 2),
leaf AS (
  SELECT c.depth, c.prefix, CAST(c.b AS BIGINT) AS b, c.n FROM nodes c
  LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.prefix = c.prefix >> 1
  WHERE (c.b <= {limit} OR c.n = 1 OR c.depth = {HASH_BITS})
    AND (p.depth IS NULL OR (p.b > {limit} AND p.n > 1)))
SELECT k.doc_id, k.n_bytes, l.depth, l.prefix,
       lpad(CAST(l.depth AS VARCHAR), 2, '0') || '-' || lpad(upper(to_hex(l.prefix)), 15, '0') AS shard_id,
       l.b AS shard_bytes, CAST(l.n AS BIGINT) AS shard_rows, l.b > {limit} AS over_limit
FROM keyed k JOIN leaf l ON l.prefix = k.h >> ({HASH_BITS} - l.depth)
"""

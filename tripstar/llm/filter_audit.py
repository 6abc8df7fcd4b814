"""Op 11, filter interaction audit with wide packed counters.

Which documents does a filter remove that no other filter would have removed,
and how does that depend on the order of the filters?  For every order of the
filters and every step of it, the audit counts what is kept, what the step
removes, what it would have removed had it not gone before, and which labelled
documents the step costs.

1. Every document becomes a *mask*: one bit for each filter that it fails, and
   one for each label.  The bits of the text filters are column expressions.
   The duplicate bit ("an earlier document has this text") follows from counts
   per (text digest, part, mask): the copies of a text are merged before they
   are shuffled, and no document is joined to its copies.
2. The masks are counted per part: at most ``2 ** (filters + 2)`` rows a part,
   whatever the part's share of the table.
3. Every mask stands for one big integer.  It has a field of ``FIELD_BITS`` bits
   for each outcome of each step of each order (5 filters: 600 steps), holding
   1 where a document with this mask has that outcome.  The integers of a part,
   times the counts, are added up, and the sum is unpacked.  A field never
   exceeds the number of documents of the part, which Spark counts in 63 bits,
   so no field overflows into the next.

Defined results: a null text is the empty text; a null part is the empty string,
one part with the rows whose part is empty.  Equal texts are told by SHA-256.  A
row with a null id has no smaller id and is no smaller id: it never fails the
duplicate filter and has no label.  Rows that repeat an id with the same text are
no copies of each other; each row counts.  Labels of one id are united (1 if any
row says 1).  Very long texts are read whole.  Bytes that are not UTF-8 count as
Spark decodes them (one replacement character each).  An empty table has no
parts and gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELD_BITS = 64
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))

# The thresholds of the text filters.
MIN_WORDS = 50
MIN_DISTINCT_PCT = 65
MAX_UPPER_PCT = 5
SYMBOLS = "[#$%&*|]"
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Maximal runs outside white space."""
    return F.array_remove(F.split(text, SPACES), "")


# Filter letter -> its failure condition on the text.
TEXT_FILTERS: dict[str, Callable[[Column], Column]] = {
    "A": lambda t: F.size(words(t)) < MIN_WORDS,
    "B": lambda t: F.size(F.array_distinct(words(t))) * 100 < F.size(words(t)) * MIN_DISTINCT_PCT,
    "C": lambda t: F.char_length(F.regexp_replace(t, "[^A-Z]+", "")) * 100 > F.char_length(t) * MAX_UPPER_PCT,
    "D": lambda t: t.rlike(SYMBOLS),
}
DUPLICATE = "E"


def _bit(condition: Column, place: int) -> Column:
    return F.when(condition, 1 << place).otherwise(0)


def masks(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]] | None = None,
          id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n): documents of each part by the filters they fail.

    Bit k of the mask is the k-th text filter; then the duplicate filter, good
    (``quality`` = 1) and toxic (``toxic`` = 1)."""
    filters = TEXT_FILTERS if filters is None else filters
    k = len(filters)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mask = F.lit(0)
    for place, fails in enumerate(filters.values()):
        mask = mask + _bit(fails(text), place)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), mask.alias("mask"))
    rows = rows.groupBy("_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))

    said = (labels.select(F.col(id_col).cast("long").alias("_id"),
                          F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
                          F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
                  .where("_id IS NOT NULL AND (good OR toxic)")
                  .groupBy("_id").agg((_bit(F.bool_or("good"), k + 1) + _bit(F.bool_or("toxic"), k + 2)).alias("said")))
    rows = rows.join(said, "_id", "left").withColumn("mask", F.col("mask") + F.coalesce("said", F.lit(0)))

    # The copies of a text, merged: how many, the smallest id, and the rows with
    # that id.  An id has one row here for each (part, digest, mask).
    merged = rows.groupBy("digest", "part", "mask").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("_id").isNotNull(), F.col("n"))), F.lit(0)).alias("n_id"),
        F.min("_id").alias("low"), F.min_by("n", "_id").alias("n_low"))
    # The smallest id of a text over all parts.  A text has few rows left here:
    # a part's copies differ in their labels only.
    first = merged.withColumn("first", F.expr("min(low) OVER (PARTITION BY digest)"))
    late = F.col("n_id") - F.when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0)
    counted = first.select("part", F.explode(F.array(
        F.struct((F.col("mask") + (1 << k)).alias("mask"), late.alias("n")),
        F.struct(F.col("mask"), (F.col("n") - late).alias("n")))).alias("c")).select("part", "c.*").where("n > 0")
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"))


def outcomes(letters: str, mask: int) -> np.ndarray:
    """What happens to one document with this mask: an array of 0 and 1 by
    (order, step, outcome)."""
    k = len(letters)
    fails = [bool(mask >> i & 1) for i in range(k)]
    good, toxic = bool(mask >> k & 1), bool(mask >> (k + 1) & 1)
    out = np.zeros((len(list(permutations(letters))), k, len(OUTCOMES)), dtype=np.uint8)
    for o, order in enumerate(permutations(range(k))):
        there = True
        for step, f in enumerate(order):
            removed = there and fails[f]
            redundant = fails[f] and not there
            there = there and not fails[f]
            out[o, step] = (there, removed, redundant, fails[f] and sum(fails) == 1, removed and good, removed and toxic)
    return out


def packed(letters: str, mask: int) -> int:
    """The outcomes of a mask as one integer, a field of FIELD_BITS each."""
    fields = outcomes(letters, mask).reshape(-1).astype("<u8")
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(letters: str, total: int) -> np.ndarray:
    """The fields of a sum of packed integers, by (order, step, outcome)."""
    k = len(letters)
    n_orders = len(list(permutations(letters)))
    n_fields = n_orders * k * len(OUTCOMES)
    raw = total.to_bytes(n_fields * FIELD_BITS // 8, "little")
    return np.frombuffer(raw, "<u8").astype(np.int64).reshape(n_orders, k, len(OUTCOMES))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]] | None = None,
          duplicate: str = DUPLICATE, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per (part, filter_order, step) with the counts of ``SCHEMA``."""
    letters = "".join(TEXT_FILTERS if filters is None else filters) + duplicate
    counts = masks(docs, labels, filters, id_col, text_col, part_col)
    # a bounded list a part: one entry for each mask that occurs in it
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n")).alias("masks"))
    return parts.mapInArrow(_steps(letters), SCHEMA)


def _steps(letters: str):
    def run(batches):
        orders = list(permutations(letters))
        names = [o for o in map("".join, orders) for _ in letters]
        letter = np.array([[letters.index(f) for f in o] for o in orders])
        steps = np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders))
        table: dict[int, int] = {}  # mask -> integer, at most 2 ** (filters + 2)
        for batch in batches:
            for part, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = 0
                for row in seen:
                    mask = row["mask"]
                    if mask not in table:
                        table[mask] = packed(letters, mask)
                    total += row["n"] * table[mask]
                got = unpacked(letters, total)
                removed = got[:, :, OUTCOMES.index("removed")]
                shapley = np.zeros(len(letters), dtype=np.int64)
                np.add.at(shapley, letter.ravel(), removed.ravel())
                columns = [got[:, :, j].ravel() for j in range(len(OUTCOMES))] + [shapley[letter].ravel()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(names)), pa.array(names), pa.array(steps), *map(pa.array, columns)],
                    names=["part", "filter_order", "step", *OUTCOMES, "shapley"])

    return run


def oracle_sql() -> str:
    """The same counts in DuckDB, step by step and without packing."""
    letters = "".join(TEXT_FILTERS) + DUPLICATE
    bits = "".join(f"CASE position('{f}' IN filter_order) WHEN step THEN 1 ELSE 0 END * fail_{f} + " for f in letters) + "0"
    before = " OR ".join(f"(position('{f}' IN filter_order) < step AND fail_{f} = 1)" for f in letters)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
said AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
firsts AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
f AS (
  SELECT d.part, coalesce(said.good, 0) AS good, coalesce(said.toxic, 0) AS toxic,
         CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END AS fail_A,
         CASE WHEN 100 * len(list_distinct(w)) < {MIN_DISTINCT_PCT} * len(w) THEN 1 ELSE 0 END AS fail_B,
         CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > {MAX_UPPER_PCT} * length(d.t) THEN 1 ELSE 0 END AS fail_C,
         CASE WHEN regexp_matches(d.t, '{SYMBOLS}') THEN 1 ELSE 0 END AS fail_D,
         CASE WHEN d.doc_id > firsts.low THEN 1 ELSE 0 END AS fail_E
  FROM d JOIN firsts ON d.t = firsts.t LEFT JOIN said ON d.doc_id = said.doc_id),
classes AS (
  SELECT part, good, toxic, fail_A, fail_B, fail_C, fail_D, fail_E, count(*) AS n
  FROM f GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || e.l || g.l AS filter_order
  FROM letter a, letter b, letter c, letter e, letter g
  WHERE len(list_distinct([a.l, b.l, c.l, e.l, g.l])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
seen AS (
  SELECT part, filter_order, step, n, good, toxic, {bits} AS fails,
         fail_A + fail_B + fail_C + fail_D + fail_E AS all_fails, ({before}) AS gone
  FROM classes, steps),
counted AS (
  SELECT part, filter_order, step,
         sum(CASE WHEN fails = 0 AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails = 1 AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails = 1 AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = 1 AND all_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails = 1 AND NOT gone AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails = 1 AND NOT gone AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM counted
"""

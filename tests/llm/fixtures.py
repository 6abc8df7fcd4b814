"""Small inputs shared by the operator tests: nulls, empty and long texts,
copies, ties, repeated rows, and columns named like the operators' own."""

import random

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def documents(sf=SF, columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def mixed_rows(seed=3, n=60):
    """Texts put together from shared passages, with null ids, null and empty
    texts, repeated ids and repeated rows."""
    pick = random.Random(seed)
    passages = ["the quick brown fox jumps over the lazy dog and runs " * 2, "a" * 120, "xyz" * 40, "é" * 60,
                "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do ", "\n", "b", ""]
    rows = []
    for i in range(n):
        text = "".join(pick.choices(passages + [f"{pick.random()} "], k=pick.randint(0, 6)))
        rows.append((pick.choice([None, i, i, i, 5]), pick.choice([text] * 6 + [None, ""])))
    return rows + rows[:5]


def frame(spark, rows, parts=4):
    """A frame with clashing extra columns, over several partitions."""
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("doc_id", "text", "1 AS part", "'x' AS row", "array(1) AS rest", "2 AS label", "'s' AS spans",
                         "3 AS h", "0.5D AS score", "4 AS bucket").repartition(parts)


def key_sorted(rows):
    return sorted(map(tuple, rows), key=repr)


needs_data = pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="test data not present")

"""Landing and the raw-data gate.

The gate turns the pre-load checks into a report DataFrame with a
``severity`` per check: ``fail`` stops the load, ``warn`` is reported and the
load goes on, ``pass`` is fine.  :func:`check_source` looks at the source
before anything is written: that it exists, that no file is empty, the file
names, and that every column of every file can be read.  :func:`land_checked`
lands only what passed, and compares the copy's rows with the source's.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JError

from tripstar.session import staged_table
from tripstar.sources.files import exists
from tripstar.sources.sinks import write_table

# Gate thresholds.
MIN_ROWS = 500_000
MIN_COLUMNS = 8
DTYPES_LOGGED = 5
SAMPLE_ROWS = 100_000
SAMPLE_SEED = 42

GATE_SCHEMA = "check string, observed long, threshold long, severity string, detail string"


def month_path(base: str, year: int, month: int) -> str:
    """Where a month lies: ``base/year=2024/month=01``."""
    return f"{base.rstrip('/')}/year={int(year):04d}/month={int(month):02d}"


def land_raw(df: DataFrame, base: str, year: int, month: int) -> str:
    """Write raw trips to the month's folder, replacing only that month."""
    return write_table(df, month_path(base, year, month), overwrite="static")


def read_landed(spark: SparkSession, base: str) -> DataFrame:
    """Read landed months with ``year``/``month`` kept as columns."""
    return spark.read.option("basePath", base).parquet(base)


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, GATE_SCHEMA)


def _readable_rows(spark: SparkSession, path: str) -> int:
    """Rows of the files under a path, with every column of every row decoded
    (an aggregate over all columns cannot be answered from footers).  Raises if
    any page of any file cannot be read."""
    df = spark.read.option("ignoreCorruptFiles", "false").option("ignoreMissingFiles", "false").parquet(path)
    touched = F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return int(df.agg(F.count(F.lit(1)).alias("n"), touched.alias("x")).first()["n"])


def check_source(spark: SparkSession, path: str) -> DataFrame:
    """The files exist, none is empty, they are Parquet by name, and
    all of them can be read.  Failing checks are rows with severity ``fail``."""
    if not exists(spark, path):
        return _rows(spark, [("exists", 0, 1, "fail", "no such path")])
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                  .load(path).select("path", "length"))
    listing = files.agg(F.count(F.lit(1)).alias("n"),
                        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                        F.count_if(~F.col("path").endswith(".parquet")).alias("other")).first()
    read, size, other = (int(listing[k]) for k in ("n", "bytes", "other"))
    n = len(files.inputFiles())  # the listing; a scan leaves out files without a byte
    empty = n - read
    checks = [("exists", n, 1, "pass" if n > 0 else "fail", "data files found"),
              ("empty_files", empty, 0, "pass" if empty == 0 and n else "fail", f"{size / (1024 * 1024):.2f} MB in all"),
              ("non_parquet_files", other, 0, "pass" if other == 0 else "warn",
               "expected .parquet files")]
    if n:
        try:
            checks.append(("readable", _readable_rows(spark, path), 1, "pass", "rows read, every column"))
        except (PySparkException, Py4JError) as exc:
            checks.append(("readable", 0, 1, "fail", type(exc).__name__))
    return _rows(spark, checks)


def check_copy(spark: SparkSession, path: str, source_rows: int) -> DataFrame:
    """The landed copy passes the file checks and has the source's rows."""
    report = check_source(spark, path)
    got = report.where("check = 'readable'").agg(F.coalesce(F.max("observed"), F.lit(0)).alias("n"))
    rows = got.select(F.lit("rows_landed").alias("check"), F.col("n").alias("observed"),
                      F.lit(int(source_rows)).cast("long").alias("threshold"),
                      F.when(F.col("n") == source_rows, "pass").otherwise("fail").alias("severity"),
                      F.lit("rows of the copy against the source").alias("detail"))
    return report.unionByName(rows)


def gate_raw(df: DataFrame, min_rows: int = MIN_ROWS, min_columns: int = MIN_COLUMNS) -> DataFrame:
    """Row and column counts against thresholds (below ->
    ``warn``), and the first five column types as detail."""
    n_cols = len(df.columns)
    dtypes = ", ".join(f"{name}:{dtype}" for name, dtype in df.dtypes[:DTYPES_LOGGED])
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    rows = F.array(
        F.struct(F.lit("row_count").alias("check"), F.col("n").alias("observed"),
                 F.lit(min_rows).cast("long").alias("threshold"),
                 F.when(F.col("n") >= min_rows, "pass").otherwise("warn").alias("severity"),
                 F.lit("rows in the raw data").alias("detail")),
        F.struct(F.lit("column_count").alias("check"), F.lit(n_cols).cast("long").alias("observed"),
                 F.lit(min_columns).cast("long").alias("threshold"),
                 F.lit("pass" if n_cols >= min_columns else "warn").alias("severity"),
                 F.lit(dtypes).alias("detail")),
    )
    return counted.select(F.explode(rows).alias("_r")).select("_r.*")


def gate_passed(report: DataFrame) -> bool:
    """The load may go on unless a check failed."""
    return report.where(F.col("severity") == "fail").isEmpty()


def land_checked(spark: SparkSession, src: str, base: str, year: int, month: int) -> tuple[bool, list[DataFrame]]:
    """Check the source, land it only if no check failed, check the copy.
    Returns whether all went well, and the reports."""
    source = check_source(spark, src)
    reports = [source]
    if not gate_passed(source):
        return False, reports
    df = spark.read.parquet(src)
    reports.append(gate_raw(df))
    if not gate_passed(reports[-1]):
        return False, reports
    rows = source.where("check = 'readable'").first()["observed"]
    reports.append(check_copy(spark, land_raw(df, base, year, month), rows))
    return gate_passed(reports[-1]), reports


def sample_n(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED,
             oversample: float = 1.2) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen uniformly at random.

    Equal rows are counted first and dealt again by their copy number, so each
    row has a key of its own: a seeded hash of its values and that number.  The
    key is the same on every run and after any recomputation, unlike ``rand()``
    over a shuffled input, and copies of a row are drawn independently.  Rows
    whose key is below a threshold a little above ``n / rows`` survive a
    distributed filter, and only those ~n are ordered to cut exactly n.
    """
    columns = df.columns
    total = df.count()
    if total <= n:
        return df
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    key = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], F.col("_copy")), F.lit(2 ** 53)) / F.lit(float(2 ** 53))
    keyed = (counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
                    .withColumn("_key", key))
    frac = min(1.0, oversample * n / total + 10.0 / total)
    while True:
        # written once: the grouping of all rows runs for this write only
        picked = staged_table(keyed.where(F.col("_key") < F.lit(frac)).select(*columns, "_key"), "sample")
        if frac >= 1.0 or picked.count() >= n:
            break
        frac = min(1.0, frac * 1.5)
    return picked.orderBy("_key").limit(n).select(*columns)

from tripstar import cli
from tripstar.session import scratch_path
from tripstar.sources.tables import raw_trips


def test_jobs_chain(spark, sf_small):
    src = scratch_path(spark, "src")
    raw_trips(spark, sf_small).write.parquet(src)
    raw_base = scratch_path(spark, "raw")
    wh = scratch_path(spark, "wh")
    out = scratch_path(spark, "out")
    # the gate warns (fewer than 500,000 rows) but does not fail
    assert cli.main(["ingest", "--src", src, "--raw-base", raw_base], spark=spark) == 0
    leaf = f"{raw_base}/year=2024/month=01"
    assert cli.main(["etl", "--raw", leaf, "--out", wh], spark=spark) == 0
    assert cli.main(["analytics", "--warehouse", wh, "--out", out], spark=spark) == 0
    assert cli.main(["profile", "--raw", leaf, "--out", out + "/profile"], spark=spark) == 0
    q1 = spark.read.option("header", True).csv(f"{out}/q1_hour_weekday_volume_fare")
    assert q1.count() == 168
    issues = spark.read.option("header", True).csv(f"{out}/profile/issues")
    assert issues.count() == 7


def test_ingest_without_a_source_lands_nothing(spark, tmp_path):
    assert cli.main(["ingest", "--src", str(tmp_path / "nope"), "--raw-base", str(tmp_path / "raw")], spark=spark) == 1
    assert not (tmp_path / "raw").exists()

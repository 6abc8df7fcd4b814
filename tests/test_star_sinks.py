from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import frame, trip
from tripstar.operators import clean, extensions, star
from tripstar.plans import analytics
from tripstar.plans.etl import FEW_MONTHS, read_warehouse, run_etl, stage
from tripstar.session import scratch_path, staged_table
from tripstar.sources.files import list_names, remove_tree, swap_in
from tripstar.sources import landing, sinks


def test_payment_labels(spark):
    rows = [trip(minute=i, payment=code) for i, code in enumerate([None, 1, 2, 3, 4, 5, 6, 7])]
    dim = star.dim_payment(clean.finish(clean.prepare(frame(spark, rows))))
    got = {r["payment_type"]: r["payment_desc"] for r in dim.collect()}
    assert got == {0: "Other", 1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute",
                   5: "Unknown", 6: "Voided", 7: "Other"}


def _two_months(spark):
    jan = [trip(minute=i * 61, fare=10.0 + i) for i in range(3)]
    feb = [trip(minute=31 * 24 * 60 + i * 61, fare=20.0 + i) for i in range(3)]
    return frame(spark, jan), frame(spark, feb)


def test_parity_keys_are_refused_beside_another_load(spark):
    jan, feb = _two_months(spark)
    out = scratch_path(spark, "parity")
    run_etl(spark, jan, out, keys="parity", load_month=202401)
    run_etl(spark, jan, out, keys="parity", load_month=202401)  # the same load again
    with pytest.raises(ValueError, match="other loads"):
        run_etl(spark, feb, out, keys="parity", load_month=202402)
    assert read_warehouse(spark, out)["fact_trips"].count() == 3


@pytest.mark.parametrize("order", [(0, 1), (1, 0), (0, 1, 0), (1, 0, 1)])
def test_loads_do_not_touch_each_other(spark, order):
    """Each file has a stray pickup of the other month and a NULL pickup; the
    session is left at Spark's default overwrite mode."""
    day = 24 * 60
    files = [[trip(minute=i * 61, fare=10.0 + i) for i in range(5)]
             + [trip(minute=31 * day + 61, fare=30.0), trip(minute=7, fare=31.0, pickup_null=True)],
             [trip(minute=31 * day + i * 61, fare=20.0 + i) for i in range(5)]
             + [trip(minute=61, fare=40.0), trip(minute=9, fare=41.0, pickup_null=True)]]
    out = scratch_path(spark, "loads")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for k in order:
            result = run_etl(spark, frame(spark, files[k]), out, load_month=202401 + k)
            assert {r["severity"] for r in result.load_check.collect()} == {"pass"}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    t = read_warehouse(spark, out)
    assert sorted(r["fare_amount_clean"] for r in t["fact_trips"].collect()) == sorted(r[5] for f in files for r in f)
    q1 = analytics.q1_hour_weekday_volume_fare(t["fact_trips"], t["dim_datetime"])
    assert q1.agg(F.sum("trip_count")).first()[0] == 12
    assert t["dim_datetime"].select("datetime_key").distinct().count() == t["dim_datetime"].count()


def _warehouse_rows(spark, out):
    return sorted(map(repr, read_warehouse(spark, out)["fact_trips"].collect()))


def test_a_staged_file_is_loaded_again_without_its_raw_rows(spark):
    """Two loads of one staged file give what two loads of the file give, copies included."""
    rows = [trip(minute=i * 61, fare=10.0 + i) for i in range(5)] + [trip(minute=7, fare=31.0, pickup_null=True)]
    src, base = scratch_path(spark, "file"), scratch_path(spark, "staged")
    frame(spark, rows + rows[:2]).write.parquet(src)
    raw, by_file, by_stage = spark.read.parquet(src), scratch_path(spark, "loads"), scratch_path(spark, "loads")
    for _ in range(2):
        run_etl(spark, raw, by_file, load_month=202401)
    staged = stage(spark, raw, base)
    assert staged.counts == {"raw": 8, "copies": 8, "distinct": 6}
    remove_tree(spark, src)
    for _ in range(2):
        got = {r["check"]: r["observed"] for r in run_etl(spark, staged, by_stage, load_month=202401).load_check.collect()}
        assert sorted(got.values()) == [6, 8]
    assert _warehouse_rows(spark, by_stage) == _warehouse_rows(spark, by_file)


@pytest.mark.parametrize("months", [1, FEW_MONTHS, FEW_MONTHS + 2])
def test_a_fact_of_few_months_is_written_without_a_shuffle(spark, monkeypatch, months):
    asked = {}
    put = sinks.write_table
    monkeypatch.setattr("tripstar.plans.etl.write_table", lambda df, path, *a, **k: (
        asked.__setitem__(path.rpartition("/")[2], k.get("rebalance", True)), put(df, path, *a, **k))[1])
    rows = [trip(minute=m * 31 * 24 * 60 + i, fare=10.0 + i) for m in range(months) for i in range(3)]
    out = scratch_path(spark, "months")
    run_etl(spark, frame(spark, rows + [trip(minute=3, fare=1.0, pickup_null=True)]), out)
    assert asked["fact_trips"] == (months > FEW_MONTHS)
    fact = read_warehouse(spark, out)["fact_trips"]
    assert fact.count() == 3 * months + 1 and fact.select(*star.PARTITION_COLUMNS).distinct().count() == months + 1


def test_a_load_that_loses_rows_is_reported(spark):
    jan, _ = _two_months(spark)
    staged = clean.prepare(jan, keep_copies=True)
    got = {r["check"]: r["severity"] for r in star.check_load(jan, staged, jan.limit(2), clean.COPIES).collect()}
    assert sorted(got.values()) == ["fail", "pass"]
    got = star.check_load(jan.union(jan), staged, jan, clean.COPIES).collect()
    assert [r["severity"] for r in got] == ["fail", "pass"]


def test_parity_keys_number_hours_from_one(spark):
    jan, _ = _two_months(spark)
    dim = star.dim_datetime(clean.finish(clean.prepare(jan)), keys="parity")
    assert sorted(r["datetime_key"] for r in dim.collect()) == [1, 2, 3]


def test_dynamic_overwrite_keeps_other_months(spark):
    jan, feb = _two_months(spark)
    base = scratch_path(spark, "landing")
    landing.land_raw(jan, base, 2024, 1)
    landing.land_raw(feb, base, 2024, 2)
    landing.land_raw(jan.limit(1), base, 2024, 1)   # reload January only
    got = landing.read_landed(spark, base).groupBy("month").count().orderBy("month").collect()
    assert [(r["month"], r["count"]) for r in got] == [(1, 1), (2, 3)]


def _severity(report):
    return {r["check"]: r["severity"] for r in report.collect()}


def test_landing_check_and_gate(spark):
    jan, _ = _two_months(spark)
    base = scratch_path(spark, "landing")
    leaf = landing.land_raw(jan, base, 2024, 1)
    assert leaf.endswith("/year=2024/month=01")
    assert set(_severity(landing.check_copy(spark, leaf, 3)).values()) == {"pass"}
    assert _severity(landing.check_copy(spark, leaf, 4))["rows_landed"] == "fail"
    assert _severity(landing.check_source(spark, base + "/nope")) == {"exists": "fail"}
    gate = {r["check"]: r for r in landing.gate_raw(jan).collect()}
    assert gate["row_count"]["severity"] == "warn" and gate["row_count"]["observed"] == 3
    assert gate["column_count"]["severity"] == "pass"
    assert landing.gate_passed(landing.gate_raw(jan))


def _files(folder):
    return sorted(p for p in Path(folder).rglob("*.parquet"))


@pytest.mark.parametrize("damage", ["junk", "pages", "empty"])
def test_damaged_source_is_not_landed(spark, tmp_path, damage):
    src, base = tmp_path / "src", tmp_path / "lake"
    spark.range(200_000).selectExpr("id", "cast(id * 7 as string) AS s").repartition(6).write.parquet(str(src))
    good = [r["observed"] for r in landing.check_source(spark, str(src)).collect() if r["check"] == "readable"]
    assert good == [200_000]
    victim = _files(src)[3]
    data = bytearray(victim.read_bytes())
    if damage == "junk":
        victim.write_bytes(b"not a parquet file at all" * 10)
    elif damage == "pages":
        data[4:len(data) // 2] = bytes(len(data) // 2 - 4)
        victim.write_bytes(bytes(data))
    else:
        victim.write_bytes(b"")
    for crc in src.glob(".*.crc"):
        crc.unlink()
    passed, reports = landing.land_checked(spark, str(src), str(base), 2024, 1)
    assert not passed and not base.exists()
    bad = {k for k, v in _severity(reports[-1]).items() if v == "fail"}
    assert bad == ({"empty_files"} if damage == "empty" else {"readable"}) or "empty_files" in bad


def test_sample_is_exact_size(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    s = landing.sample_n(df, n=700, seed=7)
    assert s.count() == 700 and s.distinct().count() == 700
    assert landing.sample_n(df, n=10_000).count() == 5000


def test_sample_draws_copies_one_by_one(spark):
    df = spark.range(10).selectExpr("id AS x", "explode(sequence(1, 100)) AS _").select("x")
    got = {r["x"]: r["count"] for r in landing.sample_n(df, n=100).groupBy("x").count().collect()}
    assert sum(got.values()) == 100 and len(got) == 10 and max(got.values()) < 30


def test_etl_end_to_end(spark, sf_small):
    from tripstar.sources.tables import raw_trips
    out = scratch_path(spark, "etl")
    result = run_etl(spark, raw_trips(spark, sf_small), out)
    t = read_warehouse(spark, out)
    v = {(r["table_name"], r["key_column"]): r for r in result.validation.collect()}
    assert v[("raw", None)]["row_count"] == 6057
    assert v[("fact_trips", "datetime_key")]["row_count"] == 5998
    assert t["dim_datetime"].count() == 743
    # fact rows with a key = rows whose hour is in the dimension
    keyed = t["fact_trips"].where(F.col("datetime_key").isNotNull()).count()
    assert keyed + v[("fact_trips", "datetime_key")]["null_count"] == 5998


def test_forward_fill_matches_ordered_fill(spark):
    import pandas as pd
    rows = []
    for i in range(300):
        vendor = 1 if i % 3 else 2
        rows.append(trip(minute=i, vendor=vendor, fare=float(i), pickup_null=(i % 4 == 0)))
    df = frame(spark, rows)
    got = extensions.forward_fill(df, slices=7).toPandas()
    pdf = df.toPandas().sort_values(["VendorID", "tpep_dropoff_datetime"])
    pdf["want"] = pdf.groupby("VendorID")["tpep_pickup_datetime"].ffill()
    merged = got.merge(pdf[["fare_amount", "want"]], on="fare_amount")
    assert len(merged) == 300
    assert ((merged["pickup_filled"] == merged["want"]) | (merged["want"].isna() & merged["pickup_filled"].isna())).all()


@pytest.mark.parametrize("slices", [1, 64, 300])
def test_forward_fill_of_null_vendors(spark, slices):
    rows = [trip(minute=i, vendor=None if i % 2 else 1, fare=float(i), pickup_null=i % 3 > 0) for i in range(200)]
    got = {r["fare_amount"]: r["pickup_filled"] for r in
           extensions.forward_fill(frame(spark, rows), slices=slices).collect()}
    for start in (0, 1):
        last = None
        for i in range(start, 200, 2):
            last = rows[i][1] or last
            assert got[float(i)] == last, i


def test_mode_ties_go_to_the_smallest_value(spark):
    rows = [trip(minute=i, vendor=v, payment=p) for i, (v, p) in enumerate(
        [(10, 3), (9, 3), (10, 1), (9, 1), (None, None), (2, None)])]
    got = extensions.impute_mode(frame(spark, rows)).where("minute(tpep_pickup_datetime) = 4").first()
    assert got["VendorID"] == 9 and got["payment_type"] == 1


def test_views_for_adhoc_sql(spark, sf_small):
    from tripstar.plans.etl import register_views
    from tripstar.plans.warehouse import warehouse
    register_views(warehouse(spark, sf_small))
    n = spark.sql("SELECT COUNT(*) FROM fact_trips f JOIN dim_datetime d USING (datetime_key)").first()[0]
    assert n == spark.sql("SELECT COUNT(*) FROM fact_trips WHERE datetime_key IS NOT NULL").first()[0]


def test_warehouse_invariants(spark, sf_small):
    from tripstar.plans.warehouse import warehouse
    t = warehouse(spark, sf_small)
    fact = t["fact_trips"]
    q1 = analytics.q1_hour_weekday_volume_fare(fact, t["dim_datetime"])
    keyed = fact.where(F.col("datetime_key").isNotNull()).count()
    assert q1.agg(F.sum("trip_count")).first()[0] == keyed
    row = fact.agg(
        F.min("passenger_count_clean").alias("min_pass"),
        F.count_if(F.col("trip_distance_clean").isNull() | F.col("fare_amount_clean").isNull()
                   | F.col("tip_amount_clean").isNull() | F.col("trip_duration_minutes").isNull()).alias("nulls"),
        F.max("trip_distance_clean").alias("max_dist")).first()
    assert row["min_pass"] >= 1 and row["nulls"] == 0
    # the cap is the p99 of the raw distance
    from tripstar.operators import clean
    from tripstar.sources.tables import raw_trips
    stats = clean.global_stats(clean.clean_tip(clean.clean_passengers(clean.clean_fare(
        clean.prepare(raw_trips(spark, sf_small)),
        clean.fare_bin_medians(clean.prepare(raw_trips(spark, sf_small))))))).first()
    assert row["max_dist"] <= stats["p99_distance"]


def _fact_rows(spark, out):
    return sorted(map(str, read_warehouse(spark, out)["fact_trips"].collect()))


def test_a_load_that_fails_its_check_leaves_the_former_rows(spark, monkeypatch):
    """Rows lost on the way stop the job before readers see anything of the load."""
    from tripstar.plans import etl
    jan, feb = _two_months(spark)
    out = scratch_path(spark, "publish")
    run_etl(spark, jan, out, load_month=202401)
    run_etl(spark, feb, out, load_month=202402)
    before, names = _fact_rows(spark, out), sorted(list_names(spark, out))
    whole = etl.star.fact_trips
    monkeypatch.setattr(etl.star, "fact_trips", lambda *a, **k: whole(*a, **k).limit(1))
    with pytest.raises(etl.LoadFailed):
        run_etl(spark, jan.union(feb), out, load_month=202401)
    assert _fact_rows(spark, out) == before
    assert sorted(list_names(spark, out)) == names  # no half-written folder is left
    monkeypatch.undo()
    run_etl(spark, jan.union(feb), out, load_month=202401)
    assert len(_fact_rows(spark, out)) > len(before)


def test_folders_are_back_when_a_rename_fails(spark, tmp_path):
    new, place = tmp_path / "new", tmp_path / "place"
    for folder, text in ((new / "a", "new"), (place / "a", "old"), (place / "b", "old")):
        folder.mkdir(parents=True)
        (folder / "x").write_text(text)
    with pytest.raises(OSError):
        swap_in(spark, [(str(new / "a"), str(place / "a")), (str(new / "missing"), str(place / "b"))], str(tmp_path / "aside"))
    assert [(place / n / "x").read_text() for n in "ab"] == ["old", "old"] and (new / "a" / "x").read_text() == "new"


def test_a_load_reads_no_fact_row_of_other_loads(spark, tmp_path):
    """With the other load's fact files unreadable, a load still gives the
    dimensions and the validation of both."""
    jan, feb = _two_months(spark)
    out = str(tmp_path / "warehouse")
    run_etl(spark, jan, out, load_month=202401)
    for f in _files(f"{out}/fact_trips/load_month=202401"):
        f.write_bytes(b"not parquet")
    result = run_etl(spark, feb, out, load_month=202402)
    got = {(r["table_name"], r["key_column"]): r["row_count"] for r in result.validation.collect()}
    assert got["fact_trips", "datetime_key"] == 6 and got["raw", None] == 3
    # a load written without a summary is summarised from its fact
    again = str(tmp_path / "older")
    run_etl(spark, jan, again, load_month=202401)
    remove_tree(spark, f"{again}/_fact_summary")
    result = run_etl(spark, feb, again, load_month=202402)
    assert {r["row_count"] for r in result.validation.collect() if r["table_name"] == "fact_trips"} == {6}


def test_etl_leaves_no_scratch_folder_and_scans_once(spark, sf_small):
    from tripstar.session import work_dir
    from tripstar.sources.tables import raw_trips
    out = scratch_path(spark, "etl")
    before = set(list_names(spark, f"{work_dir(spark)}/tripstar"))
    run_etl(spark, raw_trips(spark, sf_small), out)
    assert set(list_names(spark, f"{work_dir(spark)}/tripstar")) - before == {out.rsplit("/", 1)[1]}
    assert not [n for n in list_names(spark, out) if n.startswith("_new")]


def test_statistics_from_counted_values_equal_those_of_the_rows(spark, sf_small):
    from tripstar.sources.tables import raw_trips
    staged = staged_table(clean.prepare(raw_trips(spark, sf_small)), "staged")
    values = staged_table(clean.value_counts(staged), "values")
    medians = staged_table(clean.medians_of_values(values), "medians")
    plain = clean.fare_bin_medians(staged)
    assert sorted(map(str, medians.collect())) == sorted(map(str, plain.collect()))
    rows = clean.global_stats(clean.clean_tip(clean.clean_passengers(clean.clean_fare(staged, plain)))).first()
    assert clean.stats_of_values(values, medians).first() == rows


def _saves(monkeypatch, spark):
    """(open files, plan) of each write from here on."""
    from pyspark.sql import DataFrameWriter
    seen, save = [], DataFrameWriter.save

    def spy(self, *args, **kwargs):
        seen.append((int(spark.conf.get(sinks.WRITERS)), self._df._jdf.queryExecution().optimizedPlan().toString()))
        return save(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", spy)
    return seen


def test_partitioned_write_does_not_sort_its_rows(spark, tmp_path, monkeypatch):
    seen, before = _saves(monkeypatch, spark), spark.conf.get(sinks.WRITERS)
    df = spark.range(3_000).selectExpr("id", "IF(id % 31 = 0, NULL, id % 30) AS k")  # more partitions than open files
    sinks.write_table(df, str(tmp_path / "t"), ["k"])
    got = spark.read.parquet(str(tmp_path / "t")).select("id", "k")
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert [n for n, _ in seen] == [sinks.OPEN_FILES] and spark.conf.get(sinks.WRITERS) == before


def test_rewriting_a_partitioned_table_does_not_shuffle_it(spark, sf_small, monkeypatch):
    from tripstar.plans import registry
    registry._prepared(spark, sf_small)
    seen = _saves(monkeypatch, spark)
    rows = registry.queries()["dynamic_overwrite"](spark, sf_small)
    assert ["RebalancePartitions" in plan for _, plan in seen] == [True, False, False]
    assert rows.count() == registry._prepared(spark, sf_small).count()

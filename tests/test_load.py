from __future__ import annotations

import dataclasses
import datetime as dt
import json
import random
import re

import pytest
from conftest import PLAIN, TESTDATA, dicts
from pyspark.sql import functions as F

from tripmill import SavedTables, Settings, TripTables
from tripmill import schema as layouts
from tripmill.__main__ import main
from tripmill.operators import additive, clean, patterns, profile, quality, sketches, zones
from tripmill.plans import catalog, compaction, contract, load, staging
from tripmill.plans.tables import ROLLUPS
from tripmill.sources import store
from tripmill.sources.trips import open_trips, read_trips
from tripmill.streaming import incremental
from tripmill.streaming.incremental import load_new_files

SETTINGS = Settings(home="Home", min_od_trips=1, min_pair_trips=1, min_airport_trips=1)


@pytest.fixture
def month_file(spark, tmp_path):
    """Write one raw file of a month, with the plain trip changed as wanted."""
    folder = tmp_path / "raw"
    folder.mkdir()

    def write(month: int, *rows: dict) -> str:
        start = dt.datetime(2025, month, 3, 9)
        times = {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=12)}
        values = [tuple({**PLAIN, **times, **row}[n] for n in layouts.RAW_TRIPS.names) for row in rows]
        frame = spark.createDataFrame(values, layouts.RAW_TRIPS).toPandas()
        path = folder / f"trips_2025-{month:02d}.parquet"
        import pyarrow as pa
        import pyarrow.parquet as pq

        kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string(), "timestamp_ntz": pa.timestamp("us")}
        fields = [(f.name, kinds[f.dataType.simpleString()]) for f in layouts.RAW_TRIPS]
        pq.write_table(pa.Table.from_pandas(frame, pa.schema(fields), preserve_index=False), path)
        return str(path)

    write.folder = str(folder)
    return write


def test_load_of_files(spark, locations, tmp_path, month_file):
    month_file(1, {}, {"fare_amount": 600.0}, {"PULocationID": 9})
    month_file(2, {}, {}, {"RatecodeID": None})
    month_file(3, *[{}] * 4, {"passenger_count": None})
    raw = read_trips(spark, f"{month_file.folder}/trips_2025-*.parquet")
    target = str(tmp_path / "tables")
    t = load.load(spark, raw, locations, target, SETTINGS)

    assert t.fact_trip.count() == 5
    assert {r["source_period"] for r in dicts(t.fact_trip.select("source_period"))} == {"2025-01", "2025-03"}
    assert t.fact_trip.select("trip_id").distinct().count() == 5
    audit = {r["source_file"][-10:-8]: r for r in dicts(t.load_audit)}
    assert {k: r["status"] for k, r in audit.items()} == {"01": "loaded", "02": "rejected", "03": "loaded"}
    assert {k: r["file_no"] for k, r in audit.items()} == {"01": 0, "02": None, "03": 1}
    for r in audit.values():
        if r["status"] == "loaded":
            assert r["loaded_trips"] + r["filtered_trips"] == r["original_trips"]
    assert clean.audit_totals(t.load_audit).first()["filtered_trips"] == 3
    counts = {r["table_name"]: r["row_count"] for r in dicts(quality.table_counts(t))}
    assert counts["fact_trip"] == 5
    assert counts["dim_location"] == 6
    assert {r["violations"] for r in dicts(quality.contract_violations(t))} == {0}
    for name in ("mv_zone_pickup", "mv_zone_dropoff", "mv_od_flows", "mv_hourly_demand", "mv_vendor_performance"):
        column = {"mv_zone_pickup": "pickup_count", "mv_zone_dropoff": "dropoff_count"}.get(name, "trip_count")
        assert getattr(t, name).agg(F.sum(column)).first()[0] == 5

    # A second load changes nothing; one of fewer files leaves nothing of the first behind.
    before = sorted(map(repr, t.fact_trip.collect()))
    again = load.load(spark, raw, locations, target, SETTINGS)
    assert sorted(map(repr, again.fact_trip.collect())) == before
    fewer = load.load(spark, read_trips(spark, f"{month_file.folder}/trips_2025-01.parquet"), locations, target, SETTINGS)
    assert fewer.fact_trip.count() == 1
    assert fewer.mv_vendor_performance.first()["trip_count"] == 1
    assert fewer.load_audit.count() == 1


def test_files_of_different_types(spark, month_file, tmp_path):
    first = month_file(1, {})
    second = str(tmp_path / "other_2025-02.parquet")
    spark.read.parquet(first).select(
        *[F.col(c).cast("bigint").alias(c) if c in ("VendorID", "passenger_count") else c for c in layouts.RAW_TRIPS.names]
    ).drop("airport_fee").write.parquet(second)
    raw = read_trips(spark, first, second)
    assert raw.schema.simpleString() == layouts.RAW_TRIPS.simpleString()[:-1] + ",source_file:string,source_row:bigint>"
    assert raw.count() == 2
    assert raw.filter("airport_fee IS NULL").count() == 1
    with pytest.raises(ValueError):
        read_trips(spark)


def test_filters_reach_the_files(spark, locations, month_file):
    raw = read_trips(spark, month_file(1, {}))
    plan = clean.clean_trips(raw, locations.select("location_id"))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("GreaterThan(fare_amount,0.0)", "LessThan(trip_distance,200.0)", "LessThanOrEqual(passenger_count,6.0)"):
        assert part in pushed


def stream(spark, locations, tmp_path, folder, checkpoint="checkpoint"):
    target = str(tmp_path / "tables")
    query = load_new_files(spark, folder, locations, target, str(tmp_path / checkpoint), SETTINGS)
    query.awaitTermination(300)
    assert query.exception() is None
    load.refresh_rollups(spark, target, SETTINGS)
    return SavedTables(spark, target, settings=SETTINGS)


def test_incremental_load(spark, locations, tmp_path, month_file):
    month_file(1, {}, {}, {"fare_amount": 0.0})
    t = stream(spark, locations, tmp_path, month_file.folder)
    assert t.fact_trip.count() == 2

    month_file(2, {})
    month_file(3, {}, {"RatecodeID": None})
    t = stream(spark, locations, tmp_path, month_file.folder)
    assert t.fact_trip.count() == 3
    assert t.fact_trip.select("trip_id").distinct().count() == 3
    assert sorted(r["status"] for r in dicts(t.load_audit)) == ["loaded", "loaded", "rejected"]
    assert sorted(r["file_no"] for r in dicts(t.load_audit) if r["file_no"] is not None) == [0, 1]
    assert t.mv_vendor_performance.first()["trip_count"] == 3

    t = stream(spark, locations, tmp_path, month_file.folder)
    assert t.fact_trip.count() == 3


def test_repeated_batch_replaces_itself(spark, locations, tmp_path, month_file):
    target = str(tmp_path / "tables")
    load.write_dimensions(spark, locations, target)
    raw = read_trips(spark, month_file(1, {}, {}))
    load.load_trips(spark, raw, target, SETTINGS, "a-1")
    load.load_trips(spark, read_trips(spark, month_file(2, {})), target, SETTINGS, "a-2")
    load.load_trips(spark, raw, target, SETTINGS, "a-1")
    t = SavedTables(spark, target, settings=SETTINGS)
    assert t.fact_trip.count() == 3
    assert t.load_audit.count() == 2


def test_bulk_load_then_stream(spark, locations, tmp_path, month_file):
    month_file(1, {}, {})
    month_file(2, {})
    load.load(spark, read_trips(spark, month_file.folder), locations, str(tmp_path / "tables"), SETTINGS)
    t = stream(spark, locations, tmp_path, month_file.folder)
    assert t.fact_trip.count() == 3
    month_file(3, {})
    t = stream(spark, locations, tmp_path, month_file.folder)
    assert t.fact_trip.count() == t.fact_trip.select("trip_id").distinct().count() == 4
    assert sorted(r["file_no"] for r in dicts(t.load_audit)) == [0, 1, 2]


def test_second_checkpoint_adds(spark, locations, tmp_path, month_file):
    """Two streams, or one whose checkpoint was lost, into one set of tables."""
    month_file(1, {}, {}, {})
    stream(spark, locations, tmp_path, month_file.folder, "first")
    spark.read.parquet(f"{month_file.folder}/trips_2025-01.parquet").limit(2).coalesce(1).write.parquet(
        f"{month_file.folder}/more"
    )
    month_file(2, {})
    t = stream(spark, locations, tmp_path, month_file.folder, "second")
    assert t.fact_trip.count() == t.fact_trip.select("trip_id").distinct().count() == 6
    assert t.load_audit.count() == 3


def test_load_that_broke_off(spark, locations, tmp_path, month_file):
    """Trips without an audit are not part of the table, and their files are loaded again."""
    month_file(1, {})
    stream(spark, locations, tmp_path, month_file.folder, "first")
    month_file(2, {}, {})
    target = str(tmp_path / "tables")
    load.load_trips(spark, read_trips(spark, f"{month_file.folder}/trips_2025-02.parquet"), target, SETTINGS, "lost-0")
    import shutil

    shutil.rmtree(f"{target}/load_audit/load_batch=lost-0")
    assert SavedTables(spark, target, settings=SETTINGS).fact_trip.count() == 1
    t = stream(spark, locations, tmp_path, month_file.folder, "first")
    assert t.fact_trip.count() == t.fact_trip.select("trip_id").distinct().count() == 3


@pytest.mark.parametrize("incremental", [False, True])
def test_files_that_differ_or_are_broken(spark, locations, tmp_path, month_file, incremental):
    first = month_file(1, {})
    spark.read.parquet(first).withColumn("passenger_count", F.col("passenger_count").cast("bigint")).drop(
        "airport_fee"
    ).coalesce(1).write.parquet(f"{month_file.folder}/old")
    month_file(2, {"airport_fee": 1.75})
    with open(f"{month_file.folder}/trips_2025-03.parquet", "w") as broken:
        broken.write("no parquet at all")
    if incremental:
        t = stream(spark, locations, tmp_path, month_file.folder)
    else:
        found = open_trips(spark, month_file.folder)
        assert len(found.unreadable) == 1
        t = load.load(spark, found.raw, locations, str(tmp_path / "tables"), SETTINGS, found.unreadable)
    assert sorted(r["airport_fee"] or -1 for r in dicts(t.fact_trip)) == [-1, 0.0, 1.75] or sorted(
        str(r["airport_fee"]) for r in dicts(t.fact_trip)
    ) == ["0.0", "1.75", "None"]
    assert sorted(r["status"] for r in dicts(t.load_audit)) == ["loaded", "loaded", "loaded", "rejected"]
    assert {r["passenger_count"] for r in dicts(t.fact_trip)} == {1}


def test_fares_are_not_rounded(spark, locations, tmp_path, month_file):
    raw = read_trips(spark, month_file(1, {"fare_amount": 10.00004}, {"fare_amount": 10.00004}, {"tip_amount": float("inf")}))
    t = load.load(spark, raw, locations, str(tmp_path / "tables"), SETTINGS)
    assert t.mv_zone_pickup.first()["median_fare"] == 10.00004
    assert t.load_audit.first()["filtered_trips"] == 1


def test_stored_layout_and_plan(spark, locations, tmp_path, month_file):
    raw = read_trips(spark, month_file(1, {}))
    t = load.load(spark, raw, locations, str(tmp_path / "tables"), SETTINGS)
    assert t.fact_trip.schema["source_period"].dataType.simpleString() == "string"
    for report in (zones.activity_by_hour(t), patterns.hourly_since(t)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        filters = re.search(r"fact_trip.*?PartitionFilters: \[(.*?)\], PushedFilters", plan.replace("\n", " "))
        assert filters and "pickup_month" in filters[1], plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        files = t.load_audit.filter("file_no IS NOT NULL")
        plan = clean.accepted(raw, files)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning" not in plan


def test_long_results_come_out_whole(spark, tmp_path, month_file, capsys):
    zones_file = tmp_path / "zones.csv"
    zones_file.write_text('"LocationID","Borough","Zone","service_zone"\n1,"Home","A","Yellow"\n2,"Unknown","N/A","N/A"\n')
    month_file(1, *[{"fare_amount": 5 + k / 100} for k in range(30)])
    arguments = ["--trips", month_file.folder, "--zones", str(zones_file), "--out", str(tmp_path / "out")]
    main(["--home", "Home", "profile", "profile_borough_distribution", *arguments])
    assert {r["borough"]: r["count"] for r in dicts(spark.read.parquet(str(tmp_path / "out")))} == {"Home": 1, "Unknown": 1}
    main(["--home", "Home", "profile", "profile_preview", *arguments[:4], "--json", "--rows", "4"])
    printed = capsys.readouterr()
    assert len(printed.out.strip().splitlines()) == 4
    assert "first 4 rows" in printed.err


def test_preview_takes_the_earliest_trips_of_all_files(spark, locations, month_file):
    early = dt.datetime(2024, 12, 31, 23, 59)
    month_file(1, *[{}] * 4)
    month_file(2, {}, {}, {}, {"tpep_pickup_datetime": early, "fare_amount": 7.0})
    raw = read_trips(spark, f"{month_file.folder}/trips_2025-*.parquet")
    rows = dicts(profile.preview(TripTables(spark, locations, raw), 2))
    assert [r["tpep_pickup_datetime"] for r in rows] == [early, dt.datetime(2025, 1, 3, 9)]
    assert rows[0]["fare_amount"] == 7.0


def test_listed_files_are_not_opened_again(spark, locations, tmp_path, month_file, monkeypatch):
    opened = []

    def note(session, *paths, **options):
        opened.append(sorted(p[-10:-8] for p in paths))
        return open_trips(session, *paths, **options)

    monkeypatch.setattr(incremental, "open_trips", note)
    target = str(tmp_path / "tables")

    def arrive(checkpoint: str) -> None:
        query = load_new_files(spark, month_file.folder, locations, target, str(tmp_path / checkpoint), SETTINGS)
        query.awaitTermination()
        assert query.exception() is None

    month_file(1, {})
    arrive("one")
    month_file(2, {}, {})
    arrive("two")
    arrive("three")
    assert opened == [["01"], ["02"]]
    assert SavedTables(spark, target).fact_trip.count() == 3


def test_both_lots_of_trip_files_take_one_join(spark, monkeypatch):
    written = []

    def note(raw, folder, *lots):
        written.append(raw)
        write(raw, folder, *lots)

    write = staging.write_trip_files
    monkeypatch.setattr(staging, "write_trip_files", note)
    rows = staging.incremental_load(spark, f"{TESTDATA}/sf0.001", Settings(home="AMERICA")).collect()
    assert len(written) == 1
    assert sum(r["original_trips"] for r in rows) == spark.read.parquet(f"{TESTDATA}/sf0.001/lineitem.parquet").count()


def test_rollup_names_cover_the_saved_tables():
    assert len(ROLLUPS) == 6


def test_command_line(spark, tmp_path, month_file, capsys):
    month_file(1, {}, {}, {"fare_amount": 0.0})
    zones = tmp_path / "zones.csv"
    zones.write_text('"LocationID","Borough","Zone","service_zone"\n1,"Home","A","Yellow"\n2,"Home","B","N/A"\n')
    files, tables = f"{month_file.folder}/*.parquet", str(tmp_path / "tables")
    common = ["--home", "Home"]
    main([*common, "load", "--trips", files, "--zones", str(zones), "--tables", tables])
    assert "fact_trip" in capsys.readouterr().out
    main([*common, "report", "zone_top_pickup", "--tables", tables, "--limit", "5", "--json"])
    assert json.loads(capsys.readouterr().out.strip())["pickup_count"] == 2
    main([*common, "profile", "profile_raw_quality", "--trips", files, "--zones", str(zones), "--json"])
    assert json.loads(capsys.readouterr().out.strip())["invalid_fares"] == 1
    main([*common, "sql", "SELECT zone, pickup_count FROM zone_top_pickup(1)", "--tables", tables, "--json"])
    assert json.loads(capsys.readouterr().out.strip())["pickup_count"] == 2
    new = str(tmp_path / "new")
    arguments = ["--zones", str(zones), "--tables", new, "--checkpoint", str(tmp_path / "seen")]
    main([*common, "new", "--folder", month_file.folder, *arguments])
    main([*common, "report", "load_table_counts", "--tables", new, "--json"])
    assert '{"table_name":"fact_trip","row_count":2}' in capsys.readouterr().out


@pytest.mark.parametrize("incremental", [False, True])
def test_cbd_fee_of_files_that_have_it(spark, locations, tmp_path, month_file, incremental):
    first = month_file(1, {})
    month_file(2, {})
    spark.read.parquet(first).withColumn("cbd_congestion_fee", F.lit(0.75).cast("float")).coalesce(1).write.parquet(f"{month_file.folder}/new")
    for wanted, fees in ((True, [0.0, 0.0, 0.75]), (False, [0.0, 0.0, 0.0])):
        target = str(tmp_path / f"tables-{wanted}")
        if incremental:
            settings = dataclasses.replace(SETTINGS, cbd_fee=wanted)
            load_new_files(spark, month_file.folder, locations, target, f"{target}-seen", settings).awaitTermination()
        else:
            load.load(spark, open_trips(spark, month_file.folder, cbd_fee=wanted), locations, target, SETTINGS)
        fact = SavedTables(spark, target, settings=SETTINGS).fact_trip
        assert sorted(r[0] for r in fact.select("cbd_congestion_fee").collect()) == fees


def tear(path: str) -> None:
    """Spoil the middle of a file's data; its footer stays as it is."""
    with open(path, "r+b") as file:
        content = file.read()
        middle = len(content) // 3
        file.seek(middle)
        file.write(bytes(255 - b for b in content[middle : middle + len(content) // 4]))


def large_month(month_file, month, groups=4):
    """A month of several row groups, with values that do not compress to nothing."""
    import pyarrow.parquet as pq

    rows = [{"fare_amount": 5 + k * 0.37, "trip_distance": 1 + k * 0.013, "total_amount": 9 + k * 0.71} for k in range(1200)]
    path = month_file(month, *rows)
    pq.write_table(pq.read_table(path), path, row_group_size=len(rows) // groups)
    return path


@pytest.mark.parametrize("incremental", [False, True])
def test_file_torn_in_its_data(spark, locations, tmp_path, month_file, incremental):
    large_month(month_file, 1)
    torn = large_month(month_file, 2)
    cut = month_file(3, {}, {})
    tear(torn)
    with open(cut, "r+b") as file:
        file.truncate(300)
    month_file(4, {})
    with pytest.raises(Exception):
        spark.read.parquet(torn).write.format("noop").mode("overwrite").save()
    if incremental:
        t = stream(spark, locations, tmp_path, month_file.folder)
    else:
        t = load.load(spark, open_trips(spark, month_file.folder), locations, str(tmp_path / "tables"), SETTINGS)
    audit = {r["source_file"][-10:-8]: r for r in dicts(t.load_audit)}
    assert {k: r["status"] for k, r in audit.items()} == {"01": "loaded", "02": "rejected", "03": "rejected", "04": "loaded"}
    # The footer says how many trips a torn file should have had.
    assert (audit["02"]["original_trips"], audit["02"]["loaded_trips"], audit["03"]["original_trips"]) == (1200, 0, None)
    assert {r["source_period"]: r["count"] for r in dicts(t.fact_trip.groupBy("source_period").count())} == {
        "2025-01": 1200,
        "2025-04": 1,
    }
    # A month that arrives again, whole, under another name is loaded.
    if incremental:
        month_file(5, {})
        assert stream(spark, locations, tmp_path, month_file.folder).fact_trip.count() == 1202


def scanned_rows(spark, action) -> int:
    """Rows read by all tasks of all jobs that an action starts."""
    tracker = spark.sparkContext.statusTracker()
    group = "scanned-rows"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        jobs = [j for j in tracker.getJobIdsForGroup(group)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    total = 0
    for stage in stages:
        attempts = store.stageData(stage, False, spark.sparkContext._gateway.jvm.java.util.ArrayList(), False, spark.sparkContext._gateway.new_array(spark.sparkContext._gateway.jvm.double, 0))
        for k in range(attempts.size()):
            total += attempts.apply(k).inputRecords()
    return total


def test_raw_files_are_read_once(spark, locations, tmp_path, month_file):
    """All else that a load reads is small: here no trip passes the filters."""
    rows = [{"fare_amount": 600.0 + k} for k in range(5000)]
    month_file(1, *rows)
    month_file(2, *rows)
    found = open_trips(spark, month_file.folder)
    target = str(tmp_path / "tables")
    load.write_dimensions(spark, locations, target)
    read = scanned_rows(spark, lambda: load.load_trips(spark, found, target, SETTINGS, "a-1"))
    assert 10_000 <= read < 10_500
    assert [r["filtered_trips"] for r in dicts(store.read_table(spark, target, "load_audit"))] == [5000, 5000]


def test_many_files_open_in_one_job(spark, tmp_path, month_file):
    first = month_file(1, {})
    folder = tmp_path / "many"
    folder.mkdir()
    import shutil

    for k in range(3000):
        shutil.copy(first, folder / f"part-{k:05d}.parquet")
    (folder / "part-99999.parquet").write_text("no parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("open", "open")
    try:
        found = open_trips(spark, str(folder))
        jobs = len(tracker.getJobIdsForGroup("open"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4
    assert len(found.unreadable) == 1
    assert found.raw.count() == 3000 == found.files.agg(F.sum("rows")).first()[0]


def test_rollups_from_states_equal_a_rebuild(spark, locations, tmp_path, month_file):
    dice = random.Random(4)

    def rows(n):
        return [
            {
                "fare_amount": round(dice.uniform(3, 90), 2), "trip_distance": round(dice.uniform(0.2, 20), 2),
                "tip_amount": dice.choice([0.0, 1.37, 2.2]), "total_amount": round(dice.uniform(5, 99), 2),
                "VendorID": dice.choice([1, 2, 6]), "payment_type": dice.choice([1, 2]),
                "PULocationID": dice.choice([1, 2, 3, 4]), "DOLocationID": dice.choice([1, 2]),
                "store_and_fwd_flag": dice.choice(["Y", "N", None]), "extra": None,
            }
            for _ in range(n)
        ]

    target = str(tmp_path / "tables")
    month_file(1, *rows(300))
    load.load(spark, open_trips(spark, month_file.folder), locations, target, SETTINGS)
    for month in (2, 3):
        month_file(month, *rows(200))
        load_new_files(spark, month_file.folder, locations, target, str(tmp_path / "seen"), SETTINGS).awaitTermination()
    load.merge_rollups(spark, target, SETTINGS)
    stored = SavedTables(spark, target, settings=SETTINGS)
    built = TripTables(spark, locations, fact=stored.fact_trip, settings=SETTINGS)
    for name in [*ROLLUPS, "summary_statistics"]:
        mine, theirs = getattr(stored, name), getattr(built, name)
        assert mine.schema.simpleString() == theirs.schema.simpleString()
        assert sorted(map(repr, mine.collect())) == sorted(map(repr, theirs.collect())), name
    assert stored.mv_vendor_performance.agg(F.sum("trip_count")).first()[0] == 700
    load.refresh_rollups(spark, target, SETTINGS)
    again = SavedTables(spark, target, settings=SETTINGS)
    assert again.mv_vendor_performance.agg(F.sum("trip_count")).first()[0] == 700


def test_sketches_are_kept_per_batch(spark, locations, tmp_path, month_file):
    settings = dataclasses.replace(SETTINGS, sketches=True)
    target = str(tmp_path / "tables")
    month_file(1, *[{"fare_amount": 5.0 + k, "tip_amount": 1.0} for k in range(50)])
    load.load(spark, open_trips(spark, month_file.folder), locations, target, settings)
    month_file(2, *[{"fare_amount": 55.0 + k, "tip_amount": 1.0} for k in range(51)])
    load_new_files(spark, month_file.folder, locations, target, str(tmp_path / "seen"), settings).awaitTermination()
    load.merge_rollups(spark, target, settings)
    stored = SavedTables(spark, target, settings=settings)
    assert stored.value_sketches.select(sketches.quantile(F.col("fare"), 0.5)).first()[0] == 55.0
    # Small sketches hold all values.
    found = catalog.run("tipping_by_payment_type", stored, approx=True).first()
    assert found["tip_pct_median"] == pytest.approx(100 / 55)
    assert "load_batch" not in stored.value_sketches.columns


def test_states_read_new_partitions_only(spark, locations, tmp_path, month_file):
    month_file(1, {}, {})
    target = str(tmp_path / "tables")
    load.load(spark, open_trips(spark, month_file.folder), locations, target, SETTINGS)
    trips = store.read_table(spark, target, "fact_trip").filter(F.col("load_batch") == "other")
    for state in additive.states(trips).values():
        plan = state._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*load_batch[^\]]*= other", plan)


def test_batch_that_breaks_the_contract_is_not_seen(spark, locations, tmp_path, month_file):
    """A raw table with ids of its own: repeated ones, in the batch or against an earlier one, are refused."""
    target = str(tmp_path / "tables")
    load.write_dimensions(spark, locations, target)
    first = read_trips(spark, month_file(1, {}, {})).withColumn("trip_id", F.col("source_row"))
    load.load_trips(spark, first, target, SETTINGS, "a-1")
    second = read_trips(spark, month_file(2, {}, {}, {}))
    for ids, rule in ((F.lit(70), "primary key"), (F.col("source_row") + 1, "primary key of an earlier batch")):
        with pytest.raises(contract.ContractError) as error:
            load.load_trips(spark, second.withColumn("trip_id", ids.cast("bigint")), target, SETTINGS, "a-2")
        assert [v[1] for v in error.value.violations] == [rule]
        t = SavedTables(spark, target, settings=SETTINGS)
        assert (t.fact_trip.count(), t.load_audit.count()) == (2, 1)
    load.load_trips(spark, second.withColumn("trip_id", F.col("source_row") + 10), target, SETTINGS, "a-2")
    assert SavedTables(spark, target, settings=SETTINGS).fact_trip.count() == 5
    twice = locations.union(locations.limit(1))
    with pytest.raises(contract.ContractError):
        load.write_dimensions(spark, twice, target)


def test_contract_reads_no_earlier_batches(spark, locations, tmp_path, month_file):
    """Ids made of file numbers lie in ranges that do not overlap, so row groups of earlier batches are skipped."""
    target = str(tmp_path / "tables")
    load.write_dimensions(spark, locations, target)
    load.load_trips(spark, open_trips(spark, month_file(1, *[{}] * 3000)), target, SETTINGS, "a-1")
    load.load_trips(spark, open_trips(spark, month_file(2, {}, {})), target, SETTINGS, "a-2")
    read = scanned_rows(spark, lambda: contract.batch_violations(spark, target, "a-2", ["a-1"]))
    assert read < 100


def test_compaction(spark, locations, tmp_path, month_file):
    """Small batches become few files; readers see the same trips before, in between and after."""
    target = str(tmp_path / "tables")
    month_file(1, *[{"fare_amount": 5.0 + k} for k in range(40)])
    month_file(2, *[{"fare_amount": 7.0 + k} for k in range(40)])
    load.load(spark, open_trips(spark, month_file.folder), locations, target, SETTINGS)
    whole = SavedTables(spark, target, settings=SETTINGS)
    trips = store.read_table(spark, target, "fact_trip").drop("load_batch")
    audit = store.read_table(spark, target, "load_audit").limit(1)
    for k in range(12):
        store.write_fact(trips.withColumn("trip_id", F.col("trip_id") + (k + 10) * (1 << 50)), target, f"small-{k}", False)
        store.write_audit(audit.withColumn("file_no", F.lit(k + 10).cast("bigint")), target, f"small-{k}", False)

    def rows():
        return sorted(map(repr, SavedTables(spark, target, settings=SETTINGS).fact_trip.collect()))

    before, files = rows(), store.fact_files(spark, target).count()
    assert len(before) == 13 * 80 and files >= 26
    started = SavedTables(spark, target, settings=SETTINGS).fact_trip
    # A compaction that breaks off before its record has written files that nobody reads.
    write, store.write_compaction = store.write_compaction, lambda *_: (_ for _ in ()).throw(OSError("broke off"))
    try:
        with pytest.raises(OSError):
            compaction.compact(spark, target)
    finally:
        store.write_compaction = write
    assert rows() == before
    name = compaction.compact(spark, target)
    assert rows() == before == sorted(map(repr, started.collect()))
    assert store.visible_batches(spark, target) == [name]
    assert store.fact_files(spark, target).filter(F.col("load_batch") == name).count() == 2
    assert len(compaction.drop_replaced(spark, target)) == 13
    assert rows() == before
    assert compaction.compact(spark, target) is None
    # Loads go on: a batch that was complete is not loaded again, new ones are, and they are compacted with the others.
    load.load_trips(spark, open_trips(spark, month_file.folder), target, SETTINGS, "small-3")
    assert rows() == before
    month_file(3, {}, {})
    load.load_trips(spark, open_trips(spark, month_file.folder), target, SETTINGS, "later-1")
    assert len(rows()) == len(before) + 2
    assert compaction.compact(spark, target) is not None
    assert len(rows()) == len(before) + 2
    assert whole.load_audit.count() == 15
    load.refresh_rollups(spark, target, SETTINGS)
    for _ in range(2):
        t = SavedTables(spark, target, settings=SETTINGS)
        assert t.mv_vendor_performance.agg(F.sum("trip_count")).first()[0] == len(before) + 2
        month_file(4, {})
        compaction.compact(spark, target)
        load.merge_rollups(spark, target, SETTINGS)

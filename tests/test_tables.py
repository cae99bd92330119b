"""Files, dimension, joins, metrics and manifests."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from triplake.functions import exact
from triplake.operators import cleaning, dashboard, enrich, manifest, metrics, quality
from triplake.operators.canonical import batch_to_canonical
from triplake.plans import rebuild as trip_plans
from triplake.plans.trips import gather_sources, trip_table
from triplake.sources import bronze, folders, messages, tables
from triplake.sources.zones import read_zones


def day_trip(month: str, day: int = 10, **changes):
    return {
        "tpep_pickup_datetime": f"{month}-{day:02d} 08:00:00",
        "tpep_dropoff_datetime": f"{month}-{day:02d} 08:20:00",
        **changes,
    }


def write_file(df, folder, name, tmp_path):
    """One Parquet file with a chosen name."""
    out = tmp_path / f"_{name}"
    df.coalesce(1).write.parquet(str(out))
    folder.mkdir(exist_ok=True)
    part = next(out.glob("part-*.parquet"))
    (folder / name).write_bytes(part.read_bytes())


@pytest.fixture
def landed(spark, file_rows, tmp_path):
    source, target = tmp_path / "source", tmp_path / "bronze"
    jan, feb = day_trip("2024-01"), day_trip("2024-02")
    write_file(file_rows(jan, jan), source, "trips_2024-01.parquet", tmp_path)
    extra = file_rows(day_trip("2024-01", 11), counts="bigint").withColumn("airport_fee", F.lit(1.0))
    write_file(extra, source, "trips_2024-01_late.parquet", tmp_path)
    write_file(file_rows(feb), source, "trips_2024-02.parquet", tmp_path)
    write_file(file_rows(day_trip("2024-03")), source, "trips_2024-03.parquet", tmp_path)
    write_file(file_rows(jan), source, "readme.parquet", tmp_path)
    manifest_rows = bronze.land_files(spark, str(source), str(target), "2024-03")
    return source, target, {r.source_period: tuple(r)[1:] for r in manifest_rows.collect()}


def test_landing_keeps_drift_and_skips_stream_month(spark, landed):
    source, target, counted = landed
    assert counted == {"2024-01": (3, 2), "2024-02": (1, 1)}
    assert [p for p, _ in folders.period_folders(spark, str(target))] == ["2024-01", "2024-02"]
    # Landing again replaces the months and changes nothing.
    bronze.land_files(spark, str(source), str(target), "2024-03")
    months = bronze.read_months(spark, str(target))
    assert months.count() == 4
    assert months.filter("airport_fee = 1.0").count() == 1
    assert {r.source_year_month for r in months.collect()} == {"2024-01", "2024-02"}
    again = bronze.land_files(spark, str(source), str(target), "2024-03", {"2024-01"})
    assert [r.source_period for r in again.collect()] == ["2024-02"]


def test_month_choice_and_missing_sources(spark, landed, tmp_path):
    _, target, _ = landed
    assert bronze.read_months(spark, str(target), {"2024-02"}).count() == 1
    assert bronze.read_months(spark, str(target), {"2030-01"}) is None
    (target / "year=2024" / "month=13").mkdir()
    assert len(folders.period_folders(spark, str(target))) == 2
    with pytest.raises(FileNotFoundError):
        folders.period_folders(spark, str(tmp_path / "nowhere"))
    assert bronze.read_messages(spark, str(tmp_path / "nowhere")) is None
    with pytest.raises(ValueError):
        gather_sources(spark, None, None)
    with pytest.raises(ValueError):
        gather_sources(spark, str(target), None, {"2024-1"})
    with pytest.raises(FileNotFoundError):
        gather_sources(spark, None, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError, match="raw_json"):
        bronze.read_messages(spark, str(target))


ZONE_FILE = """LocationID,Borough,Zone,service_zone
10,Queens,Park,Boro Zone
10,Bronx,Park,Boro Zone
264,Unknown,N/A,N/A
"""


def test_zone_file(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(ZONE_FILE)
    rows = {r.location_id: r for r in read_zones(spark, str(path)).collect()}
    assert rows[10].borough == "Bronx" and rows[264].zone == "N/A" and len(rows) == 2
    path.write_text("LocationID,Borough\n1,x\n")
    with pytest.raises(ValueError, match="Zone"):
        read_zones(spark, str(path))
    with pytest.raises(FileNotFoundError):
        read_zones(spark, str(tmp_path / "none.csv"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_hot_and_null_keys(spark, setting, how):
    keys = [1] * 4000 + [None] * 3000 + list(range(2, 3000)) + [999_999]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key int")
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(2500)], "k int, v string")
    small = enrich.lookup_join(rows, lookup, "key", "k", how)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = enrich.lookup_join(rows, lookup, "key", "k", how)
    assert "k" not in large.columns
    expected = {
        (i, k, f"v{k}" if k is not None and k < 2500 else None) for i, k in enumerate(keys)
    }
    if how == "inner":
        expected = {row for row in expected if row[2] is not None}
    for result in (small, large):
        got = [tuple(r) for r in result.collect()]
        assert len(got) == len(expected) and set(got) == expected


def zones_of(spark):
    return spark.createDataFrame(
        [(10, "B1", "Z10", "S"), (20, "B2", "Z20", "S")],
        "location_id bigint, borough string, zone string, service_zone string",
    )


def test_unknown_zone_keeps_the_trip(spark, file_rows):
    canonical = batch_to_canonical(file_rows({"PULocationID": 999}), "2024-01", True)
    row = trip_table(canonical, zones_of(spark)).first()
    assert row.pickup_zone is None and row.dropoff_zone == "Z20"


def test_periods_are_replaced_one_by_one(spark, file_rows, tmp_path):
    path = str(tmp_path / "trips")

    def built(*trips, period):
        canonical = batch_to_canonical(file_rows(*trips), period, wall_clock=True)
        return trip_table(canonical, zones_of(spark))

    tables.write_periods(built(day_trip("2024-01"), day_trip("2024-01"), period="2024-01"), path)
    tables.write_periods(built(day_trip("2024-02"), period="2024-02"), path, rebalance=True)
    tables.write_periods(built(day_trip("2024-01"), period="2024-01"), path)
    saved = tables.read_trips(spark, path)
    assert saved.count() == 2 and dict(saved.dtypes)["pickup_month"] == "int"
    sliced = tables.read_trips(spark, path, 2024, 2)
    assert sliced.count() == 1
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "pickup_year" in partition_filters and "pickup_month" in partition_filters
    with pytest.raises(ValueError):
        tables.read_trips(spark, path, None, 2)
    with pytest.raises(ValueError):
        tables.read_trips(spark, path, 2024, 13)
    tables.write_periods(built(day_trip("2024-02"), period="2024-02"), path, mode="append")
    assert tables.read_trips(spark, path).count() == 3


def metric_rows(spark, values):
    return spark.createDataFrame(
        [(1, *v) for v in values],
        "g int, total_amount double, fare_amount double, tip_amount double,"
        " trip_distance double, trip_duration_minutes double, passenger_count bigint",
    )


def test_metrics_are_exact_and_order_free(spark):
    values = [(0.1, 0.1, None, 0.01, 1 / 60.0, 1)] * 1000 + [(None, 1e6, None, 5.0, 2.0, None)]
    first = metrics.trip_metrics(metric_rows(spark, values), ("g",)).first()
    for parts in (1, 3, 7):
        shuffled = metric_rows(spark, values[::-1]).repartition(parts)
        assert metrics.trip_metrics(shuffled, ("g",)).first() == first
    assert first.trip_count == 1001 and first.total_revenue == 100.0
    assert first.avg_total_amount == 0.1 and first.avg_tip_amount is None
    assert first.avg_passenger_count == 1.0


def test_metrics_off_the_grid(spark):
    odd = [(1 / 3, float("nan"), float("inf"), 1e15, 0.123456789, 1), (1 / 3, 1.0, 1.0, 1.0, 0.1, 1)]
    row = metrics.trip_metrics(metric_rows(spark, odd), ("g",)).first()
    assert row.avg_total_amount == pytest.approx(1 / 3, abs=1e-15)
    assert row.avg_fare_amount != row.avg_fare_amount
    assert row.avg_tip_amount == float("inf")
    assert row.avg_trip_distance == pytest.approx((1e15 + 1) / 2)
    assert row.avg_trip_duration_minutes == pytest.approx((0.123456789 + 0.1) / 2, abs=1e-15)


def test_state_rolls_up_to_the_same_tables(spark, file_rows):
    trips = [day_trip("2024-01", 1 + i % 20, PULocationID=10 * (1 + i % 3), total_amount=None if i % 4 == 0 else i / 10)
             for i in range(60)]
    table = trip_table(batch_to_canonical(file_rows(*trips), "2024-01", True), zones_of(spark))
    state = metrics.metric_state(table)
    built = {}
    for name in metrics.serving_tables():
        direct = metrics.serving_table(table, name)
        rolled = metrics.serving_table_from_state(state, name).select(*direct.columns)
        assert sorted(map(str, direct.collect())) == sorted(map(str, rolled.collect()))
        built[name] = direct
    report = quality.reconcile(table, built)
    assert quality.all_pass(report).first().overall == "PASS"
    built["payment_monthly"] = built["payment_monthly"].limit(0)
    bad = quality.reconcile(table, built)
    assert quality.all_pass(bad).first().overall == "FAIL"
    assert bad.filter("NOT trips_ok").first().table_name == "payment_monthly"


def test_reports_on_empty_input(spark, file_rows):
    empty = batch_to_canonical(file_rows({}), "2024-01", True).limit(0)
    loss = quality.cleaning_loss(empty, cleaning.usable()).first()
    assert (loss.bronze_rows, loss.removed, loss.removed_pct) == (0, 0, 0.0)


def test_fingerprint_ignores_order_and_sees_duplicates(spark):
    rows = [("a", i % 5, float(i)) for i in range(100)]
    make = lambda r, n: spark.createDataFrame(r, "p string, x int, y double").repartition(n)
    one = manifest.fingerprints(make(rows, 1), "p").first()
    assert manifest.fingerprints(make(rows[::-1], 7), "p").first() == one
    assert manifest.fingerprints(make(rows + rows[:2], 3), "p").first().fingerprint != one.fingerprint


@pytest.mark.parametrize("portable", [False, True])
def test_fingerprints_do_not_collide(spark, portable):
    def of(*values, kinds="x double, y double, s string, t string"):
        names = [k.split()[0] for k in kinds.split(", ")]
        df = spark.createDataFrame([("p", *values)], "p string, " + kinds)
        return manifest.fingerprints(df.select("p", *names), "p", portable).first().fingerprint

    rows = [
        (1.0, None, "a", "b"), (None, 1.0, "a", "b"), (None, None, "a", "b"),
        (float("nan"), None, "a", "b"), (1e300, None, "a", "b"), (float("inf"), None, "a", "b"),
        (1.0, None, "a|b", "c"), (1.0, None, "a", "b|c"), (1.00000001, None, "a", "b"),
        (1.0, None, "a", None), (1.0, None, "~", "b"), (-1.0, None, "a", "b"),
        (1.0 + 2**-50, None, "a", "b"),
    ]
    assert len({of(*r) for r in rows}) == len(rows)


def test_exact_sums_hold_any_size(spark):
    rows = spark.range(0, 1_000_000, 1, 8).select(F.lit(9.9e8).alias("x"))
    assert rows.agg(exact.exact_sum(F.col("x"), exact.MONEY_STEPS)).first()[0] == 9.9e14
    odd = spark.createDataFrame([(0.1,), (0.2,), (None,), (1e300,), (-1e300,)], "x double")
    assert odd.agg(exact.exact_sum(F.col("x"), exact.MONEY_STEPS)).first()[0] == pytest.approx(0.3)


def test_rebuild_decisions(spark):
    frame = lambda rows, s: spark.createDataFrame(rows, s)
    current = frame([(p, "1") for p in "abcdefg"], "period string, fingerprint string")
    saved = frame([("a", "1"), ("b", "0"), ("f", "1"), ("z", "1")], "period string, fingerprint string")
    outputs = frame([(p,) for p in "abcdg"], "period string")
    parents = frame([("d", "rebuilt"), ("c", "unchanged"), ("a", "rebuilt")],
                    "period string, parent_status string")
    plan = manifest.rebuild_plan(current, saved, outputs, parents)
    assert {r.period: (r.status, r.reason) for r in plan.collect()} == {
        "a": ("unchanged", None),
        "b": ("rebuilt", "input changed"),
        "c": ("bootstrapped", None),
        "d": ("rebuilt", "parent rebuilt"),
        "e": ("rebuilt", "output missing"),
        "f": ("rebuilt", "output missing"),
        "g": ("bootstrapped", None),
        "z": ("removed", "no input"),
    }


def test_first_rows_in_file_order(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 4).write.parquet(path)
    scan = spark.read.parquet(path)
    order = [r.id for r in scan.orderBy(F.col("_metadata.file_path"), F.col("_metadata.row_index")).collect()]
    kept = messages.first_rows(scan, 333)
    assert kept.columns == ["id"]
    assert sorted(r.id for r in kept.collect()) == sorted(order[:333])
    assert messages.first_rows(scan, 5000).count() == 1000
    with pytest.raises(ValueError):
        messages.first_rows(scan, 0)


def test_weighted_kpis_count_trips_without_a_value(spark):
    daily = spark.createDataFrame(
        [("2024-01-01", 10, 5.0, 2.0, 1.0), ("2024-01-02", 30, 7.0, None, 3.0)],
        "d string, trip_count bigint, total_revenue double, avg_trip_duration_minutes double,"
        " avg_trip_distance double",
    ).withColumn("pickup_date", F.col("d").cast("date"))
    kpis = dashboard.overview(daily).first()
    assert (kpis.total_trips, kpis.total_revenue) == (40, 12.0)
    assert (kpis.avg_trip_duration_minutes, kpis.avg_trip_distance) == (0.5, 2.5)
    assert dashboard.overview(daily, "2024-01-02", "2024-01-02").first().total_trips == 30
    none = dashboard.overview(daily, "2025-01-01").first()
    assert none.total_trips is None and none.avg_trip_distance is None


def test_heatmap_has_all_days(spark):
    hourly = spark.createDataFrame(
        [("Monday", 0, 3), ("Monday", 23, 4), ("Sunday", 1, 1)],
        "pickup_day_of_week string, pickup_hour int, trip_count bigint",
    )
    rows = dashboard.weekday_by_hour(hourly).collect()
    assert [r.pickup_day_of_week for r in rows][0::6] == ["Monday", "Sunday"]
    assert (rows[0].h00, rows[0].h01, rows[0].h23) == (3, 0, 4)
    assert rows[1].h00 is None and rows[6].h01 == 1


def test_top_zones_break_ties_by_id(spark):
    totals = spark.createDataFrame(
        [(i, "z", "b", 5 if i > 1 else 9) for i in range(20)],
        "pickup_location_id int, pickup_zone string, pickup_borough string, trip_count int",
    )
    ids = [r.pickup_location_id for r in dashboard.top_zones(totals, "trip_count").collect()]
    assert ids == list(range(10))
    with pytest.raises(ValueError):
        dashboard.top_zones(totals, "vendor_id")


def test_only_changed_periods_are_landed_and_rebuilt(spark, file_rows, tmp_path):
    source, zone_file = tmp_path / "source", tmp_path / "zones.csv"
    zone_file.write_text(ZONE_FILE)

    def month(name, rows):
        write_file(file_rows(*rows), source, f"trips_{name}.parquet", tmp_path)

    def land():
        landed = bronze.land_files(
            spark, str(source), str(tmp_path / "batch"), "2025-12", only_changed=True
        )
        return {r.source_period for r in landed.collect()}

    def rebuild():
        plan = trip_plans.rebuild_trips(
            spark, str(tmp_path / "batch"), None, str(zone_file), str(tmp_path / "trips"),
            str(tmp_path / "manifest"), wall_clock=True,
        )
        return {r.period: r.status for r in plan.collect()}

    month("2025-09", [day_trip("2025-09"), day_trip("2025-09", 11)])
    month("2025-10", [day_trip("2025-10")])
    assert land() == {"2025-09", "2025-10"}
    assert rebuild() == {"2025-09": "rebuilt", "2025-10": "rebuilt"}
    assert land() == set()
    assert rebuild() == {"2025-09": "unchanged", "2025-10": "unchanged"}
    files = sorted((tmp_path / "trips").rglob("*.parquet"))
    (source / "trips_2025-10.parquet").unlink()
    shutil.rmtree(tmp_path / "_trips_2025-10.parquet")
    month("2025-10", [day_trip("2025-10"), day_trip("2025-10", 12)])
    month("2025-11", [day_trip("2025-11")])
    assert land() == {"2025-10", "2025-11"}
    assert rebuild() == {"2025-09": "unchanged", "2025-10": "rebuilt", "2025-11": "rebuilt"}
    assert spark.read.parquet(str(tmp_path / "trips")).count() == 5
    assert {f for f in files if "month=9" in str(f) or "month=09" in str(f)} <= set((tmp_path / "trips").rglob("*.parquet"))
    shutil.rmtree(tmp_path / "manifest")
    assert set(rebuild().values()) == {"bootstrapped"}

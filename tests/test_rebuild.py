"""Rebuilding what changed: file states, the cascade of stages, removal."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from triplake.operators import manifest
from triplake.operators.manifest import StageSpec
from triplake.plans import rebuild, serving
from triplake.plans import trips as trips_plan
from triplake.sources import bronze, folders

ZONE_FILE = """LocationID,Borough,Zone,service_zone
10,Queens,Baisley Park,Boro Zone
20,Bronx,Belmont,Boro Zone
"""


def trip(period: str, day: int = 10, **changes):
    return {
        "tpep_pickup_datetime": f"{period}-{day:02d} 08:00:00",
        "tpep_dropoff_datetime": f"{period}-{day:02d} 08:20:00",
        **changes,
    }


@pytest.fixture
def lake(spark, file_rows, tmp_path):
    """Landed months, a zone file, and a run of trips and serving tables."""

    class Lake:
        root = tmp_path
        batch, trips, gold = (str(tmp_path / n) for n in ("batch", "trips", "gold"))
        zones = tmp_path / "zones.csv"

        def add(self, period, name, *rows):
            out = tmp_path / f"one-{period}-{name}"
            file_rows(*rows).coalesce(1).write.mode("overwrite").parquet(str(out))
            year, month = period.split("-")
            folder = tmp_path / "batch" / f"year={year}" / f"month={month}"
            folder.mkdir(parents=True, exist_ok=True)
            shutil.copy(next(out.glob("part-*")), folder / f"{name}.parquet")
            return folder

        def run(self, dataset=False):
            stages = [
                rebuild.trip_stage(spark, self.batch, None, str(self.zones), self.trips, wall_clock=True),
                rebuild.serving_stage(spark, self.trips, self.gold),
            ]
            if dataset:
                stages.append(rebuild.dataset_stage(spark, self.trips, str(tmp_path / "ml"), "2025-11", 1.0, 1.0))
            plan = rebuild.rebuild(
                spark, self.batch, None, stages, str(tmp_path / "manifest"), wall_clock=True
            )
            return {(r.stage, r.period): (r.status, r.reason) for r in plan.collect()}

        def statuses(self, **how):
            return {key: status for key, (status, _) in self.run(**how).items()}

    lake = Lake()
    lake.zones.write_text(ZONE_FILE)
    for period in ("2025-09", "2025-10", "2025-11"):
        lake.add(period, "a", trip(period), trip(period, 11))
    return lake


PERIODS = ("2025-09", "2025-10", "2025-11")


def every(stage, status, periods=PERIODS):
    return {(stage, p): status for p in periods}


def test_stages_follow_sources_lookups_and_outputs(spark, lake):
    built = every("trips", "rebuilt") | every("serving", "rebuilt")
    assert lake.statuses(dataset=True) == built | {("dataset", "*"): "rebuilt"}
    same = every("trips", "unchanged") | every("serving", "unchanged")
    assert lake.statuses(dataset=True) == same | {("dataset", "*"): "unchanged"}
    # A late file: only its month is built again, and what is made of it.
    lake.add("2025-10", "late", trip("2025-10", 12))
    late = same | {("trips", "2025-10"): "rebuilt", ("serving", "2025-10"): "rebuilt"}
    kept = sorted((lake.root / "gold").rglob("pickup_month=9/*.parquet"))
    assert lake.statuses(dataset=True) == late | {("dataset", "*"): "rebuilt"}
    assert kept == sorted((lake.root / "gold").rglob("pickup_month=9/*.parquet"))
    assert serving.check_serving(spark, lake.trips, lake.gold)[1]
    # A changed zone reaches all stages.
    lake.zones.write_text(ZONE_FILE.replace("Belmont", "Belmont North"))
    assert lake.statuses(dataset=True) == built | {("dataset", "*"): "rebuilt"}
    zones = spark.read.parquet(lake.trips).select("dropoff_zone").distinct().collect()
    assert [r[0] for r in zones] == ["Belmont North"]
    # An output that is missing is built again, and no other.
    folders.delete(spark, f"{lake.gold}/daily_summary/pickup_year=2025/pickup_month=9")
    plan = lake.run(dataset=True)
    assert plan["serving", "2025-09"] == ("rebuilt", "output missing")
    assert [k for k, (status, _) in plan.items() if status != "unchanged"] == [("serving", "2025-09")]
    # Without state, outputs are adopted.
    shutil.rmtree(lake.root / "manifest")
    assert set(lake.statuses(dataset=True).values()) == {"bootstrapped"}


def test_periods_without_input_or_usable_rows_go(spark, lake):
    lake.run()
    shutil.rmtree(lake.root / "batch" / "year=2025" / "month=09")
    # All trips of this month end before they begin.
    lake.add("2025-10", "a", trip("2025-10", tpep_dropoff_datetime="2025-10-10 07:00:00"))
    plan = lake.run()
    assert plan["trips", "2025-09"] == plan["serving", "2025-09"] == ("removed", "no input")
    assert plan["trips", "2025-10"] == plan["serving", "2025-10"] == ("rebuilt", "no usable rows")
    assert rebuild.table_periods(spark, lake.trips) == {"2025-11"}
    assert rebuild.table_periods(spark, f"{lake.gold}/hourly_demand") == {"2025-11"}
    assert serving.check_serving(spark, lake.trips, lake.gold)[1]
    # All are settled.
    assert lake.statuses() == every("trips", "unchanged", PERIODS[1:]) | every("serving", "unchanged", PERIODS[1:])


def test_a_failed_run_goes_on_where_it_stopped(lake, monkeypatch):
    lake.run()
    lake.add("2025-10", "late", trip("2025-10", 12))
    with monkeypatch.context() as patch:
        def fail(*_):
            raise RuntimeError("lost")
        patch.setattr(rebuild.serving, "serving_of_periods", fail)
        with pytest.raises(RuntimeError):
            lake.run()
    plan = lake.run()
    assert plan["trips", "2025-10"][0] == "unchanged"
    assert plan["serving", "2025-10"][0] == "rebuilt"


def leaves(df):
    found = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_only_changed_files_are_read(spark, lake, monkeypatch):
    read = []

    def spy(name):
        reader = getattr(rebuild, name)

        def spied(*args):
            read.append((name, sorted(args[4])))
            return reader(*args)

        monkeypatch.setattr(rebuild, name, spied)

    spy("read_months")
    known = rebuild._saved(spark, str(lake.root / "none"), rebuild._FILES)
    first = rebuild.source_states(spark, lake.batch, None, known, True)
    assert len(read.pop()[1]) == 3 and not read
    again = rebuild.source_states(spark, lake.batch, None, first, True)
    assert not read and again.count() == 3
    lake.add("2025-10", "b", trip("2025-10", 13))
    lake.add("2025-11", "a", trip("2025-11", 14))
    (lake.root / "batch/year=2025/month=09/a.parquet").unlink()
    lake.add("2025-12", "none")
    last = rebuild.source_states(spark, lake.batch, None, again, True)
    files = read.pop()[1]
    assert [f.split("month=")[1] for f in files] == ["10/b.parquet", "11/a.parquet", "12/none.parquet"]
    rows = bronze.read_months(spark, lake.batch, {"2025-10"}, True, files, "_file")
    # Of the two files of this month the scan opens one.
    scan = leaves(rows)[0]
    rows.collect()
    assert rows.count() == 1
    assert scan.selectedPartitions().totalNumberOfFiles() == 1
    # The fingerprints are those of a full read.
    months = bronze.read_months(spark, lake.batch, None, True)
    full = manifest.fingerprints(months, "source_year_month").collect()
    parts = manifest.fingerprints_of_files(last).collect()
    assert sorted(map(tuple, parts)) == sorted(map(tuple, full))
    assert {r.period for r in last.collect()} == {"2025-10", "2025-11", None}


def test_a_version_that_was_not_finished_is_not_read(spark, tmp_path):
    root = str(tmp_path / "state")
    assert folders.latest_version(spark, root) is None
    for n in (1, 2):
        folders.write_version(spark.range(n).coalesce(1), root)
    (tmp_path / "state" / "version-000000000009").mkdir()
    assert spark.read.parquet(folders.latest_version(spark, root)).count() == 2


def test_cascade_of_three_stages(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    def print_of(stage, fingerprint, settings):
        one = frame([("p", fingerprint)], "period string, fingerprint string")
        spec = StageSpec(stage, None, settings)
        return manifest.stage_fingerprints(one, spec).first().fingerprint

    sources = frame([("p", "1"), ("q", "2"), ("r", "3")], "period string, fingerprint string")
    stages = [StageSpec("a", None, "s"), StageSpec("b", "a", "t"), StageSpec("c", "b", "u", True)]
    a = {p: print_of("a", f, "s") for p, f in (("p", "1"), ("q", "2"), ("r", "3"))}
    b = {p: print_of("b", f, "t") for p, f in a.items()}
    saved = [("a", p, f) for p, f in a.items()] + [("b", "p", b["p"]), ("b", "q", "old"), ("b", "x", "gone")]
    outputs = [("a", "p"), ("a", "q"), ("b", "p"), ("b", "q"), ("b", "r"), ("b", "x"), ("c", "*")]
    found = manifest.cascade(
        sources, stages, frame(saved, "stage string, period string, fingerprint string"),
        frame(outputs, "stage string, period string"),
    )
    assert {(r.stage, r.period): (r.status, r.reason) for r in found.collect()} == {
        ("a", "p"): ("unchanged", None), ("a", "q"): ("unchanged", None),
        ("a", "r"): ("rebuilt", "output missing"),
        ("b", "p"): ("unchanged", None), ("b", "q"): ("rebuilt", "input changed"),
        ("b", "r"): ("rebuilt", "parent rebuilt"), ("b", "x"): ("removed", "no input"),
        ("c", "*"): ("rebuilt", "parent rebuilt"),
    }
    none = manifest.cascade(sources.limit(0), stages, frame([], "stage string, period string, fingerprint string"), frame([], "stage string, period string"))
    assert none.collect() == []


def test_serving_tables_follow_late_replaced_and_removed_files(spark, lake, monkeypatch):
    base, state = str(lake.root / "late"), str(lake.root / "late-state")

    def refresh():
        return rebuild.refresh_serving(spark, lake.batch, None, str(lake.zones), base, state, True)

    def same_as_a_full_build(n):
        full, trips = str(lake.root / f"full-{n}"), str(lake.root / f"all-{n}")
        trips_plan.build_trips(spark, lake.batch, None, str(lake.zones), trips, wall_clock=True)
        serving.build_serving(spark, trips, full)
        ours, theirs = (serving.read_serving(spark, path) for path in (base, full))
        for name, table in theirs.items():
            columns = sorted(table.columns)
            found, want = (
                sorted(map(str, t.select(columns).collect())) for t in (ours[name], table)
            )
            assert found == want, name
        return len(found)

    assert refresh() == list(PERIODS)
    same_as_a_full_build(1)
    read = []
    reader = rebuild.read_months
    monkeypatch.setattr(rebuild, "read_months", lambda *args: read.append(args[4]) or reader(*args))
    assert refresh() == [] and not read
    lake.add("2025-10", "late", trip("2025-10", 12, payment_type=3), trip("2025-10", 30))
    assert refresh() == ["2025-10"]
    assert [f.rsplit("/", 1)[1] for f in read.pop()] == ["late.parquet"]
    same_as_a_full_build(2)
    # A replaced file leaves the metrics, a removed one takes its period along.
    lake.add("2025-10", "late", trip("2025-10", 13, fare_amount=99.0))
    (lake.root / "batch/year=2025/month=09/a.parquet").unlink()
    assert refresh() == ["2025-09", "2025-10"]
    same_as_a_full_build(3)
    lake.zones.write_text(ZONE_FILE.replace("Baisley", "Upper Baisley"))
    with monkeypatch.context() as patch:
        def fail(*_):
            raise RuntimeError("lost")
        patch.setattr(rebuild, "write_version", fail)
        with pytest.raises(RuntimeError):
            refresh()
    assert refresh() == ["2025-10", "2025-11"]
    same_as_a_full_build(4)

"""Features, encoding, models and scoring."""

from __future__ import annotations

from statistics import fmean, pvariance

import pytest
from pyspark.sql import functions as F

from triplake.__main__ import main
from triplake.operators import encoding, features, models, regression, scoring, trees
from triplake.operators.canonical import batch_to_canonical
from triplake.operators.cleaning import with_calendar
from triplake.plans import duration
from triplake.sources import tables


def random_dataset(spark, n=800):
    base = spark.range(n).select(
        F.col("id").alias("row_id"),
        (1 + F.col("id") % 12).cast("int").alias("pickup_location_id"),
        (1 + (F.col("id") * 7) % 9).cast("int").alias("dropoff_location_id"),
        (1 + F.col("id") % 6).cast("int").alias("passenger_count"),
        (0.5 + (F.col("id") * 13) % 40 / 4).alias("trip_distance"),
        F.lit(1).alias("rate_code_id"),
        (F.col("id") % 24).cast("int").alias("pickup_hour"),
        (1 + F.col("id") % 7).cast("int").alias("pickup_day_of_week_num"),
        (1 + F.col("id") % 12).cast("int").alias("pickup_month"),
    )
    label = 3 * F.col("trip_distance") + F.col("pickup_location_id")
    return features.with_engineered(base).withColumn("label", label)


def test_model_bounds_are_inclusive(spark, file_rows):
    def minutes(m):
        return {"tpep_dropoff_datetime": f"2024-01-10 {8 + m // 60:02d}:{m % 60:02d}:00"}

    cases = [
        (minutes(1), True), (minutes(180), True), (minutes(181), False),
        ({"tpep_dropoff_datetime": "2024-01-10 08:00:59"}, False),
        ({"trip_distance": 0.1}, True), ({"trip_distance": 100.0}, True),
        ({"trip_distance": 0.09}, False), ({"trip_distance": None}, False),
        ({"trip_distance": float("nan")}, False),
        ({"RatecodeID": 6}, True), ({"RatecodeID": 7}, False),
        ({"passenger_count": 0}, False), ({"passenger_count": 6}, True),
        ({"PULocationID": 265}, True), ({"PULocationID": 266}, False),
        ({"DOLocationID": 0}, False), ({"passenger_count": None}, False),
    ]
    rows = file_rows(*[{**c, "VendorID": i} for i, (c, _) in enumerate(cases)])
    trips = with_calendar(batch_to_canonical(rows, "2024-01", wall_clock=True))
    kept = features.duration_features(trips, keep=("vendor_id",))
    assert sorted(r.vendor_id for r in kept.collect()) == [
        i for i, (_, ok) in enumerate(cases) if ok
    ]
    train, test = features.split_by_period(kept, "2024-01")
    assert train.count() == 0 and test.count() == kept.count()
    assert test.first().is_weekend == 0 and test.first().is_rush_hour == 1
    features.require_dataset_columns(test)
    with pytest.raises(ValueError, match="label"):
        features.require_dataset_columns(test.drop("label"))


def test_samples(spark):
    ids = spark.range(10_000).withColumnRenamed("id", "k")
    kept = {r.k for r in features.keyed_sample(ids, "k", 0.05, 42).collect()}
    again = {r.k for r in features.keyed_sample(ids.repartition(7), "k", 0.05, 42).collect()}
    assert kept == again and 400 < len(kept) < 600
    other = {r.k for r in features.keyed_sample(ids, "k", 0.05, 43).collect()}
    assert len(kept & other) < 60
    folds = encoding.with_fold(features.keyed_sample(ids, "k", 0.5, 42), "k", 5, 42)
    assert all(850 < r["count"] < 1150 for r in folds.groupBy("fold").count().collect())
    assert 300 < features.bernoulli_sample(ids, 0.05, 42).count() < 700
    for bad in (0, 1.5, -1):
        with pytest.raises(ValueError):
            features.bernoulli_sample(ids, bad, 1)
        with pytest.raises(ValueError):
            features.keyed_sample(ids, "k", bad, 1)


def expected_encoding(train, category):
    prior = fmean(y for _, y in train)
    mine = [y for c, y in train if c == category]
    if not mine:
        return prior
    overall, inside = pvariance([y for _, y in train]), pvariance(mine)
    weight = len(mine) * overall / (len(mine) * overall + inside)
    return weight * fmean(mine) + (1 - weight) * prior


def test_target_encoding_against_brute_force(spark):
    train = encoding.with_fold(random_dataset(spark, 300), "row_id")
    column = ("pickup_location_id",)
    rows = train.select("row_id", "fold", *column, "label").collect()
    assert {r.fold for r in rows} == {0, 1, 2, 3, 4}
    table = encoding.encoding_table(train, column)
    got = encoding.encode(train, table, column, out_of_fold=True).collect()
    assert len(got) == 300
    for r in got:
        others = [(o[2], o.label) for o in rows if o.fold != r.fold]
        assert r.pickup_location_id_te == pytest.approx(expected_encoding(others, r[1]))
    unseen = train.limit(1).withColumn("pickup_location_id", F.lit(200))
    value = encoding.encode(unseen.drop("fold"), table, column).first().pickup_location_id_te
    assert value == pytest.approx(fmean(r.label for r in rows))


def test_metrics_in_one_pass_match_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.range(200).select(
        F.sqrt("id").alias("label"), (F.col("id") / 15.0).alias("prediction")
    )
    row = regression.regression_metrics(df).first()
    for name in ("mae", "rmse", "r2"):
        judge = RegressionEvaluator(labelCol="label", metricName=name)
        assert row[name] == pytest.approx(judge.evaluate(df))
    assert regression.regression_metrics(df.limit(0)).first().mae is None


def test_comparison_beats_the_mean_and_survives_unseen_values(spark, tmp_path):
    data = random_dataset(spark)
    train, test = data.filter("row_id < 600"), data.filter("row_id >= 600")
    test = test.withColumn(
        "pickup_location_id", F.when(F.col("row_id") == 600, 250).otherwise(F.col("pickup_location_id"))
    )
    result = models.compare_models(train, test, ["linear", "gbt"], 42, str(tmp_path))
    scores = {r.model: r for r in result.scores.collect()}
    assert set(scores) == {"mean_baseline", "linear", "gbt"}
    assert max(scores["linear"].rmse, scores["gbt"].rmse) < scores["mean_baseline"].rmse
    best = result.best.first()
    assert best.rmse == min(scores["linear"].rmse, scores["gbt"].rmse)
    assert models.chosen_models(" Linear, rf ,") == ["linear", "rf"]
    with pytest.raises(ValueError, match="svm"):
        models.chosen_models("gbt,svm")
    empty = models.compare_models(train, test, [])
    assert empty.scores.count() == 1 and empty.best.count() == 0


def test_scoring_keeps_rejected_rows_with_a_reason(spark):
    model = models.fit_model(random_dataset(spark, 300), "linear")
    planned = spark.createDataFrame(
        [
            (1, 3, 4, 1, 2.0, 1, 8, "friday", 12),
            (2, 999_999_999_999, 4, 1, 2.0, 1, 8, "Friday", 12),
            (3, 3, 4, 9, 2.0, 9, 8, "Friday", 12),
            (4, 3, 4, 1, None, 1, 8, "Friday", 12),
            (5, 3, 4, 1, 2.0, 1, 24, "Friday", 12),
            (6, 3, 4, 1, 2.0, 1, 8, "Someday", 12),
            (7, 200, 4, 1, 2.0, 1, 8, "Sunday", 1),
        ],
        "id int, pickup_location_id bigint, dropoff_location_id bigint, passenger_count int,"
        " trip_distance double, rate_code_id int, pickup_hour int, pickup_day_of_week string,"
        " pickup_month int",
    )
    rows = {r.id: r for r in scoring.score_trips(model, planned).collect()}
    assert {i: r.failed_rule for i, r in rows.items()} == {
        1: None, 2: "pickup_location_id", 3: "passenger_count", 4: "trip_distance",
        5: "pickup_hour", 6: "pickup_day_of_week", 7: None,
    }
    assert rows[2].pickup_location_id == 999_999_999_999
    assert all((r.prediction is not None) == r.valid for r in rows.values())


def test_boosting_waits_for_a_smaller_error():
    falling = [1 / (i + 1) for i in range(30)]
    assert models.stopping_point(falling) == (30, False)
    # Rises for a few trees and falls again.
    bump = [5.0, 4.0, 4.5, 4.6, 4.7, 3.0, 3.5]
    assert models.stopping_point(bump, patience=4) == (6, False)
    assert models.stopping_point(bump, patience=2) == (2, True)
    assert models.stopping_point([2.0] * 21) == (1, True)
    assert models.stopping_point([3.0, 1.0] + [2.0] * 19) == (2, False)
    assert models.stopping_point([3.0, 1.0] + [2.0] * 20 + [0.0]) == (2, True)


def test_both_ways_to_look_encodings_up(spark, monkeypatch):
    rows = encoding.with_fold(random_dataset(spark, 300), "row_id", 3)
    rows = rows.withColumn(
        "rate_code_id", F.when(F.col("row_id") % 5 > 0, F.col("rate_code_id"))
    ).withColumn("fold", F.when(F.col("row_id") % 11 > 0, F.col("fold")))
    table = tables.stored(encoding.encoding_table(rows.filter("row_id < 200")), "test-encodings")
    for out_of_fold in (True, False):
        def values():
            out = encoding.encode(rows, table, out_of_fold=out_of_fold)
            return out, sorted(out.select("row_id", *models.ENCODED).collect())

        by_map, found = values()
        plan = by_map._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        with monkeypatch.context() as patch:
            patch.setattr(encoding, "MAP_ENTRIES", 0)
            joined, other = values()
        assert found == other and len({r[1] for r in found}) > 10
        assert joined._jdf.queryExecution().executedPlan().toString().count("Join") > 3
    nothing = encoding.encode(rows, table.limit(0)).first()
    assert nothing["rate_code_id_te"] is None


@pytest.mark.parametrize("name", ["rf", "gbt"])
def test_ensembles_as_sql(spark, name):
    """Spark and DuckDB run the SQL form, also for NULL and unseen categories."""
    duckdb = pytest.importorskip("duckdb")
    data = random_dataset(spark, 500)
    fitted = models.fit_model(data, name)
    other = data.limit(40).withColumns({
        "pickup_location_id": F.when(F.col("row_id") % 3 == 0, 99).when(
            F.col("row_id") % 3 == 1, F.col("pickup_location_id")),
        "trip_distance": F.col("trip_distance") * 3 - 5,
    })
    rows = encoding.with_category_text(data.unionByName(other.withColumn("row_id", F.col("row_id") + 1000)))
    text = trees.ensemble_sql(fitted)
    both = fitted.transform(rows).withColumn("by_sql", F.expr(text)).cache()
    assert both.filter("by_sql is null or abs(by_sql - prediction) > 1e-9").count() == 0
    assert both.select(F.count_distinct(F.round("by_sql", 6))).first()[0] > 10
    con = duckdb.connect()
    inputs = both.drop("features", "prediction", *models.INDEXES).toPandas()
    con.register("inputs", inputs)
    found = con.sql(f"SELECT by_sql, {text} AS duck FROM inputs").fetchall()
    assert len(found) == 540 and all(a == pytest.approx(b, rel=1e-12) for a, b in found)
    both.unpersist()
    gone = rows.limit(1).withColumn("trip_distance", F.lit(None).cast("double"))
    assert gone.select(F.expr(text)).first()[0] is None


def test_categories_in_sql():
    labels = ["a", "b'c"]
    assert trees._category_test("x", labels, {1}) == "coalesce(x IN ('b''c'), FALSE)"
    assert trees._category_test("x", labels, {0, 2}) == "coalesce(x NOT IN ('b''c'), TRUE)"
    assert trees._category_test("x", labels, {0, 1, 2}) == "TRUE"
    assert trees._category_test("x", labels, set()) == "FALSE"


def test_no_sql_for_other_models(spark):
    fitted = models.fit_model(random_dataset(spark, 60), "linear")
    with pytest.raises(ValueError, match="no SQL form"):
        trees.ensemble_sql(fitted)


def test_boosting_ends_at_the_smallest_held_out_error(spark, monkeypatch):
    noisy = random_dataset(spark, 600).withColumn(
        "label", F.col("label") + 40 * F.abs(F.hash("row_id") % 100) / 100
    )
    fits = []
    grow = models.GBTRegressor

    def spy(**settings):
        fits.append(settings["maxIter"])
        return grow(**settings)

    monkeypatch.setattr(models, "GBTRegressor", spy)
    monkeypatch.setattr(models, "FIRST_TREES", 4)
    monkeypatch.setattr(models, "PATIENCE", 3)
    monkeypatch.setattr(models.stopping_point, "__defaults__", (3,))
    fitted = models.fit_encoded_boosting(noisy, "row_id", iterations=40)
    # Attempts double until the error has not fallen for three trees.
    assert fits[:2] == [4, 8] and fits[-1] == fitted.trees < 40
    assert fitted.trees + 3 <= max(fits)
    one = models.fit_encoded_boosting(noisy.limit(3), "row_id", iterations=2)
    assert one.trees <= 2


def test_encoded_boosting_goes_on_while_it_learns(spark, tmp_path):
    base = random_dataset(spark, 3000).withColumn(
        "label", 3 * F.col("trip_distance") + F.sin(F.col("pickup_hour")) * 9 + F.col("dropoff_location_id")
    )
    for name, part in (("train", "row_id % 5 <> 0"), ("test", "row_id % 5 = 0")):
        base.filter(part).drop("row_id").write.parquet(f"{tmp_path}/{name}")
    scores = duration.train_encoded(spark, str(tmp_path), f"{tmp_path}/model", iterations=30).first()
    assert scores.trees == 30 and scores.training_rows == 2400 and scores.r2 > 0.8
    test = spark.read.parquet(f"{tmp_path}/test")
    one = duration.predict_with_encoded(spark, f"{tmp_path}/model", test, f"{tmp_path}/out")
    again = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, one.collect())) == sorted(map(str, again.collect()))
    assert again.filter("prediction IS NOT NULL").count() == 600


def test_forest_learns(spark):
    data = random_dataset(spark)
    model = models.fit_model(data, "rf")
    predicted = model.transform(encoding.with_category_text(data))
    assert regression.regression_metrics(predicted).first().r2 > 0.5


def test_dataset_does_not_depend_on_layout(spark, file_rows, tmp_path):
    rows = file_rows(*[
        {"tpep_pickup_datetime": f"2025-{11 + i % 2}-{1 + i % 28:02d} {i % 24:02d}:00:00",
         "tpep_dropoff_datetime": f"2025-{11 + i % 2}-{1 + i % 28:02d} {i % 24:02d}:{5 + i % 50:02d}:00",
         "PULocationID": 1 + i % 30, "trip_distance": 1 + i / 50} for i in range(400)
    ])
    period = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    trips = with_calendar(batch_to_canonical(rows, period, wall_clock=True))
    found = []
    for parts in (1, 7):
        path = f"{tmp_path}/trips{parts}"
        trips.repartition(parts).write.parquet(path)
        duration.build_dataset(spark, path, f"{tmp_path}/ml{parts}", "2025-12", 0.3, 0.5)
        found.append([
            sorted(map(str, spark.read.parquet(f"{tmp_path}/ml{parts}/{n}").collect()))
            for n in ("train", "test")
        ])
    assert found[0] == found[1] and 30 < len(found[0][0]) < 90


def test_a_full_build_forgets_vanished_periods(spark, file_rows, tmp_path):
    from triplake.plans import serving
    from triplake.sources.tables import write_periods

    def trips(*months):
        rows = file_rows(*[
            {"tpep_pickup_datetime": f"2025-{m}-05 08:00:00", "tpep_dropoff_datetime": f"2025-{m}-05 08:20:00"}
            for m in months
        ])
        period = F.date_format("tpep_pickup_datetime", "yyyy-MM")
        canonical = with_calendar(batch_to_canonical(rows, period, wall_clock=True))
        return canonical.withColumns({
            f"{end}_{c}": F.lit("z") for end in ("pickup", "dropoff") for c in ("zone", "borough", "service_zone")
        })

    write_periods(trips("10", "11"), f"{tmp_path}/trips", whole=True)
    serving.build_serving(spark, f"{tmp_path}/trips", f"{tmp_path}/gold")
    write_periods(trips("11"), f"{tmp_path}/trips", whole=True)
    serving.build_serving(spark, f"{tmp_path}/trips", f"{tmp_path}/gold")
    months = {r.pickup_month for t in serving.read_serving(spark, f"{tmp_path}/gold").values() for r in t.collect()}
    assert months == {11}
    assert serving.check_serving(spark, f"{tmp_path}/trips", f"{tmp_path}/gold")[1]


def test_all_jobs_end_to_end(spark, file_rows, tmp_path, capsys):
    """Land, stream, build, check, export, train and predict by command line."""
    from test_tables import ZONE_FILE, write_file

    def at(i, month):
        start = f"2025-{month}-{1 + i % 28:02d} {i % 24:02d}"
        return {"tpep_pickup_datetime": f"{start}:00:00",
                "tpep_dropoff_datetime": f"{start}:{5 + i % 50:02d}:00",
                "PULocationID": 1 + i % 30, "trip_distance": 1 + i % 50 / 5}

    source = tmp_path / "source"
    for month in ("10", "11"):
        write_file(file_rows(*[at(i, month) for i in range(90)]), source,
                   f"trips_2025-{month}.parquet", tmp_path)
    (tmp_path / "zones.csv").write_text(ZONE_FILE)
    topic = tmp_path / "topic"
    topic.mkdir()
    rows = file_rows(*[at(i, "12") for i in range(60)]).withColumn("p", F.lit("2025-12"))
    from triplake.sources.messages import eof_messages, to_messages

    to_messages(rows, "p").unionByName(eof_messages(rows, "p")).select(
        "key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"),
    ).write.mode("append").parquet(str(topic))

    def job(*words):
        assert main([str(w) for w in words]) == 0

    p = tmp_path
    job("land", "--source", source, "--target", p / "batch", "--streaming-month", "2025-12")
    job("ingest", "--streaming-month", "2025-12", "--replay-folder", topic, "--target",
        p / "stream", "--checkpoint", p / "cp", "--until-done")
    job("trips", "--batch-root", p / "batch", "--stream-root", p / "stream", "--zones",
        p / "zones.csv", "--target", p / "trips")
    job("serving", "--trips", p / "trips", "--base", p / "gold")
    capsys.readouterr()
    job("check", "--trips", p / "trips", "--base", p / "gold")
    assert "OVERALL RESULT: PASS" in capsys.readouterr().out
    before = sorted(map(str, spark.read.parquet(str(p / "gold/daily_summary")).collect()))
    job("serving", "--trips", p / "trips", "--base", p / "gold", "--year", 2025, "--month", 11)
    assert sorted(map(str, spark.read.parquet(str(p / "gold/daily_summary")).collect())) == before
    sources = ("--batch-root", p / "batch", "--stream-root", p / "stream", "--zones", p / "zones.csv")
    job("rebuild", *sources, "--target", p / "trips", "--manifest", p / "manifest",
        "--serving", p / "gold")
    assert "bootstrapped" in capsys.readouterr().out
    job("rebuild", *sources, "--target", p / "trips", "--manifest", p / "manifest",
        "--serving", p / "gold")
    plan = capsys.readouterr().out
    assert "unchanged" in plan and "rebuilt" not in plan and "bootstrapped" not in plan
    job("refresh", *sources, "--base", p / "gold2", "--state", p / "gold2-state")
    assert sorted(map(str, spark.read.parquet(str(p / "gold2/daily_summary")).collect())) == before
    job("refresh", *sources, "--base", p / "gold2", "--state", p / "gold2-state")
    assert "periods: none" in capsys.readouterr().out
    job("export", "--base", p / "gold", "--target", p / "out")
    assert spark.read.parquet(str(p / "out/daily_summary")).count() == len(before)
    job("dataset", "--trips", p / "trips", "--base", p / "ml", "--test-month", "2025-12",
        "--train-fraction", 1.0, "--test-fraction", 1.0, "--export-to", p / "ml_out")
    job("train", "--dataset", p / "ml", "--models-base", p / "models", "--scores",
        p / "scores", "--predictions", p / "predictions", "--models", "linear")
    tested = spark.read.parquet(str(p / "ml/test"))
    assert spark.read.parquet(str(p / "predictions")).count() == tested.count() > 0
    assert len(list((p / "models/best_model_info").glob("part-*.json"))) == 1
    assert spark.read.json(str(p / "models/best_model_info")).first().best_model == "linear"
    job("train-encoded", "--dataset", p / "ml", "--target", p / "encoded", "--iterations", 3)
    job("predict-encoded", "--model", p / "encoded", "--inputs", p / "ml/test", "--target", p / "enc_out")
    assert spark.read.parquet(str(p / "enc_out")).count() == tested.count()
    tested.withColumn("pickup_day_of_week", F.lit("Monday")).write.parquet(str(p / "planned"))
    job("predict", "--models-base", p / "models", "--inputs", p / "planned", "--target",
        p / "scored")
    assert spark.read.parquet(str(p / "scored")).filter("valid").count() == tested.count()
    with pytest.raises(SystemExit):
        main(["trips", "--zones", "z", "--target", "t"])
    with pytest.raises(SystemExit):
        main(["serving", "--trips", "t", "--base", "b", "--month", "1"])

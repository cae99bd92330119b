"""Streaming ingest by replay, restarts, and audits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from triplake.operators.canonical import messages_to_canonical
from triplake.plans import stream
from triplake.schemas import MESSAGE_SCHEMA
from triplake.sources import messages
from triplake.sources.bronze import read_messages
from triplake.sources.messages import eof_messages, to_messages
from triplake.streaming import audit, ingest


@pytest.fixture
def topic(spark, file_rows, tmp_path):
    """Fifty trips in five files, closed by a control row in a sixth."""
    rows = file_rows(*[{"VendorID": i} for i in range(50)]).withColumn("p", F.lit("2024-01"))
    sent = to_messages(rows, "p", beside=("VendorID",)).withColumn("offset", F.col("VendorID"))
    closing = eof_messages(rows, "p").withColumn("offset", F.lit(50).cast("bigint"))
    folder = str(tmp_path / "topic")
    for part in (sent.drop("VendorID").repartition(5), closing.coalesce(1)):
        part.select(
            "key",
            "value",
            F.lit("trips").alias("topic"),
            F.lit(0).alias("partition"),
            "offset",
            F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        ).write.mode("append").parquet(folder)
    return folder


def run(spark, topic, tmp_path, files=2):
    source = ingest.replay_source(spark, topic, files)
    query = ingest.start_ingest(
        source, "2024-01", str(tmp_path / "bronze"), str(tmp_path / "check"), until_done=True
    )
    query.awaitTermination()
    return query


def test_replay_restart_and_audit(spark, topic, tmp_path):
    query = run(spark, topic, tmp_path)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    bronze_path = str(tmp_path / "bronze")
    bronze = spark.read.parquet(bronze_path)
    assert bronze.count() == 50
    assert (tmp_path / "bronze" / "year=2024" / "month=01").is_dir()
    run(spark, topic, tmp_path)
    assert spark.read.parquet(bronze_path).count() == 50

    report = audit.offset_audit(bronze)
    row = report.first()
    assert (row.row_count, row.min_offset, row.max_offset, row.gaps, row.duplicates) == (
        50, 0, 49, 0, 0,
    )
    assert audit.completion(report, 50).first().state == "complete"
    assert audit.completion(report, 51).first().state == "incomplete"
    assert audit.completion(report, 49).first().state == "overshoot"
    twice = audit.offset_audit(bronze.unionByName(bronze.filter("kafka_offset = 7")))
    assert audit.completion(twice, 50).first().state == "overshoot"
    trips = read_messages(spark, bronze_path)
    assert trips.filter("pickup_location_id = 10 AND passenger_count = 1").count() == 50


def test_batch_and_stream_forms_agree(spark, topic, tmp_path):
    run(spark, topic, tmp_path)
    stored = read_messages(spark, str(tmp_path / "bronze"))
    messages = spark.read.schema(MESSAGE_SCHEMA).parquet(topic)
    direct = messages_to_canonical(ingest.accept(ingest.decode(messages), "2024-01"))
    order = "kafka_offset"
    assert stored.orderBy(order).collect() == direct.orderBy(order).collect()


def test_arguments_are_checked(spark, topic, tmp_path):
    with pytest.raises(ValueError):
        ingest.replay_source(spark, topic, 0)
    with pytest.raises(ValueError):
        ingest.kafka_source(spark, "host:1", "t", max_offsets_per_trigger=0)
    stream = ingest.replay_source(spark, topic)
    with pytest.raises(ValueError):
        ingest.bronze_writer(stream, str(tmp_path), trigger_seconds=-1)
    with pytest.raises(ValueError):
        ingest.start_ingest(stream, "2024-1", str(tmp_path / "b"), str(tmp_path / "c"))


def test_checkpoint_progress(spark, tmp_path):
    checkpoint = str(tmp_path / "kafka")
    assert audit.checkpoint_progress(spark, checkpoint, "trips").count() == 0
    offsets, commits = tmp_path / "kafka" / "offsets", tmp_path / "kafka" / "commits"
    offsets.mkdir(parents=True)
    for batch, end in ((0, 10), (1, 20), (10, 41)):
        (offsets / str(batch)).write_text(
            'v1\n{"batchWatermarkMs":0}\n{"trips":{"0":%d,"1":10,"2":0}}' % end
        )
    assert tuple(audit.checkpoint_progress(spark, checkpoint, "trips").first()) == (10, 51, False)
    commits.mkdir()
    (commits / "10").write_text('v1\n{"nextBatchWatermarkMs":0}')
    assert tuple(audit.checkpoint_progress(spark, checkpoint, "trips").first()) == (10, 51, True)


def test_a_month_is_sent_and_complete(spark, file_rows, tmp_path):
    """Rows in turn over partitions, the control row after them, then the audit."""
    source, folder = str(tmp_path / "month"), str(tmp_path / "topic")
    file_rows(*[{"VendorID": i} for i in range(50)]).repartition(3).write.parquet(source)
    calls = []

    def publish(rows):
        calls.append(rows.count())
        messages.store(rows, folder, "trips")

    assert stream.send_month(spark, source, "2024-01", publish, max_rows=40) == 40
    assert calls == [40, 1]
    sent = spark.read.parquet(folder)
    per = {r.partition: (r.n, r.last) for r in sent.groupBy("partition").agg(
        F.count("*").alias("n"), F.max("offset").alias("last")).collect()}
    assert all(n == last + 1 for n, last in per.values()) and len(per) == 3
    query = ingest.start_ingest(
        ingest.replay_source(spark, folder), "2024-01", str(tmp_path / "bronze"),
        str(tmp_path / "cp"), until_done=True,
    )
    query.awaitTermination()
    stored = audit.offset_audit(spark.read.parquet(str(tmp_path / "bronze")))

    def progress(end, committed):
        return spark.createDataFrame([(3, end, committed)], "batch_id long, end_offset long, committed boolean")

    assert audit.completion(stored, 40, progress(41, True)).first().state == "complete"
    for wrong in (progress(40, True), progress(41, False), progress(41, True).limit(0)):
        assert audit.completion(stored, 40, wrong).first().state == "incomplete"
    assert audit.completion(stored, 41, progress(42, True)).first().state == "incomplete"
    assert audit.completion(stored, 39, progress(40, True)).first().state == "overshoot"
    nothing = stream.stream_state(spark, str(tmp_path / "none"), str(tmp_path / "none"), "trips", 40)
    assert nothing.first().state == "incomplete"
    with pytest.raises(ValueError):
        stream.send_month(spark, source, "2024-01", publish, max_rows=0)


def test_sending_goes_on_where_it_stopped(spark, file_rows, tmp_path):
    source, folder, log = (str(tmp_path / n) for n in ("month", "topic", "log"))
    file_rows(*[{"VendorID": i} for i in range(50)]).repartition(4).write.parquet(source)
    calls = []

    def publish(rows, fail_at=None, partly=False):
        calls.append(rows.count())
        if len(calls) == fail_at:
            if partly:
                messages.store(rows.limit(5), folder, "trips")
            raise RuntimeError("the broker went away")
        messages.store(rows, folder, "trips")

    def send(fail_at=None, partly=False, **how):
        calls.clear()
        return stream.send_month(
            spark, source, "2024-01", lambda rows: publish(rows, fail_at, partly), log=log,
            chunk_rows=12, arrived=lambda: spark.read.parquet(folder), **how,
        )

    with pytest.raises(RuntimeError):
        send(fail_at=3, partly=True)
    assert calls == [12, 12, 12]
    assert send() == 50
    # What arrived of the third chunk is not sent again.
    assert calls == [7, 12, 2, 1]
    assert send() == 50 and calls == []
    sent = spark.read.schema(MESSAGE_SCHEMA).parquet(folder)
    assert sent.count() == 51 == sent.select("partition", "offset").distinct().count()
    ingest.start_ingest(
        ingest.replay_source(spark, folder), "2024-01", str(tmp_path / "bronze"),
        str(tmp_path / "cp"), until_done=True,
    ).awaitTermination()
    stored = audit.offset_audit(spark.read.parquet(str(tmp_path / "bronze")))
    progress = audit.replay_progress(spark, str(tmp_path / "cp"))
    found = audit.completion(stored, 50, progress).first()
    assert (found.state, found.duplicates, found.end_offset) == ("complete", 0, 51)
    (tmp_path / "cp" / "commits" / str(progress.first().batch_id)).unlink()
    gone = audit.replay_progress(spark, str(tmp_path / "cp"))
    assert audit.completion(stored, 50, gone).first().state == "incomplete"
    with pytest.raises(ValueError, match="other rows"):
        send(max_rows=30)
    assert audit.replay_progress(spark, str(tmp_path / "none")).count() == 0


def test_positions_without_sorting_rows_or_files_in_one_task(spark, tmp_path, setting):
    setting("spark.sql.shuffle.partitions", "4")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    source = str(tmp_path / "rows")
    spark.range(700).repartition(23).write.parquet(source)
    rows = spark.read.parquet(source)
    starts = messages.file_starts(rows)
    ends = sorted((r._start, r._end) for r in starts.collect())
    assert [s for s, _ in ends] == [0, *[e for _, e in ends[:-1]]] and ends[-1][1] == 700
    names = [r._start_file for r in starts.orderBy("_start").collect()]
    assert names == sorted(names)
    placed = messages.with_position(rows, "at", starts)
    assert sorted(r["at"] for r in placed.collect()) == list(range(700))
    assert "SinglePartition" not in placed._jdf.queryExecution().executedPlan().toString()
    some = messages.rows_between(rows, 100, 160, starts, "at")
    assert sorted(some.collect()) == sorted(placed.filter("at >= 100 AND at < 160").collect())
    found = some._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [found.apply(i) for i in range(found.size())]
    opened = [x.selectedPartitions().totalNumberOfFiles() for x in scans if "Scan" in x.nodeName() and "id" in x.toString()]
    assert not opened or min(opened) < 23
    assert messages.with_position(rows.filter("id < 0"), "at").count() == 0

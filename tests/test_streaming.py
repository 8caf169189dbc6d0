import json
import os

import pytest
from pyspark.sql import functions as F

from tidewell.registry import sample_lake
from tidewell.schemas import DATABASE_LOG, NETWORK_LOG
from tidewell.streaming import logs
from tidewell.streaming.rollup import traffic_rollup

FOLDER = "/root/testdata/sf0.001"


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as file:
        file.write("\n".join(lines) + "\n")


def drain(spark, source, root, parse=logs.parse_database_logs):
    stream = parse(logs.read_records(spark, "text", source))
    logs.write_log_stream(stream, f"{root}/progress", path=f"{root}/stored", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/stored")


def record(n, when="2024-01-05T03:04:05.000006Z", **more):
    return json.dumps({"timestamp": when, "query_id": f"q{n}", **more})


@pytest.mark.parametrize("table, schema, parse", [
    ("database_logs", DATABASE_LOG, logs.parse_database_logs),
    ("network_logs", NETWORK_LOG, logs.parse_network_logs)])
def test_parsing_gives_the_table_back(spark, table, schema, parse):
    rows = sample_lake(spark, FOLDER)[table]
    parsed = parse(logs.as_records(rows, schema))
    assert parsed.columns == rows.columns and len(rows.columns) == len(schema) + 5
    assert parsed.exceptAll(rows).count() == 0 and parsed.count() == rows.count() == 1000


def test_restart_takes_new_files_only(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path)
    put(source, "one.json", [record(1), record(2)])
    assert drain(spark, source, root).count() == 2
    assert drain(spark, source, root).count() == 2
    put(source, "two.json", [record(3, "2024-01-06T23:00:00Z")])
    stored = drain(spark, source, root)
    assert sorted(r.query_id for r in stored.collect()) == ["q1", "q2", "q3"]
    assert os.path.isdir(tmp_path / "stored/year=2024/month=1/day=6/hour=23")
    batch = logs.parse_database_logs(spark.read.text(source).withColumnRenamed("value", "data"))
    assert stored.select(batch.columns).exceptAll(batch).count() == 0


def test_bad_records_do_not_stop_the_stream_and_go_to_quarantine(spark, tmp_path):
    source = str(tmp_path / "in")
    put(source, "bad.json", [
        "not json", '{"timestamp":"bad"}', '{"query_id":"q"}', '{"rows_affected":99999999999}', "", record(1),
        record(2, rows_affected=99999999999)])
    valid, rejected = logs.split_valid(logs.judged_logs(logs.read_records(spark, "text", source), DATABASE_LOG))
    root = str(tmp_path)
    logs.write_log_stream(valid, f"{root}/a", path=f"{root}/valid", available_now=True).awaitTermination()
    logs.write_quarantine(rejected, f"{root}/b", f"{root}/rejected", available_now=True).awaitTermination()
    assert [r.query_id for r in spark.read.parquet(f"{root}/valid").collect()] == ["q1"]
    # The text comes back as it was, so it can be mended and replayed.
    assert sorted(r.data for r in spark.read.parquet(f"{root}/rejected").collect()) == sorted([
        "not json", '{"timestamp":"bad"}', '{"query_id":"q"}', '{"rows_affected":99999999999}', "",
        record(2, rows_affected=99999999999)])


def test_log_table_is_declared_once(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS logs_db")
    for _ in range(2):
        logs.create_log_table(spark, "logs_db.network_logs", NETWORK_LOG, str(tmp_path / "net"))
    table = spark.table("logs_db.network_logs")
    assert len(table.columns) == 22 and table.columns[-4:] == ["year", "month", "day", "hour"]
    source = str(tmp_path / "in")
    put(source, "a.json", [json.dumps({"timestamp": "2024-01-05T03:00:00Z", "connection_id": "c1", "source_port": 5})])
    stream = logs.parse_network_logs(logs.read_records(spark, "text", source))
    logs.write_log_stream(stream, str(tmp_path / "progress"), table="logs_db.network_logs",
                          available_now=True).awaitTermination()
    spark.catalog.refreshTable("logs_db.network_logs")
    assert [(r.connection_id, r.hour) for r in spark.table("logs_db.network_logs").collect()] == [("c1", 3)]
    spark.sql("DROP DATABASE logs_db CASCADE")


def test_default_trigger_runs_until_stopped(spark, tmp_path):
    source = str(tmp_path / "in")
    put(source, "a.json", [record(1)])
    stream = logs.parse_database_logs(logs.read_records(spark, "text", source))
    query = logs.write_log_stream(stream, str(tmp_path / "progress"), path=str(tmp_path / "stored"))
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(str(tmp_path / "stored")).count() == 1


def test_late_rollup_waits_and_then_drops(spark, tmp_path):
    source, progress, stored = (str(tmp_path / name) for name in ("in", "progress", "stored"))

    def connection(when):
        return json.dumps({"timestamp": f"2024-01-05T{when}Z", "protocol": "TCP", "bytes_sent": 1, "bytes_received": 2})

    def run():
        rolled = traffic_rollup(logs.parse_network_logs(logs.read_records(spark, "text", source)))
        query = (rolled.writeStream.format("parquet").option("path", stored).option("checkpointLocation", progress)
                 .outputMode("append").trigger(availableNow=True).start())
        query.awaitTermination()
        return {(r.window_start.strftime("%H:%M"), r.connections, r.total_bytes)
                for r in spark.read.parquet(stored).collect()}

    put(source, "1.json", [connection("10:01:00"), connection("10:02:00")])
    put(source, "2.json", [connection("10:03:00")])
    assert run() == set()
    put(source, "3.json", [connection("10:04:00"), connection("10:30:00")])
    assert run() == {("10:00", 4, 12)}
    put(source, "4.json", [connection("10:01:00"), connection("10:50:00")])
    assert run() == {("10:00", 4, 12), ("10:30", 1, 3)}


def test_connector_payload_is_named_data(spark, tmp_path):
    put(str(tmp_path), "a.json", [record(1)])
    assert logs.read_records(spark, "text", str(tmp_path)).columns == ["data"]
    rows = spark.createDataFrame([(bytearray(record(7).encode()),)], "data binary")
    assert logs.parse_database_logs(rows).select(F.col("query_id"), "hour").first()[:] == ("q7", 3)


def test_one_stream_fills_the_table_and_the_quarantine(spark, tmp_path):
    source, path, progress = str(tmp_path / "in"), str(tmp_path / "split"), str(tmp_path / "progress")
    put(source, "one.json", [record(1), record(2, "2024-01-06T23:00:00Z"), "not json", record(3, rows_affected=99999999999)])
    judged = logs.judged_logs(logs.read_records(spark, "text", source), DATABASE_LOG)
    assert logs.read_valid(spark, path, DATABASE_LOG).count() == 0

    def drain_split():
        logs.write_split_stream(judged, progress, path, available_now=True).awaitTermination()
    drain_split()
    assert sorted(r.query_id for r in logs.read_valid(spark, path, DATABASE_LOG).collect()) == ["q1", "q2"]
    assert {r.data for r in logs.read_rejected(spark, path, DATABASE_LOG).collect()} == {
        "not json", record(3, rows_affected=99999999999)}
    put(source, "two.json", [record(4), "{"])
    drain_split()
    drain_split()
    assert logs.read_valid(spark, path, DATABASE_LOG).count() == 3
    assert sorted((r.batch, r.data) for r in logs.read_rejected(spark, path, DATABASE_LOG).collect())[-1] == (1, "{")
    # A batch that is written again, as after a crash before its commit, replaces itself.
    again = logs.judged_logs(spark.createDataFrame([(record(4),), ("{",)], "data string"), DATABASE_LOG)
    for _ in range(2):
        logs.write_split_batch(again, 1, path)
    assert sorted(r.query_id for r in logs.read_valid(spark, path, DATABASE_LOG).collect()) == ["q1", "q2", "q4"]
    assert logs.read_rejected(spark, path, DATABASE_LOG).count() == 3
    hours = os.listdir(f"{path}/fits=1/year=2024/month=1/day=5/hour=3")
    assert sorted(h for h in hours if h.startswith("batch")) == ["batch=0", "batch=1"]


def test_a_split_batch_has_few_files(spark, tmp_path):
    path = str(tmp_path / "split")
    rows = spark.range(4000).repartition(16).select(F.concat(
        F.lit('{"timestamp":"2024-01-05T0'), F.col("id") % 3, F.lit(':00:00Z","query_id":"q'), "id", F.lit('"}')).alias("data"))
    for spread, most in ((1, 1), (3, 3)):
        logs.write_split_batch(logs.judged_logs(rows, DATABASE_LOG), 0, path, spread)
        for hour in range(3):
            folder = f"{path}/fits=1/year=2024/month=1/day=5/hour={hour}/batch=0"
            assert 1 <= len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= most
        assert logs.read_valid(spark, path, DATABASE_LOG).count() == 4000

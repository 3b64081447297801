"""Committed lines, the score table in buckets, failures counted on the way."""

import json

import pytest
from pyspark.sql import functions as F

from millrace import sinks
from millrace.operators import movies
from millrace.sinks import committed
from millrace.sources import tables


def _records(spark, n, mark="a"):
    rows = [(f"http://{mark}/{i}", "2021-03-01 01:23:54", f"text {i}") for i in range(n)]
    return spark.createDataFrame(rows, "uri string, ts string, content string").withColumn("ts", F.col("ts").cast("timestamp"))


def _uris(spark, place):
    return sorted(r.uri for r in tables.decode_lines(committed.read_lines(spark, place)).collect())


def test_committed_lines_come_back(spark, tmp_path):
    place = f"file://{tmp_path}/out"
    assert committed.read_lines(spark, place).collect() == []
    committed.write(_records(spark, 7).repartition(3), place)
    committed.write(_records(spark, 2, "b"), place)
    committed.write(_records(spark, 0), place)
    rows = tables.decode_lines(committed.read_lines(spark, place)).collect()
    assert sorted(r.uri for r in rows) == sorted([f"http://a/{i}" for i in range(7)] + ["http://b/0", "http://b/1"])
    assert {float(r.ts) for r in rows} == {1614561834.0} and all(r.error is None for r in rows)


def test_an_aborted_write_leaves_nothing_to_see(spark, tmp_path):
    place = f"file://{tmp_path}/out"
    committed.write(_records(spark, 3), place)
    fails = F.when(F.col("uri").endswith("/59"), F.raise_error(F.lit("bad row"))).otherwise(F.col("uri"))
    broken = _records(spark, 60, "broken").repartition(6, "uri").withColumn("uri", fails)
    with pytest.raises(Exception, match="bad row"):
        committed.write(broken, place)
    assert _uris(spark, place) == [f"http://a/{i}" for i in range(3)]
    assert len(list((tmp_path / "out" / "manifests").glob("*.json"))) == 1


def test_a_repeated_step_adds_no_row(spark, tmp_path):
    place = f"file://{tmp_path}/out"
    _records(spark, 5).write.parquet(f"{tmp_path}/in/one")
    schema = "uri string, ts timestamp, content string"

    def run(checkpoint):
        rows = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        committed.write_stream(rows, place, f"{tmp_path}/{checkpoint}").awaitTermination()

    run("first")
    # The checkpoint is lost, so the same step comes again under the same number.
    run("second")
    assert _uris(spark, place) == [f"http://a/{i}" for i in range(5)]
    files = [json.loads(line)["file"] for f in (tmp_path / "out" / "manifests").glob("*.json") for line in open(f)]
    assert sorted(files) == sorted(f"data/{f.name}" for f in (tmp_path / "out" / "data").glob("*.txt"))
    _records(spark, 2, "later").write.parquet(f"{tmp_path}/in/two")
    run("second")
    assert len(_uris(spark, place)) == 7


def _scores(spark, n, shift=0):
    return spark.createDataFrame(
        [(86400 * d, f"m{d % 5}", 10 * (d % 7) + shift, 1, 50, 2) for d in range(n)],
        "ts long, name string, critic long, numCritic long, audience long, numAudience long",
    )


def test_series_in_buckets_need_no_shuffle_and_inserts_repeat(spark, tmp_path):
    sinks.create_score_table(spark, "bucketed_scores", f"file://{tmp_path}/scores", buckets=4)
    try:
        sinks.insert_scores(_scores(spark, 40), "bucketed_scores", "one")
        sinks.insert_scores(_scores(spark, 10, 5), "bucketed_scores", "two")
        before = sorted(spark.table("bucketed_scores").collect())
        assert len(before) == 50
        sinks.insert_scores(_scores(spark, 10, 5), "bucketed_scores", "two")
        assert sorted(spark.table("bucketed_scores").collect()) == before
        changes = movies.score_changes(spark.table("bucketed_scores"))
        plan = changes._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        whole = _scores(spark, 40).union(_scores(spark, 10, 5))
        names = ["name", "kind", "points", "minmax"]
        assert sorted(changes.select(names).collect()) == sorted(movies.score_changes(whole).select(names).collect())
    finally:
        spark.sql("DROP TABLE bucketed_scores")


def test_failures_are_counted_in_the_pass_that_writes(spark, tmp_path):
    rows = spark.range(100).select(
        "id", F.when(F.col("id") % 10 == 0, "no score").when(F.col("id") == 5, "torn").alias("error")
    )
    reasons = {"no score": F.col("error") == "no score"}
    counts = sinks.write_counted(rows, f"{tmp_path}/a", reasons, most=0.2)
    assert counts == {"rows": 100, "failed": 11, "no score": 10, "other": 1}
    assert spark.read.parquet(f"{tmp_path}/a").filter("outcome = 'quarantine'").count() == 11
    with pytest.raises(sinks.TooManyFailures, match="failed: 11") as told:
        sinks.write_counted(rows, f"{tmp_path}/b", reasons, most=0.1)
    assert told.value.counts["rows"] == 100
    none = sinks.write_counted(rows.filter("id < 0"), f"{tmp_path}/c", reasons, most=0.0)
    assert none == {"rows": 0, "failed": 0, "no score": 0, "other": 0}


def test_a_line_for_every_point_behind_an_alert(spark):
    scores = _scores(spark, 10)
    alerts = movies.score_alerts(scores, 30.0, "minmax", ["critics"])
    lines = [r.line for r in movies.point_lines(movies.alert_points(scores, alerts, ["critics"]), alerts).collect()]
    assert lines[0] == "m0 (critics): minmax=50 at=1970-01-01 00:00:00 score=0"
    assert len(lines) == sum(r.points for r in alerts.collect()) > 0

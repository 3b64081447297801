"""Index lines, CSV, encoded lines, landed payloads, sinks, registry."""

import base64
import gzip
import json
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

import __spark_entry__ as entry
from millrace import session, sinks
from millrace.functions import codec
from millrace.operators import articles, movies, quarantine
from millrace.plans import registry, studies
from millrace.sources import locations, tables


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_location_lines(spark):
    at = lines(spark, "k", " k 5 ", "k 5 7", "k 5 7 9", "", "  ", "k x", "k 5 y", "k  5")
    got = [tuple(r) for r in locations.parse_locations(at).collect()]
    assert got[:3] == [("k", 0, None, None), ("k", 5, None, None), ("k", 5, 12, None)]
    assert len(got) == 7 and all(g[0] is None and g[3] for g in got[3:])
    with pytest.raises(Exception, match="malformed location line: k"):
        locations.parse_locations(at, strict=True).collect()


def test_capture_lines(spark):
    good = 'com,x)/m/a 2021 {"filename": "f", "offset": "3", "length": "4", "mime": "text/html"}'
    at = lines(spark, good, "com,x)/m/a 2021", 'com,x)/ 1 {"filename": "f"}', "c 1 {oops}")
    got = [tuple(r) for r in locations.parse_captures(at).collect()]
    assert got[0] == ("f", 3, 7, None)
    assert [g[3] for g in got[1:]] == ["malformed capture line"] * 3


def test_csv_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('uri,ts,note\nhttp://a,12.5,"x, ""y""\nz"\nhttp://b,2021-01-02 03:04:05,\n')
    got = {r.uri: r for r in tables.read_csv_records(spark, str(tmp_path / "a.csv"), multiline=True).collect()}
    assert json.loads(got["http://a"].content) == {"uri": "http://a", "ts": "12.5", "note": 'x, "y"\nz'}
    assert json.loads(got["http://b"].content)["note"] == ""
    assert str(got["http://a"].ts) == "1970-01-01 00:00:12.500000"
    assert str(got["http://b"].ts) == "2021-01-02 03:04:05" and got["http://b"].ts_raw[:4] == "2021"
    (tmp_path / "b.csv").write_text("uri,x\n1,2\n")
    with pytest.raises(ValueError, match="ts"):
        tables.read_csv_records(spark, str(tmp_path / "b.csv"))


def encoded(row):
    return base64.b64encode(gzip.compress(json.dumps(row).encode(), 9)).decode()


def test_encoded_lines_from_elsewhere(spark):
    rows = [
        {"uri": "http://a", "ts": 1614561834.0, "content": {"k": 1}},
        {"uri": "http://b", "ts": "x", "title": "é", "text": "t\nu"},
        {"error": "bad", "reason": "why"},
    ]
    at = lines(spark, *map(encoded, rows), "not base64!", base64.b64encode(b"not gzip").decode(), "")
    got = tables.decode_lines(at).collect()
    assert [(r.uri, r.error) for r in got] == [
        ("http://a", None), ("http://b", None), (None, "bad"),
        (None, "damaged result line"), (None, "damaged result line"),
    ]
    assert got[0].content == '{"k":1}' and float(got[0].ts) == 1614561834.0
    assert (got[1].title, got[1].text, got[2].reason) == ("é", "t\nu", "why")
    with pytest.raises(Exception, match="damaged result line"):
        tables.decode_lines(at, strict=True).collect()


def test_encoded_lines_are_readable_elsewhere(spark):
    rows = spark.createDataFrame([("http://a", "long " * 500)], "uri string, content string").withColumn(
        "ts", F.timestamp_seconds(F.lit(1.5))
    )
    line = sinks.encode_lines(rows).first().value
    assert "\n" not in line and "\r" not in line
    assert json.loads(gzip.decompress(base64.b64decode(line))) == {
        "uri": "http://a", "content": "long " * 500, "ts": 1.5,
    }


def test_shards_and_append(spark, tmp_path):
    for shard in "0", "f", "x":
        sinks.write_encoded(spark.createDataFrame([(f"http://{shard}",)], "uri string"), str(tmp_path / f"results.{shard}1.json"))
    sinks.write_encoded(spark.createDataFrame([("http://0",)], "uri string"), str(tmp_path / "results.01.json"))
    got = studies.host_study(spark, str(tmp_path / "results.[0-9a-f]*.json"), form="encoded")
    assert [tuple(r) for r in got.collect()] == [("0", 2), ("f", 1)]


def test_landed_payloads(spark, tmp_path):
    (tmp_path / "1").write_text('{"blocks":\n []}')
    got = tables.read_landed_payloads(spark, str(tmp_path)).first()
    assert got.content == '{"blocks":\n []}' and got.uri.endswith("/1") and got.ts is not None


def test_quarantine(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("b", "bad")], "uri string, error string")
    assert quarantine.good(rows).first().uri == "a" and quarantine.failed(rows).first().uri == "b"
    sinks.write_with_quarantine(rows, str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q" / "outcome=quarantine")).first().uri == "b"


def test_score_table(spark, tmp_path):
    scores = spark.createDataFrame(
        [(1, "a", 2, 3, 4, 5)], "ts int, name string, critic int, numCritic int, audience int, numAudience int"
    )
    scores.write.parquet(str(tmp_path / "s"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shelf LOCATION 'file://{tmp_path}/db'")
    for _ in range(2):
        sinks.append_scores(scores, "shelf.rt")
    assert spark.table("shelf.rt").count() == 2
    assert dict(spark.table("shelf.rt").dtypes)["ts"] == "bigint"
    spark.sql("DROP DATABASE shelf CASCADE")


def test_times_as_sources_write_them(spark, tmp_path):
    raw = ["1614561834", "20210301", "20210301012354", "2021-03-01 01:23:54", "1 March 2021", ""]
    (tmp_path / "in.csv").write_text("uri,ts\n" + "".join(f"u{i},{t}\n" for i, t in enumerate(raw)))
    rows = articles.copy(tables.read_csv_records(spark, str(tmp_path / "in.csv"))).orderBy("uri").collect()
    assert [r.ts_raw or "" for r in rows] == raw
    assert [str(r.ts) for r in rows] == [
        "2021-03-01 01:23:54", "2021-03-01 00:00:00", "2021-03-01 01:23:54", "2021-03-01 01:23:54", "None", "None"]


def test_capture_table_reads_few_row_groups(spark, tmp_path):
    keys = F.concat(F.lit("com,site)/"), F.lpad((F.col("id") % 5000).cast("string"), 4, "0"))
    entry = F.concat(F.lit('{"filename": "f'), "id", F.lit('", "offset": "'), "id", F.lit('", "length": "7"}'))
    made = spark.range(20000).select(F.concat_ws(" ", keys, F.lit("20210304050607"), entry).alias("value"))
    # A key with a third of all captures, lines that are none, a time that is none.
    hot = spark.range(10000).select(F.concat_ws(" ", F.lit("com,site)/0042 20210304050607"), entry).alias("value"))
    odd = lines(spark, "", "com,site)/0043", 'com,site)/0043x soon {"filename": "g", "offset": "1", "length": "2"}')
    place = str(tmp_path / "captures")
    locations.write_capture_table(locations.parse_keyed_captures(made.union(hot).union(odd)), place, 16 << 10)
    below = locations.captures_below(spark, place, "com,site)/0043")
    got = sorted((r.url_key, r.key, r.start, r.end, r.ts is None) for r in below.collect())
    assert got == sorted(
        [("com,site)/0043", f"f{i}", i, i + 7, False) for i in (43, 5043, 10043, 15043)]
        + [("com,site)/0043x", "g", 1, 3, True)]
    )
    scan = below._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < 3000  # of 30,001
    assert locations.captures_below(spark, place, "com,site)/0042").count() == 10004
    assert locations.captures_below(spark, place, "org").count() == 0


def test_capture_index_reports_lines_that_are_none(spark, tmp_path):
    (tmp_path / "idx").write_text('com,x)/ 2021 {"filename": "none.warc.gz", "offset": "0", "length": "5"}\nbroken\n'
                                  'com,x)/ 2021 {"filename": "a", "offset": "-1", "length": "5"}\n')
    found = registry.compose(spark, "cdx-index", "copy", str(tmp_path / "idx"), base=f"file://{tmp_path}")
    assert sorted(r.error.split(":")[0] for r in found.collect()) == [
        "cannot read", "malformed capture line", "malformed capture line"]


def test_packed_points_are_unpacked(spark):
    rows = spark.createDataFrame([("a", "1;2;3;4;5"), ("b", "1;2"), ("c", None)], "name string, point string")
    got = {r.name: (r.ts, r.numAudience, r.error) for r in movies.unpack_points(rows).collect()}
    assert got == {"a": (1, 5, None), "b": (None, None, "not a packed point"), "c": (None, None, "not a packed point")}


def test_registry(spark, tmp_path):
    (tmp_path / "in.csv").write_text("uri,ts\nhttp://a/1,1\nhttp://a/2,2\nhttp://b/1,3\n")
    for sink in ("parquet", "json", "encoded"):
        out = str(tmp_path / sink)
        registry.run(spark, "csv-file", "copy", str(tmp_path / "in.csv"), out, sink=sink)
        assert [tuple(r) for r in studies.host_study(spark, out, form=sink).collect()] == [("a", 2), ("b", 1)]
        rows = tables.read_results(spark, out, ("content", "ts", "ts_raw", "title"), sink).collect()
        assert json.loads(rows[0].content)["uri"].startswith("http://")
        assert sorted((float(r.ts), r.ts_raw, r.title) for r in rows) == [
            (1.0, "1", None), (2.0, "2", None), (3.0, "3", None)]
    with pytest.raises(ValueError, match="unknown form"):
        tables.read_results(spark, out, ("uri",), "x")

    registry.register(registry.SOURCES, "numbers", lambda spark, n: spark.range(int(n)).select(
        F.concat(F.lit("http://n/"), "id").alias("uri"), F.timestamp_seconds("id").alias("ts"), F.lit("").alias("content")))
    registry.register(registry.TRANSFORMS, "first", lambda rows: rows.filter("uri = 'http://n/0'"))
    kept = []
    registry.register(registry.SINKS, "memory", lambda rows, path: kept.append((path, rows.count())))
    try:
        registry.run(spark, "numbers", "first", "5", "somewhere", sink="memory")
        assert kept == [("somewhere", 1)]
        with pytest.raises(ValueError, match="taken"):
            registry.register(registry.SOURCES, "numbers", None)
    finally:
        del registry.SOURCES["numbers"], registry.TRANSFORMS["first"], registry.SINKS["memory"]
    for args in (("x", "copy"), ("csv-file", "x")):
        with pytest.raises(ValueError, match="unknown"):
            registry.compose(spark, *args, str(tmp_path / "in.csv"))


def test_score_study(spark, tmp_path):
    rows = [
        {"uri": "https://www.rottentomatoes.com/m/a", "ts": 86400.0 * d, "criticScore": f"{10 * d}%",
         "criticNum": 1, "audienceScore": "50%", "audienceNum": 2} for d in range(3)
    ] + [{"error": "x"}]
    (tmp_path / "r.txt").write_text("\n".join(map(encoded, rows)) + "\n")
    got = studies.score_study(spark, str(tmp_path / "r.txt"), 10.0, "minmax", form="encoded").collect()
    assert [(r.name, r.kind, r.minmax) for r in got] == [("a", "critics", 20.0)]


def test_stored_scores_feed_the_alerts(spark, tmp_path):
    scores = spark.createDataFrame(
        [(86400 * d, "a", 10 * d, 1, 50, 2) for d in range(3)],
        "ts long, name string, critic long, numCritic long, audience long, numAudience long",
    )
    scores.write.parquet(str(tmp_path / "s"))
    stored = tables.read_scores(spark, str(tmp_path / "s"))
    assert [r.kind for r in movies.score_alerts(stored, 19.0, "minmax").collect()] == ["critics"]


def test_source_behind_the_data_source_interface(spark):
    """An outside system reached through Spark's own source interface."""

    class Reader(DataSourceReader):
        def partitions(self):
            return [InputPartition(i) for i in range(3)]

        def read(self, partition):
            yield f"http://n/{partition.value}", None, "text"

    class Numbered(DataSource):
        @classmethod
        def name(cls):
            return "numbered"

        def schema(self):
            return "uri string, ts timestamp, content string"

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Numbered)
    source = lambda spark, which: spark.read.format(which).load()
    registry.register(registry.SOURCES, "outside", source)
    try:
        rows = registry.compose(spark, "outside", "copy", "numbered").collect()
    finally:
        del registry.SOURCES["outside"]
    assert sorted(r.uri for r in rows) == ["http://n/0", "http://n/1", "http://n/2"]


def test_scratch_folder(spark):
    def told(root, master="local[2]"):
        context = SimpleNamespace(master=master, applicationId="test", _jsc=spark.sparkContext._jsc)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: root), sparkContext=context)

    assert session.scratch_root(told("/shared/place/")) == "file:///shared/place"
    assert session.scratch_path(told("hdfs://n/a"), "x").startswith("hdfs://n/a/millrace/x-")
    root = session.scratch_root(told(None))
    assert root.startswith("file:///") and session.scratch_root(told(None)) == root
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(told(None, "spark://host:7077"))


def test_encoded_blocks_keeps_little_on_disk(spark, tmp_path, monkeypatch):
    items = [(n // 3, n % 5, n % 7, n % 3 + 1, 2.0, 10.5, "ANR"[n % 3]) for n in range(300)]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"
    rows = spark.createDataFrame(items, f"{names}, l_extendedprice double, l_returnflag string")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(entry, "scratch_path", lambda _, label: f"file://{tmp_path}/scratch/{label}")
    # Landed files are packed, so each holds few lines: a reader takes a file as one task.
    monkeypatch.setattr(entry, "LANDED_LINES", 20)
    found = entry.encoded_blocks(spark, str(tmp_path))
    assert found.count() == entry.block_flatten(spark, str(tmp_path)).count() == 1200
    assert found.filter("landed_today").count() == 1200
    assert not (tmp_path / "scratch" / "landed").exists()
    files = [f.name for f in (tmp_path / "scratch" / "blocks").iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)


def test_landed_files_go_as_they_are_encoded(spark, tmp_path, monkeypatch):
    items = [(n // 3, n % 5, n % 7, n % 3 + 1, 2.0, 10.5, "ANR"[n % 3]) for n in range(300)]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"
    rows = spark.createDataFrame(items, f"{names}, l_extendedprice double, l_returnflag string")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(entry, "scratch_path", lambda _, label: f"file://{tmp_path}/scratch/{label}")
    monkeypatch.setattr(entry, "LANDED_LINES", 3)
    left, plain = [], entry.sinks.write_encoded

    def counted(*args, **options):
        left.append(len(list((tmp_path / "scratch" / "landed").glob("part-*.txt.gz"))))
        return plain(*args, **options)

    monkeypatch.setattr(entry.sinks, "write_encoded", counted)
    found = entry.encoded_blocks(spark, str(tmp_path))
    assert found.select("block", "block_pos", "tx_pos").distinct().count() == entry.block_flatten(
        spark, str(tmp_path)
    ).select("block", "block_pos", "tx_pos").distinct().count()
    assert found.count() == 1200
    turn = 2 * spark.sparkContext.defaultParallelism
    assert left[0] >= 100 and left == list(range(left[0], 0, -turn))


def test_a_batch_is_unpacked_in_pieces(spark):
    texts = [None, "", *("x" * 300_000 for _ in range(40)), "é"]
    packed = pa.array([codec._gzip(t) for t in texts] + [b"no gzip"], pa.binary())
    batch = pa.RecordBatch.from_arrays([packed], ["value"])
    found = list(codec.pieces(iter([batch]), codec._inflate, "json", pa.string()))
    assert [t for b in found for t in b.column("json").to_pylist()] == [*texts, None]
    assert len(found) == 11 and max(b.nbytes for b in found) < 2 * codec.PIECE
    back = codec.unpack(codec.pack(lines(spark, *texts), F.col("value"), "line"), F.col("line"), "text")
    assert [r.text for r in back.collect()] == texts


def test_queries_bound_the_bytes_of_a_batch(spark, sf_dir):
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(bound)
    entry.queries()["slug_extract"](spark, sf_dir)
    assert spark.conf.get(bound) == session.SETTINGS[bound] == "8m"

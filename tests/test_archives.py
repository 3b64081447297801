"""Archive scan: records, ranges, damage, plug-in decoders, streams."""

import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from millrace import standins
from millrace.session import scratch_path
from millrace.sources import archives, cuts, dealing, locations, records
from millrace.streaming import incremental


def record(kind, uri, block, version="WARC/1.0"):
    head = (
        f"{version}\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def http(body, *headers):
    return "\r\n".join(["HTTP/1.1 200 OK", *headers]).encode() + b"\r\n\r\n" + body


THREE = [
    record("response", "http://foo.com", http(b'{"first": 1}')),
    record("random", "http://bar.com", http(b'{"second": 2}')),
    record("response", "http://baz.com", http(b'{"third": 3}')),
]
WANT = [("http://foo.com", '{"first": 1}', None), ("http://baz.com", '{"third": 3}', None)]


def members(parts):
    return b"".join(gzip.compress(p) for p in parts)


def chunks(data, size):
    return [data[i : i + size] for i in range(0, len(data), size)]


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1 << 20])
@pytest.mark.parametrize("form", ["members", "plain", "one member"])
def test_response_records_only(form, size):
    data = {
        "members": members(THREE),
        "plain": b"".join(THREE),
        "one member": gzip.compress(b"".join(THREE)),
    }[form]
    assert list(records.responses(chunks(data, size))) == WANT


@pytest.mark.parametrize("size", [3, 1 << 20])
def test_damaged_member_is_reported_and_passed(size):
    bad = bytearray(gzip.compress(record("response", "http://bad.com", http(b"x" * 500))))
    bad[20:40] = b"\xff" * 20
    data = members(THREE[:1]) + bytes(bad) + members(THREE[2:])
    got = list(records.responses(chunks(data, size)))
    assert [g for g in got if g[2] is None] == WANT
    assert any(g[2] for g in got)


def test_truncated_and_foreign_files():
    whole = members(THREE)
    got = list(records.responses([whole[:-10]]))
    assert got[0] == WANT[0] and got[-1][2]
    assert [g[2] for g in records.responses([b"no archive at all"])] == [
        "archive ends inside a record"
    ]
    assert list(records.responses([b""])) == []
    foreign = gzip.compress(b"something else\r\n\r\n") + members(THREE)
    got = list(records.responses([foreign]))
    assert got[0][2] == "not an archive record" and got[1:] == WANT


def test_bodies_are_decoded():
    squeeze = zlib.compressobj(9, zlib.DEFLATED, -15)
    raw = squeeze.compress(b"deflated") + squeeze.flush()
    parts = [
        record("response", "http://a", http(b"4\r\nab c\r\n2;x\r\nde\r\n0\r\n\r\n", "Transfer-Encoding: chunked")),
        record("response", "http://b", http(gzip.compress(b"zipped"), "Content-Encoding: gzip")),
        record("response", "http://c", http(raw, "Content-Encoding: deflate")),
        record("response", "http://d", http(b"not chunked", "Transfer-Encoding: chunked")),
        record("response", "http://e", http(b"not zipped", "Content-Encoding: gzip")),
        record("response", "http://f", http(b"a\xffb")),
        record("response", "dns:g", b"1.2.3.4"),
    ]
    assert [r[1] for r in records.responses([members(parts)])] == [
        "ab cde", "zipped", "deflated", "not chunked", "not zipped", "ab", "1.2.3.4",
    ]


def test_many_archives_and_index(spark, tmp_path):
    names = [f"crawl-202103010123{i:02d}-{i:05d}.warc.gz" for i in range(24)]
    for name in names:
        (tmp_path / name).write_bytes(members(THREE))
    index = tmp_path / "index.txt"
    index.write_text("\n".join([*names, "", "missing.warc.gz"]) + "\n")
    listed = locations.read_locations(spark, str(index))
    rows = archives.scan_locations(listed, f"file://{tmp_path}").collect()
    good = [r for r in rows if r.error is None]
    assert len(good) == 48 and {r.key for r in good} == set(names)
    assert str(min(r.ts for r in good)) == "2021-03-01 01:23:00"
    assert [r.key for r in rows if r.error] == ["missing.warc.gz"]
    with pytest.raises(Exception, match="missing.warc.gz"):
        archives.scan_locations(listed, f"file://{tmp_path}", mode="FAILFAST").collect()
    with pytest.raises(ValueError):
        archives.scan_locations(listed, mode="OTHER")


def test_byte_ranges_are_half_open(spark, tmp_path):
    parts = [gzip.compress(p) for p in THREE]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    ends = [len(parts[0]), len(parts[0]) + len(parts[1])]
    lines = [f"a.warc.gz 0 {ends[0]}", f"a.warc.gz {ends[1]} {len(parts[2])}", f"a.warc.gz {ends[0]}"]
    at = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = archives.scan_locations(locations.parse_locations(at), f"file://{tmp_path}").collect()
    assert sorted((r.start, r.end, r.uri) for r in rows if r.end) == [
        (0, ends[0], "http://foo.com"), (ends[1], ends[1] + len(parts[2]), "http://baz.com"),
    ]
    assert [(r.uri, r.error) for r in rows if r.end is None] == [("http://baz.com", None)]


def test_pairing_reports_what_does_not_fit(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(members(THREE))
    size = (tmp_path / "a.warc.gz").stat().st_size
    at = spark.createDataFrame(
        [("a.warc.gz", 0, size), ("a.warc.gz", 0, size + 1), ("b.warc.gz", 0, None)],
        "key string, start bigint, end bigint",
    )
    base = f"file://{tmp_path}"
    found = archives.pair_with_listing(at, archives.archive_listing(spark, base), base).collect()
    assert {(r.key, r.end): r.error for r in found} == {
        ("a.warc.gz", size): None,
        ("a.warc.gz", size + 1): "ends after the archive's end",
        ("b.warc.gz", None): "no such archive",
    }


def test_own_decoder_and_binary_files(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(members(THREE))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert sorted((r.uri, r.content) for r in archives.scan_files(files).collect()) == sorted(
        w[:2] for w in WANT
    )

    def sizes(parts):
        yield "size", str(sum(map(len, parts))), None

    at = spark.createDataFrame([("a.warc.gz", 0, 7)], "key string, start bigint, end bigint")
    rows = archives.scan_locations(at, f"file://{tmp_path}", decoder=sizes).collect()
    assert [(r.uri, r.content) for r in rows] == [("size", "7")]


def test_written_archives_read_back_over_several_files(spark, sf_dir):
    pages = standins.page_records(spark, sf_dir)
    place = scratch_path(spark, "test-archives")
    lines = standins.write_archives(pages, place, roll=20_000)
    ranges = locations.parse_locations(lines)
    keys = ranges.select("key").distinct()
    assert keys.count() > 3
    whole = keys.select("key", F.lit(0).alias("start"), F.lit(None).cast("bigint").alias("end"))
    want = sorted((r.uri, r.content) for r in pages.collect())
    for at in (whole, ranges):
        rows = archives.scan_locations(at, place, tasks=5).collect()
        assert sorted((r.uri, r.content) for r in rows) == want


def test_archives_that_land_are_streamed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for step in range(2):
        for i in range(3):
            name = f"crawl-2021030101235{step}-{i:05d}.warc.gz"
            (landing / name).write_bytes(members(THREE))
        stream = incremental.stream_archives(spark, f"file://{landing}", files_per_step=2)
        run = incremental.run_incrementally(stream, lambda r: r.select("uri", "ts", "content"), out, state)
        run.awaitTermination()
        assert spark.read.parquet(out).count() == 6 * (step + 1)


@pytest.mark.parametrize("size", [100, 5_000, 40_000])
def test_long_archives_are_cut_at_records(spark, sf_dir, size):
    pages = standins.page_records(spark, sf_dir)
    place = scratch_path(spark, "test-cuts")
    ranges = locations.parse_locations(standins.write_archives(pages, place))
    whole = ranges.select("key", F.lit(0).alias("start"), F.lit(None).cast("bigint").alias("end"))
    whole = whole.distinct()
    # The same archive listed twice gives its records twice.
    twice = whole.unionByName(whole)
    parts = cuts.cut_long_ranges(twice, place, size)
    assert parts.count() > 4 * whole.count()
    rows = archives.scan_locations(parts, place).collect()
    assert [r.error for r in rows if r.error] == []
    assert sorted((r.uri, r.content) for r in rows) == sorted(
        2 * [(r.uri, r.content) for r in pages.collect()]
    )


def test_what_cannot_be_cut_stays_whole(spark, tmp_path):
    (tmp_path / "plain.warc").write_bytes(b"".join(THREE))
    (tmp_path / "short.warc.gz").write_bytes(members(THREE))
    at = spark.createDataFrame(
        [("plain.warc", 0, None), ("short.warc.gz", 0, None), ("none.warc.gz", 0, None)],
        "key string, start bigint, end bigint",
    )
    base = f"file://{tmp_path}"
    parts = cuts.cut_long_ranges(at, base, 300)
    rows = archives.scan_locations(parts, base).collect()
    assert [r.key for r in rows if r.error] == ["none.warc.gz"]
    assert sorted((r.key, r.uri) for r in rows if not r.error) == sorted(
        (k, w[0]) for k in ("plain.warc", "short.warc.gz") for w in WANT
    )


@pytest.mark.parametrize("size", [100, 150, 333, 1_000])
def test_an_archive_in_an_archive_is_not_cut(spark, tmp_path, size):
    """A stored archive shows its own records' signatures, but no reader of the outer one begins there."""
    inner = members([record("response", f"http://inner/{i}", http(b"i" * 50)) for i in range(8)])
    outer = gzip.compress(record("response", "http://outer", http(inner)), 0)
    (tmp_path / "a.warc.gz").write_bytes(members(THREE) + outer + members(THREE) * 3)
    at = spark.createDataFrame([("a.warc.gz", 0, None)], "key string, start bigint, end bigint")
    base = f"file://{tmp_path}"
    want = [(r.uri, r.content, r.error) for r in archives.scan_locations(at, base).collect()]
    assert len(want) == 9 and not any(w[2] for w in want)
    parts = cuts.cut_long_ranges(at, base, size)
    assert parts.count() > 1
    got = [(r.uri, r.content, r.error) for r in archives.scan_locations(parts, base).collect()]
    assert sorted(got) == sorted(want)


def test_damage_is_seen_alike_with_and_without_cuts(spark, tmp_path):
    bad = bytearray(gzip.compress(record("response", "http://bad.com", http(b"x" * 500))))
    bad[20:40] = b"\xff" * 20
    (tmp_path / "a.warc.gz").write_bytes(members(THREE) + bytes(bad) + members(THREE) + b"junk" + members(THREE))
    at = spark.createDataFrame([("a.warc.gz", 0, None)], "key string, start bigint, end bigint")
    base = f"file://{tmp_path}"
    rows = lambda ranges: sorted(map(str, [(r.uri, r.content, r.error) for r in archives.scan_locations(ranges, base).collect()]))
    want = rows(at)
    for size in (60, 170, 400):
        assert rows(cuts.cut_long_ranges(at, base, size)) == want


def test_bad_ranges_and_keys_are_error_rows(spark, tmp_path):
    (tmp_path / "a b#c%20.warc.gz").write_bytes(members(THREE))
    at = spark.createDataFrame(
        [("a b#c%20.warc.gz", 0, None), ("a b#c%20.warc.gz", 50, 40), ("a b#c%20.warc.gz", -3, 5),
         ("a b#c%20.warc.gz", 10_000, None), ("no such key", 0, None), ("\0", 0, None)],
        "key string, start bigint, end bigint",
    )
    base = f"file://{tmp_path}"
    for ranges in (at, cuts.cut_long_ranges(at, base, 100)):
        rows = archives.scan_locations(ranges, base).collect()
        assert sorted(r.uri for r in rows if not r.error) == sorted(w[0] for w in WANT)
        assert len([r for r in rows if r.error]) == 5


def test_bodies_of_other_records_are_not_kept():
    big = record("metadata", "http://m", b"m" * 3_000_000)
    data = members([big, *THREE])
    assert list(records.responses(chunks(data, 500))) == WANT
    cut_off = gzip.compress(big[:1_000_000]) + members(THREE)
    got = list(records.responses(chunks(cut_off, 500)))
    assert got[0][2] == "archive member ends inside a record" and got[1:] == WANT


def test_location_lines_are_parsed_once_to_be_dealt(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    listed = spark.createDataFrame([("k", n, n + 5) for n in range(40)], "key string, start bigint, end bigint")
    ranges = dealing.measured(listed.mapInArrow(counted, listed.schema)).collect()
    assert sorted((r.start, r.stop) for r in ranges) == [(n, n + 5) for n in range(40)]
    assert seen.value == 40


def test_short_ranges_of_one_archive_are_not_dealt_as_if_each_opened_it(spark):
    listed = spark.range(20_000).selectExpr("'a' as key", "id * 10 as start", "id * 10 + 10 as end")
    found = dealing.dealt(listed, task_bytes=16 << 20)
    assert found.rdd.getNumPartitions() <= dealing.spread_tasks(spark)
    assert sorted(r.start for r in found.collect()) == list(range(0, 200_000, 10))
    weights = dealing.running(dealing.measured(listed.limit(3).union(listed.limit(3).selectExpr("'b'", "start", "end"))))
    assert sum(r.weight >= dealing.OPENING for r in weights.collect()) >= 2

"""Crawl-shaped inputs derived from the given tables.

The tables hold no archives, score pages or block payloads; these jobs make
them, row by row, from whole tables, so that their size follows the tables'.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.files import arrow_path

STAMP = "20210301012354"
SITE = "https://www.rottentomatoes.com/m/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tasks a core, so that an uneven last one is a small part of the whole.
WAVES = 4


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out evenly, a few tasks a core, where the files have fewer splits than that.

    For jobs that spend far more on a row than a shuffle of it costs. Splits are cut by bytes but a row
    group is read by one task, so some of few splits hold no rows and others several times their share.
    """
    tasks = WAVES * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as records; their time is unknown, hence the epoch."""
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("uri"),
        F.timestamp_seconds(F.lit(0)).alias("ts"),
        F.col("html").alias("content"),
    )


# --- Archives -----------------------------------------------------------------


def _record(kind: str, uri: str, block: bytes) -> bytes:
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n"
        f"Content-Type: application/http; msgtype={kind}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _archive_task(base: str, stamp: str, roll: int):
    """One archive after another per task, with a request record before each response.

    The folder is named after the task attempt: what a failed attempt left
    behind is in no index line and hence never read.
    """

    def write(batches):
        task = TaskContext.get()
        folder = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        system, root = arrow_path(f"{base}/{folder}")
        system.create_dir(root, recursive=True)
        out, key, at, serial = None, "", 0, 0
        for batch in batches:
            lines = []
            for uri, page in zip(
                batch.column("uri").to_pylist(), batch.column("content").to_pylist()
            ):
                if out is None or at >= roll:
                    if out is not None:
                        out.close()
                    key = f"{folder}/crawl-{stamp}-{serial:05d}.warc.gz"
                    out = system.open_output_stream(
                        f"{root}/{key.split('/')[1]}", compression=None
                    )
                    at, serial = 0, serial + 1
                asked = _record("request", uri, b"GET / HTTP/1.1\r\n\r\n")
                # A byte that is no UTF-8, as crawled pages have; readers drop it.
                answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page.encode() + b"\xff"
                told = _record("response", uri, answer)
                out.write(asked + told)
                lines.append(f"{key} {at + len(asked)} {len(told)}")
                at += len(asked) + len(told)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if out is not None:
            out.close()

    return write


def write_archives(
    records: DataFrame, base: str, stamp: str = STAMP, roll: int = 256 << 20
) -> DataFrame:
    """Archives of the records below ``base``; returns the location lines, stored as text."""
    lines = records.select("uri", "content").mapInArrow(
        _archive_task(base, stamp, roll), "value string"
    )
    lines.write.text(f"{base}-index")
    return records.sparkSession.read.text(f"{base}-index")


def capture_index(lines: DataFrame) -> DataFrame:
    """Location lines of three fields as capture-index lines."""
    field = F.split("value", " ")
    entry = F.to_json(
        F.struct(
            F.lit("200").alias("status"), F.get(field, F.lit(0)).alias("filename"),
            F.get(field, F.lit(1)).alias("offset"), F.get(field, F.lit(2)).alias("length"),
        )
    )
    return lines.select(F.concat_ws(" ", F.lit("com,example)/"), F.lit(STAMP), entry).alias("value"))


# --- Index lines --------------------------------------------------------------


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def location_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one to four fields."""
    items = table(spark, sf_dir, "lineitem")
    key = F.concat(F.lit("crawl/"), _text("l_orderkey"), F.lit(".warc.gz"))
    start, size = _text("l_partkey"), _text(F.col("l_quantity").cast("bigint"))
    number = F.col("l_linenumber")
    return items.select(
        F.when(number == 1, key)
        .when(number == 2, F.concat_ws(" ", key, start))
        .when(number == 4, F.concat_ws(" ", key, start, size, size))
        .otherwise(F.concat_ws(" ", key, start, size))
        .alias("value")
    )


def capture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture-index lines; those of returned items lack the JSON part."""
    items = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_quantity", "l_returnflag"
        )
    )
    entry = F.to_json(
        F.struct(
            F.concat(F.lit(SITE), _text("l_partkey")).alias("url"),
            F.lit("200").alias("status"),
            F.concat(F.lit("crawl/"), _text("l_orderkey"), F.lit(".warc.gz")).alias("filename"),
            _text("l_partkey").alias("offset"),
            _text(F.col("l_quantity").cast("bigint")).alias("length"),
        )
    )
    prefix = F.concat(F.lit("com,rottentomatoes)/m/"), _text("l_partkey"), F.lit(" " + STAMP))
    return items.select(
        F.when(F.col("l_returnflag") == "R", prefix)
        .otherwise(F.concat_ws(" ", prefix, entry))
        .alias("value")
    )


def archive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive names in both styles, and names that tell no time."""
    orders = table(spark, sf_dir, "orders")
    date = F.col("o_orderdate").cast("timestamp")
    millis = F.unix_millis(date) + F.col("o_custkey")
    status = F.col("o_orderstatus")
    return orders.select(
        "o_orderkey",
        F.when(
            status == "F",
            F.concat(F.lit("crawl-"), F.date_format(date, "yyyyMMddHHmmss"), F.lit("-00478.warc.gz")),
        )
        .when(
            status == "O",
            F.concat(
                F.date_format(date, "yyyy/MM/dd"), F.lit("/"), _text("o_custkey"), F.lit("/"),
                _text(millis), F.lit("_"), _text("o_orderkey"), F.lit(".warc.gz"),
            ),
        )
        .otherwise(F.concat(F.lit("misc/"), _text("o_orderkey"), F.lit(".warc.gz")))
        .alias("key"),
    )


def movie_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie addresses: with and without www, sub-page and query."""
    part = table(spark, sf_dir, "part")
    slug = F.replace("p_name", F.lit(" "), F.lit("_"))
    size = F.col("p_size")
    return part.select(
        "p_partkey",
        F.when(size < 10, F.concat(F.lit(SITE), slug))
        .when(size < 20, F.concat(F.lit("http://rottentomatoes.com/m/"), slug, F.lit("/?page=2")))
        .when(size < 30, F.concat(F.lit(SITE), slug, F.lit("/reviews?type=user")))
        .when(size < 40, F.concat(F.lit(SITE), slug, F.lit("?cmp=a/b")))
        .otherwise(F.concat(F.lit("https://other.example.com/m/"), slug, F.lit("?x=1")))
        .alias("uri"),
    )


# --- Scores ---------------------------------------------------------------------


def score_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score page per event; the event type decides the layout."""
    events = spread(table(spark, sf_dir, "events"))
    critic = _text(F.floor(F.col("value") / 5))
    k = F.get_json_object("props", "$.k")
    audience = F.concat(k, F.lit("0"))
    critics = F.when(k == "9", F.lit("1,234")).otherwise(_text("event_id"))

    def page(*parts) -> Column:
        whole = ["<html><body><h1>Scores</h1>", *parts, "</body></html>"]
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in whole])

    meters = page(
        '<div class="critic"><span class="meter-value superPageFontColor"><span>', critic,
        '</span>%</span></div><div class="audience-score meter"><div class="icon"></div>'
        '<div class="body"><span class="big superPageFontColor">', audience, "%</span></div></div>",
    )
    halves = page(
        '<div class="mop-ratings-wrap__half critic"><h2><span>\n  ', critic,
        '%\n </span></h2> Tomatometer</div><small class="mop-ratings-wrap__text--small">\n ',
        critics, ' </small><div class="mop-ratings-wrap__half"><div></div> ', audience,
        '% liked</div><strong class="mop-ratings-wrap__text--small">x</strong>'
        '<strong class="mop-ratings-wrap__text--small">Verified Ratings: ', _text("user_id"),
        "</strong>",
    )
    one_half = page(
        '<div class="mop-ratings-wrap__half">', critic, "% fresh</div>"
        '<a class="scoreboard__link scoreboard__link--tomatometer" href="/r">', _text("event_id"),
        "</a>",
    )
    board = page(
        '<score-board audiencescore="', audience, '" rating="R" tomatometerscore="', critic,
        '"></score-board>',
    )
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit(SITE + "movie_"), _text("user_id"), F.lit("/?e="), _text("event_id")).alias("uri"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "view", meters)
        .when(kind == "signup", halves)
        .when(kind == "purchase", one_half)
        .when(kind == "click", board)
        .otherwise(page("<p>No scores yet.</p>"))
        .alias("content"),
    )


def score_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot table; error events lack one count, so their rows are incomplete."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
        F.concat(F.lit("movie_"), _text("user_id")).alias("name"),
        F.floor("value").cast("bigint").alias("critic"),
        F.col("event_id").alias("numCritic"),
        (k * 10).alias("audience"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("numAudience"),
    )


# --- Block payloads -------------------------------------------------------------


def _side(value: Column, addr: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        value.cast("bigint").alias("value"), (none if addr is None else addr).alias("addr")
    )


def _spend(*sides: Column) -> Column:
    return F.array(*[F.struct(s.alias("prev_out")) for s in sides])


def _tx(fee: Column, inputs: Column, out: Column) -> Column:
    return F.struct(fee.cast("bigint").alias("fee"), inputs.alias("inputs"), out.alias("out"))


def broken_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that break off, one per pending order."""
    pending = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return pending.select(
        F.concat(F.lit("https://blocks.example.com/broken/"), _text("o_orderkey")).alias("uri"),
        F.concat(F.lit('{"blocks": [{"block_index": '), _text("o_orderkey")).alias("content"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload of two blocks per line item.

    Returned items spend from their part and supplier, which links most of these
    to one big group; other items spend from neighbouring places of their order,
    which gives one short chain per order.
    """
    items = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_returnflag",
        )
    )
    returned = F.col("l_returnflag") == "R"
    place = F.concat(F.lit("ord-"), _text("l_orderkey"), F.lit("-"))
    part = F.concat(F.lit("part-"), _text("l_partkey"))
    supplier = F.concat(F.lit("supp-"), _text("l_suppkey"))
    first = F.when(returned, part).otherwise(F.concat(place, _text("l_linenumber")))
    second = F.when(returned, supplier).otherwise(
        F.concat(place, _text(F.col("l_linenumber") + 1))
    )
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    amount = F.col("l_quantity").cast("bigint")
    zero = F.lit(0)

    minted = _tx(zero, _spend(_side(zero)), F.array(_side(price, first)))
    spent = _tx(
        amount,
        _spend(_side(price, first), _side(amount, second), _side(F.lit(5))),
        F.array(
            _side(price, supplier), _side(zero, F.lit("dust")), _side(amount),
            _side(F.col("l_linenumber"), part),
        ),
    )
    no_owner = _tx(zero, _spend(_side(F.lit(7))), F.array(_side(F.lit(7), part)))
    small = _tx(
        F.when(F.col("l_returnflag") != "N", amount),
        _spend(_side(amount, first)),
        F.array(_side(amount, F.concat(F.lit("shop-"), _text("l_suppkey")))),
    )
    mixed = _tx(zero, _spend(_side(zero), _side(amount, first)), F.array(_side(amount, part)))

    block = F.col("l_orderkey") * 2
    late = F.when(F.col("l_linenumber") == 7, F.array(no_owner, small, mixed)).otherwise(
        F.array(no_owner, small)
    )
    blocks = F.array(
        F.struct(block.alias("block_index"), F.array(minted, spent).alias("tx")),
        F.struct((block + 1).alias("block_index"), late.alias("tx")),
    )
    return items.select(
        F.concat(F.lit("https://blocks.example.com/"), _text("l_orderkey"), F.lit("/"), _text("l_linenumber")).alias("uri"),
        F.to_json(F.struct(blocks.alias("blocks"))).alias("content"),
    )

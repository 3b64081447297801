"""

Every query runs over its whole tables. Inputs the tables do not hold (archives,
score pages, block payloads) are derived from them by Spark, see
``millrace/standins.py``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import sinks, standins
from millrace.functions.text import archive_time, movie_slug
from millrace.operators import articles, growing_groups, growing_series, hosts, ledger, movies
from millrace.plans import registry, studies
from millrace.session import SETTINGS, drop_scratch, scratch_path
from millrace.sinks import committed
from millrace.sources import archive_source, archives, cuts, locations, tables
from millrace.streaming import incremental

SLOPE_THRESHOLD = 2e-6
MINMAX_THRESHOLD = 200.0
PIPELINE_THRESHOLD = 60.0
# Lines of a landed file, about 150 MB before it is packed.
LANDED_LINES = 250_000
# Landed files a core that are encoded before they are dropped.
LANDED_TURN = 2


def _prepared(spark: SparkSession) -> SparkSession:
    for key in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxBytesPerBatch"):
        spark.conf.set(key, SETTINGS[key])
    return spark


def _at(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("at")


# --- Records ------------------------------------------------------------------


def host_distribution(spark, sf_dir):
    return hosts.host_distribution(standins.page_records(spark, sf_dir))


def copy_projection(spark, sf_dir):
    return articles.copy(standins.page_records(spark, sf_dir)).select("uri", _at("ts"), "content")


def lang_filter(spark, sf_dir):
    return articles.in_language(standins.page_records(spark, sf_dir)).select("uri", "lang")


def article_extract(spark, sf_dir):
    found = articles.articles(standins.page_records(spark, sf_dir))
    return found.select("uri", _at("ts"), "title", "text", "error")


def slug_extract(spark, sf_dir):
    return standins.movie_uris(spark, sf_dir).select(
        "p_partkey", "uri", movie_slug(F.col("uri")).alias("slug")
    )


def archive_timestamp(spark, sf_dir):
    named = standins.archive_names(spark, sf_dir)
    return named.withColumn("ts", archive_time(F.col("key"))).select("o_orderkey", "key", _at("ts"))


def quarantine_split(spark, sf_dir):
    pages = articles.with_language(standins.page_records(spark, sf_dir))
    broken = F.replace("uri", F.lit("://"), F.lit(":/"))
    damaged = pages.select(F.when(F.col("lang") == "en", F.col("uri")).otherwise(broken).alias("uri"))
    place = scratch_path(spark, "quarantine")
    sinks.write_with_quarantine(hosts.with_host(damaged), place)
    return spark.read.parquet(place).select("outcome", "uri", "host", "error")


# --- Files --------------------------------------------------------------------


def location_index_parse(spark, sf_dir):
    parsed = locations.parse_locations(standins.location_lines(spark, sf_dir))
    return parsed.select(
        "key", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "error"
    )


def cdx_index_parse(spark, sf_dir):
    parsed = locations.parse_captures(standins.capture_lines(spark, sf_dir))
    return parsed.select(
        "key", F.col("start").alias("range_start"), F.col("end").alias("range_end"), "error"
    )


def capture_prefix(spark, sf_dir):
    """Captures below a URL key, out of a table in the order of the keys."""
    place = scratch_path(spark, "captures")
    locations.write_capture_table(locations.parse_keyed_captures(standins.capture_lines(spark, sf_dir)), place)
    below = locations.captures_below(spark, place, "com,rottentomatoes)/m/1")
    return below.select(
        "url_key", _at("ts"), "key", F.col("start").alias("range_start"), F.col("end").alias("range_end")
    )


def _landed_csv(spark, sf_dir):
    place = scratch_path(spark, "csv")
    pages = standins.table(spark, sf_dir, "pages")
    pages.select(F.col("url").alias("uri"), F.col("page_id").alias("ts"), "html").write.csv(
        place, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return place


def csv_record_scan(spark, sf_dir):
    # Pages have line breaks in them.
    records = tables.read_csv_records(spark, _landed_csv(spark, sf_dir), multiline=True)
    return records.select("uri", _at("ts"), F.get_json_object("content", "$.html").alias("html"))


def encoded_roundtrip(spark, sf_dir):
    place = scratch_path(spark, "encoded")
    sinks.write_encoded(articles.copy(standins.page_records(spark, sf_dir)), place)
    rows = tables.read_encoded(spark, place)
    seconds = F.timestamp_seconds(F.col("ts").try_cast("double"))
    return rows.withColumn("ts", seconds).select("uri", _at("ts"), "content", "error")


def encoded_stream(spark, sf_dir):
    """Pages as a stream into committed encoded lines, which a second run finds complete."""
    source, place = f"{sf_dir}/pages.parquet*", scratch_path(spark, "committed")
    pages = incremental.stream_table(spark, source, spark.read.parquet(source).schema)
    records = pages.select(
        F.col("url").alias("uri"), F.timestamp_seconds(F.lit(0)).alias("ts"), F.col("html").alias("content")
    )
    for _ in range(2):
        committed.write_stream(articles.copy(records), place, f"{place}-checkpoint").awaitTermination()
    rows = tables.decode_lines(committed.read_lines(spark, place))
    seconds = F.timestamp_seconds(F.col("ts").try_cast("double"))
    return rows.withColumn("ts", seconds).select("uri", _at("ts"), "content", "error")


def _landed_archives(spark, sf_dir):
    place = scratch_path(spark, "archives")
    lines = standins.write_archives(standins.page_records(spark, sf_dir), place)
    return place, locations.parse_locations(lines)


def warc_response_scan(spark, sf_dir):
    place, ranges = _landed_archives(spark, sf_dir)
    whole = ranges.select("key").distinct().select(
        "key", F.lit(0).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end")
    )
    parts = cuts.cut_long_ranges(whole, place)
    return archives.scan_locations(parts, place).select("uri", _at("ts"), "content", "error")


def warc_source_scan(spark, sf_dir):
    """The archives of one crawl, by their time, out of a folder that has an older one as well."""
    place = scratch_path(spark, "crawls")
    pages = standins.page_records(spark, sf_dir)
    standins.write_archives(pages, f"{place}/new")
    standins.write_archives(pages.withColumn("uri", F.concat("uri", F.lit("?old"))), f"{place}/old", "20190301012354")
    archive_source.register(spark)
    records = spark.read.format(archive_source.NAME).load(place)
    return records.filter("ts >= timestamp'2021-01-01'").select("uri", _at("ts"), "content", "error")


def location_join(spark, sf_dir):
    place, ranges = _landed_archives(spark, sf_dir)
    listing = archives.archive_listing(spark, place)
    nowhere = standins.table(spark, sf_dir, "pages").filter("page_id % 10 = 0").select(
        F.concat(F.lit("missing/"), "page_id").alias("key"), F.lit(0).alias("start"),
        F.lit(9).alias("end"), F.lit(None).cast("string").alias("error"),
    )
    # Stored, as the scan and the misfits both read it.
    paired = studies.stored(archives.pair_with_listing(ranges.union(nowhere), listing, place), "paired")
    scanned = archives.scan_locations(paired.filter(F.col("error").isNull()), place)
    nothing = F.lit(None).cast("string")
    misfits = paired.filter(F.col("error").isNotNull()).select(
        nothing.alias("uri"), nothing.alias("content"), "error"
    )
    return scanned.select("uri", "content", "error").union(misfits)


def archive_articles(spark, sf_dir):
    place, ranges = _landed_archives(spark, sf_dir)
    index = f"{place}-list"
    ranges.select("key").distinct().write.text(index)
    found = registry.compose(spark, "warc-index", "news", index, base=place)
    return found.select("uri", _at("ts"), "title", "text", "error")


def registry_compose(spark, sf_dir):
    place = scratch_path(spark, "results")
    landed = _landed_csv(spark, sf_dir)
    registry.run(spark, "csv-file", "copy", landed, place, multiline=True)
    return studies.host_study(spark, place)


def incremental_archives(spark, sf_dir):
    """Archives as they land, in steps of an eighth of their bytes, which cut long ones."""
    place = scratch_path(spark, "landing")
    standins.write_archives(standins.page_records(spark, sf_dir), place)
    landed = archives.archive_listing(spark, place).agg(F.sum("length")).first()[0] or 0
    step = max(1 << 20, landed // 8)
    incremental.plan_landed(
        spark, f"{place}/*", f"{place}-plan", f"{place}-planned", size=step // 2, step_bytes=step
    ).awaitTermination()
    query = incremental.run_incrementally(
        incremental.stream_planned(spark, f"{place}-plan"), articles.copy, f"{place}-out", f"{place}-checkpoint"
    )
    query.awaitTermination()
    return spark.read.parquet(f"{place}-out").select("uri", _at("ts"), "content", "error")


def incremental_extract(spark, sf_dir):
    source = f"{sf_dir}/pages.parquet*"  # a pattern, so that one file will do as well as a folder
    stream = incremental.stream_table(spark, source, spark.read.parquet(source).schema)
    records = stream.select(
        F.col("url").alias("uri"), F.timestamp_seconds(F.lit(0)).alias("ts"),
        F.col("html").alias("content"),
    )
    place = scratch_path(spark, "incremental")
    query = incremental.run_incrementally(
        records, articles.articles, f"{place}/out", f"{place}/checkpoint"
    )
    query.awaitTermination()
    return spark.read.parquet(f"{place}/out").select("uri", _at("ts"), "title", "text", "error")


# --- Scores -------------------------------------------------------------------


def score_extract(spark, sf_dir):
    return movies.extract_scores(standins.score_pages(spark, sf_dir)).drop("ts")


def score_clean(spark, sf_dir):
    return movies.clean_scores(movies.extract_scores(standins.score_pages(spark, sf_dir)))


def score_series(spark, sf_dir):
    return movies.score_series(standins.score_snapshots(spark, sf_dir)).select("name", "at", "point")


def score_unpack(spark, sf_dir):
    series = movies.score_series(standins.score_snapshots(spark, sf_dir)).select("name", "point")
    return movies.unpack_points(series)


def score_pipeline(spark, sf_dir):
    """Archives, capture index, scores, shards, table, alerts."""
    place, results = scratch_path(spark, "score-archives"), scratch_path(spark, "score-results")
    lines = standins.write_archives(standins.score_pages(spark, sf_dir).select("uri", "content"), place)
    standins.capture_index(lines).write.text(f"{place}-captures")
    registry.run(spark, "cdx-index", "rottentomatoes", f"{place}-captures", results, base=place)
    shards = tables.read_results(spark, f"{results}/part-[0-9]*", studies.SCORE_COLUMNS)
    name = f"scores_{uuid.uuid4().hex}"
    sinks.create_score_table(spark, name, f"{results}-table", buckets=16)
    for _ in range(2):  # the second insert of a batch changes nothing
        sinks.insert_scores(movies.clean_scores(shards), name, "crawl")
    found = studies.stored(movies.score_alerts(spark.table(name), PIPELINE_THRESHOLD, "minmax"), "alerts")
    spark.sql(f"DROP TABLE {name}")
    return found.select("name", "kind", "points", "minmax")


def failure_counts(spark, sf_dir):
    """How many rows failed for which reason, as the pass that wrote them saw it."""
    reasons = {r: F.col("reason") == r for r in ("no score layout", "review count is not a number")}
    found = movies.extract_scores(standins.score_pages(spark, sf_dir))
    counts = sinks.write_counted(found, scratch_path(spark, "counted"), reasons)
    return spark.createDataFrame(list(counts.items()), "reason string, n bigint")


def score_report(spark, sf_dir):
    snapshots = standins.score_snapshots(spark, sf_dir)
    alerts = movies.score_alerts(snapshots, MINMAX_THRESHOLD, "minmax", ["critics"])
    return movies.point_lines(movies.alert_points(snapshots, alerts, ["critics"]), alerts)


def _alerts(delta, threshold):
    def query(spark, sf_dir):
        found = movies.score_alerts(standins.score_snapshots(spark, sf_dir), threshold, delta)
        return found.select(
            "name", "kind", "points", "minmax", F.round(F.col("slope") * 1e9, 3).alias("slope_e9")
        )

    return query


def score_delta_merged(spark, sf_dir):
    """Both measures out of moments that three shards of the snapshots were merged into."""
    place = scratch_path(spark, "series")
    snapshots = standins.score_snapshots(spark, sf_dir)
    for shard in range(3):
        growing_series.add_shard(spark, place, snapshots.filter(F.pmod("numCritic", F.lit(3)) == shard), shard)
    every = growing_series.changes(growing_series.moments_now(spark, place))
    measures = {"slope": SLOPE_THRESHOLD, "minmax": MINMAX_THRESHOLD}
    found = [
        every.filter(movies.DELTAS[m]() > t).select(F.lit(m).alias("measure"), "*") for m, t in measures.items()
    ]
    return found[0].union(found[1]).select(
        "measure", "name", "kind", "points", "minmax", F.round(F.col("slope") * 1e9, 3).alias("slope_e9")
    )


def score_alert_points(spark, sf_dir):
    snapshots = standins.score_snapshots(spark, sf_dir)
    alerts = movies.score_alerts(snapshots, MINMAX_THRESHOLD, "minmax", ["critics"])
    return movies.alert_points(snapshots, alerts, ["critics"]).select("name", "kind", "at", "score")


# --- Ledger -------------------------------------------------------------------


def _transactions(spark, sf_dir):
    return ledger.flatten_blocks(ledger.parse_payloads(standins.payloads(spark, sf_dir)))


def block_flatten(spark, sf_dir):
    return _transactions(spark, sf_dir).select(
        "uri", "block", "block_pos", "tx_pos", "fee",
        F.size("inputs").alias("n_inputs"), F.size("out").alias("n_outputs"),
    )


def encoded_blocks(spark, sf_dir):
    """Payloads through landed lines and encoded results, as a crawl leaves them."""
    landed, place = scratch_path(spark, "landed"), scratch_path(spark, "blocks")
    # Packed, as the plain lines take many times the tables; each file is one task, so none gets long.
    standins.payloads(spark, sf_dir).select("content").write.option("maxRecordsPerFile", LANDED_LINES).text(
        landed, compression="gzip"
    )
    # Encoded in turns, each of which drops its landed files, so that not all lines are there twice.
    files = sorted(spark.read.text(landed).inputFiles())
    turn = LANDED_TURN * spark.sparkContext.defaultParallelism
    for k in range(0, max(len(files), 1), turn):
        some = files[k : k + turn] or [landed]
        sinks.write_encoded(tables.read_landed_payloads(spark, some, per_line=True), place, compression="gzip")
        for file in files[k : k + turn]:
            drop_scratch(spark, file)
    drop_scratch(spark, landed)
    # The time of a payload is that of the file it landed in.
    age = F.unix_seconds(F.current_timestamp()) - F.col("ts").try_cast("double")
    timed = tables.read_encoded(spark, place).withColumn("uri", age.between(-60, 86400).cast("string"))
    flat = ledger.flatten_blocks(ledger.parse_payloads(timed))
    return flat.select(
        "block", "block_pos", "tx_pos", "fee",
        F.size("inputs").alias("n_inputs"), F.size("out").alias("n_outputs"),
        F.col("uri").cast("boolean").alias("landed_today"),
    )


def txn_inputs(spark, sf_dir):
    return ledger.transaction_inputs(_transactions(spark, sf_dir)).select(
        "uri", "block", "tx_pos", F.array_join("addrs", ",").alias("addrs"), "value", "error"
    )


def txn_index(spark, sf_dir):
    kept = ledger.kept_transactions(ledger.parse_payloads(standins.payloads(spark, sf_dir)))
    return kept.select("uri", "block", "idx", F.array_join("addrs", ",").alias("addrs"), "fee")


def address_groups(spark, sf_dir):
    groups = studies.ledger_study(standins.payloads(spark, sf_dir))[1]
    return groups.select("addr", "group_addr")


def groups_merged(spark, sf_dir):
    """Groups that grew by three batches of blocks, which have addresses in common."""
    place = scratch_path(spark, "growing")
    every = standins.payloads(spark, sf_dir)
    for batch in range(3):
        part = every.filter(F.pmod(F.crc32("uri"), F.lit(3)) == batch)
        kept, _ = studies.ledger_rows(part)
        growing_groups.add_transactions(spark, place, kept, batch)
    return growing_groups.groups_now(spark, place).select("addr", "group_addr")


def group_sizes(spark, sf_dir):
    return ledger.group_sizes(studies.ledger_study(standins.payloads(spark, sf_dir))[1])


def txn_edges(spark, sf_dir):
    return studies.ledger_study(standins.payloads(spark, sf_dir))[0]


def edge_files(spark, sf_dir):
    """Edges and groups as text files, read back and joined."""
    edges, groups, _ = studies.ledger_study(standins.payloads(spark, sf_dir))
    place = scratch_path(spark, "edges")
    sinks.write_edges(edges, f"{place}/edges")
    sinks.write_groups(groups, f"{place}/groups")
    kinds = "block bigint, idx bigint, group_addr string, out_addr string, amount bigint, fee bigint"
    written = spark.read.schema(kinds).csv(f"{place}/edges", sep=" ")
    names = spark.read.schema("addr string, group_addr string").csv(f"{place}/groups", sep=" ")
    known = names.select("group_addr").distinct()
    return written.join(known, "group_addr", "left_semi")


def ledger_quarantine(spark, sf_dir):
    every = standins.payloads(spark, sf_dir).union(standins.broken_payloads(spark, sf_dir))
    return studies.ledger_rows(every)[1].select("uri", "block", "error")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: host distribution of the crawled pages."""
    return host_distribution(_prepared(spark), "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator family; each takes (spark, sf_dir)."""
    jobs = {
        "host_distribution": host_distribution,
        "copy_projection": copy_projection,
        "lang_filter": lang_filter,
        "article_extract": article_extract,
        "slug_extract": slug_extract,
        "archive_timestamp": archive_timestamp,
        "quarantine_split": quarantine_split,
        "location_index_parse": location_index_parse,
        "cdx_index_parse": cdx_index_parse,
        "capture_prefix": capture_prefix,
        "csv_record_scan": csv_record_scan,
        "encoded_roundtrip": encoded_roundtrip,
        "encoded_stream": encoded_stream,
        "warc_response_scan": warc_response_scan,
        "warc_source_scan": warc_source_scan,
        "location_join": location_join,
        "archive_articles": archive_articles,
        "registry_compose": registry_compose,
        "incremental_extract": incremental_extract,
        "incremental_archives": incremental_archives,
        "score_extract": score_extract,
        "score_clean": score_clean,
        "score_series": score_series,
        "score_delta_slope": _alerts("slope", SLOPE_THRESHOLD),
        "score_delta_minmax": _alerts("minmax", MINMAX_THRESHOLD),
        "score_delta_merged": score_delta_merged,
        "score_alert_points": score_alert_points,
        "score_unpack": score_unpack,
        "score_pipeline": score_pipeline,
        "failure_counts": failure_counts,
        "score_report": score_report,
        "block_flatten": block_flatten,
        "encoded_blocks": encoded_blocks,
        "txn_inputs": txn_inputs,
        "txn_index": txn_index,
        "address_groups": address_groups,
        "groups_merged": groups_merged,
        "group_sizes": group_sizes,
        "txn_edges": txn_edges,
        "edge_files": edge_files,
        "ledger_quarantine": ledger_quarantine,
    }
    jobs.update(_llm_part("QUERIES"))
    return {name: _with_settings(job) for name, job in jobs.items()}


def _llm_part(name: str) -> dict:
    """Queries or SQL of the training-data operators and their pipeline, if both can be imported."""
    try:
        import corpus_pipeline
        from millrace.llm import queries as llm
    except ImportError as problem:
        print(f"training-data queries are not there: {problem}", file=sys.stderr)
        return {}
    found = dict(getattr(llm, name))
    if name == "QUERIES":
        found["pipeline"] = corpus_pipeline.run
    elif corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _with_settings(job):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(_prepared(spark), sf_dir)

    return query


def oracle_sql() -> dict[str, str]:
    """The same results in SQL for DuckDB."""
    from oracles import ORACLES

    return ORACLES | _llm_part("ORACLES")

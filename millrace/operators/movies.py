"""Scores of movie pages: extraction, clean-up, series and change alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions import html
from ..functions.once import once
from ..functions.text import first_token, movie_slug, percent_digits, readable_time, trim_space
from ..session import scratch_path
from .articles import earlier_error
from .skew import heavy_keys, lookup, sort_whole

# --- Extraction -------------------------------------------------------------


def _meters(page: Column) -> tuple[Column, Column]:
    """Oldest layout: one meter for critics, one for the audience."""
    critic = html.element_text(page, "span", html.open_tag("span", fmt.CRITIC_METER_CLASS, True))
    block = html.element(page, "div", html.open_tag("div", fmt.AUDIENCE_METER_CLASS, True))
    audience = html.element_text(
        block, "span", html.open_tag("span", fmt.AUDIENCE_VALUE_CLASS, False)
    )
    return critic, audience


def _half(page: Column, nth: int) -> Column:
    """Middle layout: the first word of the nth half of the ratings box."""
    opening = html.open_tag("div", fmt.HALF_CLASS, False)
    return first_token(html.element_text(page, "div", opening, nth))


def _counts(page: Column) -> tuple[Column, Column]:
    """Texts of the review counts in the middle layout; NULL where there is none."""

    def link(cls: str) -> Column:
        return html.element_text(page, "a", html.open_tag("a", cls, True))

    small = html.element_text(page, "small", html.open_tag("small", fmt.COUNT_CLASS, False))
    strong = html.element_text(page, "strong", html.open_tag("strong", fmt.COUNT_CLASS, False), 2)
    critic = F.coalesce(F.replace(small, F.lit("\n"), F.lit("")), link(fmt.CRITIC_LINK_CLASS))
    audience = F.coalesce(
        F.replace(strong, F.lit(fmt.RATINGS_LABEL), F.lit("")),
        link(fmt.AUDIENCE_LINK_CLASS),
        F.lit("0"),
    )
    return critic, audience


def _whole_number(text: Column) -> Column:
    return trim_space(text).try_cast("bigint")


def extract_scores(records: DataFrame) -> DataFrame:
    """``uri, ts, criticScore, criticNum, audienceScore, audienceNum, error, reason``.

    The layouts are tried oldest first. The meters need both scores. The halves
    are taken whenever one is present, and then a review count that is not a
    number makes the row an error instead of falling through to the board.
    """
    page = F.col("content")
    # Cheap substring tests decide which layouts are worth taking apart, so
    # that a page pays only for the one it has.
    may_meter = page.contains(fmt.CRITIC_METER_CLASS) & page.contains(fmt.AUDIENCE_METER_CLASS)
    critic_meter, audience_meter = _meters(page)
    meter = F.when(
        may_meter,
        F.struct(critic_meter.alias("critic"), audience_meter.alias("audience")),
    )

    critic_count, audience_count = _counts(page)
    first_half = F.when(page.contains(fmt.HALF_CLASS), _half(page, 1))
    halves = F.when(
        F.col("half").isNotNull(),
        F.struct(
            F.col("half").alias("critic"),
            F.coalesce(_half(page, 2), F.lit(fmt.NO_SCORE)).alias("audience"),
            _whole_number(critic_count).alias("critic_num"),
            _whole_number(audience_count).alias("audience_num"),
        ),
    )

    board = F.struct(
        html.attribute(page, fmt.BOARD_ELEMENT, fmt.BOARD_CRITIC).alias("critic"),
        html.attribute(page, fmt.BOARD_ELEMENT, fmt.BOARD_AUDIENCE).alias("audience"),
    )

    taken = records.select("uri", "ts", "content", earlier_error(records).alias("earlier"))
    taken = once(taken, meter=meter, half=first_half)
    m = F.col("meter")
    taken = taken.withColumn("meter", F.when(m["critic"].isNotNull() & m["audience"].isNotNull(), m))
    taken = once(taken, halves=F.when(F.col("meter").isNull(), halves))
    taken = once(
        taken, board=F.when(F.col("meter").isNull() & F.col("halves").isNull(), board)
    ).drop("content")

    h, b = F.col("halves"), F.col("board")
    no_count = h["critic_num"].isNull() | h["audience_num"].isNull()
    no_board = b["critic"].isNull() | b["audience"].isNull()
    reason = (
        F.when(F.col("earlier").isNotNull(), F.col("earlier"))
        .when(m.isNotNull(), F.lit(None))
        .when(h.isNotNull(), F.when(no_count, "review count is not a number"))
        .otherwise(F.when(no_board, "no score layout"))
    )
    zero = F.lit(0).cast("bigint")

    def pick(name: str) -> Column:
        return F.coalesce(m[name], h[name], b[name])

    def count(name: str) -> Column:
        return F.when(h.isNull(), zero).otherwise(h[name])

    rows = taken.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return rows.select(
        "uri", "ts",
        F.when(good, pick("critic")).alias("criticScore"),
        F.when(good, count("critic_num")).alias("criticNum"),
        F.when(good, pick("audience")).alias("audienceScore"),
        F.when(good, count("audience_num")).alias("audienceNum"),
        F.when(~good, F.concat_ws(": ", F.lit("Error processing"), F.col("uri"))).alias("error"),
        "reason",
    )


# --- Clean-up ---------------------------------------------------------------


def clean_scores(results: DataFrame) -> DataFrame:
    """Extraction results to the snapshot table ``ts, name, critic, numCritic, ...``.

    Rows without time or URI go, as do rows whose critic or audience score is
    not digits after taking ``%`` off.
    """
    critic = percent_digits(F.col("criticScore"))
    audience = percent_digits(F.col("audienceScore"))
    kind = dict(results.dtypes)["ts"]
    ts = F.col("ts") if kind.startswith("timestamp") else F.col("ts").try_cast("double")
    return (
        results.dropna(subset=["ts", "uri"])
        .select(
            ts.cast("bigint").alias("ts"),
            movie_slug(F.col("uri")).alias("name"),
            critic.alias("critic"),
            F.col("criticNum").try_cast("bigint").alias("numCritic"),
            audience.alias("audience"),
            F.col("audienceNum").try_cast("bigint").alias("numAudience"),
        )
        .filter(F.col("critic").isNotNull() & F.col("audience").isNotNull())
    )


# --- Series -----------------------------------------------------------------

KINDS = {"critics": "critic", "audience": "audience"}
_FIELDS = ["ts", "critic", "numCritic", "audience", "numAudience"]


def score_series(scores: DataFrame) -> DataFrame:
    """Each name's snapshots in time order, with the packed and the readable form.

    A series is a run of rows, not one row holding an array: the sort is by
    range over (name, ts), so a name with a third of all snapshots is spread
    over many tasks and nothing is gathered per name. Rows with any missing
    value are not part of a series.
    """
    packed = F.concat_ws(";", *[F.col(c).cast("string") for c in _FIELDS])
    complete = scores.dropna(subset=[*_FIELDS, "name"]).select("name", *_FIELDS)
    return sort_whole(complete, "name", *_FIELDS).select(
        "name", *_FIELDS, readable_time(F.col("ts")).alias("at"), packed.alias("point")
    )


def unpack_points(rows: DataFrame) -> DataFrame:
    """``name, ts, critic, numCritic, audience, numAudience, error`` of packed points.

    ``point`` has five numbers with semicolons between them, as stored series have.
    """
    fields = F.split("point", ";")
    sound = F.coalesce(F.col("point").rlike(r"^-?[0-9]{1,18}(;-?[0-9]{1,18}){4}$"), F.lit(False))
    return rows.select(
        "name",
        *[F.when(sound, F.get(fields, F.lit(i)).try_cast("bigint")).alias(c) for i, c in enumerate(_FIELDS)],
        F.when(~sound, "not a packed point").alias("error"),
    )


def score_points(scores: DataFrame, kinds=("critics", "audience")) -> DataFrame:
    """``name, kind, ts, score``: both kinds in one pass over the snapshots."""
    chosen = _kinds(kinds)
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("kind"), F.col(KINDS[k]).cast("double").alias("score"))
                for k in chosen
            ]
        )
    )
    return (
        scores.dropna(subset=[*_FIELDS, "name"])
        .select("name", F.col("ts").cast("double").alias("ts"), pairs.alias("p"))
        .select("name", "p.kind", "ts", "p.score")
    )


def _kinds(kinds) -> list[str]:
    chosen = [k for k in KINDS if k in set(kinds)]
    unknown = set(kinds) - set(KINDS)
    if unknown or not chosen:
        raise ValueError(f"choose at least one of {', '.join(KINDS)}; got {sorted(kinds)}")
    return chosen


# Change measures a caller can choose from; more can be added under a new name.
DELTAS = {
    "slope": lambda: F.abs(F.col("slope")),
    "minmax": lambda: F.col("minmax"),
}


def score_changes(scores: DataFrame, kinds=("critics", "audience")) -> DataFrame:
    """``name, kind, points, minmax, slope, intercept`` of every series.

    Declarative aggregates only, so each task sends one partial row per series
    whatever the series' length. The slope is NULL where all times are equal.
    """
    return (
        score_points(scores, kinds)
        .groupBy("name", "kind")
        .agg(
            F.count("*").alias("points"),
            (F.max("score") - F.min("score")).alias("minmax"),
            F.regr_slope("score", "ts").alias("slope"),
            F.regr_intercept("score", "ts").alias("intercept"),
        )
    )


def score_alerts(
    scores: DataFrame, threshold: float, delta: str = "slope", kinds=("critics", "audience")
) -> DataFrame:
    """Series whose change is above the threshold, by name."""
    if delta not in DELTAS:
        raise ValueError(f"unknown delta {delta!r}; choose from {', '.join(DELTAS)}")
    return (
        score_changes(scores, kinds)
        .filter(DELTAS[delta]() > threshold)
        .orderBy("name", "kind")
    )


def alert_points(scores: DataFrame, alerts: DataFrame, kinds=("critics", "audience")) -> DataFrame:
    """The dated points behind the alerts, in order; again as rows.

    An alert tells how many points its series has, so the join spreads a series
    that is too long for one task.
    """
    series = F.struct("name", "kind")
    chosen = alerts.select(series.alias("series"), "points")
    # Stored, as the lookup and the look for long series both read them.
    place = scratch_path(scores.sparkSession, "alerts")
    chosen.write.parquet(place)
    chosen = scores.sparkSession.read.schema(chosen.schema).parquet(place)
    hot = heavy_keys(chosen, "series", "points")
    points = (
        lookup(score_points(scores, kinds).withColumn("series", series), "series", chosen, hot)
        .filter(F.col("points").isNotNull())
        .select("name", "kind", "ts", "score")
    )
    return sort_whole(points, "name", "kind", "ts", "score").select(
        "name", "kind", readable_time(F.col("ts")).alias("at"), "ts", "score"
    )


def report_lines(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        F.format_string(
            "%s (%s): minmax=%s slope=%s", "name", "kind",
            F.col("minmax").cast("string"), F.col("slope").cast("string"),
        ).alias("line")
    )


def point_lines(points: DataFrame, alerts: DataFrame) -> DataFrame:
    """A line for each dated point behind the alerts, in order, with the change of its series.

    One line for a whole series would hold as many points as the series has; ``points`` are those of
    :func:`alert_points`.
    """
    change = alerts.select(F.struct("name", "kind").alias("series"), "points", "minmax")
    place = scratch_path(points.sparkSession, "changes")
    change.write.parquet(place)
    change = points.sparkSession.read.schema(change.schema).parquet(place)
    hot = heavy_keys(change, "series", "points")
    told = lookup(points.withColumn("series", F.struct("name", "kind")), "series", change.drop("points"), hot)
    number = F.format_string("%.0f", "score")
    line = F.format_string("%s (%s): minmax=%.0f at=%s score=%s", "name", "kind", "minmax", "at", number)
    return sort_whole(told, "name", "kind", "ts", "score").select(line.alias("line"))

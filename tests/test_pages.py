"""URLs, names, articles and score pages, on hand-written rows."""

import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.functions import html
from millrace.functions.text import archive_time, host_of, movie_slug, percent_digits
from millrace.operators import articles, hosts, movies


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("t"))).collect()]


def records(spark, *pages):
    rows = [(f"http://x/{i}", p) for i, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "uri string, content string")
    return frame.select("uri", F.timestamp_seconds(F.lit(0)).alias("ts"), "content")


def test_hosts(spark):
    texts = ["http://h:80/a", "HTTP://h/", "https://User@H.com?x=1", "http://", "http:///p", "ftp://h", None,
             "see http://inner/x"]
    assert values(spark, texts, host_of) == [
        "h:80", None, "User@H.com?x=1", None, None, None, None, "inner",
    ]


def test_host_distribution(spark):
    rows = spark.createDataFrame(
        [("http://b/1",), ("http://a/1",), ("https://b/2",), (None,), ("nohost",)], "uri string"
    )
    got = hosts.host_distribution(rows)
    assert [tuple(r) for r in got.collect()] == [("b", 2), ("a", 1)]
    assert [r.line for r in hosts.report_lines(got).collect()] == ["b: 2", "a: 1"]
    with pytest.raises(Exception, match="Could not extract domain from nohost"):
        hosts.host_distribution(rows, strict=True).collect()
    errors = [r.error for r in hosts.with_host(rows).collect() if r.error]
    assert errors == ["Could not extract domain from nohost"]


def test_archive_times(spark):
    names = [
        "crawl/2021/03/NEWS-20210301012354-00478.warc.gz",
        "2016/08/26/10/1472219999123_7.warc.gz",
        "nothing",
        "x-20211301012354-00478",
        None,
    ]
    got = values(spark, names, lambda c: F.unix_seconds(archive_time(c)))
    assert got == [1614561834, 1472219999, 0, 0, 0]


def test_slugs(spark):
    site = "rottentomatoes.com/m/"
    uris = [f"https://www.{site}foo", f"http://{site}foo/", f"https://{site}foo/reviews?x=2",
            f"https://{site}null_island?a=b/c", "http://other/?q"]
    assert values(spark, uris, movie_slug) == ["foo", "foo", "foo", "null_island", "http://other/"]


def test_percentages(spark):
    got = values(spark, ["85%", "85", "None", "", None, "8.5", "-3", "%"], percent_digits)
    assert got == [85, 85, None, None, None, None, None, None]


def test_languages(spark):
    pages = ['<html lang="en-US">', "<HTML class=x LANG='FR'>", '<html xml:lang="de">', "<html>",
             '<html><meta http-equiv="content-language" content="es">', '<html><meta name="lang" content="IT">']
    assert values(spark, pages, html.language) == ["en", "fr", None, None, "es", "it"]


def test_articles(spark):
    page = (
        '<html lang="en"><head><title>A &amp; <b>B</b></title><script>var a="<article>no</article>";'
        "</script></head><body>skip<article>One<nav>menu</nav>\n <p>two &lt;3</p><!-- x -->"
        "&amp;lt;<style>p{}</style></article><footer>f</footer></body></html>"
    )
    body = '<html lang="en"><body><h1>Head</h1>text<footer>f</footer></body></html>'
    rows = articles.articles(records(spark, page, body, '<html lang="en">', '<html lang="fr">')).collect()
    assert [(r.title, r.text, r.error) for r in rows] == [
        ("A & B", "One two <3 &lt;", None),
        ("Head", "Head text", None),
        (None, None, "Error processing record: Could not parse"),
    ]


def test_earlier_errors_pass_through(spark):
    bad = spark.createDataFrame(
        [("u", None, None, "unreadable")], "uri string, ts timestamp, content string, error string"
    )
    assert articles.articles(bad).first().error == "unreadable"
    assert articles.copy(bad).first().error == "unreadable"
    got = movies.extract_scores(bad).first()
    assert (got.error, got.reason) == ("Error processing: u", "unreadable")


METERS = (
    '<span class="meter-value superPageFontColor"><span>91</span>%</span>'
    '<div class="audience-score meter"><div class="in"><div></div></div>{}</div>{}'
)
SPAN = '<span class="big superPageFontColor">77%</span>'
HALVES = '<div class="mop-ratings-wrap__half">\n <b>9\n3%</b> fresh</div>'
SECOND = '<div class="x mop-ratings-wrap__half"><div></div> 88% liked</div>'
SMALL = '<small class="mop-ratings-wrap__text--small">\n {} </small>'
STRONG = '<strong class="mop-ratings-wrap__text--small">{}</strong>'
LINK = '<a class="scoreboard__link scoreboard__link--{}">{}</a>'
BOARD = '<score-board tomatometerscore="5" audiencescore="6"></score-board>'


def scores(spark, *pages):
    rows = movies.extract_scores(records(spark, *pages)).collect()
    by_uri = {r.uri: r for r in rows}
    out = []
    for i in range(len(pages)):
        r = by_uri[f"http://x/{i}"]
        out.append((r.criticScore, r.criticNum, r.audienceScore, r.audienceNum, r.reason))
    return out


def test_score_layouts(spark):
    nan, none = "review count is not a number", "no score layout"
    cases = [
        (METERS.format(SPAN, ""), ("91%", 0, "77%", 0, None)),
        # The audience value must lie inside its own block.
        (METERS.format("", SPAN), (None, None, None, None, none)),
        (METERS.format("", SPAN) + BOARD, ("5", 0, "6", 0, None)),
        (HALVES + SECOND + SMALL.format(12) + STRONG.format("a") + STRONG.format("Verified Ratings: 34"),
         ("93%", 12, "88%", 34, None)),
        (HALVES + LINK.format("tomatometer", 7), ("93%", 7, "None", 0, None)),
        (HALVES + SECOND + LINK.format("tomatometer", 7) + LINK.format("audience", " 8 "),
         ("93%", 7, "88%", 8, None)),
        # One strong element is not the audience's.
        (HALVES + SMALL.format(1) + STRONG.format("5"), ("93%", 1, "None", 0, None)),
        # Halves without a sound count are errors, even beside a board.
        (HALVES + BOARD, (None, None, None, None, nan)),
        (HALVES + SMALL.format("1,234") + BOARD, (None, None, None, None, nan)),
        (BOARD, ("5", 0, "6", 0, None)),
        ('<score-board tomatometerscore="5">', (None, None, None, None, none)),
        ('<score-board tomatometerscore="" audiencescore="">', ("", 0, "", 0, None)),
        ("<p>none</p>", (None, None, None, None, none)),
    ]
    got = scores(spark, *[page for page, _ in cases])
    assert got == [want for _, want in cases]


def test_clean_scores(spark):
    rows = spark.createDataFrame(
        [
            Row(uri="https://rottentomatoes.com/m/a/", ts="10.9", criticScore="85%", criticNum="3", audienceScore="7", audienceNum="40000"),
            Row(uri="https://rottentomatoes.com/m/null", ts="11", criticScore="1", criticNum=None, audienceScore="2%", audienceNum="1"),
            Row(uri="https://rottentomatoes.com/m/b", ts="12", criticScore="85%", criticNum="3", audienceScore="None", audienceNum="0"),
            Row(uri=None, ts="12", criticScore="1", criticNum="3", audienceScore="1", audienceNum="0"),
            Row(uri="https://rottentomatoes.com/m/c", ts=None, criticScore="1", criticNum="3", audienceScore="1", audienceNum="0"),
        ]
    )
    got = sorted(map(tuple, movies.clean_scores(rows).collect()))
    assert got == [(10, "a", 85, 3, 7, 40000), (11, "null", 1, None, 2, 1)]


SNAP = "ts bigint, name string, critic bigint, numCritic bigint, audience bigint, numAudience bigint"


def test_series_and_changes(spark):
    day = 86400
    rows = spark.createDataFrame(
        [
            (0, "one", 50, 1, 60, 1),
            (5, "same", 10, 1, 10, 1), (5, "same", 30, 1, 10, 1),
            (2 * day, "up", 30, 1, 60, 1), (0, "up", 10, 1, 60, 1), (day, "up", 20, 1, 60, 1),
            (3 * day, "up", 99, None, 60, 1),
        ],
        SNAP,
    )
    series = [(r.name, r.at, r.point) for r in movies.score_series(rows).collect()]
    assert series[0] == ("one", "1970-01-01 00:00:00", "0;50;1;60;1")
    assert [s[1] for s in series if s[0] == "up"] == [
        "1970-01-01 00:00:00", "1970-01-02 00:00:00", "1970-01-03 00:00:00",
    ]
    changes = {(r.name, r.kind): r for r in movies.score_changes(rows).collect()}
    assert changes["up", "critics"].minmax == 20.0
    assert changes["up", "critics"].slope == pytest.approx(10 / day)
    assert changes["up", "critics"].intercept == pytest.approx(10)
    assert changes["up", "audience"].slope == 0.0
    assert changes["one", "critics"].slope is None and changes["same", "critics"].slope is None

    def names(*args, **kw):
        return [(r.name, r.kind) for r in movies.score_alerts(rows, *args, **kw).collect()]

    # Strictly above the threshold.
    assert names(20.0, "minmax") == []
    assert names(19.0, "minmax") == [("same", "critics"), ("up", "critics")]
    assert names(1e-5) == [("up", "critics")]
    assert names(-1.0, "minmax", ["audience"]) == [(n, "audience") for n in ("one", "same", "up")]
    alerts = movies.score_alerts(rows, 1e-5)
    assert [r.score for r in movies.alert_points(rows, alerts).collect()] == [10.0, 20.0, 30.0]
    line = movies.report_lines(alerts).first().line
    assert line.startswith("up (critics): minmax=20.0 slope=1.15")
    for bad in ({"delta": "other"}, {"kinds": []}, {"kinds": ["nobody"]}):
        with pytest.raises(ValueError):
            movies.score_alerts(rows, 1.0, **bad)


def _article(spark, page):
    rows = spark.createDataFrame([("u", None, page)], "uri string, ts timestamp, content string")
    return articles.articles(rows).first()


@pytest.mark.parametrize(
    "part",
    ["<!-- x <script>", "<script ", "<nav><footer>", "<article>", "<", "<meta ", "<html ", "<meta name=lang ",
     "<title>", "<style"],
)
def test_pages_of_unclosed_tags_take_linear_time(spark, part):
    page = '<html lang="en"><body>' + part * (1_000_000 // len(part))
    _article(spark, "<html lang='en'><body>warm")
    began = time.perf_counter()
    _article(spark, page)
    assert time.perf_counter() - began < 5


@pytest.mark.parametrize(
    "body, text",
    [
        ("<div><nav><a>Home</a></div><p>The whole story.</p>", "Home The whole story."),
        ("<div><nav>Home</div>The story. <NAV id=b>menu</NAV > The end.", "Home The story. The end."),
        ("One <footer>two <nav>menu</nav> three", "One two three"),
        ("One</nav> <nav>two", "One two"),
        # What is closed goes whole, as the SQL has it.
        ("<footer>f <nav>menu</nav> f</footer>One", "One"),
        ("<footer>f <nav>menu</footer>One <nav>menu</nav>two", "One two"),
        ("<nav>a <nav>b</nav> c</nav> d<nav>e</nav>", "d"),
    ],
)
def test_unclosed_nav_and_footer_keep_the_text_after_them(spark, body, text):
    assert _article(spark, f"<html lang='en'><body>{body}</body></html>").text == text


@pytest.mark.parametrize("part", ["<nav>", "<footer>x</footer><nav>", "</nav><nav>"])
def test_unclosed_nav_and_footer_take_linear_time(spark, part):
    page = "</nav>" * 50_000 + part * (1_000_000 // len(part))
    _article(spark, "<html lang='en'><body>warm")
    began = time.perf_counter()
    _article(spark, "<html lang='en'><body>" + page)
    assert time.perf_counter() - began < 5


def test_languages_of_long_meta_tags(spark):
    long = "x" * 2_000
    for meta in (f'data-a="{long}" name="lang" content="en"', f'name=lang data-a="{long}" content=en'):
        assert _article(spark, f"<html><meta charset=utf-8><meta {meta}><body>t</body></html>").text == "t"
    page = "<html><meta " + "name=lang " * 100_000
    began = time.perf_counter()
    assert _article(spark, page) is None
    assert time.perf_counter() - began < 5


def test_names_of_tags_are_whole(spark):
    page = ("<html lang='en'><body><article-card>teaser</article-card>"
            "<article><nav-bar></nav-bar>KEEP THIS<nav>menu</nav>end</article></body>")
    assert _article(spark, page).text == "KEEP THIS end"


def test_entities(spark):
    page = ("<html lang='en'><body>It&rsquo;s&nbsp;10&#8239;pm &#x1F600; &#65;&#66; &amp;lt; &#0; &#xZZ; &#55296; a < b"
            " &mdash; x</body>")
    want = "It’s 10 pm \U0001f600 AB &lt; &#0; &#xZZ; &#55296; a < b — x"
    assert _article(spark, page).text == want


@pytest.mark.parametrize(
    "body, text",
    [
        ("<nav>a<nav>b</nav>c</nav>Story", "Story"),
        ("<nav>a<nav>b<nav>x</nav>y</nav>c</nav><nav>d</nav>Story", "Story"),
        ("<nav>a<nav>b</nav>Story", "a Story"),
        ('<p title="a>b">t</p>', "t"),
        ("<p title='a>b' class=\"c'd>\">t</p>", "t"),
        ('<p title="a<b>c">t</p>', "t"),
        ("<p title=it's>t</p> and <b x='>'>u</b>", "t and u"),
        ("caf&eacute; &Uuml;ber&nbsp;all &alpha;&#233;&#xE9; &amp;lt; &nope; &;", "café Über all αéé &lt; &nope; &;"),
        ("1 < 2 & 3 <4", "1 < 2 & 3 <4"),
    ],
)
def test_markup_is_read_tag_by_tag(spark, body, text):
    rows = spark.createDataFrame([(f"<html><body>{body}</body></html>",)], "page string")
    assert rows.select(html.body_text(F.col("page")).alias("t")).first().t == text


@pytest.mark.parametrize("part", ["&#", "&a", '<p "', "<nav>a", "<nav></nav>", "<p title='x'>y", '<p a="', "'\"<>"])
def test_markup_of_any_kind_takes_linear_time(spark, part):
    page = "<html><body>" + part * (1_000_000 // len(part))
    rows = spark.createDataFrame([(page,)], "page string")
    began = time.time()
    rows.select(F.length(html.body_text(F.col("page")))).collect()
    assert time.time() - began < 15


def test_an_element_takes_its_page_apart_once(spark):
    pages = spark.createDataFrame([('<div><b class="x">1<b>2</b></b></div>',)], "page string")
    found = pages.select(html.element(F.col("page"), "b", html.open_tag("b", "x", False)).alias("x"))
    assert found.first().x == "1<b>2</b>"
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_what_follows_an_opening_tag_is_what_a_split_leaves(spark):
    draw = random.Random(3)
    parts = ['<div class="x">', "<div ", 'class="x"', "class='a> x'", ">", "'", '"', " ", "</div>", "\n", "<DIV id=1 class=x y>", "é"]
    texts = [("".join(draw.choice(parts) for _ in range(draw.randrange(14))),) for _ in range(600)] + [(None,), ("",)]
    page = F.col("page")
    pages = spark.createDataFrame(texts, "page string")
    for exact in (True, False):
        opening = html.open_tag("div", "x", exact)
        for nth in (1, 2):
            pairs = pages.select(
                F.get(F.split(page, opening, nth + 1), F.lit(nth)).alias("a"), html._after(page, opening, nth).alias("b")
            )
            assert pairs.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
            assert pairs.filter(F.col("b").isNotNull()).count() > 10

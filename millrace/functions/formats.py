"""Patterns, class names and labels of the outside formats.

These must equal what the crawled sites, archives and payloads use; the code
that applies them lives elsewhere.
"""

# --- Fixed values -----------------------------------------------------------
# Archive names: a 14-digit stamp before a 5-digit serial, or epoch milliseconds
# in an older path style.
ARCHIVE_STAMP = r"([0-9]{14})-[0-9]{5}"
ARCHIVE_STAMP_FORMAT = "yyyyMMddHHmmss"
ARCHIVE_EPOCH_MS = r"[0-9]{4}/[0-9]{2}/[0-9]{2}/[0-9]+/([0-9]+)_[0-9]+"

# Host of a URL.
HOST = r"https?://([^ /]*)"

# Movie pages.
MOVIE_PAGE = r"https?://(www\.)?rottentomatoes\.com/m/([^/]*)/?.*"

# Readable time.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Score pages: classes, elements and attributes of the three layouts.
CRITIC_METER_CLASS = "meter-value superPageFontColor"
AUDIENCE_METER_CLASS = "audience-score meter"
AUDIENCE_VALUE_CLASS = "superPageFontColor"
HALF_CLASS = "mop-ratings-wrap__half"
COUNT_CLASS = "mop-ratings-wrap__text--small"
CRITIC_LINK_CLASS = "scoreboard__link scoreboard__link--tomatometer"
AUDIENCE_LINK_CLASS = "scoreboard__link scoreboard__link--audience"
BOARD_ELEMENT = "score-board"
BOARD_CRITIC = "tomatometerscore"
BOARD_AUDIENCE = "audiencescore"
RATINGS_LABEL = "Verified Ratings: "
NO_SCORE = "None"

# Archive records.
RESPONSE = "response"
TARGET_URI = "WARC-Target-URI"

# Language kept by the article job.
ARTICLE_LANGUAGE = "en"

# Label of newly minted value.
COINBASE = "COINBASE"

# Archives looked ahead per step of an incremental run.
LOOK_AHEAD = 16
# ----------------------------------------------------------------------------

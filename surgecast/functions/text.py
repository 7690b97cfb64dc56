"""Text expressions: media lists, keywords, accents, annotations (no Python UDF
except the full Unicode accent strip, which Spark has no built-in for)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# ---- fixed values (must equal the reference's for equal keywords) ----------
# Two-word place names removed from team names when building search keywords.
TWO_WORD_PLACES = [
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota",
    "Rhode Island", "South Carolina", "South Dakota", "West Virginia", "South Florida",
    "Southern Utah", "Notre Dame", "Los Angeles", "Las Vegas",
]
# Social-metric topic per sport, the source list and the measurement window.
TOPIC_ID = {"hockey": 940401, "football": 1410787, "basketball": 1697931, "baseball": 1040201}
SOURCES = (
    "Twitter,Facebook,Instagram,Tumblr,YouTube,Blogs,Comments,Forums,Internal,"
    "Microblogs,News,ConsumerReviews,ProfReviews,SocialNetworks,Other"
)
DAYS_BEFORE_EVENT = 7
DAYS_IN_MEASURED_PERIOD = 10
# Leagues for which no keywords are built.
NO_KEYWORD_LEAGUES = ["caribbean-series"]
# Characters removed from keywords: anything not word/space/dot/underscore/digit, and the word "Else".
KEYWORD_JUNK = r"(?U)([^\w\s._\d]|Else)"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def media_list(media: ColumnOrName, unknown: str = "media_unknown") -> Column:
    """PRJ8 + PRJ9: null -> unknown; '|' and ',' both separate entries."""
    m = F.coalesce(_c(media), F.lit(unknown))
    return F.split(F.translate(m, "|", ","), ",")


def media_key(media: ColumnOrName) -> Column:
    """Canonical text of a media list (used for the one-hot vocabulary)."""
    return F.array_join(media_list(media), ",")


def team_keywords(name: ColumnOrName, league: ColumnOrName | None = None, places: list[str] | None = None) -> Column:
    """PRJ12: search keywords from an ``A at B`` event name.

    For each side: every contained two-word place removed; and the text after
    'State', else after 'City', else everything after the first word. The
    full side names are added; distinct, sorted. Empty for excluded leagues.
    """
    places_arr = F.array(*[F.lit(p) for p in (places or TWO_WORD_PLACES)])
    sides = F.split(_c(name), " at ")

    def per_side(n: Column) -> Column:
        stripped = F.filter(
            F.transform(places_arr, lambda s: F.when(F.contains(n, s), F.replace(n, s, F.lit("")))),
            lambda x: x.isNotNull(),
        )
        words = F.split(n, " ")
        short = (
            F.when(F.contains(n, F.lit("State")), F.element_at(F.split(n, "State"), -1))
            .when(F.contains(n, F.lit("City")), F.element_at(F.split(n, "City"), -1))
            .otherwise(F.array_join(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), " "))
        )
        return F.concat(stripped, F.array(short))

    kws = F.array_sort(F.array_distinct(F.concat(F.flatten(F.transform(sides, per_side)), sides)))
    if league is not None:
        kws = F.when(_c(league).isin(NO_KEYWORD_LEAGUES), sides).otherwise(kws)
    return kws


def clean_keywords(kws: ColumnOrName) -> Column:
    """PRJ13: strip junk characters and the word 'Else'; drop empty keywords."""
    cleaned = F.transform(_c(kws), lambda w: F.regexp_replace(w, KEYWORD_JUNK, ""))
    return F.array_sort(F.array_distinct(F.filter(cleaned, lambda w: w != "")))


@F.pandas_udf(T.StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """PRJ10: canonical decomposition, then combining marks U+0300-U+036F removed.

    Arrow-batched; Spark has no Unicode normalization built-in.
    """

    def one(x):
        if x is None:
            return None
        d = unicodedata.normalize("NFD", x)
        return "".join(ch for ch in d if not ("̀" <= ch <= "ͯ"))

    return s.map(one)


def annotation_text(metrics: ColumnOrName) -> Column:
    """PRJ30: ``based on a, b`` from a list of metric names."""
    return F.concat(F.lit("based on "), F.array_join(_c(metrics), ", "))


def map_values(col: ColumnOrName, mapping: dict[str, str]) -> Column:
    """PRJ16: replace values found in ``mapping``; others are kept."""
    if not mapping:
        return _c(col)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(col)), _c(col))


def topic_for_sport(sport: ColumnOrName) -> Column:
    """PRJ15: literal lookup of the topic id per sport."""
    m = F.create_map(*[F.lit(x) for kv in TOPIC_ID.items() for x in kv])
    return F.try_element_at(m, _c(sport))

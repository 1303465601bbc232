"""Track rows from catalogue JSON (P15): playlist, album and track pages as JSON text.

A page is parsed once with the schema of its shape (``from_json``; fields that are not needed are not
read) and its items become rows by ``posexplode_outer``, so a page without items, or text that is
no such page, still gives its one row without a track, which ``tracks_only`` leaves out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of the three kinds of pages.
_ARTISTS = "struct<items: array<struct<profile: struct<name: string>>>>"
_NAMED = "struct<name: string>"
_LASTS = "struct<totalMilliseconds: bigint>"
SHAPES = {
    "playlist": "data struct<playlistV2: struct<name: string, content: struct<totalCount: bigint, items: array<struct<itemV2: "
                f"struct<data: struct<name: string, artists: {_ARTISTS}, albumOfTrack: {_NAMED}, trackDuration: {_LASTS}>>>>>>>",
    "album": "data struct<albumUnion: struct<name: string, tracks: struct<totalCount: bigint, items: array<struct<track: "
             f"struct<name: string, artists: {_ARTISTS}, duration: {_LASTS}>>>>>>",
    "track": f"data struct<trackUnion: struct<name: string, firstArtist: {_ARTISTS}, otherArtists: {_ARTISTS}, albumOfTrack: {_NAMED}, duration: {_LASTS}>>",
}


def _text(c: Column) -> Column:
    """A missing text field reads as an empty text."""
    return F.coalesce(c, F.lit(""))


def _names(artists: Column) -> Column:
    """Names of an artist list, without missing and empty ones."""
    names = F.transform(F.coalesce(artists["items"], F.array().cast("array<struct<profile: struct<name: string>>>")), lambda a: a["profile"]["name"])
    return F.filter(names, lambda n: n.isNotNull() & (n != ""))


def _first(artists: Column) -> Column:
    return _text(F.try_element_at(artists["items"], F.lit(1))["profile"]["name"])


def _seconds(ms: Column) -> Column:
    """Whole seconds, by integer division; a missing duration is 0."""
    return F.coalesce((ms - F.pmod(ms, F.lit(1000))) / 1000, F.lit(0)).cast("long")


def track_rows(pages: DataFrame, json: str, shape: str) -> DataFrame:
    """One row per track of the JSON column's pages: the other columns of ``pages``, pos (NULL without a track),
    title, artist (the first one), artists (all, in order), album (a playlist's from the item, an album's from the
    page) and duration_s. ``shape`` is playlist, album or track."""
    page = pages.withColumn("__page", F.from_json(json, SHAPES[shape])["data"]).drop(json)
    others = [c for c in page.columns if c != "__page"]
    if shape == "track":
        t = F.col("__page")["trackUnion"]
        artists = F.concat(F.when(_first(t["firstArtist"]) != "", F.array(_first(t["firstArtist"]))).otherwise(F.array().cast("array<string>")),
                           _names(t["otherArtists"]))
        return page.select(*others, F.when(t.isNotNull(), F.lit(0)).alias("pos"), _text(t["name"]).alias("title"), _first(t["firstArtist"]).alias("artist"),
                           artists.alias("artists"), _text(t["albumOfTrack"]["name"]).alias("album"), _seconds(t["duration"]["totalMilliseconds"]).alias("duration_s"))
    root = F.col("__page")["playlistV2" if shape == "playlist" else "albumUnion"]
    items = root["content" if shape == "playlist" else "tracks"]["items"]
    rows = page.select(*others, root["name"].alias("__name"), F.posexplode_outer(items).alias("pos", "__item"))
    t = F.col("__item")["itemV2"]["data"] if shape == "playlist" else F.col("__item")["track"]
    album = t["albumOfTrack"]["name"] if shape == "playlist" else F.col("__name")
    last = t["trackDuration" if shape == "playlist" else "duration"]["totalMilliseconds"]
    return rows.select(*others, "pos", _text(t["name"]).alias("title"), _first(t["artists"]).alias("artist"), _names(t["artists"]).alias("artists"),
                       _text(album).alias("album"), _seconds(last).alias("duration_s"))


def tracks_only(rows: DataFrame) -> DataFrame:
    """Without the rows that stand for pages without tracks."""
    return rows.filter(F.col("pos").isNotNull())

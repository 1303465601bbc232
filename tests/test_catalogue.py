"""P15 on hand-made pages of each kind."""

import json

from skein.operators import catalogue as C


def artists(*names):
    return {"items": [{"profile": {"name": n}} for n in names]}


def run(spark, shape, *pages):
    df = spark.createDataFrame([(i, p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(pages)], "id int, page string")
    rows = C.track_rows(df, "page", shape).orderBy("id", "pos").collect()
    return [(r.id, r.pos, r.title, r.artist, r.artists, r.album, r.duration_s) for r in rows]


NOTHING = (None, "", "", [], "", 0)


def test_playlist_takes_the_album_from_the_item(spark):
    page = {"data": {"playlistV2": {"name": "Mix", "content": {"items": [
        {"itemV2": {"data": {"name": "One", "artists": artists("A", "B"), "albumOfTrack": {"name": "X"}, "trackDuration": {"totalMilliseconds": 61999}}}},
        {"itemV2": {"data": {"name": "Two", "artists": artists(), "trackDuration": {"totalMilliseconds": 999}}}}, {"itemV2": {}}]}}}}
    assert run(spark, "playlist", page, {"data": {}}, "no json", None) == [
        (0, 0, "One", "A", ["A", "B"], "X", 61), (0, 1, "Two", "", [], "", 0), (0, 2, "", "", [], "", 0),
        (1, *NOTHING), (2, *NOTHING), (3, *NOTHING)]


def test_album_takes_the_album_from_the_page(spark):
    page = {"data": {"albumUnion": {"name": "LP", "tracks": {"items": [{"track": {"name": "One", "artists": artists("A"), "duration": {"totalMilliseconds": 1000}}}]}}}}
    assert run(spark, "album", page) == [(0, 0, "One", "A", ["A"], "LP", 1)]


def test_track_page_lists_all_artists(spark):
    page = {"data": {"trackUnion": {"name": "T", "firstArtist": artists("A"), "otherArtists": {"items": [{"profile": {"name": "B"}}, {"profile": {"name": ""}}, {}]},
                                    "albumOfTrack": {"name": "X"}, "duration": {"totalMilliseconds": 2500}}}}
    assert run(spark, "track", page, "{}") == [(0, 0, "T", "A", ["A", "B"], "X", 2), (1, *NOTHING)]


def test_pages_without_tracks_can_be_left_out(spark):
    df = spark.createDataFrame([(1, "{}")], "id int, page string")
    assert C.tracks_only(C.track_rows(df, "page", "album")).count() == 0

"""Pages built from the order tables (P15): which columns travel, and their order inside a page."""

import json

from skein.plans import shaping


class Few:
    """Small tables with a part key that comes twice, null names and an order without lines."""

    def __init__(self, spark):
        self.part = spark.createDataFrame([(1, "p", "B1", "type b"), (1, "p", "B0", "type c"), (1, "p", "B2", "type a"), (2, None, "B3", None)],
                                          "p_partkey long, p_name string, p_brand string, p_type string")
        self.supplier = spark.createDataFrame([(1, "S1"), (2, None)], "s_suppkey long, s_name string")
        self.lineitem = spark.createDataFrame([(2, 1, 1, 3, 1.5), (2, 1, 1, 1, 2.0), (3, 2, 2, 2, None), (3, 2, 1, None, 4.0), (None, 1, 1, 1, 1.0)],
                                              "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double")
        self.orders = spark.createDataFrame([(2, "HIGH"), (3, None), (4, "LOW"), (3, "LOW")], "o_orderkey long, o_orderpriority string")


def test_pages_keep_their_order_and_nulls_and_nest_songs_after_the_shuffle(spark):
    pages = shaping._catalogue_pages(Few(spark))
    got = sorted((r.o_orderkey, r.page) for r in pages.collect())
    assert [k for k, _ in got] == [2, 3, 3, 4]
    items = json.loads(got[0][1])["data"]["playlistV2"]["content"]
    songs = [x["itemV2"]["data"] for x in items["items"]]
    # with artists: ordered by supplier, then brand; without: by type
    assert items["totalCount"] == 6
    assert [(s["albumOfTrack"]["name"], [a["profile"]["name"] for a in s["artists"]["items"]]) for s in songs] == [
        ("type c", ["S1", "B0"]), ("type b", ["S1", "B1"]), ("type a", ["S1", "B2"]), ("type a", []), ("type b", []), ("type c", [])]
    assert [s["duration"]["totalMilliseconds"] for s in songs] == [200] * 3 + [150] * 3 == [s["trackDuration"]["totalMilliseconds"] for s in songs]
    albums = [json.loads(p)["data"]["albumUnion"] for k, p in got if k == 3]
    assert sorted(a.get("name", "") for a in albums) == ["", "LOW"]
    for a in albums:
        tracks = [x["track"] for x in a["tracks"]["items"]]
        assert [t["artists"]["items"] for t in tracks] == [[], [{"profile": {}}, {"profile": {"name": "B3"}}]]
        assert [t["duration"] for t in tracks] == [{"totalMilliseconds": 400}, {}] and all("name" not in t for t in tracks)
    plan = pages._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    grouped = [line for line in plan.splitlines() if "ObjectHashAggregate(" in line]
    assert len(grouped) == 2 and not any("totalMilliseconds" in line for line in grouped)

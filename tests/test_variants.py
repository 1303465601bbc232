"""JSON through VARIANT: mixed types survive, nothing is inferred."""

import json

from skein.operators import variants

DOCS = [
    {"a": 1, "b": {"c": [1, "x", None, {"d": 2.5}]}, "e": []}, {"a": "one", "b": None}, {"a": {"deep": {"er": True}}}, [1, [2, 3]], 7, "text", None, {}, {"a b": 1},
]


def walk(v, path="$", depth=9):
    if depth and isinstance(v, dict) and v:
        for k, x in v.items():
            yield from walk(x, f"{path}.{k}", depth - 1)
    elif depth and isinstance(v, list) and v:
        for i, x in enumerate(v):
            yield from walk(x, f"{path}[{i}]", depth - 1)
    elif isinstance(v, (dict, list)):
        yield path, json.dumps(v, separators=(",", ":"))
    else:
        yield path, None if v is None else str(v).lower() if isinstance(v, bool) else str(v)


def test_leaves(spark):
    df = spark.createDataFrame([(i, json.dumps(d), "x") for i, d in enumerate(DOCS)] + [(99, "{broken", "x"), (98, None, "x")], "id int, j string, key string")
    v = df.select("id", "key", variants.parsed("j").alias("v"))
    for depth in (1, 2, 5):
        got = sorted((r.id, r.path, r.value) for r in variants.leaves(v, "v", depth).drop("key").collect() if r.id < 90)
        want = sorted((i, p, x) for i, d in enumerate(DOCS) for p, x in walk(d, depth=depth))
        assert [(i, p, x) for i, p, x in got] == want
    odd = [r for r in variants.leaves(v, "v", 2).collect() if r.id >= 90]
    assert len(odd) == 2 and all((r.path, r.value, r.kind) == ("$", None, None) or r.kind in (None, "VOID") for r in odd)


def test_kinds_and_merged_schema(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [true]}',), ('{"a": 2.5}',)], "j string").select(variants.parsed("j").alias("v"))
    kinds = {(r.path, r.kind) for r in variants.leaves(df, "v", 3).collect()}
    assert ("$.a", "BIGINT") in kinds and ("$.b[0]", "BOOLEAN") in kinds and any(p == "$.a" and k.startswith("DECIMAL") for p, k in kinds)
    assert variants.schema_of_column(df, "v").first().schema.startswith("OBJECT<a: DECIMAL")


def test_levels_keep_rows_without_members(spark):
    df = spark.createDataFrame([(1, "[]"), (2, "{}"), (3, "5"), (4, None), (5, '{"k": null}')], "id int, j string").select("id", variants.parsed("j").alias("v"))
    assert sorted((r.id, r.pos, r.key) for r in variants.level(df, "v").collect()) == [(1, None, None), (2, None, None), (3, None, None), (4, None, None), (5, 0, "k")]
    assert [r.id for r in variants.level(df, "v", outer=False).collect()] == [5]


def test_tracks_of_mixed_pages(spark):
    pages = [
        {"data": {"playlistV2": {"content": {"items": [{"itemV2": {"data": {"name": "s", "artists": {"items": [{"profile": {"name": "n"}}]}, "trackDuration": {"totalMilliseconds": "61999"}}}}]}}}},
        {"data": {"albumUnion": {"tracks": {"items": [{"track": {"name": "t", "duration": {"totalMilliseconds": 1000}}}, {"track": None}]}}}}, {"data": {}}, [],
    ]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(pages)] + [(9, "no page")], "id int, page string")
    got = sorted(((r.id, r.pos, r.title, r.artist, r.duration_s) for r in variants.track_rows_variant(df, "page").collect()), key=str)
    assert got == sorted([(0, 0, "s", "n", 61), (1, 0, "t", "", 1), (1, 1, "", "", 0), (2, None, "", "", 0), (3, None, "", "", 0), (9, None, "", "", 0)], key=str)

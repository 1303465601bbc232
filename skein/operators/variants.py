"""Nested JSON text through VARIANT (S1, P1, P15): parsed once, without a schema and without an inference pass.

A VARIANT keeps every value with its own type, so a field that is a number in one row and a text or an object in
another survives; ``from_json`` would make it NULL. Paths are read where they are needed; the merged schema of a whole
column is one aggregate over values that are parsed anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(json: Column | str) -> Column:
    """JSON text -> VARIANT; NULL where the text is no JSON."""
    return F.try_parse_json(F.col(json) if isinstance(json, str) else json)


def schema_of_column(df: DataFrame, variant: str) -> DataFrame:
    """One row: the merged schema of all values of the column, as SQL text."""
    return df.agg(F.schema_of_variant_agg(variant).alias("schema"))


def level(df: DataFrame, variant: str, outer: bool = True, names: tuple[str, str, str] = ("pos", "key", "value")) -> DataFrame:
    """P1, one level: the other columns, and for each member of an object or element of an array its position, key (NULL in an
    array) and value, called ``names``. Other values, objects and arrays without members, and NULL give one row without position (none
    if not ``outer``)."""
    others = [c for c in df.columns if c != variant]
    if clash := set(others) & set(names):
        raise ValueError(f"columns {sorted(clash)} are there already; choose other names")
    view = "variant_explode_outer" if outer else "variant_explode"
    plain = df.select(F.struct(*others).alias("__others"), F.col(variant).alias("__v")) if others else df.select(F.lit(0).alias("__others"), F.col(variant).alias("__v"))
    exploded = plain.lateralJoin(getattr(df.sparkSession.tvf, view)(F.col("__v").outer()))
    return exploded.select(*[F.col("__others")[c].alias(c) for c in others], *[F.col(a).alias(b) for a, b in zip(("pos", "key", "value"), names)])


def leaves(df: DataFrame, variant: str, depth: int) -> DataFrame:
    """Every scalar of a nested value, down to ``depth`` levels, as (other columns, path, value: text, kind).

    Paths are like ``$.a[0].b``. What is nested deeper, and an empty object or array, comes as its JSON text; a JSON null as the kind VOID.
    One generator per level: no row leaves its task."""
    others = [c for c in df.columns if c != variant]
    rows = df.select(*others, F.lit("$").alias("path"), F.col(variant).alias("__v"))
    out = None
    for _ in range(depth):
        kind = F.schema_of_variant("__v")
        nested = (kind.startswith("OBJECT<") & (kind != "OBJECT<>")) | (kind.startswith("ARRAY<") & (F.to_json("__v") != "[]"))
        nested = F.coalesce(nested, F.lit(False))
        flat = rows.filter(~nested)
        out = flat if out is None else out.unionByName(flat)
        inner = level(rows.filter(nested), "__v", False, ("__pos", "__key", "__value"))
        step = F.when(F.col("__key").isNull(), F.concat(F.lit("["), F.col("__pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("__key")))
        rows = inner.select(*others, F.concat(F.col("path"), step).alias("path"), F.col("__value").alias("__v"))
    out = rows if out is None else out.unionByName(rows)
    kind = F.schema_of_variant("__v")
    scalar = ~(kind.startswith("OBJECT<") | kind.startswith("ARRAY<"))
    text = F.when(scalar, F.try_variant_get("__v", "$", "string")).otherwise(F.to_json("__v"))
    return out.select(*others, "path", text.alias("value"), kind.alias("kind"))


def track_rows_variant(pages: DataFrame, json: str) -> DataFrame:
    """P15 for playlist and album pages alike: (other columns, pos, title, artist, duration_s); the page says itself which it is.

    A page without tracks, and text that is no page, gives one row without position. Durations may be numbers or texts."""
    page = pages.withColumn("__p", parsed(json)).drop(json)
    others = [c for c in page.columns if c != "__p"]
    items = F.coalesce(F.try_variant_get("__p", "$.data.playlistV2.content.items", "variant"), F.try_variant_get("__p", "$.data.albumUnion.tracks.items", "variant"))
    rows = level(page.select(*others, items.alias("__i")), "__i")
    track = F.coalesce(F.try_variant_get("value", "$.itemV2.data", "variant"), F.try_variant_get("value", "$.track", "variant"))
    rows = rows.withColumn("__t", track)
    get = lambda path, kind: F.try_variant_get("__t", path, kind)
    ms = F.coalesce(get("$.trackDuration.totalMilliseconds", "bigint"), get("$.duration.totalMilliseconds", "bigint"), F.lit(0))
    return rows.select(*others, "pos", F.coalesce(get("$.name", "string"), F.lit("")).alias("title"),
                       F.coalesce(get("$.artists.items[0].profile.name", "string"), F.lit("")).alias("artist"),
                       ((ms - F.pmod(ms, F.lit(1000))) / 1000).cast("long").alias("duration_s"))

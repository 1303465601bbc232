"""Projections, flattening and filters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def clean_column_name(name: str) -> str:
    """P1 rename rule: ``.``/``$`` -> ``_``, ``__`` -> ``_``, blanks and ``-`` removed."""
    n = name.replace(".", "_").replace("$", "_")
    n = n.replace(" ", "").replace("-", "")
    while "__" in n:
        n = n.replace("__", "_")
    return n


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Explode arrays (outer) and lift struct fields as ``parent_child`` until flat.

    One ``select`` per nesting level, walking ``df.schema``; two arrays in a
    row multiply rows (as the reference does).
    """
    while True:
        fields = df.schema.fields
        arrays = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
        structs = [f for f in fields if isinstance(f.dataType, T.StructType)]
        if not arrays and not structs:
            break
        if arrays:
            name = arrays[0]
            df = df.withColumn(name, F.explode_outer(F.col(f"`{name}`")))
            continue
        cols = []
        for f in fields:
            if isinstance(f.dataType, T.StructType):
                for sub in f.dataType.fields:
                    cols.append(F.col(f"`{f.name}`.`{sub.name}`").alias(clean_column_name(f"{f.name}{sep}{sub.name}")))
            else:
                cols.append(F.col(f"`{f.name}`"))
        df = df.select(*cols)
    return df.toDF(*[clean_column_name(c) for c in df.columns])


def drop_rename(df: DataFrame, drop_pattern: str | None = None, drop: list[str] = (),
                rename: dict[str, str] | None = None) -> DataFrame:
    """Drop columns matching a regex or listed, then rename."""
    rx = re.compile(drop_pattern) if drop_pattern else None
    gone = [c for c in df.columns if (rx and rx.search(c)) or c in drop]
    out = df.drop(*gone)
    for a, b in (rename or {}).items():
        out = out.withColumnRenamed(a, b)
    return out


def split_list(c: Column | str, sep: str = ",", trim: bool = True) -> Column:
    """Delimited string -> array; ``trim=False`` keeps the blanks (Q1)."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.split(c, re.escape(sep))
    return F.transform(parts, lambda x: F.trim(x)) if trim else parts


def split_by_column(value: Column | str, delimiter: Column | str, literal: bool = True) -> Column:
    """P5: split by another column's delimiter; regex by default in Spark, so
    ``literal=True`` quotes it (``$``, ``^``, ``|`` then split as characters)."""
    value = F.col(value) if isinstance(value, str) else value
    delimiter = F.col(delimiter) if isinstance(delimiter, str) else delimiter
    pat = F.concat(F.lit("\\Q"), delimiter, F.lit("\\E")) if literal else delimiter
    return F.split(value, pat)


def owner_or_feature(df: DataFrame, key: str, owner: str, features: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose owner is in the id set or whose feature list overlaps it.

    The id set stays a DataFrame (never collected): (row key, candidate id)
    pairs over owner and features are semi-joined with the set, then the
    matching keys select the rows.
    """
    s = ids.select(F.col(id_col).alias("__id")).distinct()
    empty = F.array().cast(df.schema[features].dataType)
    cand = df.select(F.col(key), F.explode(F.array_union(
        F.array(F.col(owner)), F.coalesce(F.col(features), empty))).alias("__id"))
    hit = cand.join(s, "__id", "left_semi").select(key).distinct()
    return df.join(hit, key, "left_semi")


def head_tail(names: Column | str, sep: str = ", ") -> list[Column]:
    """First element is the owner, the tail joined by ``sep`` the features."""
    names = F.col(names) if isinstance(names, str) else names
    return [F.element_at(names, 1).alias("owner"),
            F.array_join(F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))), sep).alias("feats")]


def contains_any_case(cols: list[str], text: str | None) -> Column:
    """Any of ``cols`` contains ``text`` ignoring case; ``None`` keeps all rows."""
    if text is None:
        return F.lit(True)
    t = text.lower()
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(F.lower(F.col(c)).contains(t), F.lit(False))
    return cond


def url_path_part(url: Column | str, index: int) -> Column:
    """``split(url, '/')[index]`` with the query string removed (NULL when absent)."""
    url = F.col(url) if isinstance(url, str) else url
    part = F.get(F.split(url, "/"), index)
    return F.split(part, r"\?").getItem(0)


def composite_key(title: Column | str, artist: Column | str, sep: str = "---") -> Column:
    """``title---artist``."""
    return F.concat_ws(sep, title, artist)


def split_composite(key: Column | str, sep: str = "---") -> list[Column]:
    """Back to (title, artist) at the first separator (Q8: a title with the
    separator splits early, as in the reference)."""
    key = F.col(key) if isinstance(key, str) else key
    parts = F.split(key, re.escape(sep), 2)
    return [parts.getItem(0).alias("title"), parts.getItem(1).alias("artist")]


def resource_link(base: str, id_col: Column | str) -> Column:
    """Derived link ``base + id``."""
    return F.concat(F.lit(base), F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string"))


def tagged_json(tag: str, **fields: Column) -> Column:
    """``{"type": tag, ...fields}`` as one JSON string."""
    return F.to_json(F.struct(F.lit(tag).alias("type"), *[c.alias(k) for k, c in fields.items()]))


# URL shapes of the music service's links (host passed separately).
# Q19: the album link takes a 22-character ``si``, the others 16.
URL_KINDS = {
    "track": r"/track/[a-zA-Z0-9]{22}\?si=[a-zA-Z0-9]{16}$",
    "playlist": r"/playlist/[a-zA-Z0-9]{22}\?si=[a-zA-Z0-9]{16}$",
    "album": r"/album/[a-zA-Z0-9-]{22}\?si=[a-zA-Z0-9_-]{22}$",
}


def url_kind(url: Column | str, prefix_rx: str, kinds: dict[str, str] = URL_KINDS) -> Column:
    """The first kind whose pattern the URL matches (``prefix_rx`` + kind pattern), else NULL.

    For the music service ``prefix_rx = '^https://' + re.escape(host)``.
    """
    url = F.col(url) if isinstance(url, str) else url
    out = F.lit(None).cast("string")
    prefix = prefix_rx
    for k, pat in reversed(list(kinds.items())):
        out = F.when(url.rlike(prefix + pat), F.lit(k)).otherwise(out)
    return out


HOST_RX = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)"
PORT_RX = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/:?#]+:([0-9]+)"


def origin_allowed(url: Column | str, hosts: list[str], ports: list[int]) -> Column:
    """Host in ``hosts`` and port in ``ports`` (-1 = no port given); bad or
    missing URL -> false."""
    url = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract(url, HOST_RX, 1)
    port_txt = F.regexp_extract(url, PORT_RX, 1)
    port = F.when(port_txt == "", F.lit(-1)).otherwise(port_txt.try_cast("int"))
    ok = host.isin(hosts) & port.isin(ports)
    return F.coalesce(ok, F.lit(False))


def select_by_type(df: DataFrame, kind: str = "numeric") -> DataFrame:
    """Keep only numeric (or string) columns, read from ``df.schema``."""
    if kind == "numeric":
        keep = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    elif kind == "string":
        keep = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    else:
        raise ValueError(kind)
    return df.select(*keep)


def semi_lookup(df: DataFrame, keys: DataFrame, key: str, allowed: tuple[str, ...] | None = None,
                keys_col: str | None = None) -> DataFrame:
    """Rows whose ``key`` is in the ``keys`` table; ``allowed`` is the
    allow-list of key columns (Q7: an unknown key column is an error)."""
    if allowed is not None and key not in allowed:
        raise ValueError(f"key {key!r} not in {allowed}")
    kc = keys_col or key
    k = keys.select(F.col(kc).alias(key)).distinct()
    return df.join(k, key, "left_semi")

"""Projection / flattening / filter queries (P1-P22) on the driver tables.

Role mapping: the track catalogue is built from ``lineitem``: one track per
order, its artists are the order's suppliers by line number (the first is the
owner, the rest the features, stored ", "-joined as in the reference data).
The searched artists are the suppliers of nations 0-9. ``pages`` carries URLs
and HTML; ``part`` names play titles and brands artists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import catalogue as track_catalogue
from skein.operators import shape, variants
from skein.plans.registry import ORACLE_SQL, query
from skein.sources.tables import Tables

# ------------------------------------------------------------------ catalogue


def catalogue(t: Tables) -> DataFrame:
    """(id, artist_id, feats_ids): per order the supplier list by line number.

    The list is built per order (a bounded fan-out: the lines of one order);
    ``sort_array`` over (line number, supplier) fixes the order.
    """
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("lines"))
    names = F.transform("lines", lambda x: x["l_suppkey"].cast("string"))
    ht = shape.head_tail(names)
    return lines.select(F.col("l_orderkey").alias("id"), ht[0].alias("artist_id"), ht[1].alias("feats_ids"))


_CAT_SQL = """
  cat0 AS (SELECT l_orderkey AS id, list(l_suppkey::VARCHAR ORDER BY l_linenumber, l_suppkey) AS names
           FROM lineitem GROUP BY l_orderkey),
  cat AS (SELECT id, names[1] AS artist_id, array_to_string(names[2:], ', ') AS feats_ids FROM cat0)"""


def artist_set(t: Tables) -> DataFrame:
    """Distinct searched artist ids (kept as a DataFrame, never collected)."""
    return t.supplier.filter(F.col("s_nationkey") < 10).select(
        F.col("s_suppkey").cast("string").alias("artist")).distinct()


@query("head_tail_features", sql=f"WITH {_CAT_SQL} SELECT * FROM cat")
def q_head_tail(spark, sf_dir):
    """owner = first artist, features = the rest joined by ', '."""
    return catalogue(Tables(spark, sf_dir))


@query("split_features", sql=f"""WITH {_CAT_SQL}
    SELECT id, artist_id, CASE WHEN feats_ids = '' THEN [] ELSE list_transform(string_split(feats_ids, ','), lambda x: trim(x)) END AS feats
    FROM cat""")
def q_split_features(spark, sf_dir):
    """The feature string back to an array (trimmed; Q1)."""
    c = catalogue(Tables(spark, sf_dir))
    feats = F.when(F.col("feats_ids") == "", F.array().cast("array<string>")).otherwise(
        shape.split_list("feats_ids", ",", trim=True))
    return c.select("id", "artist_id", feats.alias("feats"))


@query("artist_or_feature", sql=f"""WITH {_CAT_SQL},
    s AS (SELECT DISTINCT s_suppkey::VARCHAR AS artist FROM supplier WHERE s_nationkey < 10)
    SELECT * FROM cat WHERE artist_id IN (SELECT artist FROM s)
       OR list_has_any(list_transform(string_split(feats_ids, ','), lambda x: trim(x)), (SELECT list(artist) FROM s))""")
def q_artist_or_feature(spark, sf_dir):
    """Tracks owned by, or featuring, any searched artist."""
    t = Tables(spark, sf_dir)
    c = catalogue(t).withColumn("feats", shape.split_list("feats_ids", ",", trim=True))
    out = shape.owner_or_feature(c, "id", "artist_id", "feats", artist_set(t), "artist")
    return out.select("id", "artist_id", "feats_ids")


_NESTED_HOST = r"^[a-z]+://([^/:?#]+)"
_NESTED_PATH = r"^[a-z]+://[^/?#]*(/[^?#]*)"


@query("flatten_nested", sql=f"""
    SELECT page_id, regexp_extract(url, '{_NESTED_HOST}', 1) AS link_host,
           unnest(string_split(regexp_extract(url, '{_NESTED_PATH}', 1), '/')) AS link_segments,
           length(html)::INTEGER AS link_meta_size
    FROM pages""")
def q_flatten_nested(spark, sf_dir):
    """A nested page record (struct with an array and a nested struct) made flat."""
    p = Tables(spark, sf_dir).pages
    nested = p.select("page_id", F.struct(
        F.regexp_extract("url", _NESTED_HOST, 1).alias("host"),
        F.split(F.regexp_extract("url", _NESTED_PATH, 1), "/").alias("segments"),
        F.struct(F.length("html").alias("size")).alias("meta"),
    ).alias("link"))
    return shape.flatten(nested)


_LINK_RX = r'(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'


@query("explode_transform", sql=f"""
    SELECT page_id, hrefs[i] AS href, texts[i] AS text, lower_texts FROM (
      SELECT page_id, hrefs, texts, list_transform(texts, lambda x: lower(x)) AS lower_texts,
             unnest(range(1, len(hrefs) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '{_LINK_RX}', 1) AS hrefs,
                   regexp_extract_all(html, '{_LINK_RX}', 2) AS texts FROM pages))""")
def q_explode_transform(spark, sf_dir):
    """Explode the page's link items, star-expand them, transform the text list."""
    p = Tables(spark, sf_dir).pages
    items = F.arrays_zip(F.regexp_extract_all("html", F.lit(_LINK_RX), 1).alias("href"),
                         F.regexp_extract_all("html", F.lit(_LINK_RX), 2).alias("text"))
    texts = F.regexp_extract_all("html", F.lit(_LINK_RX), 2)
    d = p.select("page_id", F.explode(items).alias("item"),
                 F.transform(texts, lambda x: F.lower(x)).alias("lower_texts"))
    return d.select("page_id", "item.*", "lower_texts")


@query("drop_rename", sql="""
    SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey, l_linenumber, l_quantity,
           l_extendedprice, l_returnflag, l_linestatus FROM lineitem""")
def q_drop_rename(spark, sf_dir):
    """Drop by name pattern and by list, then rename."""
    li = Tables(spark, sf_dir).lineitem
    return shape.drop_rename(li, r"^l_(tax|discount)$", ["l_shipdate"],
                             {"l_orderkey": "order_id", "l_partkey": "part_id"})


@query("split_by_column", sql="""
    SELECT page_id, CASE WHEN url LIKE 'https%' THEN '.' ELSE '/' END AS delim,
           string_split(url, CASE WHEN url LIKE 'https%' THEN '.' ELSE '/' END) AS parts FROM pages""")
def q_split_by_column(spark, sf_dir):
    """P5: split a column by the delimiter held in another column (literal)."""
    p = Tables(spark, sf_dir).pages.withColumn(
        "delim", F.when(F.col("url").like("https%"), ".").otherwise("/"))
    return p.select("page_id", "delim", shape.split_by_column("url", "delim", literal=True).alias("parts"))


@query("numeric_only", sql="""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
    FROM lineitem""")
def q_numeric_only(spark, sf_dir):
    """The numeric columns, chosen from the schema."""
    return shape.select_by_type(Tables(spark, sf_dir).lineitem, "numeric")


@query("lookup_keys", sql="""
    SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def q_lookup_keys(spark, sf_dir):
    """P10: a batch of primary keys looked up by a semi join."""
    t = Tables(spark, sf_dir)
    keys = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return shape.semi_lookup(t.customer, keys, "c_custkey")


@query("lookup_by_key", sql="""
    SELECT * FROM customer WHERE c_name IN (
      SELECT 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') FROM orders WHERE o_orderstatus = 'F')""")
def q_lookup_by_key(spark, sf_dir):
    """Look up by a chosen unique key from an allow-list (here the name)."""
    t = Tables(spark, sf_dir)
    keys = t.orders.filter(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("c_name"))
    return shape.semi_lookup(t.customer, keys, "c_name", allowed=("c_custkey", "c_name"))


@query("contains_filter", sql="""
    SELECT p_partkey, p_name, p_type FROM part
    WHERE contains(lower(p_name), 'all') OR contains(lower(p_type), 'all')""")
def q_contains_filter(spark, sf_dir):
    """Owner or features contain a text, any case."""
    p = Tables(spark, sf_dir).part
    return p.filter(shape.contains_any_case(["p_name", "p_type"], "ALL")).select("p_partkey", "p_name", "p_type")


@query("url_path_id", sql="""
    SELECT page_id, split_part(string_split(url, '/')[5], '?', 1) AS path_id FROM pages""")
def q_url_path_id(spark, sf_dir):
    """The fifth '/'-part of the URL without its query string."""
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", shape.url_path_part("url", 4).alias("path_id"))


_PAGES_SQL = """
  i AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos, l_linenumber,
               p_name, p_type, p_brand, s_name, (l_extendedprice * 100)::BIGINT AS ms
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)"""


def _catalogue_pages(t):
    """One JSON page per order, its items the order's lines: playlist pages for even order keys, album pages for odd
    ones. Every third line has no artists, the others two.

    What is shuffled and sorted per line is the few plain columns of its song; the nested song is made of them in the page."""
    li = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    has_artists = lambda number: number % 3 != 0
    artist = [F.when(has_artists(F.col("l_linenumber")), F.col(c)).alias(c) for c in ("s_name", "p_brand")]
    plain = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "p_name", *artist, "p_type")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(plain)).alias("lines"))

    def song(x):
        name = lambda c: F.struct(x[c].alias("name"))
        profile = lambda c: F.struct(name(c).alias("profile"))
        none = F.array().cast("array<struct<profile: struct<name: string>>>")
        artists = F.struct(F.when(has_artists(x["l_linenumber"]), F.array(profile("s_name"), profile("p_brand"))).otherwise(none).alias("items"))
        lasts = F.struct((x["l_extendedprice"] * 100).cast("long").alias("totalMilliseconds"))
        return F.struct(x["p_name"].alias("name"), artists.alias("artists"), name("p_type").alias("albumOfTrack"), lasts.alias("trackDuration"),
                        lasts.alias("duration"))

    o = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "o_orderpriority", "lines")
    playlist = F.struct(F.struct(F.struct(F.col("o_orderpriority").alias("name"), F.struct(F.size("lines").alias("totalCount"), F.transform(
        "lines", lambda x: F.struct(F.struct(song(x).alias("data")).alias("itemV2"))).alias("items")).alias("content")).alias("playlistV2")).alias("data"))
    album = F.struct(F.struct(F.struct(F.col("o_orderpriority").alias("name"), F.struct(F.transform(
        "lines", lambda x: F.struct(song(x).alias("track"))).alias("items")).alias("tracks")).alias("albumUnion")).alias("data"))
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.to_json(playlist)).otherwise(F.to_json(album)).alias("page"))


@query("json_items", sql=f"""WITH {_PAGES_SQL}
    SELECT o_orderkey, pos::INTEGER AS pos, coalesce(p_name, '') AS title, CASE WHEN l_linenumber % 3 <> 0 THEN s_name ELSE '' END AS artist,
           CASE WHEN l_linenumber % 3 <> 0 THEN [s_name, p_brand] ELSE []::VARCHAR[] END AS artists,
           CASE WHEN pos IS NULL AND o_orderkey % 2 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN p_type ELSE o_orderpriority END AS album,
           coalesce(ms // 1000, 0) AS duration_s
    FROM orders LEFT JOIN i ON l_orderkey = o_orderkey""")
def q_json_items(spark, sf_dir):
    """Playlist and album pages (JSON text with an item array) to track rows; ms to s by integer division."""
    pages = _catalogue_pages(Tables(spark, sf_dir))
    even = F.col("o_orderkey") % 2 == 0
    return track_catalogue.track_rows(pages.filter(even), "page", "playlist").unionByName(
        track_catalogue.track_rows(pages.filter(~even), "page", "album"))


@query("variant_tracks", sql=f"SELECT o_orderkey, pos, title, artist, duration_s FROM ({ORACLE_SQL['json_items']})")
def q_variant_tracks(spark, sf_dir):
    """P15 on VARIANT: track rows of playlist and album pages in one pass, without a schema."""
    rows = variants.track_rows_variant(_catalogue_pages(Tables(spark, sf_dir)), "page")
    return rows.select("o_orderkey", "pos", "title", "artist", "duration_s")


@query("composite_key", sql="""
    SELECT p_partkey, p_name || '---' || p_brand AS key,
           regexp_extract(p_name || '---' || p_brand, '^(.*?)---(.*)$', 1) AS title,
           regexp_extract(p_name || '---' || p_brand, '^(.*?)---(.*)$', 2) AS artist
    FROM part""")
def q_composite_key(spark, sf_dir):
    """Build ``title---artist`` and split it back."""
    p = Tables(spark, sf_dir).part.select("p_partkey", shape.composite_key("p_name", "p_brand").alias("key"))
    return p.select("p_partkey", "key", *shape.split_composite("key"))


@query("resource_links", sql="""
    SELECT c_custkey AS id, c_name AS name, '/v1/customers/' || c_custkey::VARCHAR AS link FROM customer""")
def q_resource_links(spark, sf_dir):
    """Resource view with a derived link."""
    c = Tables(spark, sf_dir).customer
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    shape.resource_link("/v1/customers/", "c_custkey").alias("link"))


@query("tagged_json", sql="""
    SELECT event_id, to_json({'type': 'stockupdate', 'symbol': event_type, 'price': value})::VARCHAR AS msg
    FROM events""")
def q_tagged_json(spark, sf_dir):
    """Tagged JSON messages (type, symbol, price)."""
    e = Tables(spark, sf_dir).events
    return e.select("event_id", shape.tagged_json("stockupdate", symbol=F.col("event_type"),
                                                  price=F.col("value")).alias("msg"))


PAGE_PREFIX = r"^https?://[a-z.]+\.example\.(com|org|net)"
PAGE_KINDS = {
    "paged": r"/[a-z]{2}/[0-9]+\?page=[0-9]+.*$",
    "anchored": r"/[a-z]{2}/[0-9]+#[a-z]+$",
    "plain": r"/[a-z]{2}/[0-9]+$",
}


@query("url_valid", sql=f"""
    SELECT page_id, CASE {' '.join(f"WHEN regexp_matches(url, '{PAGE_PREFIX + p}') THEN '{k}'" for k, p in PAGE_KINDS.items())}
                    ELSE NULL END AS kind FROM pages""")
def q_url_valid(spark, sf_dir):
    """URL shape check, first matching kind."""
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", shape.url_kind("url", PAGE_PREFIX, PAGE_KINDS).alias("kind"))


ALLOWED_HOSTS = ["blog.tionsh.example.net", "thther.example.org", "localhost"]
ALLOWED_PORTS = [-1, 9000, 19001]


@query("origin_filter", sql=f"""
    SELECT page_id, url FROM pages
    WHERE regexp_extract(url, '{shape.HOST_RX}', 1) IN ({', '.join(repr(h) for h in ALLOWED_HOSTS)})
      AND coalesce(CASE WHEN regexp_extract(url, '{shape.PORT_RX}', 1) = '' THEN -1
                        ELSE try_cast(regexp_extract(url, '{shape.PORT_RX}', 1) AS INTEGER) END
                   IN ({', '.join(map(str, ALLOWED_PORTS))}), false)""")
def q_origin_filter(spark, sf_dir):
    """Keep pages whose origin (host, port) is allowed."""
    p = Tables(spark, sf_dir).pages
    return p.filter(shape.origin_allowed("url", ALLOWED_HOSTS, ALLOWED_PORTS)).select("page_id", "url")

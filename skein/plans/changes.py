"""Set operators and bulk changes (U1-U5, D1-D5) on the driver tables.

``customer`` is the mutable table; change batches are derived from
``orders`` / ``supplier`` so that they grow with the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skein.operators import changes, paging
from skein.plans.registry import ORACLE_SQL, query
from skein.session import scratch_path
from skein.sources import snapshots
from skein.sources.tables import Tables


@query("append_rows", sql="""
    SELECT n_nationkey AS id, n_name AS name FROM nation
    UNION ALL
    SELECT ((SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY r_name))::INTEGER, r_name FROM region""")
def q_append_rows(spark, sf_dir):
    """Append rows with new ids after the largest one."""
    t = Tables(spark, sf_dir)
    base = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    new = t.region.select(F.col("r_name").alias("name"))
    return changes.append_rows(base, new, "id", [F.col("name")])


@query("set_diff", sql="""
    SELECT (SELECT count(*) FROM (SELECT DISTINCT o_custkey AS k FROM orders
                                  EXCEPT ALL SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))) AS only_left,
           (SELECT count(*) FROM (SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
                                  EXCEPT ALL SELECT DISTINCT o_custkey FROM orders)) AS only_right""")
def q_set_diff(spark, sf_dir):
    """Two derivations of the same key set compared irrespective of order."""
    t = Tables(spark, sf_dir)
    a = t.orders.select(F.col("o_custkey").alias("k")).distinct()
    b = t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select(
        F.col("c_custkey").alias("k"))
    return changes.set_difference_counts(a, b)


@query("id_intersect", sql="""
    SELECT o_custkey AS id FROM orders INTERSECT SELECT user_id FROM events""")
def q_id_intersect(spark, sf_dir):
    """Intersection of two id sets."""
    t = Tables(spark, sf_dir)
    return t.orders.select(F.col("o_custkey").alias("id")).intersect(t.events.select("user_id"))


_SPLIT_TS = "2024-01-15 00:00:00"


@query("history_then_updates", sql=f"""
    SELECT symbol, ts, event_id, price, 0 AS phase FROM (
      SELECT event_type AS symbol, ts, event_id, value AS price,
             row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE ts < TIMESTAMP '{_SPLIT_TS}') WHERE rn <= 50
    UNION ALL
    SELECT event_type, ts, event_id, value, 1 FROM events WHERE ts >= TIMESTAMP '{_SPLIT_TS}'""")
def q_history_then_updates(spark, sf_dir):
    """U4: the last 50 quotes before a point, then every later quote, with a phase column."""
    e = Tables(spark, sf_dir).events.select(F.col("event_type").alias("symbol"), "ts", "event_id",
                                             F.col("value").alias("price"))
    cut = F.lit(_SPLIT_TS).cast("timestamp_ntz")
    hist = paging.top_k_per_group(e.filter(F.col("ts") < cut), ["symbol"],
                                  [F.col("ts").desc(), F.col("event_id").desc()], 50).drop("rank")
    return changes.history_then_updates(hist, e.filter(F.col("ts") >= cut))


@query("except_keys", sql="""
    SELECT DISTINCT user_id FROM events WHERE event_type = 'view'
    EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 250""")
def q_except_keys(spark, sf_dir):
    """The watch list minus the keys asked to be removed."""
    e = Tables(spark, sf_dir).events
    watch = e.filter(F.col("event_type") == "view").select("user_id").distinct()
    drop = e.filter((F.col("event_type") == "error") & (F.col("value") > 250)).select("user_id")
    return changes.except_keys(watch, drop, "user_id")


_CHG_SQL = """(SELECT o_custkey AS c_custkey,
                      CASE WHEN count(*) > 12 THEN NULL ELSE round(max(o_totalprice) / 1000, 2) END AS c_acctbal
               FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)"""


def _changes(t):
    o = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    g = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("m"))
    return g.select("c_custkey", F.when(F.col("n") > 12, F.lit(None)).otherwise(
        F.round(F.col("m") / 1000, 2)).cast("double").alias("c_acctbal"))


@query("apply_updates", sql=f"""
    SELECT c.c_custkey, c.c_name, c.c_nationkey,
           CASE WHEN ch.c_custkey IS NOT NULL THEN ch.c_acctbal ELSE c.c_acctbal END AS c_acctbal, c.c_mktsegment
    FROM customer c LEFT JOIN {_CHG_SQL} ch USING (c_custkey)""")
def q_apply_updates(spark, sf_dir):
    """Update by key from a change table (a NULL in the change overwrites)."""
    t = Tables(spark, sf_dir)
    return changes.apply_updates(t.customer, _changes(t), "c_custkey", ["c_acctbal"])


@query("apply_deletes", sql="""
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)""")
def q_apply_deletes(spark, sf_dir):
    """Delete by key."""
    t = Tables(spark, sf_dir)
    return changes.except_keys(t.customer, _deletes(t), "c_custkey")


def _deletes(t):
    return t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)).select(
        F.col("o_custkey").alias("c_custkey"))


_UPS_SQL = """(SELECT o_custkey + CASE WHEN o_orderstatus = 'P' THEN 1000000 ELSE 0 END AS c_custkey,
                      'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS c_name, 0 AS c_nationkey,
                      o_totalprice AS c_acctbal, o_orderpriority AS c_mktsegment, o_orderdate, o_orderkey
               FROM orders)"""


@query("apply_upserts", sql=f"""
    WITH ch AS (SELECT * EXCLUDE (o_orderdate, o_orderkey) FROM (
                  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                  FROM {_UPS_SQL}) WHERE rn = 1)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM ch)
    UNION ALL SELECT c_custkey, c_name, c_nationkey::INTEGER, c_acctbal, c_mktsegment FROM ch""")
def q_apply_upserts(spark, sf_dir):
    """D3: insert or replace on key; the latest change per key wins."""
    t = Tables(spark, sf_dir)
    up = changes.apply_upserts(t.customer, _upserts(t), "c_custkey", [F.col("o_orderdate"), F.col("o_orderkey")])
    return up.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _upserts(t):
    return t.orders.select(
        (F.col("o_custkey") + F.when(F.col("o_orderstatus") == "P", 1000000).otherwise(0)).alias("c_custkey"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("c_name"),
        F.lit(0).cast("int").alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"), "o_orderdate", "o_orderkey")


#: buckets of the customer snapshot in the queries below
BUCKETS = 64


def _customer_snapshot(spark, t) -> str:
    path = scratch_path(spark, f"tables/{spark.sparkContext.applicationId}/snapshot-{uuid.uuid4().hex}")
    snapshots.create_snapshot(t.customer, path, "c_custkey", BUCKETS)
    return path


@query("apply_updates_bucketed", sql=ORACLE_SQL["apply_updates"])
def q_apply_updates_bucketed(spark, sf_dir):
    """D1 on a hash-partitioned snapshot: only touched buckets are read and replaced."""
    t = Tables(spark, sf_dir)
    path = _customer_snapshot(spark, t)
    snapshots.update_snapshot(spark, path, _changes(t), ["c_acctbal"])
    return snapshots.read_snapshot(spark, path)


@query("apply_deletes_bucketed", sql=ORACLE_SQL["apply_deletes"])
def q_apply_deletes_bucketed(spark, sf_dir):
    """D2 on a hash-partitioned snapshot."""
    t = Tables(spark, sf_dir)
    path = _customer_snapshot(spark, t)
    snapshots.delete_from_snapshot(spark, path, _deletes(t))
    return snapshots.read_snapshot(spark, path)


@query("apply_upserts_bucketed", sql=ORACLE_SQL["apply_upserts"])
def q_apply_upserts_bucketed(spark, sf_dir):
    """D3 on a hash-partitioned snapshot; the latest change per key wins."""
    t = Tables(spark, sf_dir)
    path = _customer_snapshot(spark, t)
    snapshots.upsert_snapshot(spark, path, _upserts(t), [F.col("o_orderdate"), F.col("o_orderkey")])
    return snapshots.read_snapshot(spark, path)


@query("unique_insert", sql="""
    WITH RECURSIVE b AS (
      SELECT (s_suppkey // 3) * 20 AS c_custkey, 'Supplier#' || (s_suppkey % 50)::VARCHAR AS c_name, s_suppkey AS ord,
             row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier),
    c AS (SELECT b.*, CASE WHEN c_custkey IN (SELECT c_custkey FROM customer) THEN 'c_custkey exists'
                           WHEN c_name IN (SELECT c_name FROM customer) THEN 'c_name exists' END AS base FROM b),
    r AS (
      SELECT 0::BIGINT AS n, []::BIGINT[] AS ids, []::VARCHAR[] AS names, NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_name,
             NULL::BIGINT AS ord, NULL::VARCHAR AS reason
      UNION ALL
      SELECT n, CASE WHEN reason IS NULL THEN list_append(ids, c_custkey) ELSE ids END,
             CASE WHEN reason IS NULL THEN list_append(names, c_name) ELSE names END, c_custkey, c_name, ord, reason
      FROM (SELECT c.n, r.ids, r.names, c.c_custkey, c.c_name, c.ord,
                   CASE WHEN c.base IS NOT NULL THEN c.base WHEN list_contains(r.ids, c.c_custkey) THEN 'c_custkey repeated'
                        WHEN list_contains(r.names, c.c_name) THEN 'c_name repeated' END AS reason
            FROM r JOIN c ON c.n = r.n + 1))
    SELECT c_custkey, c_name, ord, reason FROM r WHERE n > 0""")
def q_unique_insert(spark, sf_dir):
    """Insert with uniqueness on id and name; accepted rows (reason NULL) and rejects. Ids repeat in threes and
    names every fifty rows, so rejected rows share values with later ones."""
    t = Tables(spark, sf_dir)
    batch = t.supplier.select((F.expr("s_suppkey div 3") * 20).alias("c_custkey"),
                              F.concat(F.lit("Supplier#"), (F.col("s_suppkey") % 50).cast("string")).alias("c_name"),
                              F.col("s_suppkey").alias("ord"))
    acc, rej = changes.unique_insert(t.customer, batch, ["c_custkey", "c_name"], [F.col("ord")])
    return acc.withColumn("reason", F.lit(None).cast("string")).unionByName(rej)


@query("consistent_songs", sql="""
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events)""")
def q_consistent_songs(spark, sf_dir):
    """Publish only the songs whose fingerprint rows exist."""
    t = Tables(spark, sf_dir)
    fp = t.events.select(F.col("user_id").alias("c_custkey"))
    return changes.keep_consistent(t.customer.select("c_custkey", "c_name"), fp, "c_custkey")

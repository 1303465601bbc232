"""Join queries (J2, J7, J8, J12, J13) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import joins, paging
from skein.plans.listing import PAGE_SIZE, _COMPUTERS_SQL, companies, computers
from skein.plans.registry import query
from skein.sources.tables import Tables


@query("left_join_collect", sql=f"""
    SELECT * FROM (SELECT id, name, company, row_number() OVER (ORDER BY name, id)::BIGINT AS rank
                   FROM ({_COMPUTERS_SQL})) WHERE rank <= {PAGE_SIZE} AND company IS NOT NULL""")
def q_left_join_collect(spark, sf_dir):
    """Left join, page, then keep only rows that found a company (filter after paging)."""
    df = computers(Tables(spark, sf_dir)).select("id", "name", "company")
    p = paging.page(df, paging.order_columns(df, "name", tie="id"), 0, PAGE_SIZE)
    return p.filter(F.col("company").isNotNull())


@query("not_yet_known", sql="SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def q_not_yet_known(spark, sf_dir):
    """Candidates not known yet (anti join)."""
    t = Tables(spark, sf_dir)
    known = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti_known(t.customer.select("c_custkey", "c_name"), known, "c_custkey")


@query("range_first", sql="""
    SELECT o_orderkey, dur, l_linenumber, cand FROM (
      SELECT o.o_orderkey, o.o_totalprice / 10000 AS dur, l.l_linenumber, l.l_extendedprice / 1000 AS cand,
             row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, l.l_extendedprice / 1000) AS rn
      FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
      WHERE abs(l.l_extendedprice / 1000 - o.o_totalprice / 10000) <= 5) WHERE rn = 1""")
def q_range_first(spark, sf_dir):
    """Per track the best-ranked candidate whose duration is within 5 s."""
    t = Tables(spark, sf_dir)
    q = t.orders.select("o_orderkey", (F.col("o_totalprice") / 10000).alias("dur"))
    c = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                          (F.col("l_extendedprice") / 1000).alias("cand"))
    return joins.range_first(q, c, "o_orderkey", "dur", "cand", ["l_linenumber", "cand"], 5.0).select(
        "o_orderkey", "dur", "l_linenumber", "cand")


@query("fk_orphans", sql="""
    SELECT c_custkey, c_nationkey FROM customer
    WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)""")
def q_fk_orphans(spark, sf_dir):
    """Computers whose company id has no company row."""
    t = Tables(spark, sf_dir)
    there = t.nation.filter(F.col("n_regionkey") != 4)  # makes the orphans
    return joins.orphans(t.customer.select("c_custkey", "c_nationkey"), there, "c_nationkey", "n_nationkey")


@query("row_with_options", sql="""
    SELECT c.c_custkey, c.c_name, n.n_name AS label, n.n_nationkey::VARCHAR AS value,
           row_number() OVER (ORDER BY n.n_name, n.n_nationkey::VARCHAR) - 1 AS position
    FROM customer c, nation n WHERE c.c_custkey = 21""")
def q_row_with_options(spark, sf_dir):
    """One computer plus the company option list for its edit view."""
    t = Tables(spark, sf_dir)
    row = t.customer.filter(F.col("c_custkey") == 21).select("c_custkey", "c_name")
    opts = companies(t).select(F.col("n_nationkey").cast("string").alias("value"), F.col("n_name").alias("label"))
    return joins.row_with_options(row, opts, "value", "label")

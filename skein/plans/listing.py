"""E3 listing on the driver tables.

Role mapping: ``customer`` plays the computer table (id, name, company_id)
and ``nation`` the company table; a computer with a negative balance has no
company (a NULL company_id, and NULL after the left join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import paging
from skein.plans.registry import query
from skein.sources.tables import Tables

PAGE_SIZE = 20
NAME_TEXT = "customer#0000001"  # searched any case, as the listing's filter box does

_COMPUTERS_SQL = """
    SELECT c.c_custkey AS id, c.c_name AS name, c.c_acctbal AS acctbal,
           n.n_name AS company, c.company_id
    FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS company_id FROM customer) c
    LEFT JOIN nation n ON c.company_id = n.n_nationkey
"""


def companies(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", "n_name")


def computers(t: Tables) -> DataFrame:
    """Computers left join companies -> (id, name, acctbal, company, company_id)."""
    c = t.customer.select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("company_id"))
    j = paging.left_join_dim(c, companies(t), "company_id", "n_nationkey")
    return j.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"), F.col("n_name").alias("company"),
        "company_id",
    )


@query("left_join_dim", sql=_COMPUTERS_SQL)
def q_left_join_dim(spark, sf_dir):
    return computers(Tables(spark, sf_dir))


@query("name_filter", sql=f"""
    SELECT id, name, company FROM ({_COMPUTERS_SQL}) WHERE name ILIKE '%{NAME_TEXT}%'
""")
def q_name_filter(spark, sf_dir):
    df = computers(Tables(spark, sf_dir))
    return df.filter(paging.contains_ci("name", NAME_TEXT)).select("id", "name", "company")


@query("order_nulls_last", sql=f"""
    SELECT * FROM (
      SELECT id, name, acctbal, company, company_id,
             row_number() OVER (ORDER BY company DESC NULLS LAST, id)::BIGINT AS rank
      FROM ({_COMPUTERS_SQL})) WHERE rank > {3 * PAGE_SIZE} AND rank <= {4 * PAGE_SIZE}
""")
def q_order_nulls_last(spark, sf_dir):
    """O1: order by column number 4 (company) descending, nulls last; page 3."""
    df = computers(Tables(spark, sf_dir))
    keys = paging.order_columns(df, 4, descending=True, tie="id")
    return paging.page(df, keys, page_no=3, page_size=PAGE_SIZE)


@query("order_named", sql=f"""
    SELECT * FROM (
      SELECT id, name, acctbal, company, company_id,
             row_number() OVER (ORDER BY acctbal DESC NULLS LAST, id)::BIGINT AS rank
      FROM ({_COMPUTERS_SQL})) WHERE rank <= {PAGE_SIZE}
""")
def q_order_named(spark, sf_dir):
    """O2: order by an allow-listed column name and direction (first page)."""
    df = computers(Tables(spark, sf_dir))
    keys = paging.order_columns(df, "acctbal", descending=True, tie="id")
    return paging.page(df, keys, page_no=0, page_size=PAGE_SIZE)


@query("page", sql=f"""
    SELECT * FROM (
      SELECT id, name, acctbal, company, company_id,
             row_number() OVER (ORDER BY name NULLS LAST, id)::BIGINT AS rank
      FROM ({_COMPUTERS_SQL}) WHERE name ILIKE '%customer#00000%')
    WHERE rank > {2 * PAGE_SIZE} AND rank <= {3 * PAGE_SIZE}
""")
def q_page(spark, sf_dir):
    """E3 as one plan: join, filter, order, page 2 of 20."""
    df = computers(Tables(spark, sf_dir)).filter(paging.contains_ci("name", "customer#00000"))
    keys = paging.order_columns(df, "name", tie="id")
    return paging.page(df, keys, page_no=2, page_size=PAGE_SIZE)


@query("page_keyset", sql=f"""
    SELECT id, name, acctbal, company, company_id FROM ({_COMPUTERS_SQL})
    WHERE company IS NULL OR company < 'FRANCE' OR company = 'FRANCE' AND (acctbal < 5000 OR acctbal = 5000 AND id > 40)
    ORDER BY company DESC NULLS LAST, acctbal DESC NULLS LAST, id LIMIT {PAGE_SIZE}
""")
def q_page_keyset(spark, sf_dir):
    """O3: the page after a given row (its key), however deep: company and balance descending, then id."""
    df = computers(Tables(spark, sf_dir))
    return paging.page_after(df, [("company", True), ("acctbal", True), ("id", False)], ["FRANCE", 5000.0, 40], PAGE_SIZE)


@query("count_filtered", sql=f"""
    SELECT count(*) AS total,
           count(*) FILTER (WHERE name ILIKE '%{NAME_TEXT}%') AS matched,
           count(company) AS with_company
    FROM ({_COMPUTERS_SQL})
""")
def q_count_filtered(spark, sf_dir):
    """A1: count of all rows and of filtered rows in one pass."""
    df = computers(Tables(spark, sf_dir))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(paging.contains_ci("name", NAME_TEXT)).alias("matched"),
        F.count("company").alias("with_company"),
    )


@query("page_meta", sql=f"""
    SELECT total, 2::BIGINT AS page, {2 * PAGE_SIZE}::BIGINT AS "offset",
           ceil(total / {PAGE_SIZE})::BIGINT AS pages,
           true AS has_prev, ({3 * PAGE_SIZE} < total) AS has_next
    FROM (SELECT count(*) AS total FROM ({_COMPUTERS_SQL}) WHERE name ILIKE '%customer#00000%')
""")
def q_page_meta(spark, sf_dir):
    """Total, page count and has-prev / has-next for page 2."""
    df = computers(Tables(spark, sf_dir)).filter(paging.contains_ci("name", "customer#00000"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return total.select(*paging.page_meta(F.col("total"), 2, PAGE_SIZE))

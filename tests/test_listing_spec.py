"""Listing, paging, lookup, update and validation on a computer-database-shaped
fixture, asserting what the reference's model and functional specs assert
(lookup by id, total, page counts, name search, update to NULL, form
validation). The rows are generated here by a rule; only the shape and the
asserted facts follow the reference's fixture."""

import datetime as dt

from pyspark.sql import functions as F

from skein.operators import changes, paging, validate

N_COMPUTERS, N_COMPANIES = 574, 42


def _computers(spark):
    rows = []
    for i in range(1, N_COMPUTERS + 1):
        if i == 21:
            rows.append((i, "Macintosh", dt.datetime(1984, 1, 24), None, 1))
            continue
        name = f"Apple model {i}" if i % 44 == 0 else f"Computer {i:03d}"
        intro = dt.datetime(1970 + i % 40, 1 + i % 12, 1 + i % 28) if i % 3 else None
        company = None if i % 10 == 0 else 1 + i % N_COMPANIES
        rows.append((i, name, intro, None, company))
    return spark.createDataFrame(
        rows, "id long, name string, introduced timestamp, discontinued timestamp, company_id long")


def _companies(spark):
    return spark.createDataFrame([(i, f"Company {i}") for i in range(1, N_COMPANIES + 1)], "id long, name string")


def test_lookup_total_and_pages(spark):
    c = _computers(spark)
    m = c.filter(F.col("id") == 21).select("name", "introduced").first()
    assert (m.name, m.introduced) == ("Macintosh", dt.datetime(1984, 1, 24))
    meta = c.agg(*paging.page_meta(F.count(F.lit(1)), 0, 20)).first()
    assert (meta.total, meta.pages, meta.has_prev, meta.has_next) == (574, 29, False, True)
    last = c.agg(*paging.page_meta(F.count(F.lit(1)), 28, 20)).first()
    assert (last.has_prev, last.has_next) == (True, False)


def test_page_of_ten_with_company_names(spark):
    c = _computers(spark)
    co = _companies(spark).select(F.col("id").alias("cid"), F.col("name").alias("company"))
    j = paging.left_join_dim(c, co, "company_id", "cid")
    assert j.count() == N_COMPUTERS  # computers without a company are kept
    keys = paging.order_columns(j, "name", tie="id")
    p = paging.page(j, keys, 1, 10).orderBy("rank").collect()
    assert [r["rank"] for r in p] == list(range(11, 21))
    names = sorted(r["name"] for r in c.collect())
    assert [r["name"] for r in p] == names[10:20]


def test_name_search_ignores_case(spark):
    c = _computers(spark)
    assert c.filter(paging.contains_ci("name", "apple")).count() == 13
    assert c.filter(paging.contains_ci("name", "APPLE")).count() == 13


def test_update_to_null_date(spark):
    c = _computers(spark)
    ch = spark.createDataFrame([(21, None)], "id long, introduced timestamp")
    u = changes.apply_updates(c, ch, "id", ["introduced"])
    assert u.count() == N_COMPUTERS
    assert u.filter(F.col("id") == 21).first().introduced is None
    assert u.filter(F.col("introduced").isNull()).count() == c.filter(F.col("introduced").isNull()).count() + 1


def test_form_validation(spark):
    rules = [validate.Rule("name", "nonempty"), validate.Rule("introduced", "date", "yyyy-MM-dd"),
             validate.Rule("price", "min", 0)]
    df = spark.createDataFrame([(1, "Lamp", "last spring", 3), (2, "Lamp", "1998-02-28", 0), (3, "Desk", "2020-06-01", -7)],
                               "id long, name string, introduced string, price int")
    got = {r.id: sorted(r.errors) for r in validate.validate(df, rules).collect()}
    assert got[2] == []
    assert got[1] and all(e.startswith("introduced:") for e in got[1])
    assert got[3] == ["price:error.min"]

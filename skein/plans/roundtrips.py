"""Sources and sinks written and read back over whole tables.

Every file goes to the application's folder under the shared checkpoint folder and is released with the
other written tables.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from skein.operators import ml
from skein.plans.mlplans import _SPLIT_SQL
from skein.plans.registry import query
from skein.session import _tables_dir
from skein.sources import files
from skein.sources.tables import Tables

_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_PART_SQL = f"SELECT {', '.join(_PART)} FROM part"


def _folder(spark, name: str) -> str:
    return f"{_tables_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("json_documents", sql=_PART_SQL)
def q_json_documents(spark, sf_dir):
    """A table as JSON documents, read back with its schema; no record is corrupt."""
    part, path = Tables(spark, sf_dir).part.select(*_PART), _folder(spark, "json")
    part.write.json(path)
    return files.read_json_documents(spark, path, part.schema, multiline=False).filter(F.col("_corrupt_record").isNull()).select(*_PART)


@query("csv_table", sql=_PART_SQL)
def q_csv_table(spark, sf_dir):
    """S5 + S2: a ';'-separated table with a header and a fixed column order, read back."""
    part, path = Tables(spark, sf_dir).part.select(*_PART), _folder(spark, "csv")
    files.write_hash_csv(part, path, _PART)
    return files.read_csv(spark, path, part.schema, sep=";")


@query("written_once", sql="SELECT c_custkey, c_name FROM customer")
def q_written_once(spark, sf_dir):
    """The second write to a target changes nothing."""
    t, path = Tables(spark, sf_dir), _folder(spark, "once")
    files.write_once(t.customer.select("c_custkey", "c_name"), path, "parquet")
    files.write_once(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")), path, "parquet")
    return spark.read.parquet(path)


@query("seeded", sql="SELECT * FROM supplier")
def q_seeded(spark, sf_dir):
    """Seed rows enter a missing table once."""
    t, path = Tables(spark, sf_dir), _folder(spark, "seed")
    files.seed_if_empty(spark, path, t.supplier)
    files.seed_if_empty(spark, path, t.supplier)
    return spark.read.parquet(path)


@query("stored_model", sql=f"""
    SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
           round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem WHERE {_SPLIT_SQL}""")
def q_stored_model(spark, sf_dir):
    """A fitted pipeline saved (twice: the second overwrites) and loaded."""
    li, path = Tables(spark, sf_dir).lineitem, _folder(spark, "model")
    model = ml.fit_linear(li.filter(ml.split_flag(F.col("l_orderkey"), F.col("l_linenumber"))), ["l_quantity"], "l_extendedprice")
    files.save_model(model, path)
    files.save_model(model, path)
    lr = PipelineModel.load(path).stages[-1]
    return spark.createDataFrame([(round(float(lr.intercept), 4), round(float(lr.coefficients[0]), 4))], "intercept double, slope double")


@query("dropped_table", sql="SELECT r_name, true AS was_there, false AS is_there FROM region")
def q_dropped_table(spark, sf_dir):
    """A catalogue table that exists is dropped; dropping it again is no error."""
    region, name = Tables(spark, sf_dir).region, f"dropped_{uuid.uuid4().hex}"
    region.write.option("path", _folder(spark, "dropped")).saveAsTable(name)
    before = spark.catalog.tableExists(name)
    files.drop_table(spark, name)
    files.drop_table(spark, name)
    return region.select("r_name", F.lit(before).alias("was_there"), F.lit(spark.catalog.tableExists(name)).alias("is_there"))


@query("upload_sizes", sql="SELECT 'parquet' AS ext, true AS all_files, count(*) AS rows FROM part")
def q_upload_sizes(spark, sf_dir):
    """S4 + S16: files of a written table listed by extension with their total bytes."""
    part, path = Tables(spark, sf_dir).part, _folder(spark, "sizes")
    part.repartition(3).write.parquet(path)
    sizes = files.upload_sizes(files.list_media(spark, path, ["parquet"]))
    return sizes.select("ext", ((F.col("files") == 3) & (F.col("bytes") > 0)).alias("all_files"), F.lit(spark.read.parquet(path).count()).cast("long").alias("rows"))

"""The fingerprint index as a stored table, ready to be probed.

The index (address, song_id, anchor_ms) is a parquet table bucketed and sorted by ``address``: a join on the address
reads it as it lies, without an Exchange on its side, and only the clips' fingerprints are shuffled, to the
index's buckets. ``buckets`` fixes the number of join tasks; choose it so that a bucket is a few hundred MB. A hot
address is in one bucket, as its rows are in any join on it; its clip side is what AQE can split or broadcast.

Batches are appended: each adds at most one file per bucket, and only rows that are not stored yet, so
(address, song_id, anchor_ms) stays unique. The check for stored rows is a join on the address, too, so it does not
shuffle the index either. ``compact_index`` writes the batches of every bucket as one sorted file again.

The catalogue entry names the folder; ``open_index`` makes a new one, with the same buckets, in a session whose catalogue
doesn't know it. There is one writer at a time; an append that died leaves rows that the next one finds stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "address"
COLUMNS = "address bigint, song_id bigint, anchor_ms bigint"


def create_index(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """An empty index table ``name`` in the folder ``path``."""
    open_index(spark, name, path, buckets)
    if not spark.table(name).isEmpty():
        raise ValueError(f"{path} holds an index already")


def open_index(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """The index in the folder ``path`` under the name ``name``; ``buckets`` as it was written."""
    if not spark.catalog.tableExists(name):
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {int(buckets)} BUCKETS LOCATION '{where}'")
    return spark.table(name)


def buckets_of(spark: SparkSession, name: str) -> int:
    for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect():
        if row.col_name == "Num Buckets":
            return int(row.data_type)
    raise ValueError(f"{name} is not bucketed")


def append_to_index(spark: SparkSession, name: str, batch: DataFrame) -> None:
    """Add the rows of ``batch`` that the index does not hold; repeated rows of the batch count once."""
    table = spark.table(name)
    buckets = buckets_of(spark, name)
    columns = table.columns
    rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields]).filter(F.col(KEY).isNotNull())
    # one partitioning by address for all of it: the distinct, the check against the buckets, and the write
    rows = rows.repartition(buckets, KEY).dropDuplicates(columns)
    new = rows.join(table, columns, "left_anti")
    new.repartition(buckets, KEY).write.mode("append").format("parquet").bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name)


def compact_index(spark: SparkSession, name: str, path: str) -> str:
    """Write the index as one sorted file per bucket into the new folder ``path`` and let ``name`` mean that."""
    buckets = buckets_of(spark, name)
    other = f"{name}_compacted"
    # a repartition by the bucket column itself would be left out, and the files be read one by one
    spark.table(name).repartition(buckets, F.coalesce(KEY, F.lit(0).cast("long"))).write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(other)
    spark.sql(f"DROP TABLE {name}")  # the folder stays: the table is external
    spark.sql(f"ALTER TABLE {other} RENAME TO {name}")
    return path


def probe_index(clips: DataFrame, index: DataFrame) -> DataFrame:
    """(request_id, song_id, address, s_ms, d_ms) of every clip fingerprint and stored couple of one address."""
    stored = index.select(KEY, F.col("anchor_ms").alias("d_ms"), "song_id")
    return clips.select("request_id", KEY, "s_ms").join(stored, KEY)

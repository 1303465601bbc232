"""Set operators and bulk keyed changes.

Tables are immutable snapshots: a change produces a new DataFrame (written
by the caller as a new snapshot directory; see ``sources.store``). Every
change is a join on the key, so it shuffles only on that key and never
collects a key set to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import materialize


def append_rows(base: DataFrame, new: DataFrame, id_col: str, order: list[Column],
                block: Column | None = None) -> DataFrame:
    """Append rows, numbering new ids after the largest existing id.

    The batch is numbered by ``order`` with per-block counts and offsets
    (range-partitioned blocks, or a caller's bounded ``block`` monotone in
    ``order``), so no single task numbers it all; the
    offset is ``max(id)`` of the base (a scalar subquery: partial max per task).
    """
    from skein.operators.windows import dense_index

    top = base.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    numbered = dense_index(new, [], block, order, out="__rn", start=1)
    numbered = numbered.withColumn(id_col, (top + F.col("__rn")).cast(base.schema[id_col].dataType))
    return base.unionByName(numbered.drop("__rn"))


def set_difference_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a not in b and of b not in a (multiset), as counts; equal sets -> (0, 0).

    One signed count per row: +1 for each in a, -1 for each in b, combined before the shuffle."""
    both = a.withColumn("__s", F.lit(1)).union(b.withColumn("__s", F.lit(-1)))
    left = both.groupBy(*a.columns).agg(F.sum("__s").alias("__s"))
    return left.agg(F.coalesce(F.sum(F.greatest("__s", F.lit(0))), F.lit(0)).alias("only_left"),
                    F.coalesce(F.sum(F.greatest(-F.col("__s"), F.lit(0))), F.lit(0)).alias("only_right"))


def history_then_updates(history: DataFrame, updates: DataFrame) -> DataFrame:
    """U4: one stream of history (phase 0) followed by updates (phase 1)."""
    return history.withColumn("phase", F.lit(0)).unionByName(updates.withColumn("phase", F.lit(1)))


def except_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Remove rows whose key is in ``keys`` (anti join)."""
    return df.join(keys.select(key).distinct(), key, "left_anti")


def last_per_key(changes: DataFrame, key: str, order: list[Column] | None) -> DataFrame:
    """The last change of each key by ``order``; equal ones, or all without an order, by their columns. An
    aggregate (combined on the map side), not a window."""
    others = [c for c in changes.columns if c != key]
    by = F.struct(*(order or []), *others)
    return changes.groupBy(key).agg(F.max_by(F.struct(*others), by).alias("__last")).select(key, "__last.*")


def apply_updates(base: DataFrame, changes: DataFrame, key: str, cols: list[str], order: list[Column] | None = None) -> DataFrame:
    """Update ``cols`` of rows whose key appears in ``changes``; absent keys ignored.

    Of several changes of a key the last one by ``order`` counts. The choice is made on a match flag, not on
    NULL, so a NULL in the change overwrites (``UPDATE ... SET c = NULL``).
    """
    ch = last_per_key(changes, key, order)
    ch = ch.select(key, *[F.col(c).alias(f"__new_{c}") for c in cols]).withColumn("__hit", F.lit(True))
    j = base.join(ch, key, "left")
    out = [F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
           for c in base.columns]
    return j.select(*out)


def apply_upserts(base: DataFrame, changes: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """D3: insert or replace on key (copy-on-write). The last change per key wins."""
    ch = last_per_key(changes, key, order)
    return base.join(ch.select(key), key, "left_anti").unionByName(ch.select(*base.columns))


def _alternating(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows (``__order`` tells them apart) that are certainly accepted: those without an earlier row of an equal key, and of
    chains in which every row has one earlier row, every second one."""
    told = rows.select("__order", *keys)
    for k in keys:
        known = rows.filter(F.col(k).isNotNull()).select(k, "__order")
        first = known.groupBy(k).agg(F.min("__order").alias("__a"))
        second = known.join(first, k).filter(F.col("__order") > F.col("__a")).groupBy(k).agg(F.first("__a").alias("__a"), F.min("__order").alias("__b"))
        # the first row of a key has none before it, the second one has the first, the others have several
        told = told.join(first.withColumnRenamed("__a", f"{k}_a"), k, "left").join(second.select(k, F.col("__b").alias(f"{k}_b")), k, "left")
    before = [F.when(F.col("__order") > F.col(f"{k}_a"), F.col(f"{k}_a")) for k in keys]
    several = [F.coalesce(F.col("__order") > F.col(f"{k}_b"), F.lit(False)) for k in keys]
    found = F.array_distinct(F.filter(F.array(*before), lambda x: x.isNotNull()))
    waits = F.size(found) > 1
    for s in several:
        waits = waits | s
    told = told.select("__order", F.when(~waits, F.try_element_at(found, F.lit(1))).alias("to"), waits.alias("waits"))
    told = materialize(told.withColumn("odd", F.col("to").isNotNull()), "chains")
    while not (open_ := told.filter(F.col("to").isNotNull())).isEmpty():
        ahead = told.select(F.col("__order").alias("to"), F.col("to").alias("__to"), F.col("odd").alias("__odd"), F.col("waits").alias("__waits"))
        moved = open_.join(ahead, "to").select("__order", F.col("__to").alias("to"), F.col("__waits").alias("waits"), (F.col("odd") != F.col("__odd")).alias("odd"))
        told = materialize(told.filter(F.col("to").isNull()).select("__order", "to", "waits", "odd").unionByName(moved), "chains")
    return rows.join(told.filter(~F.col("waits") & ~F.col("odd")).select("__order"), "__order", "left_semi")


def unique_insert(base: DataFrame, batch: DataFrame, unique: list[str | tuple[str, ...]],
                  order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Insert row by row in ``order`` with uniqueness on each of ``unique`` (a column or a group of columns).

    A row is rejected when a unique value of it stands in the base or in an earlier *accepted* row; a rejected
    row leaves no trace, so it blocks nobody. A NULL never conflicts. ``order`` must tell the rows apart.
    Returns (accepted, rejected with reason, the first violated one of ``unique``).

    Rounds instead of a row-by-row pass. In each, undecided rows that no earlier undecided row shares a value with are accepted;
    rows with one such earlier row have the opposite fate of that one, so whole chains of them are decided at once, by pointers
    that double their reach (``_alternating``). Rows that share a value with an earlier accepted one are rejected. What has several
    earlier rows waits for the next round; the first undecided row is always decided. Each round is a few aggregates and joins on the
    unique values; its state is written.
    """
    groups = {u if isinstance(u, str) else ", ".join(u): [u] if isinstance(u, str) else list(u) for u in unique}
    cols = batch.columns

    def known(df: DataFrame, names: list[str]) -> Column:
        return F.when(F.expr(" and ".join(f"`{n}` is not null" for n in names)), F.struct(*names))

    rows = batch.withColumn("__order", F.struct(*order)).withColumn("__reason", F.lit(None).cast("string"))
    keys = {name: f"__u{i}" for i, name in enumerate(groups)}
    for name, names in groups.items():
        rows = rows.withColumn(keys[name], known(rows, names))
    for name, names in groups.items():
        there = base.select(known(base, names).alias(keys[name])).filter(F.col(keys[name]).isNotNull()).distinct()
        there = there.withColumn("__in", F.lit(f"{name} exists"))
        rows = rows.join(there, keys[name], "left").withColumn("__reason", F.coalesce("__reason", "__in")).drop("__in")
    rejected = materialize(rows.filter(F.col("__reason").isNotNull()), "rejected")
    rows = materialize(rows.filter(F.col("__reason").isNull()), "undecided")
    accepted = rows.limit(0)
    while not rows.isEmpty():
        taken = materialize(_alternating(rows, list(keys.values())), "accepted")
        rest = rows.join(taken.select("__order"), "__order", "left_anti")
        for name, k in keys.items():
            blocked = taken.filter(F.col(k).isNotNull()).select(k, F.col("__order").alias("__by"), F.lit(f"{name} repeated").alias("__in"))
            rest = rest.join(blocked, k, "left").withColumn("__reason", F.coalesce("__reason", F.when(F.col("__by") < F.col("__order"), F.col("__in")))).drop("__in", "__by")
        rest = materialize(rest, "rest")
        accepted = accepted.unionByName(taken)
        rejected = rejected.unionByName(rest.filter(F.col("__reason").isNotNull()))
        rows = rest.filter(F.col("__reason").isNull())
    return accepted.select(*cols), rejected.select(*cols, F.col("__reason").alias("reason"))


def keep_consistent(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Publish only parents that have at least one child row (semi join)."""
    return parents.join(children.select(key).distinct(), key, "left_semi")

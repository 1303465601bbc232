"""Many small groups through pandas with one Python call per Arrow batch.

``applyInPandas`` pays a fixed cost per group; for many small, bounded groups
(a block of frames, a chunk of samples) it is cheaper to hash-partition by the
group key, sort inside partitions and walk the groups in ``mapInPandas``,
carrying a group that spans two Arrow batches over to the next batch. Groups
must be bounded by construction (the callers cut them into blocks).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame


def apply_sorted_groups(df: DataFrame, keys: list[str], order: list[str],
                        fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                        partitions: int | None = None) -> DataFrame:
    d = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    d = d.sortWithinPartitions(*keys, *order)

    def run(batches):
        carry = None
        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
                carry = None
            if pdf.empty:
                continue
            # the last group may continue in the next batch
            last = tuple(pdf.iloc[-1][k] for k in keys)
            tail = pd.Series(True, index=pdf.index)
            for k, v in zip(keys, last):
                tail &= pdf[k].isna() if pd.isna(v) else pdf[k] == v  # a NULL key is a group, too
            carry = pdf[tail]
            done = pdf[~tail]
            outs = [fn(g) for _, g in done.groupby(keys, sort=False, dropna=False)] if not done.empty else []
            outs = [o for o in outs if o is not None and len(o)]
            if outs:
                yield pd.concat(outs, ignore_index=True)
        if carry is not None and not carry.empty:
            o = fn(carry)
            if o is not None and len(o):
                yield o

    return d.mapInPandas(run, schema)

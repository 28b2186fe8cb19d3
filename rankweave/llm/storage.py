"""Steps that are written down before the next one starts."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from rankweave.session import cut_lineage


def settle(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder, so that a lost executor replays nothing before it.

    Spark deletes the shuffle files of finished jobs when the driver collects the garbage that stands for them. That may
    be long after; between steps that each shuffle a good part of the corpus it is asked for, so that disk is needed for
    one step at a time.
    """
    # A projection of its own carries the plan that runs; `df`, which the caller still holds, has none to keep alive.
    settled = cut_lineage(df.select("*"))
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return settled

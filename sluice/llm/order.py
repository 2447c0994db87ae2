"""Rows in id order with their successor, without one sorted partition.

Parts of like size are cut at ids that occur in the table (quantiles, found by
one aggregate over the ids).  Every row goes to its part, and the first row of
each part also, as a copy, to the end of the part before it (the first of all
to the last part), so each part knows the successor of its last row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Parts are streamed, so their size is free; their number bounds the list of cuts.
MOST_PARTS = 10_000


def with_copies(df: DataFrame, id_col: str, tie: str) -> DataFrame | None:
    """``df`` plus ``_part`` and ``_copy``, partitioned by part and sorted by
    (part, copies last, id with nulls first, tie).  None for an empty table."""
    spark = df.sparkSession
    parts = min(MOST_PARTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    probs = F.lit([k / parts for k in range(1, parts)])
    head = df.agg(F.min(id_col).alias("low"), F.count(F.lit(1)).alias("n"), F.count(id_col).alias("ids"),
                  F.percentile_approx(id_col, probs, 10 * parts).alias("cuts")).first()
    if not head["n"]:
        return None
    nulls = head["n"] > head["ids"]
    cuts = np.array(sorted({head["low"], *(head["cuts"] or [])} - {None}) or [0], np.int64)
    last = len(cuts) - 1

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, missing: pd.Series) -> pd.Series:
        x, none = ids.to_numpy(np.int64), missing.to_numpy(bool)
        part = np.where(none, 0, np.maximum(np.searchsorted(cuts, x, "right") - 1, 0))
        leads = ~none & (cuts[part] == x)
        first = none if nulls else leads & (part == 0)
        out = []
        for p, lead, one in zip(part.tolist(), leads.tolist(), first.tolist()):
            own = [2 * p]
            if lead and p:
                own.append(2 * (p - 1) + 1)
            if one:
                own.append(2 * last + 1)
            out.append(own)
        return pd.Series(out)

    return (df.withColumn("_place", F.explode(places(F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")), F.col(id_col).isNull())))
            .withColumn("_part", F.shiftright("_place", 1)).withColumn("_copy", F.col("_place").bitwiseAND(1)).drop("_place")
            .repartition("_part").sortWithinPartitions("_part", "_copy", F.col(id_col).asc_nulls_first(), tie))

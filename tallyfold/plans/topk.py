"""First n rows per group without sending a group through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.plans.windows import ROWS_PER_SEGMENT, windowed

SALTS = 64
#: The largest ``n`` whose salted rows of one group still fit a task.
SALTED_MOST = ROWS_PER_SEGMENT // SALTS


def top_per_group(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    n: int,
    rank: str = "rank",
    own: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, numbered from 1 in ``rank``.

    Each group is first cut to ``n`` rows per salt, so the last step sees at most
    ``SALTS * n`` rows of a group; an ``n`` above ``SALTED_MOST`` takes the segmented window
    instead. ``own`` names a column with the limit of the row's group where groups differ;
    it counts where it is below ``n``.
    """

    def among(place: str) -> Column:
        first = F.col(place) <= n
        return first if own is None else first & (F.col(place) <= F.col(own))

    if n > SALTED_MOST:
        return windowed(df, keys, order, sums={rank: F.lit(1)}).where(among(rank))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    per_salt = Window.partitionBy(*keys, "_salt").orderBy(*order)
    per_group = Window.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("_place", F.row_number().over(per_salt))
        .where(among("_place"))
        .withColumn(rank, F.row_number().over(per_group).cast("bigint"))
        .where(among(rank))
        .drop("_salt", "_place")
    )

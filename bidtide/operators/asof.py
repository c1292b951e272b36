"""As-of lookup: each probe row with the version of its key that was current at the probe's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidtide.operators.skew import (
    DEFAULT_POLICY,
    SEGMENT,
    HeavyKeys,
    SkewPolicy,
    find_heavy_keys,
    segmented,
    with_earlier_segments,
)

_FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def latest_versions(
    changelog: DataFrame, key: str, sequence: str | None = None, version_time: str | None = None
) -> DataFrame:
    """One row per key (or per key and version time): the last one written.

    ``max_by`` combines map-side, so a key with many versions costs no more than its partial results. Columns
    of fixed width are picked one by one, which keeps the aggregation hash-based; others travel in a struct.
    """
    if not (sequence or version_time):
        raise ValueError("name the column that orders versions")
    order = sequence or version_time
    group = [key, version_time] if sequence and version_time else [key]
    types = dict(changelog.dtypes)
    rest = [c for c in changelog.columns if c not in group]
    if all(types[c] in _FIXED_WIDTH for c in rest):
        return changelog.groupBy(*group).agg(*[F.max_by(c, order).alias(c) for c in rest]).select(*changelog.columns)
    picked = changelog.groupBy(*group).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*group, "__row.*").select(*changelog.columns)


def asof_join(
    probes: DataFrame,
    versions: DataFrame,
    key: str,
    probe_time: str,
    version_time: str,
    values: Sequence[str],
    *,
    inclusive: bool = True,
    deleted: str | None = None,
    versions_by_key: bool = False,
    heavy: HeavyKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Left as-of join: every probe row, with ``values`` of the latest version at or before its time.

    ``inclusive=False`` looks strictly before the probe. ``versions`` has one row per key and time
    (see ``latest_versions``); a true ``deleted`` column ends the key's validity from that time on. Probes and
    versions meet in one shuffle: both are stacked, ordered by time, and the last version carried forward. With
    ``versions_by_key`` the versions come hash-partitioned by key, as ``profile_changelog`` leaves them when no
    user is heavy; then only the probes move.
    """
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    payload = [c for c in probes.columns if c not in (key, probe_time)]
    version_side = 0 if inclusive else 1

    def stack(df: DataFrame, time: str, side: int, version: Column, row: Column) -> DataFrame:
        return df.select(
            F.col(key), F.col(time).alias("__t"), F.lit(side).alias("__side"), version.alias("__v"), row.alias("__p")
        )

    version = F.struct(gone.alias("gone"), *values)
    left = stack(probes, probe_time, 1 - version_side, F.lit(None), F.struct(F.lit(1).alias("probe"), *payload))
    right = stack(versions.where(F.col(key).isNotNull()), version_time, version_side, version, F.lit(None))
    heavy = find_heavy_keys(left.unionByName(right), key, policy) if heavy is None else heavy
    if versions_by_key and not heavy:
        left = left.repartition(key)
    stacked = left.unionByName(right)
    # Probes at one instant get the same version, so a heavy key may be cut between them.
    order = ["__t", "__side", "__tie"] if heavy else ["__t", "__side"]
    rows = segmented(stacked.withColumn("__tie", F.xxhash64("__p")), heavy, order) if heavy else stacked
    keys = [key, SEGMENT] if heavy else [key]
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("__found", F.last("__v", ignorenulls=True).over(frame))
    if heavy:
        # A segment without versions has a null tail; probes in it still need the ones before.
        tail = F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__t")))
        tails = rows.groupBy(*keys).agg(tail.alias("__tail"))
        found = with_earlier_segments(found, heavy, tails, {"__carried": F.last("__tail", ignorenulls=True)})
        found = found.withColumn("__found", F.coalesce("__found", "__carried"))
    result = found.where(F.col("__p").isNotNull())
    live = ~F.col("__found.gone")
    out = {name: F.when(live, F.col(f"__found.{name}")).alias(name) for name in values}
    own = {key: F.col(key), probe_time: F.col("__t").alias(probe_time)}
    own |= {c: F.col(f"__p.{c}").alias(c) for c in payload}
    return result.select(*[own[c] for c in probes.columns], *out.values())

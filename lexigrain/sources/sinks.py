"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.versions import canonical


def canonical_json(df: DataFrame, key: str = "key") -> DataFrame:
    """One canonical JSON text per row, with its key."""
    return df.select(key, canonical(*df.columns).alias("json"))


def write_canonical_json(df: DataFrame, path: str, key: str = "key") -> None:
    """JSON lines in code-point order of the key: sorted files with ascending ranges."""
    rows = canonical_json(df, key)
    rows.repartitionByRange(key).sortWithinPartitions(key).select("json").write.mode("errorifexists").text(path)


def write_bank(df: DataFrame, path: str, key: str) -> None:
    """A bank as Parquet, range partitioned and sorted by key, over what an interrupted run left there."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def land_dated(df: DataFrame, path: str, day: str = "dt") -> None:
    """Replace exactly the days present in ``df``; the committer makes it all or nothing."""
    (
        df.repartition(day, *[c for c in df.columns if c != day][:1])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    )

"""Joins and row numbers that hold when one key carries a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.session import materialize

_POSITION_BITS = 33
COUNTERS = 8  # of the sketch, for every key that can be hot


def hot_keys(rows: DataFrame, on: list[str]) -> list[tuple[int, int]]:
    """Hashes of keys that hold more rows than half a shuffle partition, and in how many parts to split each.

    Counted by a mergeable heavy-hitter sketch with a bounded number of counters: each task keeps its own, and only
    counters travel, whatever the number of keys.  At most twice as many keys as shuffle partitions can be hot.
    """
    grain = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = f"approx_top_k(_hash, {grain}, {min(COUNTERS * grain, 1_000_000)})"
    hashed = rows.select(F.xxhash64(*on).alias("_hash"))
    found = hashed.agg(F.expr(sketch).alias("top"), F.count("*").alias("n")).first()
    least = max(found["n"] / grain, 1)
    return [(r["item"], -int(-r["count"] // least)) for r in found["top"] or () if r["count"] > least]


def sized_keys(per_key: DataFrame, on: list[str], size: str) -> list[tuple[int, int]]:
    """The same from a table of one row per key that tells how many rows it holds."""
    grain = 2 * int(per_key.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max((per_key.agg(F.sum(size)).first()[0] or 0) / grain, 1)
    found = per_key.filter(F.col(size) > least).select(F.xxhash64(*on).alias("h"), size).collect()
    return [(h, -int(-n // least)) for h, n in found]


def salted_join(
    rows: DataFrame,
    per_key: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "inner",
    size: str | None = None,
) -> DataFrame:
    """Join a large table with a table of one row per key; keys that hold too many rows are split, and only those.

    ``spread`` names columns that differ between rows of one key.  A hot key is split in proportion to its rows, and
    its row of ``per_key`` is repeated for each part; all others stay as they are.  ``rows`` are read once more to
    find hot keys, unless ``size`` names a column of ``per_key`` that has their numbers.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    # Equal keys have equal hashes on both sides only if their types are equal.
    per_key = per_key.withColumns({c: F.col(c).cast(rows.schema[c].dataType) for c in on})
    hot = hot_keys(rows, on) if size is None else sized_keys(per_key, on, size)
    if not hot:
        return rows.join(per_key, on, how)
    # Bounded by the number of shuffle partitions, so it can always be sent.
    parts = F.broadcast(rows.sparkSession.createDataFrame(hot, "_hash long, _parts int"))

    def split(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(*on)).join(parts, "_hash", "left").drop("_hash")

    number = F.coalesce("_parts", F.lit(1))
    salted = split(rows).withColumn("_salt", F.pmod(F.xxhash64(*spread), number).cast("int")).drop("_parts")
    copies = split(per_key).withColumn("_salt", F.explode(F.sequence(F.lit(0), number - 1))).drop("_parts")
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def with_positions(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Dense 0-based row numbers in a total order, without a single-partition window.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus the sizes
    of the partitions before it.  The numbered rows are checkpointed once, since range bounds come from
    a sample and a second run could cut the partitions elsewhere.  The offsets have one row per
    partition, so broadcasting them is bounded by the partition count.
    """
    marked = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
    ).withColumns(
        {
            "_part": F.shiftright("_mark", _POSITION_BITS),
            "_place": F.col("_mark").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    sizes = marked.groupBy("_part").agg((F.max("_place") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    return (
        marked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_base") + F.col("_place"))
        .drop("_mark", "_part", "_place", "_base")
    )

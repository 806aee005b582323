"""Applying a feed of inserts, updates and deletes to a table (problem 2).

Column-wise last writer wins. Every change has a position (sequence, writes before deletes, index).
A replacement or a delete sets every field, a patch only the fields it names, so for each field the
value of the highest position that set it is the value after the latest delete or replacement. All
of it is one max_by per field: Spark combines it on the map side, which is what keeps a record that
owns a third of the feed from landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The producers' names of operations, after trimming and lower-casing.
WRITES = ("i", "insert", "u", "update", "upsert", "c", "create", "r", "replace")
PATCHES = ("p", "patch", "merge")
DELETES = ("d", "delete", "del", "remove")


def operation_kind(operation: Column) -> Column:
    """'write', 'patch' or 'delete'; null for a name that is none of them."""
    name = F.lower(F.trim(operation))
    return F.when(name.isin(*WRITES), "write").when(name.isin(*PATCHES), "patch").when(name.isin(*DELETES), "delete")


def apply_changes(
    state: DataFrame,
    feed: DataFrame,
    *,
    key: str,
    fields: Sequence[str],
    operation: Column,
    sequence: Column,
    index: Column,
    delivered: Column,
    state_sequence: Column,
    state_tombstone: Column,
) -> DataFrame:
    """One row per record of state or feed: key, fields, tombstone, sequence.

    feed and state hold the columns of fields under those names; the other arguments are columns of
    feed or state. A patch names a field by giving it a value that is not null. Of several
    deliveries of one change (same record, sequence, kind of change and index) the one delivered
    last counts, on a tie the one with the greatest fields. A change whose sequence the state
    already contains is not applied. A delete of what is not there leaves a tombstone.

    Rows of the feed with a null key, sequence or index or an unknown operation are not applied
    (see rejected_changes); rows of the state with a null key are left out. Null deliveries count as
    the earliest. A null state_sequence contains nothing, a null state_tombstone is no tombstone. An
    empty feed gives the state, an empty state what the feed builds. Other columns, whatever their
    names, are ignored.
    """
    kind = operation_kind(operation)
    rank = F.when(kind == "delete", 1).otherwise(0)
    packed = F.struct(*[F.col(f).alias(f) for f in fields])
    changes = feed.select(
        F.col(key).alias("k_"), sequence.cast("long").alias("s_"), rank.alias("d_"), index.cast("long").alias("i_"),
        (kind == "patch").alias("p_"), F.coalesce(delivered, F.lit("0001-01-01").cast("timestamp")).alias("t_"), packed.alias("v_"),
    ).where(kind.isNotNull() & F.col("k_").isNotNull() & F.col("s_").isNotNull() & F.col("i_").isNotNull())
    # Delivery order decides inside one position; deliveries of one change share a position.
    deliveries = changes.groupBy("k_", "s_", "d_", "i_").agg(F.max(F.struct("t_", "v_", "p_")).alias("m_"))
    contained = state.where(F.col(key).isNotNull()).select(
        F.col(key).alias("k_"), F.coalesce(state_sequence.cast("long"), F.lit(-(2**62))).alias("s_"),
        F.coalesce(state_tombstone, F.lit(False)).cast("int").alias("d_"), packed.alias("v_"),
    )
    # The state's row is the change at its own sequence's very end: nothing of that sequence or before beats it.
    rows = deliveries.select("k_", "s_", F.lit(0).alias("e_"), "d_", "i_", F.col("m_.v_").alias("v_"), F.col("m_.p_").alias("p_")).unionByName(
        contained.select("k_", "s_", F.lit(1).alias("e_"), "d_", F.lit(0).cast("long").alias("i_"), "v_", F.lit(False).alias("p_"))
    )
    at = F.struct("s_", "e_", "d_", "i_")
    gone = F.col("d_") == 1
    picks = []
    for f in fields:
        value = F.when(gone, F.lit(None)).otherwise(F.col(f"v_.{f}"))
        sets = ~F.col("p_") | gone | F.col(f"v_.{f}").isNotNull()
        picks.append(F.max_by(F.struct(value.alias("v")), F.when(sets, at))["v"].alias(f"f_{f}"))
    merged = rows.groupBy("k_").agg(*picks, F.max_by(F.col("d_"), at).alias("z_"), F.max("s_").alias("y_"))
    return merged.select(
        F.col("k_").alias(key), *[F.col(f"f_{f}").alias(f) for f in fields], (F.col("z_") == 1).alias("tombstone"),
        F.when(F.col("y_") > -(2**62), F.col("y_")).alias("sequence"),
    )


def rejected_changes(feed: DataFrame, *, key: str, operation: Column, sequence: Column, index: Column) -> DataFrame:
    """The rows of the feed that apply_changes cannot place, with the reason."""
    reason = (
        F.when(F.col(key).isNull(), "no record id")
        .when(sequence.isNull() | index.isNull(), "no position")
        .when(operation_kind(operation).isNull(), "unknown operation")
    )
    return feed.withColumn("reason", reason).where(F.col("reason").isNotNull())

"""Queries of problem 2: the paper state after the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.change_feed import apply_changes
from ..session import table

FIELDS = ("content_sha256", "payload_json")


def _papers(spark: SparkSession, folder: str, fields: tuple[str, ...]) -> DataFrame:
    state = table(spark, folder, "paper_state").withColumnRenamed("raw_payload_json", "payload_json")
    order = F.col("replay_order")
    return apply_changes(
        state, table(spark, folder, "lake_records"), key="source_record_id", fields=fields, operation=F.col("operation"), sequence=order["diff_index"],
        index=order["operation_index"], delivered=F.col("ingested_at"), state_sequence=F.col("diff_index"), state_tombstone=F.col("tombstone"),
    )


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _papers(spark, folder, FIELDS[:1]).where(~F.col("tombstone")).select("source_record_id", "content_sha256")


def p2_state(spark: SparkSession, folder: str) -> DataFrame:
    return _papers(spark, folder, FIELDS)


_MERGED = """
with feed as (
  select source_record_id r, replay_order.diff_index s, replay_order.operation_index i, ingested_at t, content_sha256 h, payload_json p,
         case when lower(trim(operation)) in ('d', 'delete', 'del', 'remove') then 1 else 0 end d
  from lake_records
), changes as (
  select * from feed qualify row_number() over (partition by r, s, d, i order by t desc, h desc) = 1
), every as (
  select r, s, 0 e, d, i, h, p from changes
  union all select source_record_id, diff_index, 1, tombstone::int, 0, content_sha256, raw_payload_json from paper_state
), final as (select * from every qualify row_number() over (partition by r order by s desc, e desc, d desc, i desc) = 1)
"""
ORACLES = {
    "p2_found": _MERGED + "select r source_record_id, h content_sha256 from final where d = 0",
    "p2_state": _MERGED
    + """select r source_record_id, case when d = 0 then h end content_sha256, case when d = 0 then p end payload_json,
         d = 1 tombstone, s "sequence" from final""",
}
QUERIES = {"p2_found": p2_found, "p2_state": p2_state}

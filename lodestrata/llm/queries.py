"""Queries of problems 3, 4 and 7 to 10, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import boilerplate, consensus, entity_match, packing, tokenizer, truncation


def _registries(spark: SparkSession, folder: str) -> tuple[tuple[DataFrame, DataFrame], dict]:
    columns = {
        "our_id": "id", "our_name": F.coalesce("canonical_name", "normalized_name"), "our_size": F.col("parameters"), "our_owner": "organization",
        "their_id": "model_id", "their_name": F.coalesce("alias", "normalized_alias"), "their_size": F.col("size_label"), "their_owner": "publisher",
    }
    return (table(spark, folder, "models"), table(spark, folder, "model_aliases")), columns


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_matches(spark, folder).select("model_id", "alias_model_id")


def p3_matches(spark: SparkSession, folder: str) -> DataFrame:
    tables, columns = _registries(spark, folder)
    return entity_match.match(*tables, **columns)


def p3_calibration(spark: SparkSession, folder: str) -> DataFrame:
    tables, columns = _registries(spark, folder)
    return entity_match.calibration(*tables, **columns)


def _ranked(spark: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    models = consensus.credible_instant(table(spark, folder, "models"), "updated_at", "instant_")
    confidence = F.col("confidence")
    ranks = {
        "status": consensus.status_rank(F.col("status")),
        "confidence": F.when((confidence >= 0) & (confidence <= 1) & ~F.isnan(confidence), confidence + F.lit(0.0)),
        "updated_at": F.col("instant_"),
    }
    return models, ranks


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    models, ranks = _ranked(spark, folder)
    return consensus.best_rows(models, "id", "model_row", ranks)


def p4_records(spark: SparkSession, folder: str) -> DataFrame:
    """id, canonical_name, organization, status, confidence, updated_at: the surviving record of every id. Names by consensus, weighted by how usable the row is."""
    models, ranks = _ranked(spark, folder)
    weight = F.lit(1.0) + sum(F.when(c.isNotNull(), 0.25).otherwise(0.0) for c in ranks.values())
    weighed = models.withColumns({f"rank_{f}": c for f, c in ranks.items()} | {"weight_": weight})
    best = weighed.where("id is not null").groupBy("id").agg(
        *[F.max_by(f, F.when(F.col(f"rank_{f}").isNotNull(), F.struct(f"rank_{f}", -F.col("model_row")))).alias(f) for f in ranks]
    )
    out = best
    for field in ("canonical_name", "organization"):
        out = out.join(consensus.consensus_values(weighed, "id", field, F.col("weight_")), "id", "left")
    return out.select("id", "canonical_name", "organization", "status", "confidence", "updated_at")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.outside_lines(table(spark, folder, "documents"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizer.encode(table(spark, folder, "documents"))


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(tokenizer.count_tokens(table(spark, folder, "documents")), table(spark, folder, "container_sizes"))


def p9_items(spark: SparkSession, folder: str) -> DataFrame:
    return _packed(spark, folder)


def p9_fill(spark: SparkSession, folder: str) -> DataFrame:
    """container, bins, tokens, fill: how full each kind of container is."""
    used = _packed(spark, folder).where("bin is not null").groupBy("container", "capacity", "bin").agg(F.sum("length").alias("used"))
    return used.groupBy("container", "capacity").agg(F.count("*").alias("bins"), F.sum("used").alias("tokens")).withColumn("fill", F.round(F.col("tokens") / F.col("bins") / F.col("capacity"), 4))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncated(table(spark, folder, "documents")).select("doc_id")


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return truncation.truncation_rates(documents, truncation.truncated(documents))


_P4 = """
with m as (
  select *, list_position(['stub', 'candidate', 'documented', 'released'], lower(trim(status))) s,
         case when confidence between 0 and 1 and not isnan(confidence) then confidence end c,
         case when updated_at::timestamptz between '1990-01-01'::timestamptz and '2049-12-31'::timestamptz then updated_at::timestamptz end u
  from models where id is not null
), twice as (select id from m group by id having count(*) >= 2)
select id, 'status' field, arg_min(model_row, (-s, model_row)) model_row from m semi join twice using (id) where s is not null and s > 0 group by id
union all select id, 'confidence', arg_min(model_row, (-c, model_row)) from m semi join twice using (id) where c is not null group by id
union all select id, 'updated_at', arg_min(model_row, (-epoch_us(u), model_row)) from m semi join twice using (id) where u is not null group by id
"""

QUERIES = {"p3_found": p3_found, "p3_matches": p3_matches, "p3_calibration": p3_calibration, "p4_found": p4_found, "p4_records": p4_records, "p7_found": p7_found, "p8_ids": p8_ids, "p9_items": p9_items, "p9_fill": p9_fill, "p10_found": p10_found, "p10_rates": p10_rates}
ORACLES = {"p4_found": _P4}

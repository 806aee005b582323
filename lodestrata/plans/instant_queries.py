"""Queries of problem 5: instants and dates of four tables in one form."""

from __future__ import annotations

import zoneinfo
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import instants
from ..session import table

#: table, key, value, and the column of a later event of the row, if it has one
INSTANTS = (("source_huggingface_page1", "hub_row", "created_at", "last_modified"), ("documents", "doc_id", "crawled_at", None))
DATES = (("source_openalex_page1", "work_row", "publication_date"), ("source_epoch", "epoch_row", "publication_date"))


def _rows(spark: SparkSession, folder: str, tables: tuple) -> DataFrame:
    """tab, row_key, value, source of all tables, and seen, a later time of the row."""
    text = F.lit(None).cast("string")
    each = [
        table(spark, folder, t).select(F.lit(t).alias("tab"), F.col(k).alias("row_key"), F.col(c).alias("value"), "source", (F.col(more[0]) if more and more[0] else text).alias("seen"))
        for t, k, c, *more in tables
    ]
    return reduce(DataFrame.unionByName, each)


def _settings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_settings").select(F.col("source"), F.col("zone_name"), F.col("date_order"))


MOST_ZONES = 1000  #: more than the world has; more is an error


def _zones(settings: DataFrame) -> list[str]:
    """The zones in use; those of the world if none is named."""
    names = [r[0] for r in settings.select("zone_name").where("zone_name is not null").distinct().limit(MOST_ZONES + 1).collect()]
    if len(names) > MOST_ZONES:
        raise ValueError(f"more than {MOST_ZONES} zones")
    return sorted(names) or sorted(zoneinfo.available_timezones())


def p5_zones(spark: SparkSession, folder: str) -> DataFrame:
    """source, zone: the zone of each source as estimated from its rows, without its setting."""
    settings = _settings(spark, folder)
    timed = _rows(spark, folder, INSTANTS)
    return _estimated(timed, timed.select("source").where("source is not null").distinct(), _zones(settings))


def _estimated(rows: DataFrame, sources: DataFrame, zones: list[str]) -> DataFrame:
    """Zones of sources by three kinds of bounds: the instant that a value states beside its local time, a later event of the row, and its neighbours in sequence."""
    p = F.col("p")
    # The bare times of every source are neighbours; a known instant is one that says its offset, or UTC.
    read = rows.select("tab", "row_key", "source", "seen", instants.read_parts(F.col("value"), F.lit("")).alias("p"))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=p["epoch"].cast("decimal(20,0)").cast("decimal(26,6)") / F.lit(1_000_000))
    stated = F.coalesce(epoch, F.when(p["h"].isNotNull(), instants.wall_to_instant(instants.wall(p), instants.stated_offset(p), F.lit(None).cast("string"))))
    timed = read.select(
        "tab", "row_key", "source", F.when(p["h"].isNotNull() & p["epoch"].isNull(), instants.wall(p)).alias("wall"), stated.alias("stated"), "seen",
        (p["zone"].rlike("^[A-Z]") & ~p["zone"].isin("Z", "UTC", "GMT") | (p["region"] != "") & (p["region"] != "UTC")).alias("named"), (F.coalesce(p["zone"], F.lit("")) == "").alias("bare"),
    )
    later = instants.normal_instants(timed.where("bare and seen is not null"), F.col("seen"), F.lit("UTC"), F.lit("")).withColumn("upper", F.to_timestamp_ntz("normal"))
    none = F.lit(None).cast("timestamp_ntz")
    bounds = instants.sequence_bounds(timed, ["tab"], "row_key", F.col("stated")).where("bare")
    known = (
        timed.where("named").select("source", "wall", F.col("stated").alias("lower"), F.col("stated").alias("upper"), F.lit(True).alias("sure"))
        .unionByName(later.select("source", "wall", none.alias("lower"), "upper", F.lit(True).alias("sure")))
        .unionByName(bounds.select("source", "wall", "lower", "upper", F.lit(False).alias("sure")))
    )
    wanted = known.join(F.broadcast(sources), "source", "left_semi") if sources.limit(MOST_ZONES + 1).count() <= MOST_ZONES else known.join(sources, "source", "left_semi")
    return instants.estimate_zones(wanted, F.col("source"), F.col("wall"), F.col("lower"), F.col("upper"), zones, F.col("sure"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The stated zone of a source counts; a source without one takes the estimate, or UTC where nothing tells."""
    settings = _settings(spark, folder)
    timed = _rows(spark, folder, INSTANTS)
    zoned = timed.join(settings, "source", "left").withColumn("guess_", F.lit(None).cast("string"))
    unset = timed.select("source").where("source is not null").distinct().join(settings.where("zone_name is not null"), "source", "left_anti")
    if unset.limit(1).count():  # with every zone set there is nothing to estimate
        guessed = _estimated(timed, unset, _zones(settings)).select("source", F.col("zone").alias("guess_"))
        zoned = timed.join(settings, "source", "left").join(guessed, "source", "left")
    exact = instants.normal_instants(zoned, F.col("value"), F.coalesce("zone_name", "guess_"), F.col("date_order"))
    dated = _rows(spark, folder, DATES).join(settings, "source", "left")
    days = instants.normal_dates(dated, F.col("value"), F.col("date_order"))
    both = exact.select("tab", "row_key", "normal").unionByName(days.select("tab", "row_key", "normal"))
    return both.where(F.col("normal").isNotNull())


QUERIES = {"p5_found": p5_found, "p5_zones": p5_zones}
ORACLES: dict[str, str] = {}

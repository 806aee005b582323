import pytest
from pyspark.sql import functions as F

from lodestrata.operators import instants

INSTANTS = [
    ("2023-11-14T01:14:52.473Z", "UTC", "dmy", "2023-11-14T01:14:52.473000Z"), ("2024-04-05 10:01:37 EDT", "UTC", "dmy", "2024-04-05T14:01:37.000000Z"),
    ("8/25/2023 7:24 am", "UTC", "mdy", "2023-08-25T07:24:00.000000Z"), ("25/8/2023 12:24 pm", "UTC", "dmy", "2023-08-25T12:24:00.000000Z"), ("20220227054528", "Australia/Sydney", "dmy", "2022-02-26T18:45:28.000000Z"),
    ("1776722258", "Asia/Tokyo", "dmy", "2026-04-20T21:57:38.000000Z"), ("1687590324527", None, None, "2023-06-24T07:05:24.527000Z"), ("1684521231008966", None, None, "2023-05-19T18:33:51.008966Z"),
    ("2021-08-19T03:15:34+10", "UTC", "dmy", "2021-08-18T17:15:34.000000Z"), ("2021-11-06T10:42:52-0330", "UTC", "dmy", "2021-11-06T14:12:52.000000Z"), ("Sat, 6 Nov 2021 10:42:52 -0330", "UTC", "dmy", "2021-11-06T14:12:52.000000Z"),
    ("2022-11-11T01:37:37+01:00[Europe/Berlin]", "UTC", "dmy", "2022-11-11T00:37:37.000000Z"), ("Jul 14, 2021 8:32:13 PM", "America/New_York", "mdy", "2021-07-15T00:32:13.000000Z"),
    ("2024-03-31 02:30:00", "Europe/Berlin", "dmy", "2024-03-31T01:30:00.000000Z"),  # skipped: offset before the change
    ("2024-10-27 02:30:00", "Europe/Berlin", "dmy", "2024-10-27T00:30:00.000000Z"),  # twice: the earlier
    ("2024-10-27 02:30:00 CET", "Europe/Berlin", "dmy", "2024-10-27T01:30:00.000000Z"), ("２０２４-01-02T03:04:05Z", "UTC", "dmy", "2024-01-02T03:04:05.000000Z"),
    ("2021-09-09T17:14:41.623611012Z", "UTC", "dmy", "2021-09-09T17:14:41.623611Z"), ("2024-13-45 10:00", "UTC", "dmy", None), ("2023-02-30T12:00:00Z", "UTC", "dmy", None), ("0000-00-00T00:00:00Z", "UTC", "dmy", None),
    ("unknown", "UTC", "dmy", None), ("", "UTC", "dmy", None), (None, "UTC", "dmy", None), ("9" * 50_000, "UTC", "dmy", None), ("2024-01-01 10:00:00", "No/Zone", "dmy", "2024-01-01T10:00:00.000000Z"),
    ("2024-01-01 10:00:00 XYZT", "UTC", "dmy", None), ("1/2/2024 13:00 pm", "UTC", "dmy", None),
]
DATES = [
    ("2025-04-09", "dmy", "2025-04-09"), ("09/16/2020", "mdy", "2020-09-16"), ("30/11/18", "dmy", "2018-11-30"), ("2013-09", "dmy", "2013-09"), ("2015", "dmy", "2015"), ("01.04.2024", "mdy", "2024-04-01"), ("May 2021", "dmy", "2021-05"),
    ("May 28, 2013", "dmy", "2013-05-28"), ("20121210", "dmy", "2012-12-10"), ("2023-W05-7", "dmy", "2023-02-05"), ("2025-319", "dmy", "2025-11-15"), ("44494", "dmy", "2021-10-25"), ("14 de octubre de 2023", "dmy", "2023-10-14"),
    ("20. Mai 2014", "dmy", "2014-05-20"), ("2017-1-5", "dmy", "2017-01-05"), ("2023-03-17T23:30:00-05:00", "dmy", "2023-03-17"), ("Oct-17-2013", "dmy", "2013-10-17"), ("9. Dezember 2021", "dmy", "2021-12-09"),
    ("1er août 2020", "dmy", "2020-08-01"), ("2023-366", "dmy", None), ("2024-366", "dmy", "2024-12-31"), ("2021-W53-1", "dmy", None), ("31/31/2023", "dmy", None), ("2024-02-30", "dmy", None), ("2024-13", "dmy", None),
    ("in press", "dmy", None), (None, None, None), ("", "dmy", None),
]


def test_instants(spark):
    df = spark.createDataFrame([(i, *x[:3]) for i, x in enumerate(INSTANTS)], "n int, v string, z string, o string")
    out = {r["n"]: r["normal"] for r in instants.normal_instants(df, F.col("v"), F.col("z"), F.col("o")).collect()}
    assert [(x[0] and x[0][:60], out[i]) for i, x in enumerate(INSTANTS)] == [(x[0] and x[0][:60], x[3]) for x in INSTANTS]


def test_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_instants(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates(spark):
    df = spark.createDataFrame([(i, *x[:2]) for i, x in enumerate(DATES)], "n int, v string, o string")
    out = {r["n"]: r["normal"] for r in instants.normal_dates(df, F.col("v"), F.col("o")).collect()}
    assert [(x[0], out[i]) for i, x in enumerate(DATES)] == [(x[0], x[2]) for x in DATES]


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Asia/Kolkata"])
def test_estimated_zone(spark, zone):
    zones = ["Europe/Berlin", "Europe/London", "America/New_York", "Asia/Kolkata", "UTC"]
    days = spark.range(0, 300, 7).select(F.expr("timestamp_ntz'2024-01-01 12:00:00' + make_interval(0,0,0,cast(id as int))").alias("wall"), F.lit(zone).alias("zone"))
    rows = days.select(F.lit("s").alias("source"), "wall", (F.convert_timezone("zone", F.lit("UTC"), F.col("wall")) + F.expr("interval 20 second")).alias("seen"))
    rows = rows.unionByName(rows.limit(1).select(F.lit(None).cast("string").alias("source"), "wall", "seen"))
    rows = rows.withColumn("before", F.col("seen") - F.expr("interval 1 minute"))
    out = instants.estimate_zones(rows, F.col("source"), F.col("wall"), F.col("before"), F.col("seen"), zones).collect()
    assert [(r["source"], r["zone"]) for r in out] == [("s", zone)]


def test_sequence_bounds(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, rng.choice([None, f"2024-01-01 00:{i % 60:02d}:00"])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, n long, t string").withColumn("t", F.to_timestamp_ntz("t"))
    for block in (7, 1000):
        got = {r["n"]: (r["lower"], r["upper"]) for r in instants.sequence_bounds(df, ["g"], "n", F.col("t"), block).collect()}
        known = {r["n"]: r["t"] for r in df.collect()}
        for g, n, _ in rows:
            own = [m for h, m, _ in rows if h == g and known[m] is not None]
            before, after = [m for m in own if m < n], [m for m in own if m > n]
            assert got[n] == (known[max(before)] if before else None, known[min(after)] if after else None)
    assert instants.sequence_bounds(df.limit(0), ["g"], "n", F.col("t")).count() == 0


def test_sequence_without_order_speaks_for_utc(spark):
    wall = F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_interval(0,0,0,0,cast(pmod(xxhash64(id), 9000) as int))")
    other = F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_interval(0,0,0,0,cast(pmod(xxhash64(id, 1), 9000) as int))")
    df = spark.range(4000).select(F.lit("s").alias("source"), wall.alias("wall"), other.alias("lower"))
    out = instants.estimate_zones(df, F.col("source"), F.col("wall"), F.col("lower"), F.lit(None).cast("timestamp_ntz"), ["Asia/Tokyo", "UTC", "Europe/Berlin"], F.lit(False)).collect()
    assert [tuple(r) for r in out] == [("s", "UTC")]


@pytest.mark.parametrize("hidden", ["Europe/Berlin", "America/New_York"])
def test_found_uses_the_estimate_for_hidden_zones(spark, tmp_path, hidden):
    """A source without a setting, whose bare local times lie between rows of other sources that state their instant, over a change of offset."""
    from lodestrata.plans.instant_queries import p5_found

    at = F.expr("timestamp_ntz'2024-02-01 00:00:00' + make_interval(0,0,0,0,0,cast(id * 37 as int))")
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), at.alias("at"), (F.col("id") % 3 == 0).alias("bare"))
    local = F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(hidden), F.col("at")), "yyyy-MM-dd HH:mm:ss")
    stated = F.concat(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    docs = rows.select("doc_id", F.when(F.col("bare"), local).otherwise(stated).alias("crawled_at"), F.when(F.col("bare"), "unset").otherwise("other").alias("source"), "at", "bare")
    docs.select("doc_id", "crawled_at", "source").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("other", "Asia/Kolkata", "dmy"), ("x", "Europe/Berlin", "dmy"), ("y", "America/New_York", "dmy"), ("z", "UTC", "dmy")], "source string, zone_name string, date_order string").write.parquet(f"{tmp_path}/source_settings.parquet")
    spark.createDataFrame([], "hub_row long, created_at string, last_modified string, source string").write.parquet(f"{tmp_path}/source_huggingface_page1.parquet")
    for name, key in (("source_openalex_page1", "work_row"), ("source_epoch", "epoch_row")):
        spark.createDataFrame([], f"{key} long, publication_date string, source string").write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["row_key"]: r["normal"] for r in p5_found(spark, str(tmp_path)).collect()}
    expected = {r["doc_id"]: r["n"] for r in docs.where("bare").select("doc_id", F.concat(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000000Z")).alias("n")).collect()}
    assert len(got) == 3000 and sum(got[k] == v for k, v in expected.items()) >= 0.99 * len(expected)

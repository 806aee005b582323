"""Timestamps of mixed formats and zones in one form (problem 5).

A value is matched against a few layouts and rewritten to one line of parts, so that each row costs
one replacement and one split, all inside the JVM. Wall-clock times become instants through the
offset history of a zone: stated in the value, else the source's, else estimated by estimate_zones.
"""

from __future__ import annotations

import zoneinfo
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Month names in English, German, French and Spanish, January first.
MONTHS = (
    "jan january januar jänner janvier janv enero ene",
    "feb february februar février fevrier févr fev febrero",
    "mar march märz maerz mär mrz mars marzo",
    "apr april avril avr abril abr",
    "may mai mayo",
    "jun june juni juin junio",
    "jul july juli juillet juil julio",
    "aug august août aout agosto ago",
    "sep sept september septembre septiembre setiembre",
    "oct october oktober okt octobre octubre",
    "nov november novembre noviembre",
    "dec december dezember dez décembre decembre déc diciembre dic",
)
# Minutes east of Greenwich of zone abbreviations.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120, "EET": 120, "EEST": 180, "MSK": 180, "IST": 330,
    "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660, "ACST": 570, "AWST": 480, "NZST": 720, "NZDT": 780, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

# Full-width forms of ! to ~, the digits of Arabic and Persian, and dashes.
_WIDE = "".join(chr(c) for c in (*range(0xFF01, 0xFF5F), *range(0x660, 0x66A), *range(0x6F0, 0x6FA), *range(0x2010, 0x2016), 0x2212))
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F)) + "0123456789" * 2 + "-" * 7

_ZONE = r"(Z|z|[+-]\d{2}:?\d{2}|[+-]\d{2}|(?![AaPp]\.?[Mm]\b)[A-Za-z]{2,5})?(?:\[([^\]]+)\])?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*(?:([AaPp])\.?[Mm]\.?)?\s*" + _ZONE
_TIME = rf"(?:[T ,]+{_CLOCK})?"


def _tail(first: int) -> str:
    return "".join(f"|${n}" for n in range(first, first + 7))


_ISO = rf"^(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}}){_TIME}$"
_COMPACT = rf"^(\d{{4}})(\d{{2}})(\d{{2}})[T ]?(\d{{2}})(\d{{2}})(\d{{2}})(?:[.,](\d+))?{_ZONE}$"
_SLASHED = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}}){_TIME}$"
_DOTTED = rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}|\d{{2}}){_TIME}$"
_MONTH_FIRST = rf"^(?:\p{{L}}+\.?, )?(\p{{L}}+)\.?[ -](\d{{1,2}})(?:st|nd|rd|th)?(?:, ?|[ -])(\d{{4}}){_TIME}$"
_DAY_FIRST = rf"^(?:\p{{L}}+\.?,? )?(\d{{1,2}})(?:\.|er|st|nd|rd|th)?[ -](?:de |of )?(\p{{L}}+)\.?,?(?: de)?[ -](\d{{4}}){_TIME}$"
_PART_DATES = (
    (r"^(\d{4})(\d{2})(\d{2})$", "$1|$2|$3"),
    (r"^(\d{4})[-/](\d{1,2})$", "$1|$2|"),
    (r"^(\d{1,2})/(\d{4})$", "$2|$1|"),
    (r"^(\p{L}+)\.?,? (?:de )?(\d{4})$", "$2|$1|"),
    (r"^(\d{4})$", "$1||"),
)


def _months() -> Column:
    names = {name: number for number, row in enumerate(MONTHS, 1) for name in row.split()}
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def _int(c: Column) -> Column:
    return F.when(c != "", c.try_cast("int"))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: without it, Catalyst writes out value wherever body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def read_parts(value: Column, date_order: Column) -> Column:
    """A struct of y, mo, d, h, mi, s, f (microseconds), zone, region, epoch (micros), text and the like.

    All but text are null where no layout fits. date_order is 'mdy' where slashed dates put the month
    first, else the day comes first.
    """
    text = F.trim(F.regexp_replace(F.translate(value, _WIDE, _PLAIN), r"[\s\u00a0\u2007\u202f\u3000]+", " "))
    mdy = F.coalesce(F.lower(date_order), F.lit("")) == "mdy"
    return _bind(F.struct(text.alias("t"), mdy.alias("mdy")), lambda x: _bind(F.struct(x["t"].alias("t"), F.split(_line(x["t"], x["mdy"]), r"\|", -1).alias("l")), lambda y: _parts(y["t"], y["l"])))


def _line(t: Column, mdy: Column) -> Column:
    """year|month|day|hour|minute|second|fraction|a or p|zone|region of the layout that fits."""
    slashed = F.when(mdy, F.regexp_replace(t, _SLASHED, "$3|$1|$2" + _tail(4))).otherwise(F.regexp_replace(t, _SLASHED, "$3|$2|$1" + _tail(4)))
    line = (
        F.when(t.rlike(_ISO), F.regexp_replace(t, _ISO, "$1|$2|$3" + _tail(4)))
        .when(t.rlike(_COMPACT), F.regexp_replace(t, _COMPACT, "$1|$2|$3|$4|$5|$6|$7||$8|$9"))
        .when(t.rlike(_SLASHED), slashed)
        .when(t.rlike(_DOTTED), F.regexp_replace(t, _DOTTED, "$3|$2|$1" + _tail(4)))
        .when(t.rlike(_MONTH_FIRST), F.regexp_replace(t, _MONTH_FIRST, "$3|$1|$2" + _tail(4)))
        .when(t.rlike(_DAY_FIRST), F.regexp_replace(t, _DAY_FIRST, "$3|$2|$1" + _tail(4)))
    )
    for layout, order in _PART_DATES:
        line = line.when(t.rlike(layout), F.regexp_replace(t, layout, order + "|||||||"))
    return line


def _parts(t: Column, line: Column) -> Column:
    part = [F.get(line, i) for i in range(10)]
    month = F.when(part[1].rlike(r"^\d+$"), part[1].try_cast("int")).when(part[1] != "", F.try_element_at(_months(), F.lower(part[1])))
    year = F.when(F.length(part[0]) == 2, part[0].try_cast("int") + 2000).otherwise(_int(part[0]))
    half = F.lower(part[7])
    hour = _int(part[3])
    hour = F.when(half.isin("a", "p"), F.when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0)).otherwise(99)).otherwise(hour)
    number = t.try_cast("long")
    epoch = (
        F.when(t.rlike(r"^\d{9,10}$"), number * 1_000_000)
        .when(t.rlike(r"^\d{12,13}$"), number * 1000)
        .when(t.rlike(r"^\d{15,16}$"), number)
        .when(t.rlike(r"^\d{18,19}$"), F.floor(number / 1000))
    )
    return F.struct(
        year.alias("y"), month.alias("mo"), _int(part[2]).alias("d"), hour.alias("h"), _int(part[4]).alias("mi"),
        F.coalesce(_int(part[5]), F.lit(0)).alias("s"), F.coalesce(_int(F.substring(F.rpad(part[6], 6, "0"), 1, 6)), F.lit(0)).alias("f"),
        F.upper(part[8]).alias("zone"), part[9].alias("region"), epoch.alias("epoch"), t.alias("text"), (part[1] != "").alias("has_month"), (part[2] != "").alias("has_day"),
    )


def wall(p: Column) -> Column:
    seconds = p["s"].cast("decimal(16,6)") + p["f"].cast("decimal(16,6)") / 1_000_000
    made = F.try_make_timestamp_ntz(p["y"], p["mo"], p["d"], F.coalesce(p["h"], F.lit(0)), F.coalesce(p["mi"], F.lit(0)), seconds.cast("decimal(16,6)"))
    return F.when((p["s"] < 60) & (p["y"] > 0), made)


def stated_offset(p: Column) -> Column:
    """Minutes east of Greenwich that the value itself states; null without or beyond 18 hours."""
    zone = p["zone"]
    number = F.regexp_replace(zone, r"[+:-]", "")
    minutes = F.rpad(number, 4, "0").substr(1, 2).try_cast("int") * 60 + F.rpad(number, 4, "0").substr(3, 2).try_cast("int")
    table = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    signed = F.when(zone.rlike(r"^[+-]\d{2,4}") | zone.rlike(r"^[+-]\d{2}:"), F.when(zone.startswith("-"), -minutes).otherwise(minutes))
    return F.coalesce(F.when(F.abs(signed) <= 1080, signed), F.try_element_at(table, F.when(zone != "", zone)))


def _known(zone: Column) -> Column:
    return F.when(zone.isin(*sorted(zoneinfo.available_timezones())), zone)


def wall_to_instant(wall: Column, offset: Column, zone: Column) -> Column:
    """UTC wall time of a local one. A skipped local time takes the offset before the change, a doubled one is the earlier."""
    fixed = wall - F.make_dt_interval(F.lit(0), F.lit(0), offset, F.lit(0).cast("decimal(18,6)"))
    return F.when(offset.isNotNull(), fixed).when(zone.isNotNull(), F.convert_timezone(zone, F.lit("UTC"), wall))


def _written(moment: Column) -> Column:
    text = moment.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"), F.lit("Z"))


def normal_instants(df: DataFrame, value: Column, zone: Column, date_order: Column) -> DataFrame:
    """df with normal: UTC as YYYY-MM-DDTHH:MM:SS.ffffffZ, null for values that name no possible time.

    Offset or region of the value first, then zone, then UTC. A date without a time is its local
    midnight. Null, empty and overlong values give null. df's other columns stay; a column named
    normal is replaced, so callers select what they need first.
    """

    def moment(p: Column, zone: Column) -> Column:
        where = F.struct(wall(p).alias("wall"), stated_offset(p).alias("offset"), F.coalesce(_known(p["region"]), _known(zone), F.lit("UTC")).alias("zone"))
        at = _bind(where, lambda w: wall_to_instant(w["wall"], w["offset"], w["zone"]))
        # A zone that is written but not understood makes the value unreadable rather than wrong.
        understood = (F.coalesce(p["zone"], F.lit("")) == "") | stated_offset(p).isNotNull()
        epoch = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=p["epoch"].cast("decimal(20,0)").cast("decimal(26,6)") / F.lit(1_000_000))
        return F.when(p["epoch"].isNotNull(), epoch).when(understood & p["has_day"], at)

    both = F.struct(read_parts(value, date_order).alias("p"), zone.alias("z"))
    return df.withColumn("normal", _bind(_bind(both, lambda x: moment(x["p"], x["z"])), _written))


def normal_dates(df: DataFrame, value: Column, date_order: Column) -> DataFrame:
    """df with normal: the date as written, as YYYY-MM-DD, YYYY-MM or YYYY by its own precision.

    ISO weeks and days of the year are converted, five digits are a sheet's day count. Null for
    values that name no possible date.
    """
    return df.withColumn("normal", _bind(read_parts(value, date_order), _date))


def _date(p: Column) -> Column:
    text = p["text"]
    year = F.substring(text, 1, 4).try_cast("int")
    week_text, day_text = r"^(\d{4})-?W(\d{2})-?(\d)$", r"^\d{4}-\d{3}$"
    week, weekday = F.regexp_extract(text, week_text, 2).try_cast("int"), F.regexp_extract(text, week_text, 3).try_cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    by_week = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7 + weekday - 1)
    last = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))  # a year's last week holds 28 December
    by_day = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), F.substring(text, 6, 3).try_cast("int") - 1)
    return (
        F.when(text.rlike(week_text), F.when((year > 0) & week.between(1, last) & weekday.between(1, 7), by_week.cast("string")))
        .when(text.rlike(day_text), F.when((year > 0) & (F.year(by_day) == year) & (F.substring(text, 6, 3) != "000"), by_day.cast("string")))
        .when(text.rlike(r"^[1-9]\d{4}$"), F.date_add(F.lit("1899-12-30").cast("date"), text.try_cast("int")).cast("string"))
        .when(p["has_day"], F.to_date(wall(p)).cast("string"))
        .when(p["has_month"], F.when(p["mo"].between(1, 12) & (p["y"] > 0), F.format_string("%04d-%02d", p["y"], p["mo"])))
        .when(p["y"].between(1000, 2999), p["y"].cast("string"))
    )


def sequence_bounds(df: DataFrame, group: list[str], order: str, known: Column, block: int = 100_000) -> DataFrame:
    """df with lower and upper: the known instants nearest before and behind each row in the sequence order (a number) of its group; null without one.

    Sequences are cut into blocks of order, and what a block does not hold comes from a table with a row per
    block, so no group is sorted in one task. Rows of equal order are neighbours in either way.
    """
    at = df.withColumns({"block_": F.floor(F.col(order) / block), "known_": known})
    within = W.partitionBy(*group, "block_")
    reach = (W.unboundedPreceding, -1)
    near = at.withColumn("lower", F.last("known_", True).over(within.orderBy(order).rowsBetween(*reach))).withColumn("upper", F.last("known_", True).over(within.orderBy(F.desc(order)).rowsBetween(*reach)))
    ends = at.groupBy(*group, "block_").agg(F.max_by("known_", F.when(F.col("known_").isNotNull(), F.col(order))).alias("last_"), F.min_by("known_", F.when(F.col("known_").isNotNull(), F.col(order))).alias("first_"))
    across = W.partitionBy(*group)
    carried = ends.select(
        *group, "block_", F.last("last_", True).over(across.orderBy("block_").rowsBetween(*reach)).alias("before_"), F.last("first_", True).over(across.orderBy(F.desc("block_")).rowsBetween(*reach)).alias("after_")
    )
    joined = near.join(carried, [*group, "block_"], "left")
    return joined.withColumns({"lower": F.coalesce("lower", "before_"), "upper": F.coalesce("upper", "after_")}).drop("block_", "known_", "before_", "after_")


def estimate_zones(df: DataFrame, source: Column, wall: Column, lower: Column, upper: Column, candidates: list[str], trusted: Column | None = None) -> DataFrame:
    """source, zone: of the candidate zones the one whose offset history violates least what is known of the rows' instants.

    wall is a local timestamp_ntz; lower and upper are UTC timestamp_ntz between which its instant must lie,
    null where nothing is known: an instant stated beside it (both are that), the time of ingestion (upper, and
    lower by the longest delay), or neighbours in sequence order (sequence_bounds). Violations of trusted
    bounds count before those of others; where the others' counts differ by no more than chance, UTC is
    taken; ties go to the history that stays least far from them, then to the first candidate by name. Rows without a wall time or a bound say nothing; a source of such rows alone
    is left out.

    A row says which offsets are possible: from wall - upper to wall - lower, in steps of five minutes. Rows
    are counted by source, hour and these before candidates are tried, and candidates of the same offsets
    are tried once, so a hot source is no hot task.
    """
    least = F.ceil(F.timestamp_diff("SECOND", upper, wall) / 300) * 5
    most = F.floor(F.timestamp_diff("SECOND", lower, wall) / 300) * 5
    day = 24 * 60
    rows = df.select(
        source.alias("source"), F.date_trunc("HOUR", wall.cast("timestamp_ntz")).cast("timestamp_ntz").alias("hour_"), F.greatest(F.lit(-day), F.least(F.lit(day), least)).alias("least_"),
        F.greatest(F.lit(-day), F.least(F.lit(day), most)).alias("most_"), (F.lit(True) if trusted is None else F.coalesce(trusted, F.lit(False))).alias("trusted_"),
    )
    counted = rows.where("source is not null and hour_ is not null and (least_ is not null or most_ is not null)").groupBy("source", "hour_", "least_", "most_", "trusted_").agg(F.count("*").alias("n_"))
    tried = counted.withColumn("zone", F.explode(F.array(*[F.lit(z) for z in sorted(candidates)])))
    offset = F.timestamp_diff("MINUTE", F.convert_timezone(F.col("zone"), F.lit("UTC"), F.col("hour_")), F.col("hour_"))
    beyond = F.greatest(F.coalesce(F.col("least_") - F.col("offset_"), F.lit(0)), F.coalesce(F.col("offset_") - F.col("most_"), F.lit(0)), F.lit(0))
    scored = tried.withColumn("offset_", offset).withColumn("beyond_", beyond)
    wrong = F.when(F.col("beyond_") > 0, F.col("n_")).otherwise(0)
    per = scored.groupBy("source", "zone").agg(
        F.sum(F.when(F.col("trusted_"), wrong).otherwise(0)).alias("wrong_"), F.sum(F.when(F.col("trusted_"), F.lit(0)).otherwise(wrong)).alias("loose_"), F.sum(F.col("beyond_") * F.col("n_")).alias("far_")
    )
    least_wrong = per.groupBy("source").agg(F.min(F.struct("wrong_", "loose_")).alias("best_"))
    # Sequences that are out of order violate every history alike: what chance explains (three deviations) does not speak against UTC.
    level = F.col("loose_") <= F.col("best_.loose_") + 3 * F.sqrt(F.col("best_.loose_"))
    tied = per.join(least_wrong, "source").where((F.col("wrong_") == F.col("best_.wrong_")) & level)
    return tied.groupBy("source").agg(F.min_by("zone", F.struct(F.col("zone") != "UTC", "loose_", "far_", "zone")).alias("zone"))

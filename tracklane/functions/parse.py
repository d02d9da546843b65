"""Typed parsing of cells: null where a cell does not parse, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.functions.text import strip

_INT, _FLOAT = r"^[+-]?[0-9]+(_[0-9]+)*$", r"^(?i)[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?$"
_NOT_FINITE = r"^(?i)[+-]?(nan|inf(inity)?)$"


def to_int(c: Column) -> Column:
    """Whole numbers with an optional sign; "2020.0" is null."""
    s = strip(c)
    return F.when(s.rlike(_INT), F.replace(s, F.lit("_"), F.lit("")).try_cast("int"))


def to_double(c: Column) -> Column:
    """Decimal and exponent forms, nan and inf."""
    s = strip(c)
    return F.when(s.rlike(_FLOAT), F.replace(s, F.lit("_"), F.lit("")).try_cast("double")).when(
        s.rlike(_NOT_FINITE), F.regexp_replace(F.lower(s), "^([+-]?)inf$", "$1infinity").try_cast("double")
    )


def to_int_via_double(c: Column) -> Column:
    """As to_int, but "2020.0" is 2020; fractions are cut off."""
    x = to_double(c)
    return F.when(~F.isnan(x) & (F.abs(x) < 2147483648.0), x.cast("int"))


def to_count(c: Column) -> Column:
    return F.coalesce(to_int(c), F.lit(0))


def _part(c: Column, k: int) -> Column:
    """The k-th part of a text in colons, as a number; the caller has checked that it is one."""
    return F.split_part(c, F.lit(":"), F.lit(k)).cast("int")


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def length_seconds(c: Column) -> Column:
    """ "m:ss" with ss below 60 in seconds, else null (hours are not read)."""
    s = strip(c)
    return F.when(s.rlike(r"^[0-9]{1,3}:[0-5][0-9]$"), _part(s, 1) * 60 + _part(s, 2))


def length_seconds_long(c: Column) -> Column:
    """As length_seconds, and "h:mm:ss" whose parts are not checked; a native time "Thh:mm:ss" means hh minutes and mm seconds."""
    s = strip(c)
    native = F.substring(s, 2, 8)
    return (
        F.when(s.rlike(r"^[0-9]{1,3}:[0-5][0-9]$"), _part(s, 1) * 60 + _part(s, 2))
        .when(s.rlike(r"^[0-9]{1,2}:[0-9]{1,2}:[0-9]{2}$"), _part(s, 1) * 3600 + _part(s, 2) * 60 + _part(s, 3))
        .when(s.rlike(r"^T[0-9]{2}:[0-9]{2}:[0-9]{2}$"), _part(native, 1) * 60 + _part(native, 2))
    )


_PART = r"[+-]?[0-9]+(?:_[0-9]+)*"
_LENGTH = rf"^[:\s]*({_PART})\s*:[:\s]*({_PART})\s*(?::[:\s]*({_PART})\s*)?(?::[:\s]*)?$"


def length_key(c: Column) -> Column:
    """Equal lengths in one form, "m:ss" or "h:mm:ss"; other text unchanged (stripped). Empty parts do not count."""
    s = strip(c)
    # Most lengths are plain; only others are taken apart, once a row.
    plain = s.rlike(r"^(?:0|[1-9]|[1-5][0-9]):[0-5][0-9]$")
    parts = F.when(s.rlike(_LENGTH), F.split(F.regexp_replace(F.regexp_replace(s, _LENGTH, "$1:$2:$3"), "_", ""), ":"))

    def key(x: Column) -> Column:
        a, b, c3 = (F.get(x["parts"], k).try_cast("int") for k in range(3))
        three = F.get(x["parts"], 2) != ""
        h, m, sec = F.when(three, a).otherwise(0), F.when(three, b).otherwise(a), F.when(three, c3).otherwise(b)
        good = (h >= 0) & (m >= 0) & (m < 60) & (sec >= 0) & (sec < 60)
        short, long = F.concat_ws(":", m.cast("string"), _two(sec)), F.concat_ws(":", h.cast("string"), _two(m), _two(sec))
        return F.when(good, F.when(h > 0, long).otherwise(short)).otherwise(x["text"])

    return F.when(plain, s).otherwise(F.transform(F.array(F.struct(s.alias("text"), parts.alias("parts"))), key)[0])


def bpm_key(c: Column) -> Column:
    """Equal tempos in one form: whole numbers without a fraction, others with up to six digits; other text unchanged."""
    s, x = strip(c), to_double(c)
    whole = F.abs(x - F.rint(x)) < 1e-9
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e15)
    return F.when(finite & whole, F.rint(x).cast("bigint").cast("string")).when(finite, F.regexp_replace(F.format_string("%.6f", x), r"\.?0+$", "")).otherwise(s)


def play_time(c: Column) -> Column:
    """ "h:mm" or "h:mm:ss" as it is (parts unchecked), else null."""
    s = strip(c)
    return F.when(s.rlike(r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"), s)


def play_time_ampm(c: Column) -> Column:
    """As play_time; "h:mm AM" and "PM" as 24-hour "HH:MM", a native time "Thh:mm:ss" without its T."""
    s = strip(c)
    half = F.lower(F.substring(s, -2, 1))
    hour = F.pmod(_part(s, 1), F.lit(12)) + F.when(half == "p", 12).otherwise(0)
    return (
        F.when(s.rlike(r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"), s).when(s.rlike(r"^(?i)[0-9]{1,2}:[0-9]{2}\s*[ap]m$"), F.concat_ws(":", _two(hour), F.substring(F.split_part(s, F.lit(":"), F.lit(2)), 1, 2)))
        .when(s.rlike(r"^T[0-9]{2}:[0-9]{2}:[0-9]{2}$"), F.substring(s, 2, 8))
    )


def wall_time(c: Column) -> Column:
    """Wall time "y-M-d H:m" as a timestamp, else null."""
    s = strip(c)
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}$"), F.try_to_timestamp(s, F.lit("yyyy-M-d H:m")))


def instant_of(wall: Column, zone: str) -> Column:
    """The UTC timestamp of wall time in `zone`: of the standard offset where the hour occurs twice."""
    early = F.to_utc_timestamp(wall, zone)
    late = early + F.expr("interval 1 hour")
    return F.when(F.from_utc_timestamp(late, zone) == wall, late).otherwise(early)


def instant_text(wall: Column, instant: Column) -> Column:
    """Wall time in ISO form with its distance from the UTC `instant`. Session time zone: UTC."""
    minutes = ((F.unix_timestamp(wall) - F.unix_timestamp(instant)) / 60).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), sign, F.format_string("%02d:%02d", F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60))


def local_instant(c: Column, zone: str) -> Column:
    """Wall time "y-M-d H:m" in `zone` as ISO text with its offset, in one expression; for tables see with_instant."""
    wall = wall_time(c)
    return instant_text(wall, instant_of(wall, zone))


def with_instant(rows: DataFrame, c: Column, zone: str, name: str = "played_at") -> DataFrame:
    """`rows` whose wall time parses, with its text in ISO form; each step is a projection of its own, computed once."""
    wall = rows.withColumn("_wall", wall_time(c)).filter(F.col("_wall").isNotNull())
    at = wall.withColumn("_instant", instant_of(F.col("_wall"), zone))
    return at.withColumn(name, instant_text(F.col("_wall"), F.col("_instant"))).drop("_wall", "_instant")

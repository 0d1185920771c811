"""Column expressions. Everything here is a built-in Spark expression (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tardy.schemas import NAME_SEPARATOR, NIGHT, PEAK_RANGES, PERIOD_RANGES

_ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
UTC_SUFFIX = "+00:00"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns by a generator of one row: no later step evaluates them again, and the code generated for a step
    stays short enough (8,000 bytes a method) for the JVM to compile it."""
    return df.select(*df.columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def iso_utc(ts) -> Column:
    """Timestamp -> ``2024-01-01T00:06:00+00:00`` (session zone is pinned to UTC)."""
    return F.concat(F.date_format(_c(ts), _ISO_SECONDS), F.lit(UTC_SUFFIX))


def iso_utc_micros(ts) -> Column:
    """ISO-8601 UTC text with microseconds when they are non-zero (seconds-only otherwise)."""
    t = _c(ts)
    micros = F.date_format(t, "SSSSSS")
    return F.when(micros == F.lit("000000"), iso_utc(t)).otherwise(
        F.concat(F.date_format(t, _ISO_SECONDS), F.lit("."), micros, F.lit(UTC_SUFFIX)))


# Epoch seconds of the years 1 to 9999: what a calendar time can hold.
EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)


def epoch_to_iso(epoch_text) -> Column:
    """B1: epoch seconds as text (missing, malformed or out of range -> 0) -> UTC ISO-8601 text."""
    return seconds_to_iso(int_value(epoch_text, "bigint"))


def seconds_to_iso(secs) -> Column:
    """Epoch seconds (null or out of range -> 0) -> UTC ISO-8601 text."""
    secs = _c(secs)
    return iso_utc(F.timestamp_seconds(F.when(secs.between(*EPOCH_RANGE), secs).otherwise(F.lit(0))))


# Integer literal grammar of the source's number fields: optional surrounding blanks, an optional
# sign, digits with single underscores between digit groups ("1_000"). "12a" and "120.0" are not.
INT_LITERAL = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def _int_text(text) -> Column:
    """The digits of an integer literal (blanks and group underscores removed), else null."""
    t = _c(text)
    return F.when(t.rlike(INT_LITERAL), F.regexp_replace(F.trim(t), "_", ""))


def int_value(text, kind: str = "int") -> Column:
    """The number that an integer literal holds; null if it is none or ``kind`` cannot hold it."""
    return _int_text(text).try_cast(kind)


def is_malformed_number(text, kind: str = "int", value: Column | None = None) -> Column:
    """True when a value is present but no integer literal that ``kind`` can hold (``value``: its ``int_value``)."""
    t = _c(text)
    return t.isNotNull() & (int_value(t, kind) if value is None else value).isNull()


def is_malformed_epoch(text, secs: Column | None = None) -> Column:
    """True when a value is present but no epoch second of a calendar time (``secs``: its ``int_value``)."""
    t = _c(text)
    return t.isNotNull() & ~F.coalesce((int_value(t, "bigint") if secs is None else secs).between(*EPOCH_RANGE), F.lit(False))


def parse_int_default(text, default: int = 0, value: Column | None = None) -> Column:
    """B2: numeric text -> int, missing -> default. Malformed text is null, never the default."""
    t = _c(text)
    return F.when(t.isNull(), F.lit(default)).otherwise(int_value(t) if value is None else value)


def decode_flag(text, is_text=None) -> Column:
    """The text "1" -> true, anything else or missing -> false.

    ``is_text`` tells whether the JSON value was a string: the number 1 is not the text "1".
    """
    flag = F.coalesce(_c(text), F.lit("0")) == F.lit("1")
    return flag if is_text is None else flag & F.coalesce(is_text, F.lit(False))


def with_default(c, default: str, present: Column | None = None) -> Column:
    """Nested value with a default for a missing path; ``present`` tells a null value from a missing one."""
    return F.coalesce(_c(c), F.lit(default)) if present is None else F.when(present, _c(c)).otherwise(F.lit(default))


def parse_iso_utc(text) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ holding UTC wall time; malformed -> null.

    The offset is honoured (``+02:00`` is converted), then the instant is expressed in UTC.
    """
    return F.try_to_timestamp(_c(text)).cast("timestamp_ntz")


def is_delayed(delay_seconds="delay_seconds") -> Column:
    """B9."""
    return _c(delay_seconds) > 0


def delay_minutes(delay_seconds="delay_seconds") -> Column:
    """Minutes, one decimal, half away from zero."""
    return F.round(_c(delay_seconds) / F.lit(60), 1)


def departure_hour(ts="scheduled_time") -> Column:
    """B11."""
    return F.hour(_c(ts))


def departure_date(ts="scheduled_time") -> Column:
    """B12."""
    return F.to_date(_c(ts))


def day_of_week(ts="scheduled_time") -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(ts))


def surrogate_key(station="station_id", vehicle="vehicle_id", ts="scheduled_time") -> Column:
    """md5 of ``station-vehicle-time``; a null part gives a null key (concat, not concat_ws)."""
    return F.md5(F.concat(_c(station).cast("string"), F.lit("-"), _c(vehicle).cast("string"),
                          F.lit("-"), _c(ts).cast("string")))


def primary_name(name="station_name") -> Column:
    """Text before the first separator of a bilingual name; whole name when none."""
    return F.split_part(_c(name), F.lit(NAME_SEPARATOR), F.lit(1))


def peak_flag(hour) -> Column:
    """B18."""
    h = _c(hour)
    cond = None
    for lo, hi in PEAK_RANGES:
        part = h.between(lo, hi)
        cond = part if cond is None else (cond | part)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def time_period(hour) -> Column:
    """Morning / Afternoon / Evening, everything else Night."""
    h = _c(hour)
    expr = None
    for name, lo, hi in PERIOD_RANGES:
        expr = F.when(h.between(lo, hi), F.lit(name)) if expr is None else expr.when(h.between(lo, hi), F.lit(name))
    return expr.otherwise(F.lit(NIGHT))


def hour_label(hour) -> Column:
    """``"{h}:00"``."""
    return F.concat(_c(hour).cast("string"), F.lit(":00"))


def category_rank(c, order: list) -> Column:
    """1-based position of a value in a fixed list; values outside it rank null (sort last)."""
    x = _c(c)
    expr = None
    for i, v in enumerate(order, start=1):
        expr = F.when(x == F.lit(v), F.lit(i)) if expr is None else expr.when(x == F.lit(v), F.lit(i))
    return expr


def pct(part, whole) -> Column:
    """part * 100 / whole as DOUBLE (a literal 100.0 would make Spark SQL use DECIMAL)."""
    return F.try_divide(_c(part).cast("double") * F.lit(100.0), _c(whole).cast("double"))


def ratio_pct(part, whole) -> Column:
    """part / whole * 100 in that order, as the report code computes it."""
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * F.lit(100)


def tenths(minutes) -> Column:
    """A one-decimal minutes value as an exact integer count of tenths."""
    return F.round(_c(minutes) * F.lit(10)).cast("long")


def round_tenths_ratio(total_tenths, n, half_even: bool = False) -> Column:
    """(sum of tenths) / n rounded to one decimal, computed exactly in integers.

    A double mean of one-decimal values depends on addition order, so a true x.x5 tie can
    land on either side between runs or engines; the integer form cannot. Ties round away
    from zero (``round``) or to even (``bround``); the result is DOUBLE, null when n is 0.
    """
    t, m = _c(total_tenths).cast("long"), _c(n).cast("long")
    a = F.abs(t)
    r = F.pmod(a, m)
    q = ((a - r) / m).cast("long")            # a - r is a multiple of m: the quotient is exact
    twice = r * 2
    if half_even:
        up = F.when(twice > m, 1).when((twice == m) & (F.pmod(q, F.lit(2)) == 1), 1).otherwise(0)
    else:
        up = F.when(twice >= m, 1).otherwise(0)
    sign = F.when(t < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(m > 0, (sign * (q + up)).cast("double") / F.lit(10.0))


def round_like_numpy(x, digits: int = 1) -> Column:
    """numpy/pandas ``round``: scale, round half to even to an integer (``rint``), unscale.

    Bit-identical to ``numpy.round(x, digits)`` because the same IEEE operations run in the
    same order; ``bround`` instead rounds the shortest decimal form and differs near ties.
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(_c(x) * scale) / scale


def round_like_python(x, digits: int = 1) -> Column:
    """Python's built-in ``round`` on a float: the exact binary value, ties to even.

    ``format_number`` formats with ``DecimalFormat`` (half-even on the exact binary value, as
    Python does); the grouping commas are removed and the text read back as DOUBLE.
    """
    return F.regexp_replace(F.format_number(_c(x), digits), ",", "").cast("double")

"""Column expressions for display values (all JVM-side, codegen friendly).

Python's ``round(x, 1)`` and ``"%.3f"`` round the exact binary value half to
even.  Spark's ``round``, ``bround``, ``format_string`` and ``format_number`` do
not agree with that on all inputs (0.0005 to three decimals), so the digits are
worked out exactly in doubles: the fraction times a power of ten, and what that
product lost, decide the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playgraph import schema as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def fixed_decimals(x, digits: int) -> Column:
    """Text with exactly ``digits`` (0 to 7) decimals, no grouping (Python ``%.Nf``).

    Exact for all values below 2 ** 63; larger ones, which are whole numbers,
    show their shortest digits and zeros.
    """
    if not 0 <= digits <= 7:
        raise ValueError("0 to 7 decimals")
    scale = 10**digits

    def rounded(v: Column) -> Column:
        """(whole, last): the digits before and after the point."""
        # The fraction f times the scale is p plus what the product lost, exactly: f goes in halves of 26 and 27 bits.
        t = v["f"] * F.lit(134217729.0)
        high = t - (t - v["f"])
        p = v["f"] * F.lit(float(scale))
        parts = F.struct(v["whole"].alias("whole"), p.alias("p"), high.alias("high"), (v["f"] - high).alias("low"))

        def step(w: Column) -> Column:
            lost = (w["high"] * F.lit(float(scale)) - w["p"]) + w["low"] * F.lit(float(scale))
            n = F.floor(w["p"])
            return F.struct(w["whole"].alias("whole"), n.alias("n"), (w["p"] - n.cast("double")).alias("over"), lost.alias("lost"))

        def up(w: Column) -> Column:
            odd = (w["n"] if digits else w["whole"]) % 2 == 1  # of the number without its point
            more = (w["over"] > 0.5) | ((w["over"] == 0.5) & ((w["lost"] > 0) | ((w["lost"] == 0) & odd)))
            return F.struct(w["whole"].alias("whole"), (w["n"] + more.cast("bigint")).alias("last"))

        return _let(_let(parts, step), up)

    def text(w: Column) -> Column:
        carry = w["last"] == scale
        whole = (w["whole"] + carry.cast("bigint")).cast("string")
        return F.concat(whole, F.lit("."), F.lpad(F.when(carry, F.lit(0)).otherwise(w["last"]).cast("string"), digits, "0")) if digits else whole

    def number(v: Column) -> Column:
        size = F.abs(v)
        whole = F.floor(size).cast("bigint")
        exact = F.struct(whole.alias("whole"), (size - whole.cast("double")).alias("f"))  # both exact
        large = F.call_function("format_number", size, F.lit("0." + "0" * digits if digits else "0"))
        sign = F.when((v < 0) | (v.cast("string") == "-0.0"), F.lit("-")).otherwise(F.lit(""))
        infinite = F.when(v > 0, F.lit("inf")).otherwise(F.lit("-inf"))
        shown = F.when(size < 9.2e18, _let(_let(exact, rounded), text)).otherwise(large)
        return F.when(F.isnan(v), F.lit("nan")).when(size == float("inf"), infinite).otherwise(F.concat(sign, shown))

    return _let(_c(x).cast("double"), number)


def round_half_even_py(x, digits: int) -> Column:
    """Double rounded like Python's ``round(x, digits)``."""
    return fixed_decimals(x, digits).cast("double")


def grouped_int(x) -> Column:
    """Integer with thousands separators (Python ``f"{n:,}"``)."""
    return F.format_number(_c(x), 0)


def floor_div(x, d: int) -> Column:
    """Python ``x // d`` (floors towards minus infinity)."""
    return F.floor(_c(x) / F.lit(d)).cast("bigint")


def py_mod(x, d: int) -> Column:
    """Python ``x % d`` (sign of the divisor)."""
    return F.pmod(_c(x), F.lit(d)).cast("bigint")


def hours_one_decimal(minutes) -> Column:
    """``round(minutes / 60.0, 1)`` as a double."""
    return round_half_even_py(_c(minutes) / F.lit(60.0), 1)


def hours_one_decimal_label(minutes) -> Column:
    """``f"{round(minutes / 60.0, 1)} hrs"``."""
    return F.concat(fixed_decimals(_c(minutes) / F.lit(60.0), 1), F.lit(S.HOURS_SUFFIX))


def whole_hours_label(minutes) -> Column:
    """``f"{minutes // 60:,} hrs"``."""
    return F.concat(grouped_int(floor_div(minutes, 60)), F.lit(S.HOURS_SUFFIX))


def hours_minutes_label(minutes) -> Column:
    """``f"{m // 60}h {m % 60}m"`` with a missing value read as 0."""
    m = F.coalesce(_c(minutes), F.lit(0))
    return F.format_string("%dh %dm", floor_div(m, 60), py_mod(m, 60))


def utc_date_or_unknown(epoch_seconds) -> Column:
    """Epoch seconds to ``YYYY-MM-DD`` (UTC); 0 or missing gives ``Unknown``.

    Day arithmetic on the integer keeps this independent of the session
    time zone.
    """
    e = _c(epoch_seconds)
    day = F.date_from_unix_date(F.floor(e / F.lit(86400)).cast("int"))
    return (
        F.when(e.isNull() | (e == 0), F.lit(S.UNKNOWN_DATE))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def profile_url(account_id) -> Column:
    return F.concat(F.lit(S.PROFILE_URL_PREFIX), _c(account_id).cast("string"))


def unknown_game_name(appid) -> Column:
    """``f"Unknown ({appid})"``; a missing id renders as Python's ``None``."""
    return F.concat(
        F.lit(S.UNKNOWN_GAME_PREFIX),
        F.coalesce(_c(appid).cast("string"), F.lit(S.NULL_APPID_TEXT)),
        F.lit(")"),
    )


def strip_ws(x) -> Column:
    """Python ``str.strip()`` for ASCII whitespace (``trim`` only drops spaces)."""
    return F.btrim(_c(x), F.lit(" \t\n\r\f\x0b"))

"""Column expressions of the job (all JVM-side built-ins, no UDFs).

Numeric convention: money and quantities are exact decimals while they are
summed; a ratio is taken in double precision and the allocated amount is
stored back as ``DECIMAL(38,6)``, so later sums are exact again and do not
depend on the order in which a cluster adds them up.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_zeros_trim(c: str | Column) -> Column:
    """Remove leading '0' characters (trim-set form)."""
    return F.ltrim(col(c), F.lit("0"))


def strip_zeros_regex(c: str | Column) -> Column:
    """Remove leading zeros with a regular expression."""
    return F.regexp_replace(col(c), "^0+", "")


def prefixed(prefix: str, c: str | Column) -> Column:
    """Prefix || value; NULL stays NULL."""
    return F.concat(F.lit(prefix), col(c))


def replace_text(c: str | Column, search: str, replacement: str) -> Column:
    """Plain substring replacement."""
    return F.replace(col(c), F.lit(search), F.lit(replacement))


def fiscal_period(date_col: str | Column) -> Column:
    """Date -> 'YYYY0MM' (year, a literal 0, two-digit month)."""
    return F.date_format(col(date_col), "yyyy'0'MM")


def period_to_date(period: str | Column) -> Column:
    """C8: 'YYYY0MM' -> first day of that month."""
    p = col(period)
    return F.make_date(F.substring(p, 1, 4).cast("int"), F.substring(p, 5, 3).cast("int"), F.lit(1))


def month_name_date(year: str | Column, month_name: str | Column, names: Iterable[str]) -> Column:
    """(year, three-letter month) -> first day of the month; unknown label -> NULL."""
    number = label(month_name, {n: i for i, n in enumerate(names, start=1)})
    return F.make_date(col(year).cast("int"), number, F.lit(1))


def label(c: str | Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Code -> label through a small fixed table, held as one literal map; unmatched -> default/NULL."""
    if not mapping:
        return F.lit(None) if default is None else default
    found = F.create_map(*[F.lit(x) for entry in mapping.items() for x in entry])[col(c)]
    return found if default is None else F.coalesce(found, default)


def safe_divide(a: str | Column, b: str | Column) -> Column:
    """A / b in double precision, NULL when b is 0 or NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def plain_divide(a: str | Column, b: str | Column) -> Column:
    """A / b in double precision; division by zero is an error (ANSI)."""
    return col(a).cast("double") / col(b).cast("double")


def money(c: str | Column) -> Column:
    """An exact decimal amount at the money scale (6 places)."""
    return col(c).cast(MONEY)


MICRO = Decimal("0.000001")
# Spark's floor of a double is a 64-bit integer, which saturates silently; so the
# micros are cut in two parts, multiples of 2^40 towards zero and the rest, which is exact
# as it keeps the sign (the rest above a floor would be rounded for small negative micros).
_PART = 2.0 ** 40
#: Micros below this fit the 64-bit floor as they are: no second part.
_ONE_PART = 2.0 ** 62
#: Beyond this amount the upper part itself would no longer fit: an error, not a cap.
MONEY_LIMIT = 1e24


def money_from_double(c: str | Column) -> Column:
    """Round a double-precision allocation to 6 decimal places, half up, and store
    it as an exact decimal.  The rounding is spelled out (floor(x * 1e6 + 0.5))
    so that every engine yields the same digits; a plain cast would round the
    shortest decimal form in one engine and the binary value in another.  Both
    parts of the floor are exact; an amount beyond MONEY_LIMIT raises.  Amounts of the usual size take the
    64-bit floor as it is.  The others are evaluated inside ``transform``, which is called and not
    expanded: a row's generated code with several amounts would else pass the 8,000 bytes that the JVM compiles."""
    micros = col(c) * F.lit(1000000.0) + F.lit(0.5)
    near = (F.floor(micros).cast("decimal(19,0)") * F.lit(MICRO)).cast(MONEY)
    return F.when(F.abs(micros) < F.lit(_ONE_PART), near).when(col(c).isNotNull(), F.transform(F.array(col(c)), _large_money)[0])


def _large_money(c: Column) -> Column:
    micros = c * F.lit(1000000.0) + F.lit(0.5)
    parts = micros / F.lit(_PART)
    upper = F.when(parts < 0, F.ceil(parts)).otherwise(F.floor(parts))
    rest = F.floor(micros - upper.cast("double") * F.lit(_PART))
    whole = (upper.cast("decimal(20,0)") * F.lit(Decimal(2 ** 40)) + rest.cast("decimal(14,0)")).cast("decimal(38,0)")
    too_large = F.raise_error(F.concat(F.lit("amount beyond the money limit: "), c.cast("string")))
    return F.when(F.abs(c) > F.lit(MONEY_LIMIT), too_large.cast(MONEY)).otherwise((whole * F.lit(MICRO)).cast(MONEY))


def negate(c: str | Column) -> Column:
    """Sign flip (exact on decimals, never yields -0.0)."""
    return col(c) * F.lit(-1)


def zero_if_null(c: str | Column) -> Column:
    """C14."""
    return F.coalesce(col(c), F.lit(0))

"""Column expressions: text cleaning, amounts, ratios, digests. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from arqueo.contracts import AMOUNT


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Without white space of any script at the ends; empty becomes null."""
    return F.nullif(F.regexp_replace(_column(c).cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def null_tokens(c: Column | str, tokens: tuple[str, ...] = ()) -> Column:
    """Null where the text is one of the tokens; none by default."""
    c = _column(c)
    return F.when(~c.isin(*tokens), c) if tokens else c


def is_blank(c: Column | str) -> Column:
    """Not null, and nothing but white space."""
    c = _column(c)
    return c.isNotNull() & (F.regexp_replace(c, r"(?U)\s+", "") == "")


#: A decimal number in ASCII digits, with an exponent of three digits at most or without.
_NUMBER = r"(?U)^\s*([+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?0*[0-9]{1,3})?)\s*\z"
#: Amounts of 34 digits before the point fit, so cents fit 38 digits.
WIDEST = "decimal(36,2)"


def number_text(c: Column | str) -> Column:
    """The text of a number without white space around it; null if it is none, or blank.

    A cast that fails costs much more than one of null, so texts that are no numbers should meet none.
    """
    return F.nullif(F.regexp_extract(_column(c), _NUMBER, 1), F.lit(""))


def is_empty(c: Column | str) -> Column:
    """Null, or nothing but white space."""
    c = _column(c)
    return c.isNull() | F.regexp_like(c, F.lit(r"(?U)^\s*\z"))


def _zero_if_blank(c: Column | str) -> Column:
    return F.when(is_empty(c), F.lit(0))


def cents(c: Column | str) -> Column:
    """Whole cents as decimal(38,0), exact whatever the digits after the point, halves away from zero.

    Blank is 0; what is no number, or has more than 34 digits before the point, is null.
    """
    whole = (number_text(c).try_cast(WIDEST) * 100).cast("decimal(38,0)")
    return F.coalesce(whole, _zero_if_blank(c).cast("decimal(38,0)"))


def parse_amount(c: Column | str) -> Column:
    """Exact amount, halves away from zero; blank is 0, what is no number or doesn't fit is null."""
    return F.coalesce(number_text(c).try_cast(AMOUNT), _zero_if_blank(c).cast(AMOUNT))


def is_bad_amount(c: Column | str) -> Column:
    """Not blank, and no number that fits an amount: exactly where :func:`parse_amount` is null."""
    return parse_amount(c).isNull()


def _decimals(number: Column) -> Column:
    """How many digits after the point a number's text has, its exponent resolved; zeros at the end count."""
    exponent = F.nullif(F.regexp_extract(number, "[eE](.*)", 1), F.lit("")).cast("int")
    return F.length(F.regexp_extract(number, r"\.([0-9]*)", 1)) - F.coalesce(exponent, F.lit(0))


def _end_zeros(number: Column) -> Column:
    """How many zeros end the digits of a number's text."""
    return F.length(F.replace(F.regexp_extract(number, r"([0.]*+)(?:[eE].*)?\z", 1), F.lit("."), F.lit("")))


def _scientific(number: Column) -> Column:
    return number.contains("e") | number.contains("E")


def extra_digits_of(number: Column) -> Column:
    """Whether more than two digits follow the point of a :func:`number_text`; only exponents need arithmetic."""
    point = F.instr(number, ".")
    found = F.when(_scientific(number), _decimals(number) > 2).otherwise((point > 0) & (F.length(number) - point > 2))
    return F.coalesce(found, F.lit(False))


def rounding_of(number: Column) -> Column:
    """Whether a digit beyond the second after the point of a :func:`number_text` is not zero."""
    point = F.instr(number, ".")
    beyond = (_decimals(number) - _end_zeros(number) > 2) & F.regexp_like(number, F.lit("^[^eE]*[1-9]"))
    # Behind the point and two digits; no pattern is needed.
    plain = (point > 0) & (F.rtrim(F.substring(number, point + 3, F.length(number)), F.lit("0")) != "")
    return F.coalesce(F.when(_scientific(number), beyond).otherwise(plain), F.lit(False))


def has_extra_digits(c: Column | str) -> Column:
    """Whether more than two digits follow the point of the amount."""
    return extra_digits_of(number_text(c))


def requires_rounding(c: Column | str) -> Column:
    """Whether a digit beyond the second after the point of the amount is not zero."""
    return rounding_of(number_text(c))


def format_cents(c: Column | str) -> Column:
    return (_column(c) / 100).cast("decimal(38,2)").cast("string")


def safe_ratio(a: Column | str, b: Column | str, digits: int = 6) -> Column:
    """a / b as double with ``digits`` decimals; 0 where b is 0 or null."""
    return F.round(F.coalesce(F.try_divide(_column(a).cast("double"), _column(b).cast("double")), F.lit(0.0)), digits)


def row_sum(columns: list[str]) -> Column:
    """Sum across columns; null if any is null."""
    return reduce(lambda x, y: x + y, (F.col(c) for c in columns))


def any_null(columns: list[str]) -> Column:
    return reduce(lambda x, y: x | y, (F.col(c).isNull() for c in columns))


def row_digest(columns: list[str], null: str = "<NULL>") -> Column:
    """SHA-256 of the values, each as an eight-byte big-endian length and its UTF-8 bytes."""
    parts = []
    for c in columns:
        value = F.encode(F.coalesce(F.col(c).cast("string"), F.lit(null)), "UTF-8")
        parts += [F.unhex(F.lpad(F.hex(F.octet_length(value).cast("bigint")), 16, "0")), value]
    return F.sha2(F.concat(*parts), 256)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def key_struct(columns: list[str] | tuple[str, ...]) -> Column:
    """Columns as one value, so that rows with nulls count in count(distinct ...)."""
    return F.struct(*columns)

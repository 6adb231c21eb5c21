"""Scalar expressions: cleaning, codes, flags and safe numbers (built-in only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value, in any case (fixed values).
NULL_WORDS = ("", "nan", "none", "null", "<na>")
#: Texts that mean "literate", in any case (fixed values).
TRUE_WORDS = ("sim", "1", "true", "s")
CODE_WIDTH = 7
#: What a regular expression calls white space.
WHITE = " \t\n\x0b\f\r"


def text_of(c: Column | str) -> Column:
    """A value as text, all-round white space removed; whole numbers without
    exponent (a double of 10**7 or more prints one otherwise)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c.cast("string"), F.lit(WHITE))


def whole_number_text(c: Column | str, kind: str) -> Column:
    """Text of a code column of the given type; floats lose their fraction."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,0)").cast("string") if kind in ("double", "float") else text_of(c)


def null_like(c: Column | str) -> Column:
    """Trimmed text, null where it is a word for a missing value."""
    t = text_of(c)
    return F.when(~F.lower(t).isin(*NULL_WORDS), t)


def year(c: Column | str) -> Column:
    """A year as int; what isn't a whole number is null, ``"2024.0"`` is 2024."""
    c = F.col(c) if isinstance(c, str) else c
    number = c.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def padded_code(c: Column | str, kind: str = "string", width: int = CODE_WIDTH) -> Column:
    """A numeric code, zeros before it up to ``width``; longer codes stay.

    A text that is such a code already, as most are, is told by one match.
    """
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    done = F.regexp_like(text, F.lit(rf"\A[0-9]{{{width},}}\z")) if kind == "string" else F.lit(False)
    digits = F.regexp_replace(F.regexp_replace(whole_number_text(c, kind), r"\.0$", ""), r"\D", "")
    return F.when(done, text).when(F.length(digits) == 0, None).when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def upper_clean(c: Column | str) -> Column:
    return F.upper(null_like(c))


def lower_clean(c: Column | str) -> Column:
    t = F.lower(text_of(c))
    return F.when(~t.isin(*NULL_WORDS), t)


def true_flag(c: Column | str, words: tuple[str, ...] = TRUE_WORDS, nulls_count: bool = True) -> Column:
    """1.0 for a true word, 0.0 otherwise; null is 0.0 too unless ``nulls_count``
    is off, then null."""
    c = F.col(c) if isinstance(c, str) else c
    flag = F.lower(text_of(c)).isin(*words).cast("double")
    return F.coalesce(flag, F.lit(0.0)) if nulls_count else flag


def number(c: Column | str) -> Column:
    """A double; texts that aren't numbers, and NaN, are null."""
    c = F.col(c) if isinstance(c, str) else c
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def weight(c: Column | str, default: float = 1.0) -> Column:
    return F.coalesce(number(c), F.lit(default))


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, null where ``b`` is zero."""
    return F.try_divide(a, b)


def full_match(c: Column | str, pattern: str) -> Column:
    """Whether the whole trimmed text matches."""
    return F.regexp_like(text_of(c), F.lit(f"^(?:{pattern})$"))

"""Locale-agnostic parsing of numbers, dates, rates and categories."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vintora.params import NOT_INFORMED

MAX_INT = 2**31 - 1
WHITESPACE = " \t\n\r\x0b\x0c"
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
SLASH_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})\z"
DASH_DATE = r"^((?!0000)\d{4}-\d{1,2}-\d{1,2})(?:\z|\s+([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d([.]\d{1,9})?$)"

# Texts that stand for "no date" and "no category".
BLANK_DATES = ("", "nan", "None", "NaT")
BLANK_CATEGORIES = ("nan", "None", "", "NaN")


def clean_text(c: Column) -> Column:
    """Strip every kind of blank from both ends."""
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def trimmed_text(c: Column) -> Column:
    """``clean_text`` in more code but less time: most texts hold no other blanks than spaces."""
    text = c.cast("string")
    return F.when(text.rlike(r"[\t\n\r\x0b\x0c]"), clean_text(text)).otherwise(F.trim(text))


def norm_id(c: Column) -> Column:
    return clean_text(c)


def plain_number(text: Column) -> Column:
    """Double when the text is a plain decimal number, null otherwise."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def decimal_text(c: Column) -> Column:
    """Rewrite a number so that its last separator becomes the decimal dot.

    A text whose last separator is a comma loses its dots; any other text loses
    its commas. Repeated decimal separators survive and fail the number test.
    """
    return _one_dot(clean_text(c))


def _one_dot(text: Column) -> Column:
    return F.when(text.rlike(r",[^.,]*$"), F.translate(text, ",.", ".")).otherwise(
        F.translate(text, ",", "")
    )


def dotted_text(text: Column) -> Column:
    """``decimal_text`` of a text without blanks at its ends, in more code but less time: most texts hold no comma."""
    return F.when(text.contains(","), _one_dot(text)).otherwise(text)


def is_number(c: Column) -> Column:
    """True for parseable, false for unparseable, null for null."""
    return decimal_text(c).rlike(PLAIN_NUMBER)


def norm_decimal(c: Column, *, null_as_zero: bool = True) -> Column:
    """Number in either locale; garbage is 0, null is 0 or stays null."""
    return decimal_value(plain_number(decimal_text(c)), c, null_as_zero=null_as_zero)


def decimal_value(number: Column, c: Column, *, null_as_zero: bool = True) -> Column:
    """``norm_decimal`` of a text whose plain number is known already."""
    value = F.coalesce(number, F.lit(0.0))
    return value if null_as_zero else F.when(c.isNotNull(), value)


def norm_int(c: Column, *, null_as_zero: bool = True) -> Column:
    """As ``norm_decimal`` then rounded half-even to an integer; one that does not fit fails the job."""
    return int_value(norm_decimal(c, null_as_zero=null_as_zero), c)


def int_value(number: Column, c: Column) -> Column:
    """``norm_int`` of a text whose number is known already."""
    value = F.rint(number)
    message = F.concat(F.lit("integer out of range: "), c.cast("string"))
    return F.when(F.abs(value) > MAX_INT, F.raise_error(message).cast("int")).otherwise(value.try_cast("int"))


def norm_decimal_strict(c: Column) -> Column:
    """Validator rule: every dot is a thousands mark; unparseable is null."""
    return plain_number(clean_text(F.translate(c.cast("string"), ",.", ".")))


def date_text_is_blank(c: Column) -> Column:
    return blank_date(clean_text(c))


def blank_date(text: Column) -> Column:
    """``date_text_is_blank`` of a text without blanks at its ends."""
    return text.isNull() | text.isin(*BLANK_DATES)


def norm_date(c: Column) -> Column:
    """``d/m/yyyy``, ``yyyy-m-d`` or ``yyyy-m-d h:m:s`` with or without a fraction; anything else is null.

    The patterns decide the shape and the cast to date rejects impossible days.
    """
    return date_value(clean_text(c))


def date_value(text: Column) -> Column:
    """``norm_date`` of a text without blanks at its ends."""
    dashed = F.when(text.contains("/"), F.regexp_replace(text, SLASH_DATE, "$3-$2-$1")).otherwise(text)
    return F.regexp_extract(dashed, DASH_DATE, 1).try_cast("date")


def date_status(c: Column) -> Column:
    """``absent``, ``invalid`` (present but unparseable) or ``valid``."""
    return (
        F.when(date_text_is_blank(c), "absent")
        .when(norm_date(c).isNull(), "invalid")
        .otherwise("valid")
    )


def rate_fraction(rate: Column) -> Column:
    """Rates above 1 are percentages."""
    return F.when(rate > 1, rate / 100).otherwise(rate)


def norm_rate(c: Column) -> Column:
    number = plain_number(clean_text(F.translate(c.cast("string"), ",", ".")))
    return rate_fraction(F.coalesce(number, F.lit(0.0)))


def norm_category(c: Column) -> Column:
    return F.when(c.isNull() | c.isin(*BLANK_CATEGORIES), NOT_INFORMED).otherwise(c)


def norm_report_value(c: Column, kind: str | Column) -> Column:
    """Number printed in a report, read according to its kind.

    ``pct`` and ``decimal`` use the dot as decimal mark. ``count`` and ``money`` use
    it for thousands, except that one dot before exactly one or two last digits is
    a decimal mark.
    """
    kind = F.lit(kind) if isinstance(kind, str) else kind
    text = F.regexp_replace(c.cast("string"), r"R\$|%", "")
    text = clean_text(F.regexp_replace(text, r"\(.*?\)", ""))
    dotted = F.translate(text, ",", ".")
    grouped = (
        F.when(F.instr(text, ",") > 0, F.translate(text, ",.", "."))
        .when(text.rlike(r"^[+-]?\d+\.\d{1,2}$"), text)
        .otherwise(F.translate(text, ".", ""))
    )
    return plain_number(F.when(kind.isin("pct", "decimal"), dotted).otherwise(grouped))

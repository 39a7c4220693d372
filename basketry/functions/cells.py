"""Reading typed values out of raw text cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.schema import MISSING_TOKENS


def missing_to_null(name: str) -> str:
    """SQL: NULL for any of the missing-value tokens, the cell's text otherwise."""
    tokens = ", ".join(f"'{token}'" for token in MISSING_TOKENS)
    return f"IF(`{name}` IN ({tokens}), NULL, `{name}`)"


def _apart(name: str, expression: str) -> str:
    """SQL: `expression` of `cell` for the column `name`, kept out of the generated code.

    A lambda is interpreted where it is reached.  Rare notations thus cost the common ones
    nothing; inlined, they make the generated method too large to be compiled.
    """
    return f"get(transform(array({name}), cell -> {expression}), 0)"


# Digits that every type of the name holds.
_SAFE_DIGITS = {"INT": 9, "BIGINT": 18}


def whole_number(name: str, type_name: str, strict: bool = True) -> Column:
    """`6` and `6.0` as an integer; any other text is an error that names it, in every mode.

    Not `strict`, such text is NULL (`not_whole` words the error).
    """
    plain = rf"{name} RLIKE r'^-?[0-9]{{1,{_SAFE_DIGITS[type_name]}}}(\.0+)?\z'"
    other = _apart(name, _any_whole_number("cell", name, type_name, strict))
    return F.expr(f"CASE WHEN {plain} THEN CAST(substring_index({name}, '.', 1) AS {type_name}) ELSE {other} END")


def not_whole(name: str, text: str) -> str:
    return f"concat('{name} is not a whole number: ', {text})"


def _any_whole_number(text: str, name: str, type_name: str, strict: bool) -> str:
    without_zeros = rf"regexp_replace({text}, r'\.0+$', '')"
    number = f"TRY_CAST(IF({text} LIKE '%.%', {without_zeros}, {text}) AS {type_name})"
    # A try_cast to an integer cuts fractions off in some notations; compare as decimals.
    fits = f"coalesce({number} = TRY_CAST({text} AS DECIMAL(38,10)), false)"
    wrong = f"raise_error({not_whole(name, text)})" if strict else "NULL"
    return f"CASE WHEN {text} IS NULL OR {fits} THEN {number} ELSE {wrong} END"


def exact_amount(name: str, scale: int, strict: bool = True) -> Column:
    """The text as decimal(18, scale), never rounded.

    Text that is no number, or has more decimals than the scale holds, is an error that
    names it, in every mode.  Decimals beyond the 20th are not looked at.  Not `strict`,
    such text is NULL (`not_fitting` words the error).
    """
    scale = int(scale)
    decimals = rf"(\.[0-9]{{1,{scale}}})?" if scale else ""
    plain = rf"{name} RLIKE r'^-?[0-9]{{1,{18 - scale}}}{decimals}\z'"
    other = _apart(name, _any_amount("cell", name, scale, strict))
    return F.expr(f"CASE WHEN {plain} THEN CAST({name} AS DECIMAL(18,{scale})) ELSE {other} END")


def not_fitting(name: str, text: str, scale: int) -> str:
    return f"concat('{name} does not fit decimal(18,{scale}): ', {text})"


def _any_amount(text: str, name: str, scale: int, strict: bool) -> str:
    wide = f"TRY_CAST({text} AS DECIMAL(38,20))"
    amount = f"TRY_CAST({wide} AS DECIMAL(18,{scale}))"
    wrong = f"raise_error({not_fitting(name, text, scale)})" if strict else "NULL"
    return f"CASE WHEN {text} IS NULL OR coalesce({amount} = {wide}, false) THEN {amount} ELSE {wrong} END"


# The default date format, and its shape for the fast path below.
ISO_FORMAT = "yyyy-MM-dd HH:mm:ss"
_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def timestamp_or_null(text: Column, fmt: str = ISO_FORMAT) -> Column:
    """Zone-free timestamp; NULL where the text does not have the format.

    The default format is Spark's own notation, so a cast reads it several times
    faster than a formatter; the shape test keeps the other notations a cast
    accepts out.  For other formats the tolerant parse yields a zoned timestamp,
    which would move local times that a zone's clock change skips, so it only
    decides whether to parse.
    """
    if fmt == ISO_FORMAT:
        return F.when(text.rlike(_ISO_SHAPE), text.try_cast("timestamp_ntz"))
    return F.when(
        F.try_to_timestamp(text, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(text, F.lit(fmt))
    )


def timestamp_as_text(time: Column, missing: str | None = None) -> Column:
    """`2010-12-01 08:26:00`, with six more digits where a time has parts of a second.

    A missing time is NULL, or the text `missing`.
    """
    whole = F.date_format(time, ISO_FORMAT)
    parts = F.date_format(time, "SSSSSS")
    text = F.when(parts == "000000", whole).otherwise(F.concat_ws(".", whole, parts))
    return F.when(time.isNull(), F.lit(missing)).otherwise(text)


def money(exact: Column) -> Column:
    """Exact decimal amounts leave the engine as DOUBLE."""
    return exact.cast("double")

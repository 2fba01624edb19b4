"""Column expressions for the scalar work of the pipeline.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; nothing is a Python UDF. Regular expressions avoid
look-arounds so the same patterns run in engines with RE2-style regexes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the source pipeline's) -------------------------
# Office-code prefix -> state, as used when parsing report file names.
STATE_BY_CODE_PREFIX = {"TN": "Tamil Nadu", "KL": "Kerala", "KA": "Karnataka", "PY": "Puducherry"}
# Same prefixes as named by the completeness check (underscore spelling).
STATE_BY_CODE_PREFIX_COMPLETENESS = {"TN": "Tamil_Nadu", "KL": "Kerala", "KA": "Karnataka", "PY": "Puducherry"}
# Vehicle types a report file name may end with.
KNOWN_VEHICLE_TYPES = ("motor_car", "motor_cab")
# Title line of a report: "Maker Wise Fuel Data of <OFFICE - CODE> , <State> (...)".
TITLE_PREFIX_PATTERN = r"(?i)^maker\s+wise\s+fuel\s+data\s+of\s+"
# File name "<office> - <CODE>": lazy office name, dash, letters then digits.
FILE_NAME_PATTERN = r"^(.+?)\s*-\s*([A-Z]+[0-9]+)"
# Office code anywhere in a text: two capitals then digits.
OFFICE_CODE_PATTERN = r"([A-Z]{2}[0-9]+)"
# Title tail removed after the office: ", <state>" with an optional "(...)".
TITLE_TAIL_PATTERN = r"\s*,\s*[^,]+(\([^)]*\))?\s*$"
# Parenthesised parts dropped when names are compared.
PARENS_PATTERN = r"\([^)]*\)"
# Text accepted as a number: sign, digits with optional fraction, optional exponent.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Date layouts accepted on read, in the order they are tried (day first).
DATE_FORMATS = ("dd-MM-yyyy", "yyyy-MM-dd", "d/M/yyyy")
# Three date tokens in lower case and an optional time; month names in full or by three letters.
DATE_TOKENS = r"^([0-9]{1,4}(?:st|nd|rd|th)?|[a-z]{3,9})[-/., ]+([0-9]{1,2}(?:st|nd|rd|th)?|[a-z]{3,9})[-/., ]+([0-9]{1,4})(?:[t ]+[0-9]{1,2}:[0-9:.]*.*)?$"
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# -----------------------------------------------------------------------------


# The whitespace ``\s`` matches: space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE = " \t\n\x0b\f\r"


def strip_ws(c: Column) -> Column:
    """Trim every kind of leading/trailing whitespace (tabs, newlines), like ``str.strip``.

    ``F.trim`` removes spaces only; ``btrim`` with the whitespace set does the
    rest without a regular expression. Inner runs of spaces are significant and kept.
    """
    return F.btrim(c, F.lit(WHITESPACE))


def to_number(c: Column) -> Column:
    """Lenient number parse: bad text (``'1,234'``, ``'abc'``, ``'nan'``, blank) -> NULL, as a double.

    The text is checked against :data:`NUMBER_PATTERN` first, so only plain
    decimal notation parses (no hex, no type suffixes, no NaN/Infinity words).
    """
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_count(c: Column) -> Column:
    """Registration count: lenient parse, NULL -> 0, fraction truncated toward zero, BIGINT."""
    return F.coalesce(to_number(c), F.lit(0.0)).try_cast("bigint")


def parse_day_first(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Lenient date parse over several layouts; unparsable -> NULL."""
    text = strip_ws(c.cast("string"))
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def parse_mixed_dates(c: Column) -> Column:
    """SC11: a date in any usual layout, day first, in one pass over its tokens; unparsable -> NULL.

    The text is cut once into three tokens (numbers or a month name; ``-``, ``/``,
    ``.``, ``,`` or spaces between) and an optional time, which is ignored. A
    first token of four digits is the year of year-month-day; a month name may
    come first or second; otherwise the order is day, month, year, turned round
    where the second number can only be a day. Two-digit years are 1970 to 2069.
    """
    text = F.lower(strip_ws(c.cast("string")))
    tokens = F.when(text.rlike(DATE_TOKENS), F.split(F.regexp_replace(text, DATE_TOKENS, "$1 $2 $3"), " "))
    return _once(tokens, _date_of)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often it is used (NULL stays NULL)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _date_of(tokens: Column) -> Column:
    one, two, three = tokens[0], tokens[1], tokens[2]
    months = F.create_map(*[F.lit(x) for pair in {n: k for k, name in enumerate(MONTH_NAMES, 1) for n in (name, name[:3])}.items() for x in pair])

    def number(token: Column) -> Column:
        return F.regexp_extract(token, "^[0-9]+", 0).try_cast("int")

    # Numbers of the tokens; a token that is a month's name has none.
    name = F.when(number(one).isNull(), one).otherwise(F.when(number(two).isNull(), two))
    numbers = F.struct(
        number(one).alias("one"), number(two).alias("two"), number(three).alias("three"), F.try_element_at(months, name).alias("name"),
        (F.length(one) == 4).alias("year_first"),
    )

    def ordered(n: Column) -> Column:
        first, second, third = F.coalesce(n["one"], n["name"]), F.coalesce(n["two"], n["name"]), n["three"]
        named_first = n["one"].isNull()
        year = F.when(n["year_first"] & ~named_first, first).otherwise(third)
        mid = F.when(named_first, first).otherwise(second)
        day = F.when(named_first, second).when(n["year_first"], third).otherwise(first)
        turned = ~(n["year_first"] & ~named_first) & (mid > 12) & (day <= 12)
        year = F.when(year >= 100, year).when(year >= 70, year + 1900).otherwise(year + 2000)
        text = F.format_string("%04d-%02d-%02d", year, F.when(turned, day).otherwise(mid), F.when(turned, mid).otherwise(day))
        return F.when((year + mid + day).isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))

    return F.when(tokens.isNotNull(), _once(numbers, ordered))


def parse_day_first_strict(c: Column) -> Column:
    """Dates of :func:`parse_day_first`, else of :func:`parse_mixed_dates`; fails the job on a non-NULL unparsable value."""
    bad = F.raise_error(F.concat(F.lit("unparsable date: "), c.cast("string"))).cast("date")
    return F.coalesce(parse_day_first(c), parse_mixed_dates(c), F.when(c.isNotNull(), bad))


def fiscal_year(d: Column) -> Column:
    """April-March financial year label, e.g. 2025-04-01 -> ``'2025-26'``."""
    y = F.year(F.add_months(d, -3))
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def fiscal_quarter(d: Column) -> Column:
    """``Q1`` = April-June ... ``Q4`` = January-March."""
    return F.concat(F.lit("Q"), F.quarter(F.add_months(d, -3)).cast("string"))


def month_name(d: Column) -> Column:
    """Full English month name."""
    return F.date_format(d, "MMMM")


def data_date(run_date: Column) -> Column:
    """Counters published on a run day describe the previous day."""
    return F.date_sub(run_date, 1)


def reporting_month(run_date: Column) -> Column:
    """First day of the month the run reports on (on the 1st: previous month)."""
    return F.trunc(data_date(run_date), "month")


def fmt_day_first(d: Column) -> Column:
    """``dd-MM-yyyy`` text used in the CSV edge files."""
    return F.date_format(d, "dd-MM-yyyy")


def state_from_code(code: Column, mapping: dict[str, str] = STATE_BY_CODE_PREFIX, default: str | None = "Unknown") -> Column:
    """Office code prefix -> state; unknown prefix -> ``default``."""
    prefix = F.upper(F.substring(code, 1, 2))
    expr = None
    for p, state in mapping.items():
        expr = (F.when(prefix == p, F.lit(state)) if expr is None else expr.when(prefix == p, F.lit(state)))
    return expr.otherwise(F.lit(default))


def strip_report_ext(name: Column) -> Column:
    """Remove every ``.xlsx`` and ``.csv`` occurrence (plain substring replacement)."""
    return F.replace(F.replace(name, F.lit(".xlsx"), F.lit("")), F.lit(".csv"), F.lit(""))


def parse_report_filename(name: Column) -> Column:
    """``'<OFFICE> - <CODE>_<vehicle_type>.xlsx'`` -> struct(state, office, office_code, vehicle_type).

    The vehicle type is everything after the first ``_`` (``'unknown'`` if no
    ``_``); the office/code pattern is matched at the start of the part before
    it. The struct is NULL when the pattern does not match (file skipped).
    """
    base = strip_report_ext(name)
    first = F.substring_index(base, "_", 1)
    has_us = F.instr(base, "_") > 0
    vehicle = F.when(has_us, F.substring(base, F.instr(base, "_") + 1, F.length(base))).otherwise(F.lit("unknown"))
    matched = first.rlike(FILE_NAME_PATTERN)
    office = strip_ws(F.regexp_extract(first, FILE_NAME_PATTERN, 1))
    code = strip_ws(F.regexp_extract(first, FILE_NAME_PATTERN, 2))
    return F.when(
        matched,
        F.struct(
            state_from_code(code).alias("state"),
            office.alias("office"),
            code.alias("office_code"),
            vehicle.alias("vehicle_type"),
        ),
    )


def extract_office_code(text: Column) -> Column:
    """First ``[A-Z]{2}digits`` in the upper-cased text, ``''`` when none."""
    return F.regexp_extract(F.upper(text), OFFICE_CODE_PATTERN, 1)


def normalize_text(text: Column) -> Column:
    """Drop ``( ... )`` groups, collapse whitespace, trim, lower-case."""
    t = F.regexp_replace(text, PARENS_PATTERN, " ")
    t = F.regexp_replace(t, r"\s+", " ")
    return F.lower(strip_ws(t))


def without_extension(name: Column) -> Column:
    """File name without its last extension; a name that only starts with a dot has none."""
    return F.when(name.rlike(r"\.[^.]*$") & ~name.rlike(r"^\.[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def file_base_name(path: Column) -> Column:
    """Base name without directory and without the last extension."""
    return without_extension(F.regexp_extract(path, r"([^/\\]*)$", 1))


def split_vehicle_suffix(base: Column) -> Column:
    """Base name -> struct(office_part, vehicle_type).

    A known vehicle-type suffix (``_motor_car``/``_motor_cab``, any case) wins;
    otherwise the text after the last ``_``; otherwise an empty type.
    """
    lower = F.lower(base)
    expr = None
    for suffix in KNOWN_VEHICLE_TYPES:
        cond = lower.endswith(F.lit(f"_{suffix}"))
        head = base.substr(F.lit(1), F.length(base) - F.lit(len(suffix) + 1))
        val = F.struct(head.alias("office_part"), F.lit(suffix).alias("vehicle_type"))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    last_split = F.struct(
        F.regexp_replace(base, r"_[^_]*$", "").alias("office_part"),
        F.regexp_extract(base, r"_([^_]*)$", 1).alias("vehicle_type"),
    )
    no_split = F.struct(base.alias("office_part"), F.lit("").alias("vehicle_type"))
    return expr.when(F.instr(base, "_") > 0, last_split).otherwise(no_split)


def file_identity(name: Column) -> Column:
    """File name -> struct(office_code, vehicle_type lower-cased, normalized office name)."""
    base = file_base_name(name)
    parts = split_vehicle_suffix(base)
    return F.struct(
        extract_office_code(base).alias("office_code"),
        F.lower(parts["vehicle_type"]).alias("vehicle_type"),
        normalize_text(parts["office_part"]).alias("office_norm"),
    )


def office_from_title(title: Column) -> Column:
    """Report title -> office text: drop the fixed prefix and the trailing ``, <state> (...)``."""
    t = strip_ws(F.regexp_replace(F.coalesce(title, F.lit("")), TITLE_PREFIX_PATTERN, ""))
    t = F.regexp_replace(t, TITLE_TAIL_PATTERN, "")
    return strip_ws(t)


def code_boundary_match(text: Column, code: Column) -> Column:
    """True when ``code`` occurs in ``text`` not followed by a digit (``TN1`` never matches ``TN10``)."""
    # Codes are letters and digits only, so they need no regex escaping.
    pattern = F.concat(F.lit("(?i)"), code, F.lit("([^0-9]|$)"))
    return F.regexp_like(text, pattern)

"""Enumerated values, reasons and cell formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.text import strip

# Fixed values.
STATUSES = ("PENDING", "PARSED", "INDEXED", "FAILED", "DELETED", "SKIPPED", "EXCLUDED")
PARSE_ROUTES = (
    "RHWP", "HWPX", "PDF_DOCAI", "GCS_EXPORT", "GCS_COPY", "NONE", "KORDOC", "OSS_PARSER",
)
AUDIENCES = ("STUDENT", "STAFF")
SEVERITIES = (
    "DEFAULT", "DEBUG", "INFO", "NOTICE", "WARNING", "ERROR", "CRITICAL", "ALERT", "EMERGENCY",
)
REASON_CHARS = 2000
JOB_ERROR_CHARS = 1000
ERROR_CHARS = 500
REASON_PREFIX_CHARS = 60


def one_of(col: Column, domain: tuple[str, ...], fallback: str) -> Column:
    """The value if the domain knows it, else the fallback (also for NULL)."""
    return F.when(col.isin(*domain), col).otherwise(F.lit(fallback))


def status(col: Column) -> Column:
    return one_of(col, STATUSES, "PENDING")


def parse_route(col: Column) -> Column:
    return one_of(col, PARSE_ROUTES, "NONE")


def audience(col: Column) -> Column:
    return one_of(col, AUDIENCES, "STAFF")


def severity_level(col: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.upper(col)) - 1


def rejection_kind(detail_json: Column) -> Column:
    """Kind of a parse rejection, read from the nested or the outer ``error`` field."""
    inner = F.get_json_object(detail_json, "$.detail.error")
    outer = F.when(
        F.get_json_object(detail_json, "$.detail").startswith("{"), F.lit(None)
    ).otherwise(F.get_json_object(detail_json, "$.error"))
    return F.coalesce(F.nullif(inner, F.lit("")), F.nullif(outer, F.lit("")), F.lit("PARSE_REJECTED"))


def rejection_reason(detail_json: Column) -> Column:
    return F.concat(rejection_kind(detail_json), F.lit(":"), detail_json)


def cell_text(value: Column) -> Column:
    """A string cell ready for a Markdown table: bars escaped, line ends flattened, trimmed."""
    flat = F.regexp_replace(F.replace(value, F.lit("|"), F.lit("\\|")), r"[\r\n]", " ")
    return strip(flat)


def cell_number(value: Column) -> Column:
    """A numeric cell: a whole number loses its fraction, others get their shortest digits.

    Digits are written out from 0.0001 on; smaller fractions have an exponent of two digits.
    """
    value = value.cast("double")
    shortest = value.cast("string")
    whole = F.when(F.abs(value) < 1e38, value.cast("decimal(38,0)").cast("string")).otherwise(
        F.format_string("%.0f", value)
    )
    plain = F.rtrim(shortest.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    small = F.regexp_replace(F.regexp_replace(shortest, r"\.0E", "E"), r"E-(\d)$", "E-0$1")
    small = F.lower(F.regexp_replace(small, r"E-(\d\d)", "e-$1"))
    return (
        F.when(F.isnan(value) | (F.abs(value) == float("inf")), shortest)
        .when(value % 1 == 0, whole)
        .when(F.abs(value) >= 1e-4, plain)
        .otherwise(small)
    )


def cell_boolean(value: Column) -> Column:
    return F.when(value, "TRUE").when(~value, "FALSE")


def cell_timestamp(value: Column) -> Column:
    """ISO form with a blank between date and time, microseconds only where there are any."""
    fine = F.date_format(value, "SSSSSS")
    base = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.when(fine == "000000", base).otherwise(F.concat(base, F.lit("."), fine))


def cell_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")

"""Identifiers, URIs and names of objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.text import blank_to_null, strip

# Suffixes of the objects made from one file.
FILE_SUFFIXES = (
    ".meta.md", ".markdown", ".md", ".pdf", ".txt", ".html", ".htm", ".hwpx", ".hwp",
    ".docx", ".doc", ".pptx", ".xlsx", ".xls", ".csv", ".rtf", ".bin",
)
SIDECAR_SUFFIX = ".meta.md"
INDEXABLE_SUFFIXES = (
    ".md", ".meta.md", ".pdf", ".txt", ".html", ".doc", ".docx", ".pptx", ".rtf", ".xls",
    ".xlsx", ".csv",
)
FILE_ID_PATTERN = r"\A[A-Za-z0-9_-]{10,}\z"


def _any_suffix(suffixes: tuple[str, ...]) -> str:
    return r"(?i)(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + r")\z"


def basename(col: Column) -> Column:
    return strip(F.substring_index(col, "/", -1))


def extract_file_id(display: Column, uri: Column | None = None) -> Column:
    """File id behind an object name or URI: one known suffix and one part number removed."""
    name = F.coalesce(blank_to_null(display), uri if uri is not None else F.lit(None), F.lit(""))
    base = basename(name)
    stem = F.regexp_replace(base, _any_suffix(FILE_SUFFIXES), "")
    return F.when(base == "", F.lit("unknown")).otherwise(
        F.regexp_replace(stem, r"(?i)\.part\p{Nd}+\z", "")
    )


def is_sidecar(display: Column, uri: Column | None = None) -> Column:
    """True where the name or the URI ends with the side-file suffix."""

    def ends(col: Column) -> Column:
        return F.lower(basename(F.coalesce(col, F.lit("")))).endswith(SIDECAR_SUFFIX)

    return ends(display) if uri is None else ends(display) | ends(uri)


def is_indexable(name: Column) -> Column:
    return name.rlike(_any_suffix(INDEXABLE_SUFFIXES))


def is_clean_file_id(file_id: Column) -> Column:
    return file_id.rlike(FILE_ID_PATTERN)


def belongs_to_file(name: Column, file_id: Column) -> Column:
    """The object is the id itself or the id followed by a dot (f1 does not own f10.md)."""
    return (name == file_id) | name.startswith(F.concat(file_id, F.lit(".")))


def object_owner(name: Column) -> Column:
    """Key to join objects to files on: the name up to its first dot."""
    return F.substring_index(name, ".", 1)


def gs_uri(bucket: Column, name: Column) -> Column:
    return F.concat(F.lit("gs://"), bucket, F.lit("/"), name)


def uri_bucket(uri: Column) -> Column:
    """Bucket of a well-formed storage URI, else NULL."""
    return blank_to_null(F.regexp_extract(uri, r"\Ags://([^/]+)/(?s:.+)\z", 1))


def uri_object(uri: Column) -> Column:
    return blank_to_null(F.regexp_extract(uri, r"\Ags://[^/]+/((?s:.+))\z", 1))


def file_suffix(name: Column) -> Column:
    """Suffix of a file name with its dot, or the empty string."""
    return F.regexp_extract(name, r"[^./][^/]*(\.[^./]+)\z", 1)


def drive_size(size: Column) -> Column:
    return size.try_cast("bigint")


def drive_link(uri: Column) -> Column:
    """The stored link if it opens in a browser, else NULL."""
    link = strip(F.coalesce(uri, F.lit("")))
    return F.when(link.rlike(r"\Ahttps?://"), link)


def column_number(letters: Column) -> Column:
    """Spreadsheet column letters to a number from 1."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(letters)),
        F.lit(0),
        lambda acc, i: acc * 26 + (F.ascii(F.substring(letters, i, F.lit(1))) - 64),
    )

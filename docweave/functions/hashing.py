"""Content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(col: Column) -> Column:
    """Hash of a text (as UTF-8) or of bytes, with its scheme in front."""
    return F.concat(F.lit("sha256:"), F.sha2(col, 256))


def text_hash(markdown: Column) -> Column:
    return sha256(markdown)


def binary_hash(content: Column, path: Column, sidecar: Column) -> Column:
    """Hash of an original with the path and side text that are indexed beside it."""
    return binary_hash_from(sha256(content), path, sidecar)


def binary_hash_from(content_hash: Column, path: Column, sidecar: Column) -> Column:
    return sha256(F.concat_ws("|", content_hash, path, sidecar))


def sidecar_hash(file_id: Column, path: Column, sidecar: Column) -> Column:
    """Hash of a file of which only the side text is indexed."""
    return sha256(F.concat_ws("|", file_id, path, sidecar))

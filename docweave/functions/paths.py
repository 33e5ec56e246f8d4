"""Folder paths, bundles and the heading block of an indexed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.text import blank_to_null, is_blank, lstrip, strip

# The labels written into indexed texts and read back from them.
BUNDLE_LABEL = "자료묶음:"
PATH_LABEL = "경로:"
SIDECAR_OPENING = "이 파일은 자료묶음 `"
SIDECAR_CLOSING = "` 소속입니다. 동일 경로의 관련 PDF/PPTX/HWP와 함께 참조하세요.\n"
GENERIC_NAMES = ("content", "index", "body", "untitled")
NAMELESS = "(이름 없음)"


def path_context(folders: Column, file_name: Column) -> Column:
    """struct(path, bundle, segments) of the folder names from the root down and a file name."""
    name = F.coalesce(blank_to_null(strip(file_name)), F.lit("untitled"))
    kept = F.filter(F.transform(folders, lambda f: strip(f)), lambda f: f.isNotNull() & (f != ""))
    segments = F.concat(kept, F.array(name))
    bundle = F.when(F.size(kept) > 0, F.element_at(kept, -1)).otherwise("")
    return F.struct(
        F.array_join(segments, "/").alias("path"), bundle.alias("bundle"), segments.alias("segments")
    )


def strip_breadcrumb(markdown: Column) -> Column:
    """Remove an earlier heading block: a front matter naming a path or bundle, and a title
    with its label lines. A title without label lines belongs to the body and stays."""
    text = lstrip(markdown)
    front = F.regexp_extract(text, r"(?s)\A---(.*?)\n---", 1)
    has_front = text.rlike(r"(?s)\A---.*?\n---") & (
        F.contains(front, F.lit("path:")) | F.contains(front, F.lit("bundle:"))
    )
    opened = F.when(has_front, F.regexp_replace(text, r"(?s)\A---.*?\n---\n*", "")).otherwise(text)
    label = rf"(?:{BUNDLE_LABEL}|{PATH_LABEL})"
    blank = r"[\t\x0b-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*+"
    title = r"\A(?:# [^\n]*(?:\n|\z))?+"
    labelled = rf"{title}(?:{blank}\n)*+{label}"
    heading = (
        rf"{title}(?:{blank}\n|{label}[^\n]*\n)*+(?:{label}[^\n]*\z|{blank}\z)?+\n*"
    )
    return (
        F.when(opened.rlike(labelled), F.regexp_replace(opened, heading, ""))
        .when(has_front, opened)
        .otherwise(markdown)
    )


def breadcrumb_markdown(path: Column, bundle: Column, title: Column, body: Column) -> Column:
    """Indexed text of a document, or the side text that stands for a file without a body."""
    title = F.coalesce(blank_to_null(strip(title)), F.lit("untitled"))
    path = F.coalesce(blank_to_null(strip(path)), title)
    parent = F.when(F.contains(path, F.lit("/")), F.regexp_extract(path, r"(?s)\A(.*)/", 1)).otherwise("")
    bundle = F.coalesce(blank_to_null(strip(bundle)), parent)
    clean = strip_breadcrumb(F.coalesce(body, F.lit("")))
    heading = F.concat(F.lit("# "), title, F.lit("\n\n"))
    bundle_line = F.when(bundle != "", F.concat(F.lit(f"{BUNDLE_LABEL} "), bundle, F.lit("\n\n"))).otherwise("")
    side = F.concat(
        heading,
        F.lit(f"{BUNDLE_LABEL} "), bundle, F.lit("\n"),
        F.lit(f"{PATH_LABEL} "), path, F.lit("\n\n"),
        F.lit(SIDECAR_OPENING), bundle, F.lit(SIDECAR_CLOSING),
    )
    return F.when(is_blank(clean), side).otherwise(F.concat(heading, bundle_line, lstrip(clean)))


def citation_label(name: Column, bundle: Column, path: Column, file_id: Column) -> Column:
    """A name that tells the document apart: bundle and name, or the path of a generic name."""

    def clean(col: Column) -> Column:
        return strip(F.coalesce(col, F.lit("")))

    name, bundle, path = clean(name), clean(bundle), clean(path)
    stem = F.lower(F.regexp_replace(name, r"\.[^.]*\z", ""))
    return (
        F.when(
            name == "",
            F.coalesce(blank_to_null(bundle), blank_to_null(file_id), F.lit(NAMELESS)),
        )
        .when(
            (bundle != "") & (bundle != name) & ~F.contains(name, bundle),
            F.concat(bundle, F.lit(" / "), name),
        )
        .when(bundle != "", name)
        .when(stem.isin(*GENERIC_NAMES) & (path != ""), path)
        .otherwise(name)
    )


def display_name(state_name: Column, hit_name: Column, file_id: Column, state_path: Column) -> Column:
    """Stored name, else the hit's, else the id; a bare object name gives way to the path."""
    shown = F.coalesce(blank_to_null(state_name), blank_to_null(hit_name), file_id)
    machine = shown.rlike(r"\.(?:pdf|md|txt|pptx|xlsx)\z") & blank_to_null(state_name).isNull()
    return F.when(machine, F.coalesce(blank_to_null(state_path), shown)).otherwise(shown)

"""The parse-quality gate and what its mode makes of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.options import GateOptions


def _number(value: float) -> str:
    return repr(value)


def evaluate_quality(metrics: DataFrame, opts: GateOptions = GateOptions()) -> DataFrame:
    """Add density, reasons, triggered and empty_text.

    ``metrics`` has text_length, source_bytes, table_count and tables_rendered. Density is 0
    without source bytes; a table loss is judged only where there are tables.
    """
    length, total = F.col("text_length"), F.col("table_count")
    density = F.when(F.col("source_bytes") > 0, length / F.col("source_bytes")).otherwise(0.0)
    lost = F.greatest(F.lit(0), total - F.col("tables_rendered"))
    ratio = lost / total
    thin = F.when(
        density < opts.density_threshold,
        F.concat(F.lit("G1_DENSITY:"), F.format_string("%.6f", density), F.lit(f"<{_number(opts.density_threshold)}")),
    )
    torn = F.when(
        (total > 0) & (ratio > opts.table_loss_ratio),
        F.concat(
            F.lit("G2_TABLE_LOST:"), lost.cast("string"), F.lit("/"), total.cast("string"), F.lit("="),
            F.format_string("%.3f", ratio), F.lit(f">{_number(opts.table_loss_ratio)}"),
        ),
    )
    empty = F.when(
        length < opts.min_text_length,
        F.concat(F.lit("EMPTY_TEXT:"), length.cast("string"), F.lit(f"<{opts.min_text_length}")),
    )
    return (
        metrics.withColumn("density", density)
        .withColumn("reasons", F.array_compact(F.array(thin, torn, empty)))
        .withColumn("triggered", F.size("reasons") > 0)
        .withColumn("empty_text", length < opts.min_text_length)
    )


def gate_disposition(triggered: Column, empty_text: Column, opts: GateOptions = GateOptions()) -> Column:
    """``pass``, ``logged``, ``fallback_requested`` or the kind of a rejection."""
    outcome = {
        "log": "logged",
        "reject": "QUALITY_GATE",
        "fallback": "fallback_requested" if opts.fallback_enabled else "logged",
    }[opts.mode]
    return F.when(~triggered, "pass").when(empty_text, "EMPTY_TEXT").otherwise(outcome)


def table_baseline(structural: Column, rendered: Column) -> Column:
    """Tables by structure; where they could not be counted, the rendered ones, so no loss shows."""
    return F.coalesce(structural, rendered)

"""Tables of HTML texts as cells of the grid.

One pattern cuts a text into the tags that matter and the text between them; comments and scripts fall
out. Which table, row and cell a piece belongs to follows from counts down the pieces of its text, which
windows over one text give. Only the place of a cell among the spans from above depends on the cells before
it; a fold over the cells of one table finds it. Nested tables are tables of their own with the cell that
holds them, so ``tables.fold_nested`` puts their texts into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import text

# A comment, a script or style with its content, a tag with quoted attributes, or text up to the next "<".
_PIECE = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
    r"|</?[a-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^<]++|<"
)
_TAG = r"(?is)\A<(/?)(table|tr|td|th)(?=[\s/>])"


def _span(tag: Column, name: str) -> Column:
    """Value of a span attribute, 1 where it is missing or no number above 1."""
    value = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*[\"']?\s*\+?(\d+)\s*[\"'\s>/]", 1)
    return F.greatest(F.lit(1), F.coalesce(value.try_cast("int"), F.lit(1)))


def html_pieces(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """(page_id, at, tag, opens, piece): tags of tables in order, and texts with ``tag`` blank."""
    pieces = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_PIECE), F.lit(0))
    holds = F.lower(html).contains("<table")
    cut = pages.filter(holds).select(page_id, F.posexplode(pieces).alias("at", "piece"))
    cell = F.lower(F.regexp_extract("piece", _TAG, 2))
    kept = cut.withColumn("tag", F.when(cell == "th", "td").otherwise(cell)).withColumn(
        "opens", F.regexp_extract("piece", _TAG, 1) == ""
    )
    is_text = ~F.col("piece").rlike(r"(?is)\A<(?:!--|/?[a-z])")
    return kept.filter((F.col("tag") != "") | is_text)


def html_cells(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """Cells of all tables: (page_id, table_no, parent_no, parent_cell, cell_no, row, text, row_span, col_span).

    A cell that is not closed ends with the next cell, row or table. Tables and cells count from 1 in the
    order in which they begin; ``parent_no`` and ``parent_cell`` name the cell a nested table lies in.
    White space runs are one blank, entities are decoded.
    """
    down = Window.partitionBy(page_id).orderBy("at")
    tag, opens = F.col("tag"), F.col("opens")
    step = F.when((tag == "table") & opens, 1).when(tag == "table", -1).otherwise(0)
    rows = html_pieces(pages, page_id, html).withColumn("depth", F.sum(step).over(down)).withColumn(
        "table_no", F.sum(F.when((tag == "table") & opens, 1).otherwise(0)).over(down)
    )
    # The innermost open table of a piece is the last one that began at its depth.
    at_depth = Window.partitionBy(page_id, "depth").orderBy("at")
    began = F.when((tag == "table") & opens, F.col("table_no"))
    rows = rows.withColumn("table_no", F.last(began, ignorenulls=True).over(at_depth)).filter("depth > 0 AND table_no IS NOT NULL")
    inside = Window.partitionBy(page_id, "table_no").orderBy("at")
    rows = rows.withColumn("row", F.count_if((tag == "tr") & opens).over(inside)).withColumn(
        "cell_no", F.count_if((tag == "td") & opens).over(inside)
    ).withColumn("in_cell", F.last(
        F.when((tag == "td") & opens, True).when(tag.isin("td", "tr"), False).when((tag == "table") & opens, False), ignorenulls=True
    ).over(inside))
    cells = rows.filter("in_cell").groupBy(page_id, "table_no", "cell_no").agg(
        F.min("row").alias("row"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(tag == "", F.struct("at", "piece")))), lambda p: p["piece"]), "").alias("text"),
        F.max(F.when(tag == "td", _span(F.col("piece"), "rowspan"))).alias("row_span"),
        F.max(F.when(tag == "td", _span(F.col("piece"), "colspan"))).alias("col_span"),
    )
    folded = text.strip(F.regexp_replace(text.html_unescape(F.col("text")), rf"[{text.WS}]+", " "))
    # A nested table opens inside a cell of the table one level up.
    levels = rows.select(page_id, "at", "depth", "table_no", "cell_no", "in_cell", "tag", "opens")
    openings = levels.filter((tag == "table") & opens).select(page_id, F.col("table_no").alias("t"), F.col("at").alias("t_at"), "depth")
    holders = levels.filter((tag == "td") & opens).select(
        F.col(page_id).alias("h_page"), (F.col("depth") + 1).alias("h_depth"), F.col("at").alias("h_at"),
        F.col("table_no").alias("parent_no"), F.col("cell_no").alias("parent_cell"),
    )
    nested = openings.filter("depth > 1").join(
        holders, (F.col(page_id) == F.col("h_page")) & (F.col("depth") == F.col("h_depth")) & (F.col("h_at") < F.col("t_at"))
    ).groupBy(page_id, F.col("t").alias("table_no")).agg(
        F.max_by(F.struct("parent_no", "parent_cell"), "h_at").alias("holder")
    ).select(page_id, "table_no", "holder.*")
    return cells.withColumn("text", folded).join(nested, [page_id, "table_no"], "left")


def placed_cells(cells: DataFrame, page_id: str) -> DataFrame:
    """(page_id, table_no, row_no, col_no, cell_text, row_span, col_span, cell_no, parent_no, parent_cell) from 1.

    A cell takes the first column of its row, after the cell before it, that no span from above holds.
    """
    start = F.struct(
        F.lit(-1).alias("row"), F.lit(1).alias("col"), F.array().cast("array<int>").alias("busy"),
        F.array().cast("array<int>").alias("cols"),
    )

    def step(state: Column, cell: Column) -> Column:
        first = F.when(cell["row"] == state["row"], state["col"]).otherwise(1)
        free = F.filter(
            F.sequence(first, F.greatest(first, F.size(state["busy"]) + 1)),
            lambda c: F.coalesce(F.get(state["busy"], c - 1), F.lit(-1)) < cell["row"],
        )
        col = F.get(free, F.lit(0))
        last, until = col + cell["col_span"] - 1, cell["row"] + cell["row_span"] - 1
        busy = F.transform(F.sequence(F.lit(1), F.greatest(F.size(state["busy"]), last)), lambda c: F.when(
            (c >= col) & (c <= last), F.greatest(F.coalesce(F.get(state["busy"], c - 1), F.lit(-1)), until)
        ).otherwise(F.coalesce(F.get(state["busy"], c - 1), F.lit(-1))))
        return F.struct(
            cell["row"].alias("row"), (last + 1).alias("col"), busy.alias("busy"),
            F.array_append(state["cols"], col).alias("cols"),
        )

    ordered = cells.groupBy(page_id, "table_no").agg(F.array_sort(F.collect_list(F.struct(
        "cell_no", F.col("row").cast("int").alias("row"), "row_span", "col_span", "text", "parent_no", "parent_cell"
    ))).alias("cells"))
    cols = F.aggregate("cells", start, step)["cols"]
    both = ordered.select(page_id, "table_no", F.array_min(F.transform("cells", lambda c: c["row"])).alias("top"),
                          F.inline(F.transform(F.arrays_zip(F.col("cells"), cols.alias("cols")), lambda z: F.struct(
                              z["cells"].alias("cell"), z["cols"].alias("col_no")))))
    return both.select(
        page_id, "table_no", (F.col("cell.row") - F.col("top") + 1).alias("row_no"), "col_no", F.col("cell.text").alias("cell_text"),
        F.col("cell.row_span").alias("row_span"), F.col("cell.col_span").alias("col_span"), F.col("cell.cell_no").alias("cell_no"),
        F.col("cell.parent_no").alias("parent_no"), F.col("cell.parent_cell").alias("parent_cell"),
    )


def _table_id(pages: DataFrame, page_id: str, table_no: Column) -> Column:
    if pages.schema[page_id].dataType.typeName() in ("long", "integer", "short", "byte"):
        return F.shiftleft(F.col(page_id).cast("long"), 24) + table_no
    return F.struct(page_id, table_no.alias("table_no"))


def html_tables(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Cells (table_id, row_no, col_no, cell_text, row_span, col_span) and nested tables for ``fold_nested``.

    A table's id is a number made of its page's and its own, or the struct of both where pages have no numbers.
    """
    own, other = (_table_id(pages, page_id, F.col(c)) for c in ("table_no", "parent_no"))
    placed = placed_cells(html_cells(pages, page_id, html), page_id).withColumn("table_id", own)
    holders = placed.select(
        F.col(page_id), F.col("table_no").alias("parent_no"), F.col("cell_no").alias("parent_cell"), "row_no", "col_no"
    )
    nested = placed.filter("parent_no IS NOT NULL").select(page_id, "table_no", "parent_no", "parent_cell").distinct().join(
        holders, [page_id, "parent_no", "parent_cell"]
    ).select(own.alias("table_id"), other.alias("parent_id"), "row_no", "col_no")
    return placed.select("table_id", "row_no", "col_no", "cell_text", "row_span", "col_span"), nested

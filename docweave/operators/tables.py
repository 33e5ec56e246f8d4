"""Table grids on a long table of cells.

Cells are rows (table_id, row_no, col_no, cell_text, row_span, col_span), numbered from 1. Grids
are kept by row, (table_id, row_no, texts), so that a row is shuffled once and not once for
each cell. A table may be of any size: rows are grouped on (table_id, row_no), and what needs an
order down a whole table uses the blocked forms of ``prefix`` or a bound that follows from the
size of its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import text
from docweave.operators import prefix
from docweave.session import cut_lineage

NESTED_SEPARATOR = " / "
# The marks of a cut and of a blank workbook.
TRUNCATED = "> (크기 상한에서 잘림 — 원본 일부만 색인됨)"
BLANK_WORKBOOK = "내용 없는 스프레드시트(빈 셀만)"

# --- Grids ---------------------------------------------------------------------------

def cell_rows(cells: DataFrame) -> DataFrame:
    """(table_id, row_no, cells): the cells of each row as one array, in any order."""
    return cells.groupBy("table_id", "row_no").agg(
        F.collect_list(F.struct("col_no", "cell_text", "row_span", "col_span")).alias("cells")
    )


def grid_rows(cells: DataFrame) -> DataFrame:
    """(table_id, row_no, texts) of all rows that a cell covers, gaps blank.

    A row span repeats the text downwards, a column span keeps it in its first column. Where
    spans overlap, the cell that comes first in row order wins.

    ``cells`` has a row for each cell, or a row for each table row with its cells as an array
    (``cell_rows``). Only the rows below a span add to those that are grouped, and a source that
    is partitioned by table is not shuffled again.
    """
    rows = cells if "cells" in cells.columns else cell_rows(cells)
    deepest = F.greatest(F.lit(1), F.array_max(F.col("cells")["row_span"]))
    down = rows.select("table_id", "row_no", "cells", F.explode(F.sequence(F.lit(0), deepest - 1)).alias("__down"))
    reaching = F.when(F.col("__down") == 0, F.col("cells")).otherwise(
        F.filter("cells", lambda c: c["row_span"] > F.col("__down"))
    )

    def slot(col: Column, cell: Column, value: Column) -> Column:
        return F.struct(col.alias("col"), F.col("row_no").alias("from_row"), cell["col_no"].alias("from_col"), value.alias("text"))

    own = F.transform("cells", lambda c: slot(c["col_no"], c, F.coalesce(c["cell_text"], F.lit(""))))
    further = F.flatten(F.transform(F.filter("cells", lambda c: c["col_span"] > 1), lambda cell: F.transform(
        F.sequence(cell["col_no"] + 1, cell["col_no"] + cell["col_span"] - 1), lambda c: slot(c, cell, F.lit(""))
    )))
    widest = F.array_max(F.col("cells")["col_span"])
    covered = down.select("table_id", "row_no", "__down", reaching.alias("cells")).select(
        "table_id", (F.col("row_no") + F.col("__down")).alias("__row"),
        F.when(widest > 1, F.concat(own, further)).otherwise(own).alias("slots"),
    )
    taken = covered.groupBy("table_id", F.col("__row").alias("row_no")).agg(
        F.array_sort(F.flatten(F.collect_list("slots"))).alias("slots")
    )

    def texts(winners: Column) -> Column:
        width = F.element_at(winners, -1)["col"]
        by_col = F.map_from_entries(F.transform(winners, lambda s: F.struct(s["col"], s["text"])))
        gapped = text.let(by_col, lambda m: F.transform(
            F.sequence(F.lit(1), width), lambda c: F.coalesce(F.element_at(m, c), F.lit(""))
        ))
        return F.when(F.size(winners) == width, winners["text"]).otherwise(gapped)

    winners = F.filter("slots", lambda s, i: (i == 0) | (F.get("slots", i - 1)["col"] != s["col"]))
    return taken.withColumn("slots", winners).select("table_id", "row_no", texts(F.col("slots")).alias("texts"))


def cells_of_rows(rows: DataFrame) -> DataFrame:
    return rows.select("table_id", "row_no", F.posexplode("texts").alias("__pos", "cell_text")).select(
        "table_id", "row_no", (F.col("__pos") + 1).alias("col_no"), "cell_text"
    )


def _padded(width: Column) -> Column:
    texts = F.coalesce("texts", F.array().cast("array<string>"))
    return F.concat(texts, F.array_repeat(F.lit(""), (width - F.size(texts)).cast("int")))


def dense_rows(rows: DataFrame) -> DataFrame:
    """The rows of each table's rectangle: all of one width, rows without cells blank.

    The rows are written once: the tables' sizes and the rows themselves are read from it.
    """
    kept = cut_lineage(rows)
    size = kept.groupBy("table_id").agg(
        F.max("row_no").alias("height"), F.max(F.size("texts")).alias("width"), F.count(F.lit(1)).alias("__rows")
    )
    padded = kept.join(size.select("table_id", "width"), "table_id").select(
        "table_id", "row_no", _padded(F.col("width")).alias("texts")
    )
    # Rows without cells are few, or none: only the tables that have such rows are listed.
    holed = size.filter("__rows < height")
    numbers = holed.select("table_id", "width", F.explode(F.sequence(F.lit(1), F.col("height").cast("int"))).alias("row_no"))
    blank = numbers.join(kept.select("table_id", "row_no"), ["table_id", "row_no"], "left_anti").select(
        "table_id", "row_no", F.array_repeat(F.lit(""), F.col("width").cast("int")).alias("texts")
    )
    return padded.unionByName(blank)


def _filled_columns(full: DataFrame) -> DataFrame:
    """(table_id, __columns): the numbers of the columns that any row fills, in order.

    They are gathered as bits of 64 columns each, so that a group holds one number and no list.
    """
    column = F.col("c") - 1
    words = full.select("table_id", F.explode("__filled").alias("c")).groupBy(
        "table_id", F.shiftright(column, 6).alias("word")
    ).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), column.bitwiseAND(63))).alias("bits"))
    numbers = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("bits", i) == 1)
    listed = words.select("table_id", "word", F.transform(numbers, lambda i: F.col("word") * 64 + i + 1).alias("cs"))
    return listed.groupBy("table_id").agg(
        F.flatten(F.array_sort(F.collect_list(F.struct("word", "cs")))["cs"]).alias("__columns")
    )


def trim_blank(rows: DataFrame) -> DataFrame:
    """Drop blank rows, blank columns and empty tables, and number the rows from 1.

    The filled columns of a row are an array of their numbers; a table's are the distinct union,
    no longer than the table is wide.
    """
    filled = F.filter(
        F.transform("texts", lambda t, i: F.when(~text.is_blank(t), i + 1)), lambda c: c.isNotNull()
    )
    # Written before the filter, which would have the texts made twice; read twice below.
    full = cut_lineage(rows.withColumn("__filled", filled)).filter(F.size("__filled") > 0)
    block = prefix.row_block("row_no")
    numbered = prefix.running_sum(full, ["table_id"], ["row_no"], F.lit(1), block, "__new", written=True)
    return numbered.join(_filled_columns(full), "table_id").select(
        "table_id", F.col("__new").cast("int").alias("row_no"),
        F.transform("__columns", lambda c: F.coalesce(F.get("texts", c - 1), F.lit(""))).alias("texts"),
    )


def fold_nested(cells: DataFrame, nested: DataFrame) -> DataFrame:
    """Cells of the outermost tables, with the texts of nested tables folded into them.

    ``nested`` has (table_id, parent_id, row_no, col_no): the nested table and the cell that holds
    it. All texts below one table of a cell are joined by slashes, in the order in which they are
    read: a cell's own text, then its nested tables. Each nested table is placed by the path of
    places that leads to it, so the texts are gathered once, for the outermost nested table. Levels
    of nesting are few, and one is resolved each round.
    """
    def place(row: str, col: str, table: str) -> Column:
        return F.struct(F.col(row).cast("long"), F.col(col).cast("long"), F.col(table).cast("long"))

    # Narrow, and read by every round and twice after them.
    held = cut_lineage(nested.select(
        "table_id", F.col("parent_id").alias("at_table"), F.col("row_no").alias("at_row"), F.col("col_no").alias("at_col")
    ))
    inner = held.select("table_id").distinct()
    # Tables of cells that are not nested themselves; then, round by round, those below them.
    level = held.join(inner.withColumnRenamed("table_id", "at_table"), "at_table", "left_anti").select(
        "table_id", "at_table", "at_row", "at_col", F.col("table_id").alias("top"), F.array().cast(
            "array<struct<r:bigint,c:bigint,t:bigint>>").alias("path")
    )
    placed, open_tables = level, held.join(level.select("table_id"), "table_id", "left_anti")
    while not open_tables.isEmpty():
        above = level.select(F.col("table_id").alias("below"), "at_table", "at_row", "at_col", "top", "path")
        inside = open_tables.select("table_id", F.col("at_table").alias("below"), F.col("at_row").alias("r"), F.col("at_col").alias("c"))
        level = cut_lineage(inside.join(above, "below").select(
            "table_id", "at_table", "at_row", "at_col", "top",
            F.array_append("path", place("r", "c", "table_id").cast("struct<r:bigint,c:bigint,t:bigint>")).alias("path"),
        ))
        if level.isEmpty():
            raise ValueError("nested tables contain themselves")
        placed = placed.unionByName(level)
        open_tables = open_tables.join(level.select("table_id"), "table_id", "left_anti")
    texts = cells.join(placed, "table_id").filter(~text.is_blank(F.col("cell_text"))).select(
        "at_table", "at_row", "at_col", "top", F.array_append("path", F.struct(
            F.col("row_no").cast("long").alias("r"), F.col("col_no").cast("long").alias("c"), F.lit(-1).cast("long").alias("t")
        )).alias("path"), text.strip(F.col("cell_text")).alias("t"),
    )
    folded = texts.groupBy("at_table", "at_row", "at_col", "top").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("path", "t")))["t"], NESTED_SEPARATOR).alias("folded")
    )
    into = folded.groupBy(
        F.col("at_table").alias("table_id"), F.col("at_row").alias("row_no"), F.col("at_col").alias("col_no")
    ).agg(F.array_join(F.array_sort(F.collect_list(F.struct("top", "folded")))["folded"], "\n").alias("folded"))
    outer = cells.join(inner, "table_id", "left_anti").join(into, ["table_id", "row_no", "col_no"], "left")
    own = text.blank_to_null(F.col("cell_text"))
    return outer.withColumn(
        "cell_text", F.coalesce(F.concat_ws("\n", own, F.col("folded")), F.lit(""))
    ).select(*cells.columns)


def fill_down(cells: DataFrame) -> DataFrame:
    """Blank cells inside a vertical span take the last text above them in their column.

    A real text wins over the span, and spans across columns are left alone.
    """
    block, keys = prefix.row_block("row_no"), ["table_id", "col_no"]
    own, last_row = text.blank_to_null(F.col("cell_text")), F.col("row_no") + F.col("row_span") - 1
    if prefix.in_one_block(cells, keys, block):
        # A cell lies inside a span if one that starts above reaches its row.
        column = Window.partitionBy(*keys).orderBy("row_no")
        reached = F.max(F.when(F.col("row_span") > 1, last_row)).over(column.rangeBetween(Window.unboundedPreceding, -1))
        filled = cells.withColumns({
            "__inside": reached >= F.col("row_no"),
            "__above": F.last(own, ignorenulls=True).over(column.rowsBetween(Window.unboundedPreceding, 0)),
        })
    else:
        inside = cells.filter(F.col("row_span") > 1).select(
            *keys, F.explode(F.sequence(F.col("row_no") + 1, last_row)).alias("row_no"), F.lit(True).alias("__inside"),
        ).distinct()
        joined = cells.join(inside, ["table_id", "row_no", "col_no"], "left")
        filled = prefix.last_value(joined, keys, ["row_no"], own, block, "__above")
    fill = F.coalesce("__inside", F.lit(False)) & (F.col("cell_text") == "")
    return filled.withColumn(
        "cell_text", F.when(fill, F.coalesce("__above", F.lit(""))).otherwise(F.col("cell_text"))
    ).select(*cells.columns)


# --- Rendering -----------------------------------------------------------------------

def rows_of_cells(cells: DataFrame) -> DataFrame:
    """(table_id, row_no, texts): the texts of each row in column order, gaps blank.

    ``cells`` is a row for each cell, or for each table row with its cells as an array.
    """
    rows = cells if "cells" in cells.columns else cells.groupBy("table_id", "row_no").agg(
        F.collect_list(F.struct("col_no", "cell_text")).alias("cells")
    )
    at, width = F.col("cells")["col_no"], F.array_max(F.col("cells")["col_no"]).cast("int")
    by_col = F.map_from_entries(F.transform("cells", lambda c: F.struct(c["col_no"], c["cell_text"])))
    gapped = text.let(by_col, lambda m: F.transform(
        F.sequence(F.lit(1), width), lambda c: F.coalesce(F.element_at(m, c), F.lit(""))
    ))
    whole = F.transform("cells", lambda c: F.coalesce(c["cell_text"], F.lit("")))
    in_order = at == F.sequence(F.lit(1), F.size("cells")).cast(rows.select(at).schema[0].dataType)
    return rows.select("table_id", "row_no", F.when(in_order, whole).otherwise(gapped).alias("texts"))


def _without_trailing_blanks(texts: Column) -> Column:
    filled = F.size(texts) - F.coalesce(
        F.nullif(F.array_position(F.transform(F.reverse(texts), lambda x: x != ""), True), F.lit(0)) - 1,
        F.size(texts),
    )
    return F.slice(texts, 1, filled.cast("int"))


def drop_trailing_blanks(rows: DataFrame) -> DataFrame:
    """Rows without blank cells at their right end; rows that become empty are dropped."""
    return rows.withColumn("texts", _without_trailing_blanks(F.col("texts"))).filter(F.size("texts") > 0)


def _line(texts: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(texts, " | "), F.lit(" |"))


def pad_rows(rows: DataFrame) -> DataFrame:
    """Rows of one width in each table, numbered so that the first is the table's header."""
    size = rows.groupBy("table_id").agg(F.max(F.size("texts")).alias("width"), F.min("row_no").alias("__first"))
    return rows.join(size, "table_id").select(
        "table_id", (F.col("row_no") - F.col("__first") + 1).alias("row_no"), _padded(F.col("width")).alias("texts")
    )


def render_lines(rows: DataFrame) -> DataFrame:
    """(table_id, line_no, line) of rows of one width: row 1 is the header, a rule follows it.

    Lines stay rows here, so that a table too big for one text can still be cut by a budget.
    """
    rule = _line(F.transform("texts", lambda _: F.lit("---")))
    parts = F.when(F.col("row_no") == 1, F.array(_line(F.col("texts")), rule)).otherwise(F.array(_line(F.col("texts"))))
    return rows.select("table_id", "row_no", F.posexplode(parts).alias("__part", "line")).select(
        "table_id",
        # Row r is line r + 1, but for the header, whose rule is line 2.
        (F.when(F.col("row_no") == 1, F.col("__part")).otherwise(F.col("row_no")) + 1).cast("bigint").alias("line_no"),
        "line",
    )


def whole_tables(rows: DataFrame) -> DataFrame:
    """(table_id, markdown, tokens) of tables that are one text each, from rows of one width.

    Each row gives one text, the first with its rule, so that rows are gathered once and not line by line.
    """
    rule = _line(F.transform("texts", lambda _: F.lit("---")))
    line = F.when(F.col("row_no") == 1, F.concat_ws("\n", _line(F.col("texts")), rule)).otherwise(_line(F.col("texts")))
    return rows.select("table_id", "row_no", "texts", line.alias("line")).groupBy("table_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("row_no", "line")))["line"], "\n").alias("markdown"),
        F.flatten(F.collect_list("texts")).alias("tokens"),
    )


def within_cell_budget(rows: DataFrame, max_cells: int) -> DataFrame:
    """Rows read before the cells of a table's earlier rows have used the budget up.

    Adds ``cells_cut``, true for all rows of a table whose budget ran out.
    """
    block = prefix.row_block("row_no")
    upto = prefix.running_sum(rows, ["table_id"], ["row_no"], F.size("texts"), block, "__upto")
    total = rows.groupBy("table_id").agg((F.sum(F.size("texts")) >= max_cells).alias("cells_cut"))
    kept = upto.filter(F.col("__upto") - F.size("texts") < max_cells).drop("__upto")
    return kept.join(total, "table_id")


PART_BYTES = 8 * 1024 * 1024


def assemble(lines: DataFrame, keys: list[str], order: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Texts of tables (keys, part_no, markdown): a table too large for one text has several parts.

    Every part but the first repeats the header, the lines numbered 1 and 2. No line is left out,
    and no task holds more than a part. Tables that fit one part, as most do, are joined at once.
    """
    kept = cut_lineage(lines)
    numbered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("__no"), "line")))
    joined = F.array_join(numbered["line"], "\n")
    size = F.sum((F.octet_length("line") + 1).cast("long"))
    large = cut_lineage(kept.groupBy(*keys).agg(size.alias("__size")).filter(F.col("__size") > part_bytes).select(*keys))
    if large.isEmpty():
        return kept.groupBy(*keys).agg(joined.alias("markdown")).select(*keys, F.lit(0).alias("part_no"), "markdown")
    # No more of them than parts of such size in all.
    fitting, rest = (kept.join(F.broadcast(large), keys, how) for how in ("left_anti", "left_semi"))
    texts = fitting.groupBy(*keys).agg(joined.alias("markdown")).select(*keys, F.lit(0).alias("part_no"), "markdown")
    block = prefix.row_block(order)
    upto = prefix.running_sum(rest, keys, [order], (F.octet_length("line") + 1).cast("long"), block, "__upto", written=True)
    parted = upto.withColumn("part_no", F.floor((F.col("__upto") - 1) / part_bytes).cast("int"))
    heads = parted.filter(F.col(order) <= 2).select(*keys, F.struct(F.col(order).alias("__no"), "line").alias("__head")).groupBy(*keys).agg(
        F.array_sort(F.collect_list("__head"))["line"].alias("__head")
    )
    parts = parted.groupBy(*keys, "part_no").agg(joined.alias("__text"), F.min(order).alias("__from"))
    headed = F.when(F.col("__from") > 2, F.array_join(F.array_append("__head", F.col("__text")), "\n")).otherwise(F.col("__text"))
    return texts.unionByName(parts.join(heads, keys).select(*keys, "part_no", headed.alias("markdown")))


def _within_book_budget(rows: DataFrame, max_cells: int) -> DataFrame:
    """Rows read before the cells of a workbook's earlier rows have used the budget up, without blank right ends.

    Adds ``cells_cut``. A block of a sheet is one row, with the few of its rows that the budget may reach,
    and of a workbook's blocks no more are looked at than the budget has cells.
    """
    cells, sheet = F.size("texts"), ["book_id", "sheet_no"]
    in_block = Window.partitionBy(*sheet, "__block").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.filter(cells > 0).withColumn("__block", prefix.row_block("row_no")).withColumns(
        {"__cells": cells, "__before": F.sum(cells).over(in_block) - cells}
    ).filter(F.col("__before") < max_cells)
    blocks = counted.withColumn("texts", _without_trailing_blanks(F.col("texts"))).groupBy(*sheet, "title", "__block").agg(
        F.sum("__cells").alias("__cells"),
        F.collect_list(F.when(F.size("texts") > 0, F.struct("row_no", "__before", "texts"))).alias("__rows"),
    )
    in_book = Window.partitionBy("book_id").orderBy("sheet_no", "__block")
    first = blocks.withColumn("__rank", F.row_number().over(in_book)).filter(F.col("__rank") <= max_cells)
    spent = first.withColumns({
        "__spent": F.coalesce(F.sum("__cells").over(in_book.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "cells_cut": F.sum("__cells").over(Window.partitionBy("book_id")) >= max_cells,
    })
    reached = F.filter("__rows", lambda r: F.col("__spent") + r["__before"] < max_cells)
    return spent.select(*sheet, "title", "cells_cut", F.explode(reached).alias("row")).select(
        *sheet, "title", "cells_cut", "row.row_no", "row.texts"
    )


def workbook_markdown(
    sheets: DataFrame, rows: DataFrame, max_cells: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """(book_id, markdown, error) of workbooks, whole unless the caller sets a budget.

    ``sheets`` has (book_id, sheet_no, title), ``rows`` (book_id, sheet_no, row_no, texts) with every
    row read, blank ones too, and may have the title of its sheet, which is met otherwise. A title line
    is set only where a workbook has more than one sheet. A workbook without any text is an error.
    """
    books = sheets.groupBy("book_id").agg(F.count(F.lit(1)).alias("sheet_count"))
    if "title" not in rows.columns:
        rows = rows.join(sheets, ["book_id", "sheet_no"])
    if max_cells:
        read = _within_book_budget(rows, max_cells)
    else:
        read = drop_trailing_blanks(rows).withColumn("cells_cut", F.lit(False))
    in_sheet = Window.partitionBy("book_id", "sheet_no")
    dense = read.withColumn("__width", F.max(F.size("texts")).over(in_sheet)).select(
        "book_id", "sheet_no", "title", "cells_cut",
        F.row_number().over(in_sheet.orderBy("row_no")).alias("row_no"), _padded(F.col("__width")).alias("texts"),
    )
    body = render_lines(dense.withColumn("table_id", F.struct("book_id", "sheet_no", "title", "cells_cut")))
    joined = body.select("table_id.*", "line_no", "line").join(books, "book_id")
    first_line = F.col("line_no") == 1
    title = F.concat(F.lit("## "), "title")
    parts = F.when(first_line & (F.col("sheet_count") > 1), F.array(title, F.col("line"))).otherwise(F.array("line"))
    lines = joined.select("book_id", "sheet_no", "cells_cut", "line_no", F.posexplode(parts).alias("part", "line"))
    in_book = Window.partitionBy("book_id")
    down = in_book.orderBy("sheet_no", "line_no", "part").rowsBetween(Window.unboundedPreceding, 0)
    used = lines.withColumn("__used", F.sum(F.octet_length("line") + 1).over(down)).withColumn(
        "__lead", F.min("sheet_no").over(in_book)
    )
    # An empty line divides a sheet from the one before.
    opens = first_line & (F.col("part") == 0) & (F.col("sheet_no") != F.col("__lead"))
    spaced = F.when(opens, F.concat(F.lit("\n"), "line")).otherwise(F.col("line")).alias("line")
    most_bytes = F.lit(max_bytes or (1 << 62))
    inside = F.when(F.col("__used") <= most_bytes, F.struct("sheet_no", "line_no", "part", spaced))
    texts = used.groupBy("book_id").agg(
        F.array_join(F.array_sort(F.collect_list(inside))["line"], "\n").alias("__text"),
        (F.max("__used") > most_bytes).alias("bytes_cut"), F.max("cells_cut").alias("cells_cut"),
    )
    out = books.join(texts, "book_id", "left")
    cut = F.coalesce("cells_cut", F.lit(False)) | F.coalesce("bytes_cut", F.lit(False))
    empty = F.col("__text").isNull()
    return out.select(
        "book_id",
        F.when(empty, F.lit(None)).when(cut, F.concat("__text", F.lit(f"\n\n{TRUNCATED}"))).otherwise(F.col("__text")).alias("markdown"),
        F.when(empty, BLANK_WORKBOOK).alias("error"),
    )


# --- Tables inside Markdown texts ----------------------------------------------------

_LOOSE_ROW = rf"[{text.WS}&&[^{text.LINE_END}]]*+\|[^{text.LINE_END}]*+(?:{text.LINE_BREAK}|\z)"
LOOSE_BLOCK = rf"(?<![^{text.LINE_END}])(?:{_LOOSE_ROW})++"


def broken_tables(markdown: Column) -> Column:
    """Blocks of bar lines whose bar counts differ or that lack a rule."""
    blocks = F.regexp_extract_all(F.coalesce(markdown, F.lit("")), F.lit(LOOSE_BLOCK), F.lit(0))

    def is_broken(block: Column) -> Column:
        widths = F.transform(text.lines(block), lambda line: F.regexp_count(line, F.lit(r"\|")))
        return (F.size(F.array_distinct(widths)) != 1) | ~F.contains(block, F.lit("---"))

    return F.size(F.filter(blocks, is_broken))


def _torn_lines(rows: Column) -> Column:
    """Numbers of the lines that continue the table row above them.

    A table starts at a line with a bar in front whose paragraph has a rule at or below it; the
    rule's bars are the width. A row is open while it has fewer bars than that, and takes the
    following lines of its paragraph. Only the width, the bars that the open row still lacks and the
    numbers found are carried from line to line.
    """
    def bars(line: Column) -> Column:
        return F.regexp_count(line, F.lit(r"\|"))

    def is_rule(line: Column) -> Column:
        return F.contains(line, F.lit("---")) & F.contains(line, F.lit("|"))

    facts = F.transform(rows, lambda line, i: F.struct(
        i.alias("no"), bars(line).alias("bars"), text.is_blank(line).alias("blank"),
        F.startswith(text.lstrip(line), F.lit("|")).alias("opens"), is_rule(line).alias("rule"),
    ))
    # What ends the search for a rule: the first rule, or the blank line that ends the paragraph.
    stops = text.let(facts, lambda all_: F.struct(all_.alias("lines"), F.filter(all_, lambda x: x["rule"] | x["blank"]).alias("stops")))

    def fold(found: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("width"), F.lit(0).alias("lacks"), F.array().cast("array<int>").alias("torn")
        )

        def step(state: Column, line: Column) -> Column:
            joins = (state["lacks"] > 0) & ~line["blank"]
            ahead = F.get(F.filter(found["stops"], lambda x: x["no"] >= line["no"]), F.lit(0))
            width = F.when((state["width"] > 0) & (state["lacks"] <= 0), state["width"]).otherwise(
                F.coalesce(F.when(~ahead["blank"], ahead["bars"]), F.lit(0))
            )
            width = F.when(line["opens"], F.when(width >= 2, width).otherwise(0)).otherwise(0)
            return F.when(joins, F.struct(
                state["width"].alias("width"), (state["lacks"] - line["bars"]).alias("lacks"),
                F.array_append(state["torn"], line["no"]).alias("torn"),
            )).otherwise(F.struct(
                width.alias("width"), F.when(width > 0, width - line["bars"]).otherwise(0).alias("lacks"),
                state["torn"].alias("torn"),
            ))

        return F.aggregate(found["lines"], start, step, lambda state: state["torn"])

    return text.let(stops, fold)


def rejoin_split_rows(markdown: Column) -> Column:
    """Join table rows that line ends inside cells have torn, up to the rule's bar count.

    A text stays as it is if joining gives no line that it does not have already.
    """
    def joined(found: Column) -> Column:
        rows, torn = found["rows"], found["torn"]
        whole = F.array_join(F.transform(rows, lambda line, i: F.concat(
            F.when(F.array_contains(torn, i), " ").when(i > 0, "\n").otherwise(""),
            F.when(F.array_contains(torn, i), text.strip(line))
            .when(F.array_contains(torn, i + 1), text.lstrip(line)).otherwise(line),
        )), "")
        return text.let(F.struct(whole.alias("whole"), rows.alias("rows")), lambda f: F.when(
            F.size(F.array_except(F.split(f["whole"], "\n", -1), f["rows"])) > 0, f["whole"]
        ))

    rows = text.lines(markdown)
    found = text.let(rows, lambda r: F.struct(r.alias("rows"), _torn_lines(r).alias("torn")))
    changed = text.let(found, lambda f: F.when(F.size(f["torn"]) > 0, joined(f)))
    has_rule = F.contains(markdown, F.lit("---")) & F.contains(markdown, F.lit("|"))
    return F.coalesce(F.when(has_rule, changed), markdown)


_TOKEN_MARK = "\x01"  # no white space, no mark, never part of a composition


def lost_cells(tokens: Column, canonical: Column) -> Column:
    """Number of canonical cell texts that are not part of a canonical rendering."""
    pair = F.struct(tokens.alias("tokens"), canonical.alias("whole"))
    return text.let(pair, lambda p: F.size(
        F.filter(p["tokens"], lambda t: (t != "") & ~F.contains(p["whole"], t))
    ))


def best_rendering(candidates: DataFrame) -> DataFrame:
    """For each document the rendering with the fewest lost cells, then broken tables.

    ``candidates`` has (doc_id, priority, markdown, tokens); priority 0 is the original, which
    stays unless another one is strictly better.
    """
    # All cell texts of a document are folded in one pass, held apart by a mark.
    folded = candidates.withColumns({
        "__tokens": text.canonical(F.array_join("tokens", _TOKEN_MARK)),
        "__whole": text.canonical(F.col("markdown")),
    })
    scored = folded.withColumns({
        "lost": lost_cells(F.split("__tokens", _TOKEN_MARK, -1), F.col("__whole")),
        "broken": broken_tables(F.col("markdown")),
    })
    rank = F.struct("lost", "broken", "priority")
    base = F.when(F.col("priority") == 0, F.struct("lost", "broken"))
    best = scored.groupBy("doc_id").agg(
        F.min_by(F.struct("markdown", "lost", "broken", "priority"), rank).alias("best"), F.max(base).alias("base")
    )
    return best.select(
        "doc_id", "best.markdown", "best.priority",
        (F.col("base.lost") - F.col("best.lost")).alias("cells_recovered"),
        (F.col("base.broken") - F.col("best.broken")).alias("tables_repaired"),
    )


def table_counts(tables: DataFrame) -> DataFrame:
    """Tables of each document's body, nested ones and those of headers and notes aside."""
    body = (F.col("depth") == 0) & (F.col("part") == "body")
    return tables.groupBy("doc_id").agg(F.count_distinct(F.when(body, F.col("table_id"))).alias("table_count"))

"""Table grids and table texts on literal rows."""

import pytest
from pyspark.sql import functions as F

from docweave.operators import tables


def cells(spark, rows):
    """Rows (row_no, col_no, text[, row_span, col_span]) of table 1."""
    full = [(1, *(row if len(row) == 5 else (*row, 1, 1))) for row in rows]
    return spark.createDataFrame(
        full, "table_id int, row_no int, col_no int, cell_text string, row_span int, col_span int"
    )


def grid(frame):
    rows = {}
    for r in frame.orderBy("row_no", "col_no").collect():
        rows.setdefault(r.row_no, []).append(r.cell_text)
    return list(rows.values())


def test_spans_holes_and_collisions(spark):
    frame = cells(spark, [(1, 1, "a", 2, 1), (1, 2, "b", 1, 2), (2, 1, "hidden"), (2, 3, "c"), (4, 2, "d")])
    assert grid(tables.cells_of_rows(tables.dense_rows(tables.grid_rows(frame)))) == [["a", "b", ""], ["a", "", "c"], ["", "", ""], ["", "d", ""]]
    assert grid(tables.cells_of_rows(tables.trim_blank(tables.grid_rows(frame)))) == [["a", "b", ""], ["a", "", "c"], ["", "d", ""]]
    assert grid(tables.cells_of_rows(tables.trim_blank(tables.grid_rows(cells(spark, [(1, 1, " ")]))))) == []


def test_rows_of_cells_make_the_same_grid_for_less(spark):
    """A grid sorts and groups rows, not cells: no cell is a row of the plan, and no map is built for a full row."""
    frame = cells(spark, [(1, 1, "a", 2, 1), (1, 2, "b", 1, 2), (2, 1, "hidden"), (2, 3, "c"), (4, 2, "d", 3, 2), (5, 3, "e"), (5, 5, "f")])
    by_cell, by_row = tables.grid_rows(frame), tables.grid_rows(tables.cell_rows(frame))
    want = {(1, ("a", "b", "")), (2, ("a", "", "c")), (4, ("", "d", "")), (5, ("", "d", "", "", "f")), (6, ("", "d", ""))}
    assert {(r.row_no, tuple(r.texts)) for r in by_cell.collect()} == {(r.row_no, tuple(r.texts)) for r in by_row.collect()} == want
    assert [r["__columns"] for r in tables._filled_columns(spark.createDataFrame(
        [(1, [70, 2]), (1, [64, 2, 65]), (1, [130])], "table_id int, __filled array<int>")).collect()] == [[2, 64, 65, 70, 130]]


def test_a_view_of_tables_is_grouped_where_it_lies(spark):
    """The rows of a table that the view has brought together are shuffled once, and only rows are."""
    from docweave.sources.views import Tables

    plan = tables.grid_rows(Tables(spark, "/root/testdata/sf0.001").v_cell_rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Generate") == 1


def test_groups_of_one_block_are_not_joined(spark):
    """Where no group reaches a second block, nothing is handed over and no join is planned."""
    from docweave.operators import prefix

    rows = spark.range(0, 20).selectExpr("id % 4 AS k", "CAST(id AS INT) AS n")
    short = prefix.running_sum(rows, ["k"], ["n"], F.lit(1), prefix.row_block("n"), "s")
    assert "Join" not in short._jdf.queryExecution().optimizedPlan().toString()
    long = prefix.running_sum(rows, ["k"], ["n"], F.lit(1), F.floor(F.col("n") / 8), "s")
    assert sorted(tuple(r) for r in short.collect()) == sorted(tuple(r) for r in long.collect())


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_spans_are_filled_without_a_join(spark, monkeypatch):
    """Columns of one block need one window; longer ones, in blocks, give the same."""
    from docweave.operators import prefix

    frame = cells(spark, [
        (1, 1, "a", 3, 1), (2, 1, ""), (3, 1, ""), (4, 1, ""), (5, 1, "b", 2, 1), (6, 1, ""), (7, 1, ""), (8, 1, "", 2, 1), (9, 1, ""),
    ])
    short = tables.fill_down(frame)
    assert "Join" not in plan_of(short)
    want = [["a"], ["a"], ["a"], [""], ["b"], ["b"], [""], [""], ["b"]]
    assert grid(short) == want
    monkeypatch.setattr(prefix, "BLOCK_ROWS", 2)
    assert grid(tables.fill_down(frame)) == want


def test_whole_tables_are_gathered_once(spark):
    frame = cells(spark, [(1, 1, "h"), (1, 2, "i"), (2, 2, "가"), (4, 1, "z")])
    whole = tables.whole_tables(tables.trim_blank(tables.grid_rows(frame)))
    row = whole.first()
    assert row.markdown == "| h | i |\n| --- | --- |\n|  | 가 |\n| z |  |"
    assert sorted(row.tokens) == ["", "", "h", "i", "z", "가"]


def test_a_workbook_without_a_budget_adds_up_nothing(spark, monkeypatch):
    """Where no cells are counted, no running sum is written."""
    from docweave.operators import prefix

    sheets = spark.createDataFrame([(1, 1, "s")], "book_id int, sheet_no int, title string")
    rows = spark.createDataFrame([(1, 1, 1, ["a", ""])], "book_id int, sheet_no int, row_no int, texts array<string>")
    limited = tables.workbook_markdown(sheets, rows, max_cells=9).collect()
    monkeypatch.setattr(prefix, "running_sum", None)
    assert tables.workbook_markdown(sheets, rows).collect() == limited
    assert limited[0].markdown == "| a |\n| --- |"


def test_a_budget_sends_each_row_once(spark, monkeypatch):
    """Rows that have their sheet's title go to their book once, a row for each block of a sheet, and are not written."""
    monkeypatch.setattr(tables, "cut_lineage", None)
    sheets = spark.createDataFrame([(1, n, f"s{n}") for n in range(1, 9)] + [(2, 9, "s9")], "book_id int, sheet_no int, title string")
    rows = spark.createDataFrame(
        [(1, n, f"s{n}", r, [f"{n}.{r}", ""]) for n in range(1, 9) for r in range(1, 4)]
        + [(2, 9, "s9", r, ["", ""]) for r in range(1, 3)] + [(2, 9, "s9", 3, ["x"])],
        "book_id int, sheet_no int, title string, row_no int, texts array<string>",
    ).repartition(4, "sheet_no")
    limited = tables.workbook_markdown(sheets, rows, max_cells=9)
    got = {r.book_id: r.markdown for r in limited.collect()}
    # Nine cells end in the second row of the second sheet; blank rows are cells as well.
    assert got == {
        1: f"## s1\n| 1.1 |\n| --- |\n| 1.2 |\n| 1.3 |\n\n## s2\n| 2.1 |\n| --- |\n| 2.2 |\n\n{tables.TRUNCATED}", 2: "| x |\n| --- |",
    }
    assert {r.book_id: r.markdown for r in tables.workbook_markdown(sheets, rows, max_cells=4).collect()}[2] is None
    plan = limited._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_nested_places_are_read_once(spark):
    """Each round of nesting reads the places it was given, and does not make them again."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    frame = cells(spark, [(1, 1, "top")]).select("table_id", "row_no", "col_no", "cell_text")
    deep = frame.unionByName(spark.createDataFrame([(n, 1, 1, f"t{n}") for n in range(2, 6)], frame.schema))
    links = spark.createDataFrame([(n, n - 1, 1, 1) for n in range(2, 6)], "table_id int, parent_id int, row_no int, col_no int")
    folded = tables.fold_nested(deep, links.mapInArrow(count, links.schema))
    assert grid(folded) == [["top\nt2 / t3 / t4 / t5"]] and made.value == 4


def test_nested_tables(spark):
    rows = [(1, 1, 1, "부모"), (1, 1, 2, ""), (2, 1, 1, " x "), (2, 1, 2, ""), (2, 2, 1, "y"), (3, 1, 1, "z")]
    frame = spark.createDataFrame(rows, "table_id int, row_no int, col_no int, cell_text string")
    links = spark.createDataFrame([(2, 1, 1, 2), (3, 2, 1, 2)], "table_id int, parent_id int, row_no int, col_no int")
    assert grid(tables.fold_nested(frame, links)) == [["부모", "x / z / y"]]


def test_nested_tables_in_filled_cells(spark):
    """A cell's own text comes before the tables in it, at every depth; two tables of a cell are two lines."""
    rows = [(1, 1, 1, "top"), (2, 1, 1, "x"), (2, 1, 2, "w"), (2, 2, 1, "y"), (3, 1, 1, "z"), (4, 1, 1, "v"), (5, 1, 1, "u")]
    frame = spark.createDataFrame(rows, "table_id int, row_no int, col_no int, cell_text string")
    links = spark.createDataFrame(
        [(2, 1, 1, 1), (3, 2, 1, 2), (4, 3, 1, 1), (5, 1, 1, 1)], "table_id int, parent_id int, row_no int, col_no int"
    )
    assert grid(tables.fold_nested(frame, links)) == [["top\nx / w / z / v / y\nu"]]
    loop = spark.createDataFrame([(2, 1, 1, 1), (3, 4, 1, 1), (4, 3, 1, 1)], links.schema)
    with pytest.raises(ValueError):
        tables.fold_nested(frame, loop)


def test_fill_down(spark):
    frame = cells(spark, [(1, 1, "head"), (2, 1, "분류", 3, 1), (3, 1, ""), (4, 1, "real"), (5, 1, ""), (2, 2, "w", 1, 2), (2, 3, "")])
    got = {(r.row_no, r.col_no): r.cell_text for r in tables.fill_down(frame).collect()}
    assert got[3, 1] == "분류" and got[4, 1] == "real" and got[5, 1] == "" and got[2, 3] == ""


def test_rendering_and_budgets(spark):
    frame = tables.rows_of_cells(cells(spark, [(1, 1, "h"), (2, 1, "a"), (2, 2, "가"), (3, 1, ""), (4, 3, "z")]))
    lines = tables.render_lines(tables.pad_rows(tables.drop_trailing_blanks(frame)))
    whole = tables.assemble(lines, ["table_id"], "line_no").first().markdown
    assert whole == "| h |  |  |\n| --- | --- | --- |\n| a | 가 |  |\n|  |  | z |"
    parts = tables.assemble(lines, ["table_id"], "line_no", part_bytes=52).orderBy("part_no").collect()
    head = "| h |  |  |\n| --- | --- | --- |\n"
    assert [p.markdown for p in parts] == [head + "| a | 가 |  |", head + "|  |  | z |"]
    rows = tables.within_cell_budget(frame, 3)
    assert sorted((r.row_no, r.cells_cut) for r in rows.collect()) == [(1, True), (2, True)]


def test_a_table_over_one_part_loses_no_line(spark):
    """About 9 MB of rows: every line is in one part, and each part starts with the header."""
    rows = spark.range(1, 90_001).select(
        F.lit(1).alias("table_id"), F.col("id").cast("int").alias("row_no"),
        F.array(F.concat(F.lit("row "), F.col("id")), F.lit("x" * 90)).alias("texts"),
    )
    parts = tables.assemble(tables.render_lines(rows), ["table_id"], "line_no").orderBy("part_no").collect()
    assert len(parts) == 2
    split = [p.markdown.split("\n") for p in parts]
    assert split[0][:2] == split[1][:2]
    body = [line for lines in split for line in lines[2:]]
    assert len(body) == 89_999 and len(set(body)) == 89_999


def test_workbooks(spark):
    sheets = spark.createDataFrame([(1, 1, "가"), (1, 2, "빈"), (1, 3, "나"), (2, 1, "S"), (3, 1, "S")], "book_id int, sheet_no int, title string")
    rows = spark.createDataFrame(
        [(1, 1, 1, ["a", ""]), (1, 2, 1, [""]), (1, 3, 2, ["b"]), (2, 1, 1, ["c"]), (3, 1, 1, ["", ""])],
        "book_id int, sheet_no int, row_no int, texts array<string>",
    )
    got = {r.book_id: (r.markdown, r.error) for r in tables.workbook_markdown(sheets, rows).collect()}
    assert got == {
        1: ("## 가\n| a |\n| --- |\n\n## 나\n| b |\n| --- |", None), 2: ("| c |\n| --- |", None), 3: (None, tables.BLANK_WORKBOOK),
    }


@pytest.mark.parametrize("markdown, broken", [
    ("| a | b |\n| --- | --- |\n| 1 | 2 |", 0), ("| a | b |\n| 1 | 2 |", 1), ("| a | b |\n| --- | --- |\n| 1 |", 1),
    ("text", 0), (" | a |\n | --- |\n\n| x", 1), ("| a |\n" * 5000, 1),
])
def test_broken(one, markdown, broken):
    assert one(tables.broken_tables(F.col("m")), m=markdown) == broken


@pytest.mark.parametrize("markdown, joined", [
    ("| name | n |\n| --- | --- |\n| two\nwords | 7 |\nend", "| name | n |\n| --- | --- |\n| two words | 7 |\nend"),
    ("| k | v |\n|---|---|\n  | one \n two \n three | 3 |\n| q | 4 |", "| k | v |\n|---|---|\n| one  two three | 3 |\n| q | 4 |"),
    ("| k | v |\n| --- | --- |\n| p q | 1 |\n\n| k | v |\n| --- | --- |\n| p\nq | 1 |\n",
     "| k | v |\n| --- | --- |\n| p q | 1 |\n\n| k | v |\n| --- | --- |\n| p\nq | 1 |\n"),
    ("| open\n| --- |\n| x |", "| open | --- |\n| x |"),
    ("| a | b |\n| --- | --- |\n| 1 | 2 |\n", "| a | b |\n| --- | --- |\n| 1 | 2 |\n"),
    ("| a\nb |", "| a\nb |"),
    ("| a | b |\n| --- | --- |\n| 1\n\n| 2 | 3 |", "| a | b |\n| --- | --- |\n| 1\n\n| 2 | 3 |"),
    ("앞 --- |\n| h | i |\n| --- | --- |\n| x\n  y\nz | w |", "앞 --- |\n| h | i |\n| --- | --- |\n| x y z | w |"),
])
def test_rejoin(one, markdown, joined):
    assert one(tables.rejoin_split_rows(F.col("m")), m=markdown) == joined


def test_repair_choice(spark):
    good, torn = "| 가 | 나 |\n| --- | --- |\n| 1 | 2 |", "| 가 |\n| --- |\n| 1 |"
    rows = [
        (1, 0, good), (1, 1, good), (2, 0, torn), (2, 1, good), (3, 0, good), (3, 1, torn),
        (4, 0, torn), (4, 1, torn), (4, 2, good),
    ]
    frame = spark.createDataFrame(rows, "doc_id int, priority int, markdown string").withColumn(
        "tokens", F.array(*[F.lit(x) for x in ("가", "*나*", " 1", "2", "*")])
    )
    got = {r.doc_id: (r.priority, r.cells_recovered) for r in tables.best_rendering(frame).collect()}
    assert got == {1: (0, 0), 2: (1, 2), 3: (0, 0), 4: (2, 2)}


def test_counts_leave_nested_tables_out(spark):
    rows = [(1, 1, 0, "body"), (1, 2, 1, "body"), (1, 3, 0, "furniture"), (2, 4, 1, "body")]
    frame = spark.createDataFrame(rows, "doc_id int, table_id int, depth int, part string")
    assert {r.doc_id: r.table_count for r in tables.table_counts(frame).collect()} == {1: 1, 2: 0}

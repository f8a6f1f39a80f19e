"""Workbooks to text: cells to lines, lines to chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.functions.text import as_column, shorten
from attestry.operators.running import cut_in_chunks, with_totals_before

# How the parts of a workbook are put together.
SHEET_HEADER = "=== Sheet: {sheet} ==="
PART_SEPARATOR = "\n\n"
ROW_SEPARATOR = "\n"
CELL_SEPARATOR = " "
MISSING_CELL = "NaN"
UNNAMED_COLUMN = "Unnamed: "
CUT_MARK = "..."

# Characters of one chunk of text.
CHUNK_CHARS = 65_536


def bound_cell(cell: Column | str, max_chars: int | None = None) -> Column:
    return shorten(as_column(cell), max_chars)


def shown_cell(cell: Column | str, max_chars: int | None = None) -> Column:
    """A cell as it stands in a line: line breaks and tabs escaped, long ones cut with dots."""
    text = as_column(cell)
    for plain, escaped in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    if max_chars is None:
        return text
    cut = F.concat(F.substring(text, 1, max_chars - len(CUT_MARK)), F.lit(CUT_MARK))
    return F.when(F.length(text) > max_chars, cut).otherwise(text)


def row_texts(
    cells: DataFrame,
    max_cell_chars: int | None = None,
    header_row: int = 1,
) -> DataFrame:
    """Lines of every sheet, from ``(file, sheet_no, sheet, row_no, col_no, cell)``.

    Columns are numbered from 1 and as many as the largest number of the sheet. The
    row ``header_row`` names them; a column without a name is ``Unnamed: k`` (k
    from 0). Every line holds all columns, right-aligned to the widest value,
    with ``NaN`` for a cell that is missing. A sheet without rows below its header
    has no lines, nor has a row without cells. Equal cell numbers: the last value
    in text order stays.

    Cells are gathered row by row; widths are one small table, one row per sheet.
    Returns (file, sheet_no, sheet, row_no, row_text), the header among them.
    """
    shown = cells.withColumn(
        "_text",
        F.when(F.col("row_no") == header_row, shown_cell("cell")).otherwise(
            shown_cell("cell", max_cell_chars)
        ),
    ).where(F.col("_text").isNotNull() & (F.col("row_no") >= header_row))
    entry = F.struct("col_no", "_text")
    rows = shown.groupBy("file", "sheet_no", "sheet", "row_no").agg(
        F.array_sort(F.collect_list(entry)).alias("_cells")
    )
    keys = ["file", "sheet_no", "sheet"]
    is_header = F.col("row_no") == header_row
    width = F.struct(F.max(F.length("_cell._text")).alias("w"), F.count_if(~is_header).alias("n"))
    name = F.max(F.when(is_header, F.col("_cell._text")))
    columns = (
        rows.withColumn("_cell", F.explode("_cells"))
        .groupBy(*keys, F.col("_cell.col_no").alias("col_no"))
        .agg(width.alias("_width"), name.alias("_name"))
    )
    sheets = (
        columns.groupBy(*keys)
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("col_no", F.struct("_width", "_name")))
            ).alias("_known"),
            F.max("col_no").alias("_last"),
        )
        .join(
            rows.where(~is_header).groupBy(*keys).agg(F.count("*").alias("_rows")), keys
        )
    )
    layout = sheets.withColumn(
        "_layout",
        F.expr(
            f"""transform(sequence(1, _last), c -> named_struct(
                  'name', coalesce(_known[c]._name, '{UNNAMED_COLUMN}' || (c - 1)),
                  'width', greatest(
                    length(coalesce(_known[c]._name, '{UNNAMED_COLUMN}' || (c - 1))),
                    coalesce(_known[c]._width.w, 0),
                    if(coalesce(_known[c]._width.n, 0) < _rows, {len(MISSING_CELL)}, 0))))"""
        ),
    ).select(*keys, "_layout")
    # A header may be missing altogether: its line is made from the layout alone.
    headed = rows.where(~is_header).unionByName(
        layout.select(
            *keys,
            F.lit(header_row).cast(rows.schema["row_no"].dataType).alias("row_no"),
            F.array().cast(rows.schema["_cells"].dataType).alias("_cells"),
        )
    )
    line = F.expr(
        f"""array_join(transform(_layout, (l, i) -> lpad(
              if(row_no = {header_row}, l.name, coalesce(_by[i + 1], '{MISSING_CELL}')),
              l.width, ' ')), '{CELL_SEPARATOR}')"""
    )
    return (
        headed.join(layout, keys)
        .withColumn("_by", F.expr(_LAST_PER_COLUMN))
        .select(*keys, "row_no", line.alias("row_text"))
    )


# Cells are sorted by column and text: of equal columns the last one stays.
_LAST_PER_COLUMN = """map_from_entries(transform(
  filter(_cells, (c, i) -> not coalesce(get(_cells, i + 1).col_no = c.col_no, false)),
  c -> named_struct('k', cast(c.col_no as int), 't', c._text)))"""


def _capped(rows: DataFrame, max_sheets: int | None, max_rows: int | None) -> DataFrame:
    """The first sheets, and of each the first rows: a window group limit on every map task."""
    if max_sheets is not None:
        rows = rows.where(F.col("sheet_no") <= max_sheets)
    if max_rows is not None:
        in_sheet = Window.partitionBy("file", "sheet_no", "sheet").orderBy("row_no")
        place = F.row_number().over(in_sheet)
        rows = rows.withColumn("_place", place).where(F.col("_place") <= max_rows).drop("_place")
    return rows


def sheet_chunks(
    sheet_rows: DataFrame,
    max_sheets: int | None = None,
    max_rows: int | None = None,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """The text of every sheet in chunks of ``chunk_chars`` characters.

    From ``(file, sheet_no, sheet, row_no, row_text)``; sheets are numbered from 1.
    The text of a sheet is a header line, a blank line and its rows, one per line.
    Chunk k (from 0) holds the characters from ``k * chunk_chars`` on, so all but the
    last chunk of a sheet are full, and joined in order they are the text.
    Returns (file, sheet_no, sheet, chunk_no, text).

    Where a row starts in the text of its sheet is a running total over blocks of
    rows. Rows are cut where chunks end and meet again by chunk, so no task holds more
    than a block of rows, and no value more than a chunk. A null file or sheet
    counts as one with an empty name, a null row as an empty line.
    """
    kept = _capped(sheet_rows, max_sheets, max_rows).select(
        F.coalesce("file", F.lit("")).alias("file"),
        "sheet_no",
        F.coalesce("sheet", F.lit("")).alias("sheet"),
        "row_no",
        F.coalesce("row_text", F.lit("")).alias("row_text"),
    )
    group = ["file", "sheet_no", "sheet"]
    header, tail = SHEET_HEADER.split("{sheet}")
    lead = F.concat(F.lit(header), "sheet", F.lit(tail), F.lit(PART_SEPARATOR))
    placed = with_totals_before(
        kept,
        group,
        "row_no",
        {
            "before": F.length("row_text").cast("bigint") + len(ROW_SEPARATOR),
            "place": F.lit(1).cast("bigint"),
        },
        ["row_text"],
    )
    first = F.col("place") == 0
    own = placed.select(
        *group,
        F.concat(F.when(first, lead).otherwise(F.lit(ROW_SEPARATOR)), "row_text").alias("own"),
        F.when(first, F.lit(0))
        .otherwise(F.length(lead) - len(ROW_SEPARATOR) + F.col("before"))
        .cast("bigint")
        .alias("start"),
    )
    return cut_in_chunks(own, group, chunk_chars)


def sheet_sizes(
    sheet_rows: DataFrame, max_sheets: int | None = None, max_rows: int | None = None
) -> DataFrame:
    """(file, num_sheets, num_rows, num_chars) of every workbook; no text is put together."""
    header = len(SHEET_HEADER.replace("{sheet}", "")) + len(PART_SEPARATOR)
    name = F.coalesce("sheet", F.lit(""))
    sheets = (
        _capped(sheet_rows, max_sheets, max_rows)
        .groupBy(F.coalesce("file", F.lit("")).alias("file"), "sheet_no", name.alias("sheet"))
        .agg(
            F.count("*").alias("num_rows"),
            F.sum(F.coalesce(F.length("row_text"), F.lit(0))).alias("_chars"),
        )
    )
    own = (
        F.col("_chars")
        + (F.col("num_rows") - 1) * len(ROW_SEPARATOR)
        + F.length("sheet")
        + header
    )
    return sheets.groupBy("file").agg(
        F.count("*").alias("num_sheets"),
        F.sum("num_rows").alias("num_rows"),
        (F.sum(own) + (F.count("*") - 1) * len(PART_SEPARATOR)).alias("num_chars"),
    )


def workbook_text(
    chunks: DataFrame, max_chars: int | None = None, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """(file, text): one value per workbook, from chunks of ``chunk_chars`` characters.

    Only for what takes one value; ``sheet_chunks`` has no such limit. With
    ``max_chars`` only chunks that begin inside it are looked at.
    """
    wanted = chunks if max_chars is None else chunks.where(F.col("chunk_no") * chunk_chars < max_chars)
    part = F.when(F.col("chunk_no") == 0, F.concat(F.lit(PART_SEPARATOR), "text")).otherwise(
        F.col("text")
    )
    whole = (
        wanted.withColumn("_part", part)
        .withColumn("_at", F.struct("sheet_no", "sheet", "chunk_no"))
        .groupBy("file")
        .agg(F.expr("listagg(_part, '') within group (order by _at)").alias("_text"))
    )
    text = F.substring(F.col("_text"), F.lit(len(PART_SEPARATOR) + 1), F.length("_text"))
    return whole.select("file", shorten(text, max_chars).alias("text"))

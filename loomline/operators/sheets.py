"""Worksheet grids -> tables, over long cells.

A grid is a table of cells (source_file, sheet_name, row_idx, col_idx, value,
value_type), empty cells left out, indices from zero, value_type 'd' for dates,
'n' numbers, 's' text. Header cells are few; body cells find their header by
column and their machine by row through equi joins, so a huge sheet is spread
over tasks by column and row rather than handled as one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casting import to_date, to_double, to_timestamp
from ..functions.cleaning import clean_machine_no, clean_text
from ..functions.dates import production_date
from ..functions.naming import header_name, plain_name, suffixed
from ..sources.tables import store_stage
from .versions import number_rows

SHEET = ("source_file", "sheet_name")

# Fixed values of the daily textile sheet.
PRODUCTION_HEADER_ROW, LOT_HEADER_ROW, DATA_ROW = 2, 3, 4
MACHINE_COLUMN, MONTH_COLUMN = 0, 5
OUTPUT_HEADER = "생산량"
MACHINE_PATTERN = r"(?i)^([0-9]+|M-[0-9]+)\z"
SKIPPED_PREFIX, SKIPPED_SHEET = "total", "kangatang"

# Localized headers of the start-beam sheet and their names.
START_BEAM_NAMES = {
    "호기_số_máy": "machine_no",
    "model": "model",
    "품목_loại_hàng": "item_type",
    "unit": "unit",
    "상대일_ngày_lên_beam": "beam_start_date",
    "po": "po",
    "order": "order_no",
    "lot_no": "lot_no",
    "total_yarn": "total_yarn",
    "b_m_no": "beam_no",
    "length": "length",
    "pro": "planned_output",
    "대차_chênh_lệch": "output_gap",
    "%": "output_rate",
    "하대예정일_ngày_dự_kiến_hết_beam": "expected_beam_end_at",
    "제직기간일_thời_gian_dệt": "weaving_days",
    "1일생산량mts_số_mts_dệt_mỗi_ngày": "daily_output_mts",
}
START_BEAM_DATES = ("beam_start_date", "expected_beam_end_at")
START_BEAM_NUMBERS = (
    "machine_no", "total_yarn", "length", "planned_output", "output_gap", "output_rate", "weaving_days", "daily_output_mts",
)
START_BEAM_HEADER_ROW = 2


def _date_cell() -> Column:
    """Date of a cell typed or written as a date; bare numbers are not dates."""
    return F.when(F.col("value_type").isin("d", "s"), to_date(F.col("value")))


# -- names -----------------------------------------------------------------


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def dedup_names(headers: DataFrame) -> DataFrame:
    """Number repeated names per sheet in column order: name, name_2, name_3, ..."""
    numbered = number_rows(headers, [*SHEET, "name"], ["col_idx"], "_nth_name", width=1_000)
    return numbered.withColumn("name", suffixed(F.col("name"), F.col("_nth_name"))).drop("_nth_name")


def flat_headers(cells: DataFrame, rows: Sequence[int]) -> DataFrame:
    """Header rows -> one name per (sheet, col_idx).

    Of several header rows, all but the last carry a value on to the blank
    columns right of it, as merged cells do. A sheet has at most 16,384 columns.
    """
    heads = cells.where(F.col("row_idx").isin(list(rows)))
    parts = [F.max(F.when(F.col("row_idx") == r, F.col("value"))).alias(f"part_{r}") for r in rows]
    # Columns with data but no header text still need a name.
    columns = cells.where(F.col("row_idx") > max(rows)).select(*SHEET, "col_idx").distinct()
    wide = heads.groupBy(*SHEET, "col_idx").agg(*parts).join(columns, [*SHEET, "col_idx"], "full_outer")
    to_the_left = Window.partitionBy(*SHEET).orderBy("col_idx").rowsBetween(Window.unboundedPreceding, 0)
    for r in rows[:-1]:
        wide = wide.withColumn(f"part_{r}", F.last(f"part_{r}", ignorenulls=True).over(to_the_left))
    named = wide.withColumn("name", header_name(F.array(*[f"part_{r}" for r in rows])))
    return dedup_names(named.select(*SHEET, "col_idx", "name"))


def widen(cells: DataFrame, headers: DataFrame, first_row: int) -> DataFrame:
    """Long body cells -> one row per sheet row, one text column per header name.

    Only the header names come to the driver: they are the schema. Rows and
    columns without any cell do not appear.
    """
    names = sorted(r["name"] for r in headers.select("name").distinct().collect())
    body = cells.where(F.col("row_idx") >= first_row).join(headers, [*SHEET, "col_idx"])
    return body.groupBy(*SHEET, "row_idx").pivot("name", names).agg(F.max("value"))


def row_metadata(rows: DataFrame) -> DataFrame:
    """_source_file, _sheet_name, _row_number (1-based per sheet) and _ingested_at.

    Rows are numbered by sheet row, or by machine and date where several sheet
    cells were folded into a row.
    """
    if "row_idx" in rows.columns:
        numbered = number_rows(rows, SHEET, ["row_idx"], "_row_number")
    else:
        numbered = number_rows(rows, SHEET, ["prod_date"], "_row_number", stretch=F.col("machine_no"))
    return numbered.withColumnsRenamed({"source_file": "_source_file", "sheet_name": "_sheet_name"}).withColumn(
        "_ingested_at", F.current_timestamp()
    )


# -- start beam and complete beam sheets -----------------------------------


def sheet_report_date(cells: DataFrame) -> DataFrame:
    """Report date per sheet: the last date in the first of rows 0-2 that has one."""
    dated = cells.where("row_idx < 3").withColumn("report_date", _date_cell()).where("report_date is not null")
    place = F.struct(-F.col("row_idx"), F.col("col_idx"))
    return dated.groupBy(*SHEET).agg(F.max_by("report_date", place).alias("report_date"))


def coerce_types(df: DataFrame, dates: Sequence[str] = START_BEAM_DATES, numbers: Sequence[str] = START_BEAM_NUMBERS) -> DataFrame:
    """Parse the listed columns that exist; what does not parse is NULL."""
    parsed = {c: to_timestamp(F.col(c)) for c in dates if c in df.columns}
    parsed.update({c: to_double(F.col(c)) for c in numbers if c in df.columns})
    return df.withColumns(parsed) if parsed else df


def complete_beam_rows(cells: DataFrame) -> DataFrame:
    """Finished-beam sheet: two header rows, then data."""
    return widen(cells, flat_headers(cells, (0, 1)), first_row=2)


def start_beam_rows(cells: DataFrame) -> DataFrame:
    """Beam-schedule sheet: report date above, header in row 2, then data."""
    heads = (
        cells.where((F.col("row_idx") == START_BEAM_HEADER_ROW) & ~F.col("value").startswith("Unnamed"))
        .select(*SHEET, "col_idx", plain_name(F.col("value")).alias("name"))
    )
    wide = widen(cells, dedup_names(heads), first_row=START_BEAM_HEADER_ROW + 1)
    named = coerce_types(rename_columns(wide, START_BEAM_NAMES))
    dated = named.join(sheet_report_date(cells), list(SHEET), "left")
    return dated.withColumns(
        {"_updated_at": F.col("report_date"), "_excel_row_number": F.col("row_idx") + 1}
    ).drop("report_date")


# -- daily textile sheets --------------------------------------------------


def named_sheets(cells: DataFrame) -> DataFrame:
    """Without summary sheets."""
    name = F.lower(F.trim("sheet_name"))
    return cells.where(~name.startswith(SKIPPED_PREFIX) & (name != SKIPPED_SHEET))


def keep_sheets(cells: DataFrame) -> DataFrame:
    """Drop summary sheets and sheets of fewer than five rows."""
    wanted = named_sheets(cells)
    tall = wanted.groupBy(*SHEET).agg(F.max("row_idx").alias("last")).where(F.col("last") >= DATA_ROW)
    return wanted.join(tall.select(*SHEET), list(SHEET), "left_semi")


def lot_dates(cells: DataFrame) -> DataFrame:
    """(sheet, col_idx, prod_date) of the lot columns."""
    heads = cells.where(F.col("row_idx") == LOT_HEADER_ROW).withColumn("prod_date", _date_cell())
    return heads.where("prod_date is not null").select(*SHEET, "col_idx", "prod_date")


def sheet_month(cells: DataFrame) -> DataFrame:
    """(sheet, sheet_year, sheet_month): first lot date from column 5 on. Sheets without one are left out."""
    first = (
        lot_dates(cells).where(F.col("col_idx") >= MONTH_COLUMN)
        .groupBy(*SHEET).agg(F.min_by("prod_date", "col_idx").alias("first_date"))
    )
    return first.select(*SHEET, F.year("first_date").alias("sheet_year"), F.month("first_date").alias("sheet_month"))


def in_sheet_month(dated: DataFrame, months: DataFrame) -> DataFrame:
    """Rows whose prod_date lies in their sheet's year and month."""
    same = (F.year("prod_date") == F.col("sheet_year")) & (F.month("prod_date") == F.col("sheet_month"))
    return dated.join(months, list(SHEET)).where(same).drop("sheet_year", "sheet_month")


def machine_rows(cells: DataFrame) -> DataFrame:
    """(sheet, row_idx, machine_no) of data rows that start with a machine id."""
    first = cells.where((F.col("row_idx") >= DATA_ROW) & (F.col("col_idx") == MACHINE_COLUMN))
    named = first.select(*SHEET, "row_idx", clean_machine_no(F.col("value")).alias("machine_no"))
    return named.where(F.col("machine_no").rlike(MACHINE_PATTERN))


def production_headers(cells: DataFrame, months: DataFrame) -> DataFrame:
    """(sheet, col_idx of the output column, prod_date): output header with its date two columns left."""
    heads = cells.where(F.col("row_idx") == PRODUCTION_HEADER_ROW)
    outputs = heads.where(
        F.contains(F.replace("value", F.lit(" "), F.lit("")), F.lit(OUTPUT_HEADER)) & (F.col("col_idx") >= 2)
    ).select(*SHEET, "col_idx", (F.col("col_idx") - 2).alias("date_col"))
    dates = heads.select(*SHEET, F.col("col_idx").alias("date_col"), "value", "value_type")
    dated = outputs.join(dates, [*SHEET, "date_col"]).join(months, list(SHEET))
    date = production_date(F.col("value"), F.col("value_type"), F.col("sheet_year"), F.col("sheet_month"))
    return dated.select(*SHEET, "col_idx", date.alias("prod_date")).where("prod_date is not null")


def _body(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Body cells of machine rows under the target columns (sheet, col_idx, prod_date, field), in one pass: a row's machine comes from its own first cell."""
    body = cells.where(F.col("row_idx") >= DATA_ROW).select(*SHEET, "row_idx", "col_idx", "value")
    # A sheet has at most 16,384 columns, so a row's cells are few however long the sheet is.
    row = Window.partitionBy(*SHEET, "row_idx")
    first = F.when(F.col("col_idx") == MACHINE_COLUMN, clean_machine_no(F.col("value")))
    aimed = body.join(targets, [*SHEET, "col_idx"], "left").where(F.col("field").isNotNull() | (F.col("col_idx") == MACHINE_COLUMN))
    named = aimed.withColumn("machine_no", F.max(first).over(row))
    return named.where(F.col("field").isNotNull() & F.col("machine_no").rlike(MACHINE_PATTERN))


def _lot_targets(cells: DataFrame, months: DataFrame) -> DataFrame:
    return in_sheet_month(lot_dates(cells), months).withColumn("field", F.lit("lot_no"))


def _production_targets(cells: DataFrame, months: DataFrame) -> DataFrame:
    heads = in_sheet_month(production_headers(cells, months), months)
    c = F.col("col_idx")
    triple = F.array(
        F.struct((c - 2).alias("col_idx"), F.lit("meter_reading_m").alias("field")),
        F.struct((c - 1).alias("col_idx"), F.lit("cut_length_m").alias("field")),
        F.struct(c.alias("col_idx"), F.lit("prod_output_m").alias("field")),
    )
    return heads.select(*SHEET, "prod_date", F.inline(triple)).select(*SHEET, "col_idx", "prod_date", "field")


def lot_unpivot(cells: DataFrame, months: DataFrame) -> DataFrame:
    """Lot block -> (sheet, machine_no, prod_date, lot_no)."""
    lots = _body(cells, _lot_targets(cells, months)).withColumn("lot_no", clean_text(F.col("value")))
    return lots.where("lot_no is not null").select(*SHEET, "machine_no", "prod_date", "lot_no")


_MEASURES = ("meter_reading_m", "cut_length_m", "prod_output_m")


def production_unpivot(cells: DataFrame, months: DataFrame) -> DataFrame:
    """Production triples -> (sheet, machine_no, prod_date, meter_reading_m, cut_length_m, prod_output_m) as text."""
    values = _body(cells, _production_targets(cells, months))
    return values.groupBy(*SHEET, "row_idx", "machine_no", "prod_date").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in _MEASURES]
    ).drop("row_idx")


def lot_production_join(lots: DataFrame, production: DataFrame) -> DataFrame:
    """Full outer one-to-one merge on (sheet, machine_no, prod_date).

    One tagged union and one aggregate. A key that repeats on either side is an
    error, raised when the rows are computed. Rows without any value are dropped
    and measures become numbers.
    """
    both = lots.withColumn("_lots", F.lit(1)).unionByName(
        production.withColumn("_made", F.lit(1)), allowMissingColumns=True
    )
    merged = both.groupBy(*SHEET, "machine_no", "prod_date").agg(
        *[F.max(c).alias(c) for c in ("lot_no", *_MEASURES)],
        F.count("_lots").alias("_lots"),
        F.count("_made").alias("_made"),
    )
    return _one_to_one(merged)


def _one_to_one(merged: DataFrame) -> DataFrame:
    clash = F.raise_error(
        F.concat(F.lit("machine and date repeat in sheet "), "sheet_name", F.lit(": "), "machine_no", F.lit(" "),
                 F.col("prod_date").cast("string"))
    ).cast("string")
    repeated = (F.col("_lots") > 1) | (F.col("_made") > 1)
    checked = merged.withColumn("machine_no", F.when(repeated, clash).otherwise(F.col("machine_no")))
    return checked.dropna("all", subset=["lot_no", *_MEASURES]).select(
        *SHEET, "machine_no", "prod_date", "lot_no", *[to_double(F.col(c)).alias(c) for c in _MEASURES]
    )


def textile_targets(cells: DataFrame) -> DataFrame:
    """(sheet, col_idx, prod_date, field) of the columns to read, from the two header rows in one pass.

    Sheets without a month or without a dated output column in it have no target. The header rows of a sheet meet in one task; they are at most
    2 x 16,384 cells.
    """
    row, col = F.col("row_idx"), F.col("col_idx")
    heads = cells.where(row.isin(PRODUCTION_HEADER_ROW, LOT_HEADER_ROW)).withColumn("_date", F.when(row == LOT_HEADER_ROW, _date_cell()))
    sheet = Window.partitionBy(*SHEET)
    two_left = Window.partitionBy(*SHEET, "row_idx").orderBy("col_idx").rangeBetween(-2, -2)
    first = F.min(F.when(F.col("_date").isNotNull() & (col >= MONTH_COLUMN), F.struct("col_idx", "_date"))).over(sheet)
    placed = heads.select(*SHEET, "row_idx", "col_idx", "value", "_date", first["_date"].alias("_first"),
                          F.max(F.struct("value", "value_type")).over(two_left).alias("_left"))
    year, month = F.year("_first"), F.month("_first")
    is_output = (row == PRODUCTION_HEADER_ROW) & (col >= 2) & F.contains(F.replace("value", F.lit(" "), F.lit("")), F.lit(OUTPUT_HEADER))
    made_on = F.when(is_output, production_date(F.col("_left.value"), F.col("_left.value_type"), year, month))
    dated = placed.where("_first is not null").select(
        *SHEET, "row_idx", "col_idx", F.coalesce("_date", made_on).alias("prod_date"), year.alias("_year"), month.alias("_month")
    ).where((F.year("prod_date") == F.col("_year")) & (F.month("prod_date") == F.col("_month")))
    with_output = dated.withColumn("_output", F.max(row == PRODUCTION_HEADER_ROW).over(sheet)).where("_output")

    def target(at: Column, field: str) -> Column:
        return F.struct(at.cast("int").alias("col_idx"), F.lit(field).alias("field"))

    fields = F.when(row == LOT_HEADER_ROW, F.array(target(col, "lot_no"))).otherwise(
        F.array(*[target(col - back, f) for back, f in zip((2, 1, 0), _MEASURES)])
    )
    return with_output.withColumn("_fields", fields).select(*SHEET, "prod_date", F.inline("_fields"))


def textile_day_rows(cells: DataFrame) -> DataFrame:
    """Daily textile sheets -> one row per (sheet, machine_no, prod_date).

    The header rows are read once for the columns to read, a small table that is stored; the body is read once against it. A sheet whose lot or production
    part is empty gives nothing. Sheets of fewer than five rows have no body.
    """
    cells = named_sheets(cells)
    field = F.col("field")
    values = _body(cells, store_stage(textile_targets(cells), "targets")).withColumn(
        "value", F.when(field == "lot_no", clean_text(F.col("value"))).otherwise(F.col("value"))
    ).where("value is not null")
    merged = values.groupBy(*SHEET, "machine_no", "prod_date").agg(
        *[F.max(F.when(field == f, F.col("value"))).alias(f) for f in ("lot_no", *_MEASURES)],
        F.count_if(field == "lot_no").alias("_lots"),
        F.greatest(*[F.count_if(field == f) for f in _MEASURES]).alias("_made"),
    )
    # The lot part is empty without any lot value in the month. Both branches read the same exchange.
    with_lots = merged.where("lot_no is not null").select(*SHEET).distinct()
    return _one_to_one(merged).join(with_lots, list(SHEET), "left_semi")

"""Frames and report grids derived from the order tables.

A supplier plays the organisation, the month of an order plays the report day,
aggregates over line items play the measures. The aggregate texts are plain SQL
and are shared with the checking queries.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.layouts import CODE, KEY_HEADINGS, NAME, REGION, TYPE_1_NATIONAL_ROW, Layout, Sheet

HEADER_ROW = 15
DATE_ROW = 14
FIRST_COLUMN = 5
NATIONAL = -1
# A month after the last order: a column no organisation fills.
EMPTY_MONTH = "2001-09-01"
# Long-stay reporting starts a year later where a sheet has its own dates.
LATE_START = "1996-01-01"

ADULT = "o_orderstatus <> 'P'"
PAEDIATRIC = "o_orderstatus = 'P'"


def _qty(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN l_quantity END)"


def _qty_or_zero(base: str, condition: str) -> str:
    """0 where base rows exist but none meets the condition."""
    return f"sum(CASE WHEN {base} AND {condition} THEN l_quantity WHEN {base} THEN 0 END)"


def _count(condition: str) -> str:
    return f"nullif(count(CASE WHEN {condition} THEN 1 END), 0)"


N_A = "count(CASE WHEN l_returnflag = 'A' THEN 1 END)"
Q_A = _qty("l_returnflag = 'A'")
MEASURE_SQL = {
    "ga_beds_open": "sum(l_quantity)",
    "ga_beds_occupied": _qty_or_zero("l_quantity > 0", "l_returnflag = 'R'"),
    "adult_open": _qty(ADULT),
    "adult_occupied": _qty_or_zero(ADULT, "l_returnflag = 'R'"),
    "adult_void": _qty_or_zero(ADULT, "l_tax > 0.06"),
    "paed_open": _qty(PAEDIATRIC),
    "paed_occupied": _qty_or_zero(PAEDIATRIC, "l_returnflag = 'R'"),
    "paed_void": _qty_or_zero(PAEDIATRIC, "l_tax > 0.06"),
    # One line only: 0 open beds, so the ratio is 0/0 or x/0.
    "cc_beds_open": f"CASE WHEN {N_A} > 1 THEN {Q_A} WHEN {N_A} = 1 THEN 0 END",
    "cc_beds_occupied": _qty_or_zero("l_returnflag = 'A'", "l_linestatus = 'F'"),
    "beds_closed_norovirus": _count("l_discount >= 0.05"),
    "beds_closed_unoccupied": _count("l_discount >= 0.08"),
    "long_stay_7": _count("l_quantity > 20"),
    "long_stay_21": _count("l_quantity > 40"),
    "delays_30_60": _count("l_linenumber > 3"),
    "delays_60_plus": _count("l_linenumber > 5"),
    "flu_ga": _count("l_linestatus = 'F'"),
    "flu_cc": _count("l_linestatus = 'O'"),
    "closures": _count("o_orderpriority = '1-URGENT'"),
    "diverts": _count("o_orderpriority = '2-HIGH'"),
    "ae_attendances": _count("l_quantity > 10"),
}
# Which organisations a sheet lists (all others list everybody).
PRESENT_SQL = {
    "Adult critical care": "s_acctbal >= 0 OR s_acctbal IS NULL",
    "A&E closures": "s_acctbal < 9000 OR s_acctbal IS NULL",
    "A&E Closures": "s_acctbal < 9000 OR s_acctbal IS NULL",
    "Paediatric G&A beds": "s_nationkey > 2 OR s_nationkey IS NULL",
    "G&A beds": "s_nationkey < 23 OR s_nationkey IS NULL",
    "Adult G&A beds": "s_nationkey < 23 OR s_nationkey IS NULL",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_of(timestamp: str | Column) -> Column:
    return F.trunc(timestamp, "month")


# --- report frames ----------------------------------------------------------


def report(spark: SparkSession, sf_dir: str, by: str = "nation") -> DataFrame:
    """(code, name, region, report_date, open, occ) by nation or by customer."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    facts = (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", month_of("o_orderdate").alias("report_date"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("open"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).cast("bigint").alias("occ"),
        )
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    if by == "customer":
        keys = [
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"),
            F.col("c_name").alias("name"),
            F.col("c_custkey").cast("int").alias("row_no"),
        ]
    else:
        keys = [
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"),
            F.col("n_name").alias("name"),
            F.col("n_nationkey").alias("row_no"),
        ]
    return facts.groupBy(
        *keys, F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"), "report_date"
    ).agg(F.sum("open").alias("open"), F.sum("occ").alias("occ"))


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, name, report_date, event_type, n): events per user, type and day."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("code"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("name"),
        F.to_date("ts").alias("report_date"),
        "event_type",
    ).agg(F.count("*").cast("int").alias("n"))


# --- whole-winter grids -----------------------------------------------------


def supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures per supplier and month, and per month for the whole country."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    measures = [F.expr(f"CAST({sql} AS BIGINT)").alias(name) for name, sql in MEASURE_SQL.items()]
    return (
        joined.withColumn("month", month_of("o_orderdate"))
        .groupingSets([["l_suppkey", "month"], ["month"]], "l_suppkey", "month")
        .agg(*measures)
        .withColumn("org", F.coalesce("l_suppkey", F.lit(NATIONAL)))
        .drop("l_suppkey")
    )


@dataclass(frozen=True)
class SheetColumn:
    """One repeated heading of a sheet and the frame column that fills it."""

    heading: str
    source: str | None  # None: a heading the layout ignores
    later_heading: str | None = None


SPLIT_SOURCES = {
    "Adult G&A beds": {"ga_beds_open": "adult_open", "ga_beds_occupied": "adult_occupied", "ga_beds_void": "adult_void"},
    # Printed rates, which only the archived layouts read.
    "G&A beds": {"ga_occupancy_rate": "CASE WHEN ga_beds_open > 0 THEN CAST(ga_beds_occupied AS DOUBLE) / ga_beds_open END"},
    "Paediatric G&A beds": {"ga_beds_open": "paed_open", "ga_beds_occupied": "paed_occupied", "ga_beds_void": "paed_void"},
}
IGNORED_HEADING = SheetColumn("Occupancy rate", None)


def sheet_columns(sheet: Sheet) -> list[SheetColumn]:
    sources = SPLIT_SOURCES.get(sheet.name, {})
    by_measure: dict[str, SheetColumn] = {}
    for heading, measure in sheet.series:
        source = sources.get(measure, measure)
        if measure in by_measure:
            by_measure[measure] = SheetColumn(by_measure[measure].heading, source, heading)
        else:
            by_measure[measure] = SheetColumn(heading, source)
    columns = list(by_measure.values())
    return columns if any(c.heading == IGNORED_HEADING.heading for c in columns) else [*columns, IGNORED_HEADING]


def has_own_dates(layout: Layout, sheet: Sheet) -> bool:
    """From 2020-21 on every sheet of the fixture prints its dates, before only one does."""
    return layout.winter >= "2020-21" or sheet.name == layout.date_sheet


def starts_late(layout: Layout, sheet: Sheet) -> bool:
    return layout.winter >= "2020-21" and sheet.name == "Beds Occ by long stay patients"


def has_empty_month(sheet: Sheet) -> bool:
    return sheet.dated_measure == "diverts"


# Grid cells are built from SQL text: a workbook has too many of them for one
# Column call each.

MONTH_NO = "((year(month) - 1995) * 12 + month(month) - 1)"
SERIAL = "CAST(datediff(month, DATE '1899-12-30') AS STRING)"


def date_text(forms: tuple[str, ...], as_heading: bool) -> str:
    """A month's first day as the winter writes it; text winters mix three forms."""
    if forms == ("serial", "text"):
        return (
            f"CASE WHEN month(month) <= 4 THEN {SERIAL} "
            "WHEN month(month) <= 8 THEN date_format(month, 'd-MMM-yy') "
            "ELSE concat(date_format(month, 'dd'), '-', date_format(date_add(month, 2), 'dd-MMM-yy')) END"
        )
    if forms == ("serial",) or as_heading:
        return SERIAL
    return "date_format(month, 'yyyy-MM-dd')"


def winter_grid(spark: SparkSession, sf_dir: str, layout: Layout, measured: DataFrame | None = None) -> DataFrame:
    """The winter's workbook as a cell table, filled from the order tables.

    measured: the rows of `supplier_months`, where they are at hand.
    """
    measured = supplier_months(spark, sf_dir) if measured is None else measured

    def laid_out(frame: DataFrame, cells) -> DataFrame:
        arrays = ", ".join(cells(layout, sheet) for sheet in layout.sheets)
        return frame.selectExpr(f"inline(flatten(array({arrays})))")

    months = table(spark, sf_dir, "orders").select(month_of("o_orderdate").alias("month")).distinct()
    months = months.unionByName(spark.range(1).selectExpr(f"DATE '{EMPTY_MONTH}' AS month"))
    orgs = organisations(spark, sf_dir)
    parts = [
        laid_out(spark.range(1), _title_cells),
        laid_out(months, _heading_cells),
        laid_out(orgs, _name_cells),
        laid_out(measured.join(orgs, "org"), _value_cells),
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .where(F.col("value").isNotNull())
        .select(F.lit(layout.winter).alias("winter"), "*")
    )


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, and one row standing for the whole country."""
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("org"),
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias(CODE),
            F.col("s_name").alias(NAME),
            F.col("r_name").alias(REGION),
            "s_acctbal",
            "s_nationkey",
        )
    )
    country = spark.range(1).select(
        F.lit(NATIONAL).cast("bigint").alias("org"), F.lit("-").alias(CODE), F.lit("-").alias(REGION)
    )
    return suppliers.unionByName(country, allowMissingColumns=True)


def _text(value: str) -> str:
    escaped = value.replace("'", "\\'")
    return f"'{escaped}'"


def _cell(sheet: Sheet, row: str | int, col: str | int, value: str) -> str:
    return (
        f"named_struct('workbook', {_text(sheet.workbook)}, 'sheet', {_text(sheet.name)}, "
        f"'row_idx', CAST({row} AS INT), 'col_idx', CAST({col} AS INT), 'value', CAST({value} AS STRING))"
    )


def _array(cells: list[str]) -> str:
    return f"array({', '.join(cells)})"


NO_CELLS = "CAST(array() AS array<struct<workbook:string,sheet:string,row_idx:int,col_idx:int,value:string>>)"


def _title_cells(layout: Layout, sheet: Sheet) -> str:
    keys = [(1, KEY_HEADINGS[REGION]), (3, KEY_HEADINGS[CODE]), (4, KEY_HEADINGS[NAME])]
    return _array([_cell(sheet, 3, 1, "'Title:'"), *[_cell(sheet, HEADER_ROW, c, _text(h)) for c, h in keys]])


def _columns(sheet: Sheet) -> list[SheetColumn]:
    return [SheetColumn("", sheet.dated_measure)] if sheet.dated_measure else sheet_columns(sheet)


def _column_no(sheet: Sheet, i: int) -> str:
    """Months side by side, the sheet's headings within each."""
    return f"{FIRST_COLUMN} + {MONTH_NO} * {len(_columns(sheet))} + {i}"


def _reported(layout: Layout, sheet: Sheet) -> str:
    """Months the sheet has columns for."""
    tests = ["true"]
    if not has_empty_month(sheet):
        tests.append(f"month < DATE '{EMPTY_MONTH}'")
    if starts_late(layout, sheet):
        tests.append(f"month >= DATE '{LATE_START}'")
    return " AND ".join(tests)


def _present(sheet: Sheet) -> str:
    return f"({PRESENT_SQL.get(sheet.name, 'true')})"


def _heading_cells(layout: Layout, sheet: Sheet) -> str:
    """One month's headings, and its date above them."""
    if sheet.dated_measure:
        cells = [_cell(sheet, HEADER_ROW, _column_no(sheet, 0), date_text(layout.date_forms, True))]
    else:
        cells = []
        for i, column in enumerate(_columns(sheet)):
            heading = _text(column.heading)
            if column.later_heading:
                heading = f"CASE WHEN {MONTH_NO} > 20 THEN {_text(column.later_heading)} ELSE {heading} END"
            cells.append(_cell(sheet, HEADER_ROW, _column_no(sheet, i), heading))
        if has_own_dates(layout, sheet):
            cells.append(_cell(sheet, DATE_ROW, _column_no(sheet, 0), date_text(layout.date_forms, False)))
    return f"CASE WHEN {_reported(layout, sheet)} THEN {_array(cells)} ELSE {NO_CELLS} END"


def national_rows(layout: Layout, sheet: Sheet) -> list[tuple[int, str]]:
    """(body row, name) of the country's rows; the last one lies in a dropped row."""
    rows = [(1, "ENGLAND")]
    if layout.winter >= "2020-21" and 2 not in sheet.drop_rows:
        rows.append((2, TYPE_1_NATIONAL_ROW))
    return [*rows, (next(row for row in sheet.drop_rows if row > 1), "not an organisation")]


def _name_cells(layout: Layout, sheet: Sheet) -> str:
    def named(body_row: str | int, name: str) -> list[str]:
        row = f"{body_row} + {HEADER_ROW}"
        return [_cell(sheet, row, 1, REGION), _cell(sheet, row, 3, CODE), _cell(sheet, row, 4, name)]

    country = [c for row, name in national_rows(layout, sheet) for c in named(row, _text(name))]
    return (
        f"CASE WHEN org = {NATIONAL} THEN {_array(country)} "
        f"WHEN {_present(sheet)} THEN {_array(named('org + 4', NAME))} ELSE {NO_CELLS} END"
    )


def _value_cells(layout: Layout, sheet: Sheet) -> str:
    def values(body_row: str | int) -> list[str]:
        row = f"{body_row} + {HEADER_ROW}"
        return [
            _cell(sheet, row, _column_no(sheet, i), column.source or "'-'")
            for i, column in enumerate(_columns(sheet))
        ]

    country = [c for row, _ in national_rows(layout, sheet) for c in values(row)]
    shown = f"{_reported(layout, sheet)} AND {_present(sheet)}"
    return (
        f"CASE WHEN {shown} AND org = {NATIONAL} THEN {_array(country)} "
        f"WHEN {shown} THEN {_array(values('org + 4'))} ELSE {NO_CELLS} END"
    )

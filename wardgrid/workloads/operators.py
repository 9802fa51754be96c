"""One query per operator over the order and event tables, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.dates import collapse_range, report_date, serial_date
from wardgrid.functions.labels import (
    canonical_heading,
    national_name,
    strip_group_label,
    strip_repeat_suffix,
)
from wardgrid.functions.numbers import null_if_dash, safe_ratio, sum_or_zero, to_double, to_int
from wardgrid.layouts import GA, THREE_KEYS, Layout, Sheet
from wardgrid.operators.datebook import attach_dates, date_rejects
from wardgrid.operators.grid import (
    band_ordinal,
    densify,
    drop_body_rows,
    drop_empty_columns,
    drop_empty_rows,
    heading_ordinal,
    series_lengths,
)
from wardgrid.operators.reshape import (
    headings_prefixed,
    map_measures,
    merge_series,
    pivot_series,
    select_prefixed,
    unpivot_measures,
)
from wardgrid.operators.spine import (
    attach_measures,
    build_spine,
    complete_rows,
    exclude_names,
    keys_first,
)
from wardgrid.plans.winter import combine_by_key, load_trusts, winter_panel
from wardgrid.sources.cells import read_cells, write_cells
from wardgrid.sources.directory import DIRECTORY_COLUMNS
from wardgrid.sources.snapshots import read_snapshot, write_snapshot

from wardgrid.workloads.frames import event_days, month_of, report, table
from wardgrid.workloads.stored import store_cells, work_dir

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

# --- a single-sheet report ---------------------------------------------------

REPORT_SHEET = "Report"
REPORT_LAYOUT = Layout(
    "report",
    (Sheet(REPORT_SHEET, series=(("Total beds avail", "ga_beds_open"), ("Total beds occ'd", "ga_beds_occupied"))),),
    (GA,),
    date_sheet=REPORT_SHEET,
    join_keys=THREE_KEYS,
)

REPORT_SQL = """
  SELECT {keys}, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_date,
         CAST(sum(l_quantity) AS BIGINT) AS open,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS occ
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL
"""
NATION_KEYS = "'N' || n_nationkey AS code, n_name AS name, r_name AS region"
CUSTOMER_KEYS = "'C' || c_custkey AS code, c_name AS name, r_name AS region"


def _report(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    """Without the market segment."""
    return (
        report(spark, sf_dir, by)
        .groupBy("code", "name", "region", "row_no", "report_date")
        .agg(F.sum("open").alias("open"), F.sum("occ").alias("occ"))
    )


def _named(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    """(row_no, code, name) of all organisations, with or without orders."""
    if by == "customer":
        return table(spark, sf_dir, "customer").selectExpr("c_custkey AS row_no", "concat('C', c_custkey) AS code", "c_name AS name")
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS row_no", "concat('N', n_nationkey) AS code", "n_name AS name")


def report_grid(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    """The report as a worksheet: two headings per month, a date above them."""

    def cells(frame: DataFrame, *entries: str) -> DataFrame:
        structs = ", ".join(
            f"named_struct('row_idx', CAST({row} AS INT), 'col_idx', CAST({col} AS INT), 'value', CAST({value} AS STRING))"
            for row, col, value in (entry.split(" | ") for entry in entries)
        )
        return frame.selectExpr(f"inline(array({structs}))")

    facts = _report(spark, sf_dir, by)
    months = table(spark, sf_dir, "orders").select(month_of("o_orderdate").alias("report_date")).distinct()
    col = "(5 + 2 * ((year(report_date) - 1995) * 12 + month(report_date) - 1))"
    parts = (
        cells(spark.range(1), "15 | 3 | 'Code'", "15 | 4 | 'Name'")
        .unionByName(
            cells(
                months,
                f"14 | {col} | report_date",
                f"15 | {col} | 'Total beds avail'",
                f"15 | {col} + 1 | 'Total beds occ\\'d'",
            )
        )
        .unionByName(cells(_named(spark, sf_dir, by), "18 + row_no | 3 | code", "18 + row_no | 4 | name"))
        .unionByName(cells(facts, f"18 + row_no | {col} | open", f"18 + row_no | {col} + 1 | occ"))
    )
    return parts.select(
        F.lit("report").alias("winter"),
        F.lit("main").alias("workbook"),
        F.lit(REPORT_SHEET).alias("sheet"),
        "row_idx",
        "col_idx",
        "value",
    )


def tidy_report(spark: SparkSession, sf_dir: str, by: str = "nation") -> DataFrame:
    """Cell table to one row per organisation and month, complete rows only."""
    grid = store_cells(spark, report_grid(spark, sf_dir, by), f"report-{by}")
    rows, entries = winter_panel(grid, REPORT_LAYOUT)
    return complete_rows(combine_by_key(rows, REPORT_LAYOUT, entries))


def tidy_report_sql(keys: str) -> str:
    return f"""
SELECT code, name, report_date, CAST(open AS INTEGER) AS ga_beds_open,
       CAST(occ AS INTEGER) AS ga_beds_occupied, CAST(occ AS DOUBLE) / open AS ga_occupancy_rate
FROM ({REPORT_SQL.format(keys=keys)})
"""


# --- grid shaping ------------------------------------------------------------


def heading_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user a sheet, each event a column: repeats of a heading numbered."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    numbered = heading_ordinal(events, ["user_id"], "event_type", "event_id")
    return band_ordinal(numbered, ["user_id"], "event_id", "column_no")


HEADING_ORDINAL_SQL = """
SELECT user_id, event_type, event_id,
       CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS INTEGER) AS ordinal,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS column_no
FROM events
"""


def heading_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spellings of one heading share one numbering."""
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        canonical_heading(F.col("event_type"), {"view": "visit", "click": "visit"}).alias("heading"),
    )
    return heading_ordinal(events, ["user_id"], "heading", "event_id")


HEADING_SYNONYMS_SQL = """
SELECT user_id, event_id, heading,
       CAST(row_number() OVER (PARTITION BY user_id, heading ORDER BY event_id) - 1 AS INTEGER) AS ordinal
FROM (SELECT user_id, event_id,
             CASE WHEN event_type IN ('view', 'click') THEN 'visit' ELSE event_type END AS heading
      FROM events)
"""


def series_length_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: events of each type against the user's number of active days."""
    events = table(spark, sf_dir, "events")
    days = events.select("user_id", F.to_date("ts").alias("day")).distinct()
    return series_lengths(events, days, ["user_id"], "event_type")


SERIES_LENGTH_SQL = """
SELECT user_id, event_type, n_headings, n_dates, n_headings = n_dates AS matches
FROM (SELECT user_id, event_type, count(*) AS n_headings FROM events GROUP BY ALL)
JOIN (SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS n_dates FROM events GROUP BY ALL) USING (user_id)
"""


def _event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("sheet"),
            F.col("user_id").alias("row_idx"),
            F.dayofyear("ts").alias("col_idx"),
        )
        .agg(F.count("*").cast("string").alias("value"))
    )


def densify_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event type as sheet, user as row, day as column: empty cells become NULLs."""
    cells = _event_cells(spark, sf_dir)
    columns = cells.select("sheet", "col_idx").distinct()
    return densify(cells, columns, ["row_idx"], "sheet", "col_idx", "value")


DENSIFY_SQL = """
WITH cells AS (
  SELECT event_type AS sheet, user_id AS row_idx, CAST(dayofyear(ts) AS INTEGER) AS col_idx,
         CAST(count(*) AS VARCHAR) AS value
  FROM events GROUP BY ALL
)
SELECT r.sheet, r.row_idx, c.col_idx, v.value
FROM (SELECT DISTINCT sheet, row_idx FROM cells) r
JOIN (SELECT DISTINCT sheet, col_idx FROM cells) c ON r.sheet = c.sheet
LEFT JOIN cells v ON v.sheet = r.sheet AND v.row_idx = r.row_idx AND v.col_idx = c.col_idx
"""


def dropped_body_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order a sheet, its lines the body rows; rows 2 and 3 go."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return drop_body_rows(lines, (2, 3), "l_linenumber")


def dropped_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
    )
    return drop_empty_rows(lines, ["discount", "tax"])


def dropped_empty_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as sheets, days as columns; only a purchase fills a cell."""
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    filled = events.where(F.col("event_type") == "purchase")
    return drop_empty_columns(events.select("user_id", "day").distinct(), filled, ["user_id", "day"])


# --- reshape -----------------------------------------------------------------


def unpivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _report(spark, sf_dir, "customer").select(
        "code", "report_date", "open", F.nullif("occ", F.lit(0)).alias("occ")
    )
    return unpivot_measures(wide, ["code", "report_date"], ["open", "occ"])


UNPIVOT_SQL = f"""
WITH report AS ({REPORT_SQL.format(keys=CUSTOMER_KEYS)})
SELECT code, report_date, 'open' AS metric, open AS value FROM report
UNION ALL
SELECT code, report_date, 'occ' AS metric, nullif(occ, 0) AS value FROM report
"""


def pivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_series(event_days(spark, sf_dir), ["code", "name", "report_date"], EVENT_TYPES, "event_type", "n")


EVENT_DAYS_SQL = """
SELECT 'U' || user_id AS code, 'User ' || user_id AS name, CAST(ts AS DATE) AS report_date,
       event_type, CAST(count(*) AS INTEGER) AS n
FROM events GROUP BY ALL
"""
PIVOT_SQL = f"""
SELECT code, name, report_date,
       {", ".join(f"max(CASE WHEN event_type = '{e}' THEN n END) AS {e}" for e in EVENT_TYPES)}
FROM ({EVENT_DAYS_SQL}) GROUP BY ALL
"""


def prefix_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form: part types as headings."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("heading"))
    return headings_prefixed(parts, ["Sm", "econ"])


def prefix_select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide form: line-item columns by prefix, in whatever case."""
    return select_prefixed(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["L_DISC", "L_t", "l_S"])


def across_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cast over all measure columns."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"
    )
    texts = map_measures(lines, ["l_quantity", "l_extendedprice", "l_tax"], lambda c: c.cast("string"))
    return map_measures(texts, ["l_quantity", "l_extendedprice", "l_tax"], to_int)


# --- scalar functions ---------------------------------------------------------


def excel_serial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serials with a time-of-day fraction, and texts that are none."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_returnflag")
    serial = F.concat(
        F.when(F.col("l_returnflag") == "A", "Total ").otherwise(""),
        (F.lit(30000) + F.col("l_partkey")).cast("string"),
        F.when(F.col("l_tax") > 0.04, ".75").otherwise(""),
    )
    return lines.select("l_orderkey", "l_linenumber", serial_date(serial).alias("report_date"))


EXCEL_SERIAL_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag <> 'A' THEN DATE '1899-12-30' + CAST(30000 + l_partkey AS INTEGER) END AS report_date
FROM lineitem
"""

# The order priority decides how a date is written.
DATE_TEXT = """
CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(datediff(o_orderdate, DATE '1899-12-30') AS STRING)
  WHEN '2-HIGH' THEN date_format(o_orderdate, 'd-MMM-yy')
  WHEN '3-MEDIUM' THEN concat(date_format(o_orderdate, 'dd'), '-', date_format(date_add(o_orderdate, 2), 'dd-MMM-yy'))
  WHEN '5-LOW' THEN date_format(o_orderdate, "dd-MMM-yy '(provisional)'")
  ELSE date_format(o_orderdate, "'week of' d/M/yyyy")
END
"""
DATE_TEXT_OVERRIDES = {
    "week of 29/2/1996": "1-Mar-96",
    "week of 1/1/1998": "01-Jan-98",
    "week of 3/3/1999": "",
}


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(DATE_TEXT).alias("raw"))


def read_date_text(range_day: str = "first"):
    return lambda text: report_date(text, ("serial", "text"), DATE_TEXT_OVERRIDES, range_day)


def date_text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_dates(date_texts(spark, sf_dir), "raw", {"report_date": read_date_text(), "last_day": read_date_text("last")})


def unreadable_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no date, and how many orders hold each."""
    return date_rejects(date_texts(spark, sf_dir), "raw", read_date_text())


DATE_TEXTS_SQL = """
SELECT o_orderkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR)
  WHEN '2-HIGH' THEN strftime(o_orderdate, '%-d-%b-%y')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%d') || '-' || strftime(o_orderdate + INTERVAL 2 DAY, '%d-%b-%y')
  WHEN '5-LOW' THEN strftime(o_orderdate, '%d-%b-%y (provisional)')
  ELSE 'week of ' || strftime(o_orderdate, '%-d/%-m/%Y') END AS raw
FROM orders
"""


def _parse_sql(day: str) -> str:
    return (
        "coalesce(DATE '1899-12-30' + CAST(TRY_CAST(raw AS DOUBLE) AS INTEGER), "
        "CAST(try_strptime(regexp_extract("
        f"CASE raw {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in DATE_TEXT_OVERRIDES.items())} ELSE "
        rf"regexp_replace(raw, '([0-9]+)-([0-9]+)', '\{day}') END, "
        "'^[0-9]+-[A-Za-z]+-[0-9]{2}'), '%d-%b-%y') AS DATE))"
    )


DATE_TEXT_SQL = f"""
SELECT o_orderkey, raw, {_parse_sql("1")} AS report_date, {_parse_sql("2")} AS last_day
FROM ({DATE_TEXTS_SQL})
"""


DATE_REJECTS_SQL = f"""
SELECT raw, count(*) AS n_rows FROM ({DATE_TEXT_SQL})
WHERE report_date IS NULL AND trim(raw) <> '' GROUP BY raw
"""


def date_range_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges in any text, first match only."""
    return date_texts(spark, sf_dir).select(
        "o_orderkey",
        collapse_range(F.concat("raw", F.lit(" 7-9"))).alias("first_day"),
        collapse_range(F.concat("raw", F.lit(" 7-9")), "last").alias("last_day"),
    )


DATE_RANGE_SQL = rf"""
SELECT o_orderkey, regexp_replace(raw || ' 7-9', '([0-9]+)-([0-9]+)', '\1') AS first_day,
       regexp_replace(raw || ' 7-9', '([0-9]+)-([0-9]+)', '\2') AS last_day
FROM ({DATE_TEXTS_SQL})
"""

# The line number decides how a quantity is written.
MESSY_NUMBER = """
CASE l_linenumber
  WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN concat(CAST(CAST(l_quantity AS INT) AS {text}), '.7')
  WHEN 4 THEN concat('-', CAST(CAST(l_quantity AS INT) AS {text}), '.7')
  WHEN 5 THEN concat(CAST(CAST(l_quantity AS INT) AS {text}), ' beds')
  ELSE CAST(CAST(l_quantity AS INT) AS {text}) END
"""


def messy_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(MESSY_NUMBER.format(text="STRING")).alias("raw")
    )


MESSY_SQL = f"SELECT l_orderkey, l_linenumber, {MESSY_NUMBER.format(text='VARCHAR')} AS raw FROM lineitem"


def cast_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_numbers(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", to_int(F.col("raw")).alias("as_int"), to_double(F.col("raw")).alias("as_double")
    )


CAST_SQL = f"""
SELECT l_orderkey, l_linenumber, CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS INTEGER) AS as_int,
       TRY_CAST(raw AS DOUBLE) AS as_double
FROM ({MESSY_SQL})
"""


def nullif_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_numbers(spark, sf_dir).select("l_orderkey", "l_linenumber", null_if_dash(F.col("raw")).alias("value"))


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and month: returned over accepted quantity, with 0/0 and x/0."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    sums = lines.groupBy("o_custkey", month_of("o_orderdate").alias("report_date")).agg(
        *[
            F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0)).cast("bigint").alias(name)
            for flag, name in (("A", "open"), ("R", "occ"))
        ]
    )
    return sums.withColumn("rate", safe_ratio(F.col("occ"), F.col("open")))


RATIO_SQL = """
SELECT o_custkey, report_date, open, occ,
       CASE WHEN open <> 0 THEN CAST(occ AS DOUBLE) / open WHEN occ > 0 THEN CAST('inf' AS DOUBLE) END AS rate
FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_date,
             CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS BIGINT) AS open,
             CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS occ
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
"""


def suffix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired headings back to the printed ones."""
    parts = table(spark, sf_dir, "part")
    return parts.select(
        "p_partkey",
        strip_repeat_suffix(
            F.concat("p_name", F.lit("__"), F.col("p_size").cast("string"), F.lit("__1"))
        ).alias("heading"),
    )


# --- aggregation, sets, joins ---------------------------------------------------


def sums_without_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint"))
    return lines.groupBy("l_orderkey").agg(sum_or_zero(returned).alias("returned"))


SPLIT_REPORT_SQL = """
SELECT c_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_date,
       CASE WHEN o_orderstatus = 'P' THEN 'Paeds ' ELSE 'Adult ' END || 'G&A Beds Open' AS heading,
       CAST(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) AS BIGINT) AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY ALL
"""


def merge_two_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adult and paediatric facts (by order status) under one heading, added up."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    counted = F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))

    def facts(rows: DataFrame, prefix: str) -> DataFrame:
        return (
            rows.groupBy("c_custkey", month_of("o_orderdate").alias("report_date"))
            .agg(F.sum(counted).cast("bigint").alias("value"))
            .withColumn(
                "heading", strip_group_label(F.lit(f"{prefix} G&A Beds Open"), ("Adult ", "Paeds "))
            )
        )

    adult = facts(lines.where(F.col("o_orderstatus") != "P"), "Adult")
    paediatric = facts(lines.where(F.col("o_orderstatus") == "P"), "Paeds")
    return merge_series([adult, paediatric], ["c_custkey", "report_date", "heading"])


MERGE_SQL = f"""
SELECT c_custkey, report_date, replace(replace(heading, 'Adult ', ''), 'Paeds ', '') AS heading,
       CAST(coalesce(sum(value), 0) AS BIGINT) AS value
FROM ({SPLIT_REPORT_SQL}) GROUP BY ALL
"""


def _event_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One measure table per event type, keyed by (code, name, report_date)."""
    days = event_days(spark, sf_dir)
    return {
        kind: days.where(F.col("event_type") == kind).select("code", "name", "report_date", F.col("n").alias(kind))
        for kind in EVENT_TYPES
    }


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys over five tables; rows missing a key are left out."""
    tables = [
        t.withColumn("name", F.when(F.col(kind) > 1, F.col("name")))
        for kind, t in _event_tables(spark, sf_dir).items()
    ]
    return build_spine(tables, ["code", "name", "report_date"])


SPINE_SQL = f"""
SELECT DISTINCT code, name, report_date FROM ({EVENT_DAYS_SQL}) WHERE n > 1
"""


def spine_join_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five measure tables on (code, report_date); signups are single events, so they multiply rows."""
    tables = _event_tables(spark, sf_dir)
    keys = ["code", "report_date"]
    signups = table(spark, sf_dir, "events").where(F.col("event_type") == "signup").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("code"),
        F.to_date("ts").alias("report_date"),
        F.col("event_id").alias("signup_id"),
    )
    measures = [complete_rows(tables[k]).drop("name") for k in ("click", "error", "purchase", "view")]
    base = build_spine(list(tables.values()), ["code", "name", "report_date"])
    return keys_first(attach_measures(base, [*measures, signups], keys), ["code", "name", "report_date"])


def _join_sql(using: str, extra: str = "", extra_column: str = "", base: str = "") -> str:
    kinds = ("click", "error", "purchase", "view")
    joins = "\n".join(
        f"LEFT JOIN (SELECT code, name, report_date, n AS {k} FROM days WHERE event_type = '{k}') t_{k} USING ({using})"
        for k in kinds
    )
    base = base or "(SELECT DISTINCT code, name, report_date FROM days)"
    return f"""
WITH days AS ({EVENT_DAYS_SQL})
SELECT code, spine.name AS name, report_date, {", ".join(kinds)}{extra_column}
FROM {base} spine
{joins}
{extra}
"""


SPINE_2KEY_SQL = _join_sql(
    "code, report_date",
    "LEFT JOIN (SELECT 'U' || user_id AS code, CAST(ts AS DATE) AS report_date, event_id AS signup_id "
    "FROM events WHERE event_type = 'signup') s USING (code, report_date)",
    ", signup_id",
)


def spine_join_3key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _event_tables(spark, sf_dir)
    keys = ["code", "name", "report_date"]
    measures = [complete_rows(tables[k]) for k in ("click", "error", "purchase", "view")]
    return attach_measures(build_spine(list(tables.values()), keys), measures, keys)


SPINE_3KEY_SQL = _join_sql("code, name, report_date").replace("spine.name AS name", "name")


def driver_table_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measure table leads the chain instead of a spine."""
    tables = _event_tables(spark, sf_dir)
    others = [complete_rows(tables[k]).drop("name") for k in ("click", "error", "purchase", "view")]
    return attach_measures(complete_rows(tables["signup"]), others, ["code", "report_date"])


DRIVER_TABLE_SQL = _join_sql(
    "code, report_date",
    extra_column=", signup",
    base="(SELECT code, name, report_date, n AS signup FROM days WHERE event_type = 'signup')",
)


def later_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' months, with a second series that starts in 1998."""
    main = _report(spark, sf_dir, "customer").select("code", "report_date", "open")
    later = (
        _report(spark, sf_dir, "customer")
        .where(F.col("report_date") >= F.lit("1998-01-01").cast("date"))
        .select("code", "report_date", F.col("occ").alias("late_occ"))
    )
    return attach_measures(main, [later], ["code", "report_date"])


LATER_BAND_SQL = f"""
WITH report AS ({REPORT_SQL.format(keys=CUSTOMER_KEYS)})
SELECT code, report_date, open, CASE WHEN report_date >= DATE '1998-01-01' THEN occ END AS late_occ FROM report
"""


def two_source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two workbooks in one cell table, told apart by the workbook column."""
    orders = table(spark, sf_dir, "orders")
    nation_of = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_month = (
        orders.join(nation_of, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", month_of("o_orderdate").alias("report_date"), "o_orderstatus")
        .agg(F.count("*").alias("n"))
    )
    both = per_month.withColumn(
        "workbook", F.when(F.col("o_orderstatus") == "F", "main").otherwise("ambulance")
    ).select(
        F.lit("two").alias("winter"),
        "workbook",
        F.lit("orders").alias("sheet"),
        F.col("c_nationkey").alias("row_idx"),
        F.datediff("report_date", F.lit("1994-12-31").cast("date")).alias("col_idx"),
        F.concat_ws(":", F.col("o_orderstatus"), F.col("n").cast("string")).alias("value"),
    )
    path = work_dir(spark, "two-source")
    write_cells(both, path)
    grid = read_cells(spark, path)
    place = ["row_idx", "col_idx"]

    def source(workbook: str, status: str, measure: str) -> DataFrame:
        number = F.split_part("value", F.lit(":"), F.lit(2)).cast("int")
        rows = grid.where((F.col("workbook") == workbook) & F.col("value").startswith(status))
        return rows.select(*place, number.alias(measure))

    main = source("main", "F", "finished")
    return attach_measures(main, [source("ambulance", s, m) for s, m in (("O", "open"), ("P", "partial"))], place)


TWO_SOURCE_SQL = """
WITH n AS (
  SELECT c_nationkey AS row_idx, o_orderstatus,
         CAST(date_diff('day', DATE '1994-12-31', CAST(date_trunc('month', o_orderdate) AS DATE)) AS INTEGER) AS col_idx,
         CAST(count(*) AS INTEGER) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
)
SELECT f.row_idx, f.col_idx, f.n AS finished, o.n AS open, p.n AS partial
FROM (SELECT * FROM n WHERE o_orderstatus = 'F') f
LEFT JOIN (SELECT * FROM n WHERE o_orderstatus = 'O') o USING (row_idx, col_idx)
LEFT JOIN (SELECT * FROM n WHERE o_orderstatus = 'P') p USING (row_idx, col_idx)
"""


# --- names, order, directory, snapshots ------------------------------------------


def label_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", national_name(F.initcap("c_mktsegment"), "MACHINE", "Machines").alias("name"))


def excluded_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return exclude_names(customer, ["Customer#000000001", "Customer#000000077"], "c_name")


def reorder_distinct_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admin column dropped, columns renamed, keys first, distinct, sorted."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey", "l_quantity", "l_tax")
    tidy = lines.drop("l_tax").withColumnsRenamed({"l_suppkey": "code", "l_quantity": "beds", "l_linestatus": "region"})
    return keys_first(tidy, ["code", "region"]).distinct().orderBy("code", "region")


REORDER_SQL = """
SELECT DISTINCT l_suppkey AS code, l_linestatus AS region, l_returnflag, l_quantity AS beds
FROM lineitem ORDER BY 1, 2
"""


def directory_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as a headerless directory file and read back."""
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    filled = {
        "Organisation code": F.col("c_custkey").cast("string"),
        "Name": F.concat(F.lit('"The" '), F.col("c_name"), F.lit(", Ltd")),
        "National grouping": F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")),
        "Address line 1": F.col("c_mktsegment"),
        "Open date": F.when(F.col("c_acctbal") < 0, "NA").otherwise(F.col("c_acctbal").cast("string")),
    }
    path = work_dir(spark, "directory")
    (
        customer.select(*[filled.get(c, F.lit(None).cast("string")).alias(c) for c in DIRECTORY_COLUMNS])
        .write.option("header", False)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .csv(path)
    )
    directory = load_trusts(spark, path)
    return directory.select(
        F.col("Organisation code").alias("code"),
        F.col("Name").alias("name"),
        F.col("National grouping").alias("grouping"),
        F.col("Address line 1").alias("address"),
        F.col("Open date").try_cast("double").alias("opened"),
        F.coalesce(*[F.col(f"`{c}`") for c in DIRECTORY_COLUMNS if c not in filled]).alias("blank"),
    )


DIRECTORY_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS code, '"The" ' || c_name || ', Ltd' AS name, n_name AS grouping,
       c_mktsegment AS address, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS opened,
       CAST(NULL AS VARCHAR) AS blank
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two winters saved, one replaced, both read back."""
    facts = _report(spark, sf_dir, "customer").select(
        "code",
        "name",
        "region",
        "report_date",
        F.col("open").cast("int").alias("ga_beds_open"),
        F.col("occ").cast("int").alias("ga_beds_occupied"),
    )
    path = work_dir(spark, "snapshot")
    write_snapshot(facts.where(F.col("region") == "ASIA"), "2021-22", path)
    write_snapshot(facts.withColumn("ga_beds_open", F.lit(0)), "2022-23", path)
    write_snapshot(facts, "2022-23", path)

    def saved(winter: str) -> DataFrame:
        return read_snapshot(spark, path, winter).select(
            F.lit(winter).alias("winter"), "code", "name", "report_date", "ga_beds_open", "ga_beds_occupied", "flu_ga"
        )

    return saved("2021-22").unionByName(saved("2022-23"))


SNAPSHOT_SQL = f"""
WITH report AS ({REPORT_SQL.format(keys=CUSTOMER_KEYS)})
SELECT winter, code, name, report_date, CAST(open AS INTEGER) AS ga_beds_open,
       CAST(occ AS INTEGER) AS ga_beds_occupied, CAST(NULL AS INTEGER) AS flu_ga
FROM report JOIN (VALUES ('2021-22'), ('2022-23')) w(winter) ON winter = '2022-23' OR region = 'ASIA'
"""

QUERIES = {
    "tidy_report": (tidy_report, tidy_report_sql(NATION_KEYS)),
    "tidy_report_customers": (lambda s, d: tidy_report(s, d, "customer"), tidy_report_sql(CUSTOMER_KEYS)),
    "heading_ordinal": (heading_ordinals, HEADING_ORDINAL_SQL),
    "heading_synonyms": (heading_synonyms, HEADING_SYNONYMS_SQL),
    "series_lengths": (series_length_check, SERIES_LENGTH_SQL),
    "densify_grid": (densify_grid, DENSIFY_SQL),
    "drop_body_rows": (
        dropped_body_rows,
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber NOT IN (2, 3)",
    ),
    "drop_empty": (
        dropped_empty_rows,
        "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax "
        "FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0",
    ),
    "drop_empty_columns": (
        dropped_empty_columns,
        "SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'",
    ),
    "unpivot_measures": (unpivoted, UNPIVOT_SQL),
    "pivot_series": (pivoted, PIVOT_SQL),
    "prefix_select": (
        prefix_select,
        "SELECT p_partkey, p_type AS heading FROM part WHERE lower(p_type) LIKE 'sm%' OR lower(p_type) LIKE 'econ%'",
    ),
    "prefix_select_columns": (
        prefix_select_columns,
        "SELECT l_orderkey, l_linenumber, l_suppkey, l_discount, l_tax, l_shipdate FROM lineitem",
    ),
    "across_measures": (
        across_measures,
        "SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity, "
        "CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice, CAST(trunc(l_tax) AS INTEGER) AS l_tax FROM lineitem",
    ),
    "excel_serial_date": (excel_serial_date, EXCEL_SERIAL_SQL),
    "date_text_normalise": (date_text_normalise, DATE_TEXT_SQL),
    "date_rejects": (unreadable_dates, DATE_REJECTS_SQL),
    "date_range_collapse": (date_range_collapse, DATE_RANGE_SQL),
    "cast_trunc": (cast_trunc, CAST_SQL),
    "nullif_sentinel": (
        nullif_sentinel,
        f"SELECT l_orderkey, l_linenumber, nullif(raw, '-') AS value FROM ({MESSY_SQL})",
    ),
    "safe_ratio": (ratios, RATIO_SQL),
    "heading_suffix_strip": (suffix_strip, "SELECT p_partkey, p_name || '__1' AS heading FROM part"),
    "sum_na_rm": (
        sums_without_nulls,
        "SELECT l_orderkey, CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS BIGINT) "
        "AS returned FROM lineitem GROUP BY 1",
    ),
    "merge_two_series": (merge_two_series, MERGE_SQL),
    "spine": (spine, SPINE_SQL),
    "spine_join_2key": (spine_join_2key, SPINE_2KEY_SQL),
    "spine_join_3key": (spine_join_3key, SPINE_3KEY_SQL),
    "driver_table_join": (driver_table_join, DRIVER_TABLE_SQL),
    "later_band_join": (later_band_join, LATER_BAND_SQL),
    "two_source_report": (two_source_report, TWO_SOURCE_SQL),
    "label_normalise": (
        label_normalise,
        "SELECT c_custkey, CASE WHEN upper(c_mktsegment) LIKE '%MACHINE%' THEN 'Machines' "
        "ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS name FROM customer",
    ),
    "exclude_org": (
        excluded_org,
        "SELECT c_custkey, c_name, c_acctbal FROM customer "
        "WHERE c_name NOT IN ('Customer#000000001', 'Customer#000000077')",
    ),
    "reorder_distinct_sort": (reorder_distinct_sort, REORDER_SQL),
    "directory_csv": (directory_csv, DIRECTORY_SQL),
    "snapshot_roundtrip": (snapshot_roundtrip, SNAPSHOT_SQL),
}

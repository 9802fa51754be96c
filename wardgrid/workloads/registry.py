"""All queries by name, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from wardgrid.layouts import ARCHIVED_LAYOUTS, WINTERS
from wardgrid.workloads.operators import QUERIES
from wardgrid.workloads.winters import (
    ARCHIVED_SQL,
    all_winters_sql,
    load_all_winters,
    load_archived,
    load_winter,
    refresh_winters,
    winter_sql,
)

Query = Callable[[SparkSession, str], DataFrame]


def _key(winter: str) -> str:
    return f"load_{winter.replace('-', '_')}"


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: run for name, (run, _) in QUERIES.items()}
    found |= {_key(w): partial(load_winter, winter=w) for w in WINTERS}
    found["load_all_winters"] = load_all_winters
    found["refresh_winters"] = refresh_winters
    found |= {_key(f"archived-{w}"): partial(load_archived, winter=w) for w in ARCHIVED_LAYOUTS}
    found |= {
        f"{_key(w)}_by_joins": partial(load_winter, winter=w, duplicates="multiply")
        for w in ("2019-20", "2021-22", "2022-23")
    }
    return found


def oracle_sql() -> dict[str, str]:
    found = {name: sql for name, (_, sql) in QUERIES.items()}
    found |= {_key(w): winter_sql(w) for w in WINTERS}
    found["load_all_winters"] = all_winters_sql()
    found["refresh_winters"] = all_winters_sql(("2019-20", "2022-23"))
    found |= {_key(f"archived-{w}"): ARCHIVED_SQL for w in ARCHIVED_LAYOUTS}
    found |= {f"{_key(w)}_by_joins": winter_sql(w) for w in ("2019-20", "2021-22", "2022-23")}
    return found

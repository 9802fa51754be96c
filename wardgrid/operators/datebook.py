"""Dates by distinct text: each text is read once, however many rows hold it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.operators.bounds import MAX_SMALL_ROWS, small_rows

Reader = Callable[[Column], Column]


def date_book(rows: DataFrame, text: str, dates: Mapping[str, Reader]) -> DataFrame:
    """(text, one date column per reader) of the distinct texts."""
    distinct = rows.select(text).where(F.col(text).isNotNull()).distinct()
    return distinct.select(text, *[read(F.col(text)).alias(name) for name, read in dates.items()])


def attach_dates(rows: DataFrame, text: str, dates: Mapping[str, Reader], limit: int = MAX_SMALL_ROWS) -> DataFrame:
    """rows with the dates of their text; a null text has none.

    The book of distinct texts is fetched (a job) and broadcast if it has at
    most `limit` entries; beyond that it is joined by shuffle.
    """
    book = date_book(rows, text, dates)
    found = small_rows(book, limit)
    if found is not None:
        book = F.broadcast(rows.sparkSession.createDataFrame(found, book.schema))
    return rows.join(book, text, "left").select(*rows.columns, *dates)


def date_rejects(rows: DataFrame, text: str, read: Reader, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, text, n_rows) of the texts that are not blank and read as no date."""
    texts = rows.where(F.trim(text) != "").groupBy(*keys, text).agg(F.count("*").alias("n_rows"))
    return texts.where(read(F.col(text)).isNull())

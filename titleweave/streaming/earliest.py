"""Earliest row of every title and month in a stream, whatever the order of arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_KEPT = "month string, title string, rank string, row string"


class _Earliest(StatefulProcessor):
    """Holds a title's least row of a month until the watermark has passed the month's end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getValueState("held", "rank string, row string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = not self._held.exists()
        least = None if new else tuple(self._held.get())
        for batch in rows:
            if new:
                self._handle.registerTimer(int(batch["closes"].iloc[0]))
                new = False
            first = batch["rank"].idxmin()
            found = (batch["rank"][first], batch["row"][first])
            least = found if least is None or found < least else least
        self._held.update(least)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rank, row = self._held.get()
        self._held.clear()
        yield pd.DataFrame({"month": [key[0]], "title": [key[1]], "rank": [rank], "row": [row]})

    def close(self) -> None:
        pass


def _rank(ts: str, order: list[str]) -> Column:
    """A text that sorts as the time, then the order columns, nulls first."""
    moment = F.lpad((F.unix_micros(ts) + F.lit(2**62)).cast("string"), 20, "0")
    return F.concat_ws("\u0001", moment, *[F.concat(F.when(F.col(c).isNull(), "0").otherwise("1"), F.coalesce(c, F.lit(""))) for c in order])


def earliest_titles(stream: DataFrame, ts: str = "gkg_date", title: str = "headline", order: list[str] | None = None, delay: str = "31 days") -> DataFrame:
    """Per month and title the row of the least time (ties by ``order``), once its month is closed.

    A month closes when the watermark, ``delay`` behind the latest time seen, passes its end; rows
    that come later than that are dropped by the engine. Rows without a time or a title are left
    out. The state holds one row per title of the open months; it needs the settings in ``STATE``.
    """
    columns = [c for c in stream.columns]
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).where(F.col(ts).isNotNull() & F.col(title).isNotNull())
    kind = timed.schema
    closes = F.unix_millis(F.add_months(F.trunc(F.to_date(ts), "month"), 1).cast("timestamp"))
    keyed = timed.withWatermark(ts, delay).select(
        F.date_format(ts, "yyyy-MM").alias("month"), F.col(title).alias("title"), F.col(ts).alias("at"),
        closes.alias("closes"), _rank(ts, order or []).alias("rank"), F.to_json(F.struct(*columns), _EXACT).alias("row"),
    )
    found = keyed.groupBy("month", "title").transformWithStateInPandas(
        _Earliest(), outputStructType=_KEPT, outputMode="append", timeMode="eventTime"
    )
    return found.select(F.from_json("row", kind, _EXACT).alias("kept")).select("kept.*")


def with_open_months(closed: DataFrame, rows: DataFrame, earliest, ts: str = "gkg_date") -> DataFrame:
    """Closing batch pass: the stream's rows of closed months, and ``earliest`` of the rows of all later ones.

    ``earliest`` is the batch form, such as ``web_extract.dedup_earliest``.
    """
    last = closed.agg(F.max(F.date_format(ts, "yyyy-MM"))).scalar()
    later = rows.where(last.isNull() | (F.date_format(ts, "yyyy-MM") > last))
    return closed.unionByName(earliest(later).select(*closed.columns))

"""Keys that a stream remembers for a stated time, and a place for what comes later.

Each key has a state machine: unknown, remembered until a time, forgotten. A key is remembered
until the watermark (the newest event time of earlier batches, less the horizon) passes the
latest event time that was seen for it; then a timer removes it from the state. So the state is
bounded by the keys of one horizon. An event that is older than the watermark cannot be told from
one that was stored and forgotten: it is not dropped but marked as late, for a table of its own.

Keys are held in buckets by a hash of the key, each bucket one state with one timer, since a call
of Python into the state costs far more than the row that it is for. A batch reads and writes the
buckets of its own keys only.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.schema import KEY

STORED, LATE = "stored", "late"
# Fixed value: checkpoints rely on it. Some 1,000 keys each where a horizon has fifteen million.
BUCKETS = 1 << 14
BUCKET = "_bucket"


class Remember(StatefulProcessor):
    """Decides about the rows of a bucket of keys; a key has one row in a batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("remembered", "keys array<string>, until array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        until = self.held()
        timer, changed, layout = min(until.values(), default=None), False, None
        for row in rows:
            if layout is None:
                layout = list(row.__fields__)
                name_at, moment_at = layout.index(KEY), layout.index("millis")
                kept = [i for i, name in enumerate(layout) if name not in ("millis", BUCKET)]
                marked = Row(*(layout[i] for i in kept), "fate")
            name, moment = row[name_at], row[moment_at]
            if moment < now:
                yield marked(*(row[i] for i in kept), LATE)
                continue
            if name not in until:
                yield marked(*(row[i] for i in kept), STORED)
            if moment > until.get(name, -1):
                until[name], changed = moment, True
        if changed:
            self.hold(until, timer)

    def held(self) -> dict[str | None, int]:
        """The latest event time of each remembered key."""
        found = self.state.get() if self.state.exists() else None
        return dict(zip(found[0], found[1], strict=True)) if found else {}

    def hold(self, until: dict[str | None, int], timer: int | None) -> None:
        """Keep the keys of a bucket, and set its timer to the first that is to be forgotten.

        `timer` is the time that the timer was set for, if there is one.
        """
        first = min(until.values())
        self.state.update((list(until), list(until.values())))
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer + 1)
            self.handle.registerTimer(first + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Each key goes as if it had a timer of its own: those that fire are before the watermark.
        now = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        until = {name: moment for name, moment in self.held().items() if moment + 1 > now}
        if until:
            self.hold(until, None)  # Spark removes the timer that has fired
        else:
            self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def remembered(events: DataFrame) -> DataFrame:
    """Rows that are stored and rows that come too late, told apart by the column `fate`.

    `events` has one row per key in each batch, and a watermark that was set before its rows
    were gathered: columns that still carry it would make Spark drop late rows unseen.
    """
    bucket = F.pmod(F.xxhash64(KEY), F.lit(BUCKETS)).cast("int")
    rows = events.withColumns({"millis": F.unix_millis("event_time"), BUCKET: bucket})
    schema = T.StructType([*events.schema.fields]).add("fate", "string")
    return rows.groupBy(BUCKET).transformWithState(Remember(), schema, "append", "EventTime")

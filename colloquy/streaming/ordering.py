"""Turns of a stream put in the order of their sessions.

Turns may arrive in any order and in any batch. A session's turn leaves when all
turns before it have left: at once if they are numbered without gaps, else when
the watermark has passed its event time, as nothing older can then arrive. What
has to wait is in a list, on RocksDB, to which a batch appends; it is read when the
turn that it waited for has come, or when the session's one timer on event time,
that of its earliest waiting turn, wakes it up. So a batch asks the state a few
times per session, not per turn, and a session that is silent is not read again.

Operators that take a session's turns in order, such as those of ``sessions``,
then give on a stream what they give on the whole table, however the turns were
dealt to batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def in_turn_order(turns: DataFrame, event_time: str, delay: str, first_turn: int | None = 0) -> DataFrame:
    """The turns ``conv_id, turn, ...`` as they leave, with ``late``.

    ``event_time`` is a timestamp column that does not go back within a session;
    ``delay`` is how much later than the latest one a turn may arrive (Spark
    drops what is older, and counts it in the query's progress). ``first_turn``
    is the number that sessions begin with; None waits for the watermark before
    the first turn leaves. A turn that arrives after a later one has left, or
    for the second time, leaves at once with ``late`` true. A turn that waits
    and arrives again is one turn. Within a batch, a session's rows come in the
    order of their turns. Rows without a turn or a time leave as late.
    """
    schema = turns.schema
    kind = schema["conv_id"].dataType.simpleString()
    packed = turns.withWatermark(event_time, delay).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col(event_time),
        F.unix_millis(F.col(event_time).cast("timestamp")).alias("ms"),
        F.unix_micros(F.col(event_time).cast("timestamp")).alias("us"),
        F.to_json(F.struct(*[c for c in turns.columns if c not in ("conv_id", "turn", event_time)])).alias("row"),
    )

    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    # Defined here so that workers get the class by value and need no package of ours.
    class Ordering(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.waiting = handle.getListState("waiting", "turn LONG, ms LONG, us LONG, row STRING")
            # the turn to leave next, the least turn that waits, the time of the timer
            self.place = handle.getValueState("place", "next LONG, least LONG, timer LONG")

        def handleInputRows(self, key, rows, timer_values):
            came, out = {}, []
            before = self.place.get()
            place, least, timer = (first_turn, None, None) if before is None else before
            for chunk in rows:
                for turn, ms, us, row in zip(*(chunk[c].tolist() for c in ("turn", "ms", "us", "row"))):
                    if turn != turn or turn is None or ms != ms or ms is None:
                        out.append((None if turn is None or turn != turn else int(turn), None if ms is None or ms != ms else int(us), row, True))
                    elif place is not None and turn < place or int(turn) in came:
                        out.append((int(turn), int(us), row, True))
                    else:
                        came[int(turn)] = (int(ms), int(us), row)
            if came:
                place = self.ready(came, place, out)
                if least is not None and place is not None and least <= place:
                    held = {k: v for k, v in self.held().items() if k >= place} | came
                    place = self.ready(held, place, out)
                    least, timer = self.keep(held, timer)
                elif came:
                    self.waiting.appendList([(k, *v) for k, v in came.items()])
                    least = min(came) if least is None else min(least, *came)
                    timer = self.wake(timer, min(v[0] for v in came.values()))
                self.place.update((place, least, timer))
            if out:
                yield self.rows(key, out)

        def held(self):
            """What waits; of a turn that came again, the later one."""
            return {turn: value for turn, *value in map(tuple, self.waiting.get())}

        def ready(self, turns, place, out):
            """Take what follows without a gap; the turn to leave next."""
            while place is not None and place in turns:
                _, us, row = turns.pop(place)
                out.append((place, us, row, False))
                place += 1
            return place

        def keep(self, turns, timer):
            """Let these turns wait, and no others: the least of them, and the time of the timer."""
            if not turns:
                self.waiting.clear()
                if timer is not None:
                    self.handle.deleteTimer(timer)
                return None, None
            self.waiting.put([(k, *v) for k, v in turns.items()])
            return min(turns), self.wake(timer, min(v[0] for v in turns.values()))

        def wake(self, timer, ms):
            if timer is not None and timer <= ms:
                return timer
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(ms)
            return ms

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # called by these names
            passed = timerValues.getCurrentWatermarkInMs()
            place, _, _ = self.place.get()
            held, out = self.held(), []
            last = max((turn for turn, v in held.items() if v[0] <= passed), default=None)
            if last is not None:
                for turn in sorted(t for t in held if t <= last):
                    _, us, row = held.pop(turn)
                    out.append((turn, us, row, False))
                place = self.ready(held, last + 1, out)
            self.place.update((place, *self.keep(held, None)))  # the timer that woke it is gone
            if out:
                yield self.rows(key, out)

        def rows(self, key, out):
            import pandas as pd

            frame = pd.DataFrame(out, columns=["turn", "us", "row", "late"]).astype({"turn": "Int64", "us": "Int64"})
            frame.insert(0, "conv_id", [key[0]] * len(out))
            return frame

        def close(self):
            pass

    ordered = packed.groupBy("conv_id").transformWithStateInPandas(
        Ordering(),
        outputStructType=f"conv_id {kind}, turn long, us long, row string, late boolean",
        outputMode="append",
        timeMode="EventTime",
    )
    rest = StructType([f for f in schema.fields if f.name not in ("conv_id", "turn", event_time)])
    own = F.from_json("row", rest)
    fields = []
    for f in schema.fields:
        if f.name == event_time:
            fields.append(F.timestamp_micros("us").cast(f.dataType).alias(f.name))
        elif f.name in ("conv_id", "turn"):
            fields.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            fields.append(F.col("own")[f.name].alias(f.name))
    return ordered.withColumn("own", own).select(*fields, "late")

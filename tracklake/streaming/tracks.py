"""The online pipeline as streams: observations -> buffers -> decisions -> events.

Buffers and events are stateful steps; scores use the definitions of ``operators.tracks``. The event machine keeps its state in the
state store (last decisions, open event, counts of reasons), where it can be read while the stream runs; a
test holds its events against those of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tracklake.operators.tracks import SEEN, buffer_scores
from tracklake.params import EventParams, FusionParams, MotionParams, OnlineParams

OBSERVATION = "clip bigint, track bigint, ts timestamp, step bigint, d double, obj double"
BUFFER = f"clip bigint, track bigint, session bigint, step bigint, low bigint, seen {SEEN}, closed_at bigint, late bigint"
STATE = "steps array<bigint>, ds array<double>, objs array<double>, first bigint, session bigint, clock bigint"


def observation_stream(spark: SparkSession, folder: str, schema: str = OBSERVATION, files_per_batch: int = 100) -> DataFrame:
    """Observations that arrive as Parquet files in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


class _Buffers:
    """What one track of one clip does with its observations, in the order of their steps."""

    def __init__(self, p: OnlineParams, need: int, step_ms: int):
        self.p, self.need, self.step_ms = p, need, step_ms

    def due(self, key: tuple, kept: list, first: int, session: int, a: int, b: int) -> list[tuple]:
        """A row for each due step from a to b at which enough of the buffer was seen."""
        rows = []
        for s in range(-(-a // self.p.hop) * self.p.hop, b + 1, self.p.hop):
            low = max(first, s - self.p.buffer + 1)
            seen = [{"step": t, "d": d, "obj": o} for t, d, o in kept if low <= t <= s]
            if len(seen) >= self.need:
                rows.append((*key, session, s, low, seen, None, None))
        return rows

    def __call__(self, key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        steps, ds, objs, first, session, clock = state.get if state.exists else ([], [], [], None, 0, None)
        kept, out = list(zip(steps, ds, objs, strict=True)), []
        alive = self.p.max_missing
        if state.hasTimedOut:
            last = kept[-1][0]
            out += self.due(key, kept, first, session, clock + 1, last + alive)
            out.append((*key, session, None, None, None, last + alive + 1, None))
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values("step").drop_duplicates("step")
            late = 0
            for t, d, o in zip(rows["step"].tolist(), rows["d"].tolist(), rows["obj"].tolist(), strict=True):
                if clock is not None and t <= clock:
                    late += 1  # beyond what has been judged
                    continue
                if kept:
                    last = kept[-1][0]
                    out += self.due(key, kept, first, session, clock + 1, min(t - 1, last + alive))
                    if t - last > alive + 1:
                        out.append((*key, session, None, None, None, last + alive + 1, None))
                        kept, first, session = [], None, session + 1
                first = t if first is None else first
                kept = [k for k in kept if k[0] > t - self.p.buffer] + [(t, None if pd.isna(d) else d, None if pd.isna(o) else o)]
                out += self.due(key, kept, first, session, t, t)
                clock = t
            if late:
                out.append((*key, session, None, None, None, None, late))
            if kept:
                state.update(([k[0] for k in kept], [k[1] for k in kept], [k[2] for k in kept], first, session, clock))
                state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, int(rows["ts"].max().timestamp() * 1000) + (alive + 1) * self.step_ms))
        yield pd.DataFrame(out, columns=["clip", "track", "session", "step", "low", "seen", "closed_at", "late"]).astype({c: "Int64" for c in ("session", "step", "low", "closed_at", "late")})


def decision_stream(obs: DataFrame, online: OnlineParams, motion: MotionParams | None = None, fusion: FusionParams | None = None, first_seen: int | None = None, delay: str = "10 minutes", step_ms: int = 100) -> DataFrame:
    """Decisions of a stream of observations (clip, track, ts, step, d, obj), as ``operators.tracks.decisions`` makes them,
    and for each session that has ended a row with ``closed_at`` and no decision.

    A track's state is its buffer. It is judged at a due step as soon as a later observation of the track, or
    the watermark, shows that the step is over; a track unheard of for ``max_missing`` steps is closed by the
    watermark and its state removed. Later observations of steps that are over are left out and counted: the metric
    ``late_rows`` of the query, which ``LateRows`` sums up with those that the watermark has dropped.
    """
    need = first_seen if first_seen is not None else max(3, online.window // 3)
    timed = obs.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    made = timed.groupBy("clip", "track").applyInPandasWithState(_Buffers(online, need, step_ms), BUFFER, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    made = made.observe("late_rows", F.coalesce(F.sum("late"), F.lit(0)).alias("n")).where("late IS NULL")
    x = F.when(F.col("closed_at").isNull(), buffer_scores(F.col("seen"), F.col("low"), F.col("step"), online, motion or MotionParams(), fusion or FusionParams()))
    return made.withColumn("x", x).select("clip", "track", "session", "step", "x.obj_score", "x.mot_score", "x.fused.decision", "x.fused.score", "x.fused.reason", "closed_at")


class LateRows(StreamingQueryListener):
    """Sums up the observations that streams have left out: add it by ``spark.streams.addListener``. ``judged`` came after
    their step had been judged, ``dropped`` were older than the watermark."""

    def __init__(self) -> None:
        self.judged = self.dropped = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if (row := event.progress.observedMetrics.get("late_rows")) is not None:
            self.judged += row.n
            self.dropped += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        pass


FOUND = "clip bigint, track bigint, session bigint, start_step bigint, end_step bigint, peak_score double, peak_object double, peak_motion double, n_positive int, kinds array<string>, counts array<int>"


class _Machine(StatefulProcessor):
    """The event machine of one track of one clip, by the rules of ``operators.tracks.events``."""

    def __init__(self, p: EventParams, ttl_ms: int | None):
        self.p, self.ttl_ms = p, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "decision boolean", self.ttl_ms)
        self.negatives = handle.getValueState("negatives", "n int", self.ttl_ms)
        self.open = handle.getValueState("open", "session bigint, start bigint, score double, obj double, mot double", self.ttl_ms)
        self.reasons = handle.getMapState("reasons", "reason string", "n int", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))
        frame["ends"] = frame["closed_at"].notna()
        recent, negatives = [bool(x[0]) for x in self.recent.get()], (self.negatives.get() or (0,))[0]
        held, reasons = self.open.get(), {k[0]: v[0] for k, v in self.reasons.iterator()}
        out = []

        def close(stop: int) -> None:
            nonlocal held, reasons
            kinds = sorted(reasons)
            out.append((*key, held[0], held[1], stop, *held[2:], sum(reasons.values()), kinds, [reasons[k] for k in kinds]))
            held, reasons = None, {}

        for r in frame.sort_values(["session", "ends", "step"]).itertuples(index=False):
            if r.ends:
                if held is not None:
                    close(int(r.closed_at))
                recent, negatives = [], 0
                continue
            said = bool(r.decision)
            recent, negatives = [*recent, said][-self.p.n_on :], 0 if said else negatives + 1
            if held is None and sum(recent) >= self.p.k_on:
                held = (int(r.session), int(r.step), 0.0, 0.0, 0.0)
            if held is not None and said:
                held = (*held[:2], max(held[2], r.score), max(held[3], r.obj_score), max(held[4], r.mot_score))
                reasons[r.reason] = reasons.get(r.reason, 0) + 1
            if held is not None and negatives >= self.p.m_off:
                close(int(r.step))
        self._keep(recent, negatives, held, reasons)
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in FOUND.split(", ")])

    def _keep(self, recent: list[bool], negatives: int, held: tuple | None, reasons: dict[str, int]) -> None:
        """Write what a track has; what it has not leaves the store."""
        self.reasons.clear()
        for reason, n in reasons.items():
            self.reasons.updateValue((reason,), (n,))
        if held is None:
            self.open.clear()
        else:
            self.open.update(held)
        if recent:
            self.recent.put([(x,) for x in recent])
            self.negatives.update((negatives,))
        else:
            self.recent.clear()
            self.negatives.clear()

    def close(self) -> None:
        pass


def event_stream(decisions: DataFrame, p: EventParams | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Events of a stream of ``decision_stream`` rows, each as soon as it is over.

    The state of a track is a few rows in the state store and goes when its session ends; with ``ttl_ms`` also that of a track
    which nobody closes. The store must be RocksDB (``rocksdb``).
    """
    mode = "ProcessingTime" if ttl_ms else "None"
    found = decisions.groupBy("clip", "track").transformWithStateInPandas(_Machine(p or EventParams(), ttl_ms), FOUND, "Append", mode)
    return found.withColumn("triggered_by", F.map_from_arrays("kinds", "counts")).drop("kinds", "counts")


def rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def write_events(decisions: DataFrame, folder: str, p: EventParams | None = None, ttl_ms: int | None = None) -> StreamingQuery:
    """``event_stream`` as Parquet under ``folder/events``; ends when the stream has no more data for now, and goes on
    from ``folder/checkpoint`` when it is called again."""
    rocksdb(decisions.sparkSession)
    return event_stream(decisions, p, ttl_ms).writeStream.format("parquet").option("path", f"{folder}/events").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def open_events(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``clip, track, session, start_step, peak_score`` of the events that are open after the last batch, from the state store of a stream
    of ``event_stream``, running or not."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    return state.select("key.clip", "key.track", "value.session", F.col("value.start").alias("start_step"), F.col("value.score").alias("peak_score"))


def hop_scores(observations: DataFrame, window: str = "6 hours", hop: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Hopping-window object score of each track: exact 80th percentile of the object confidence."""
    timed = observations.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy("track", F.window("ts", window, hop)).agg(F.expr("percentile(obj, 0.8)").alias("obj_score"), F.count("*").alias("n_seen"))

"""The streams give what the batch gives."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tracklake.operators import tracks as T
from tracklake.params import EventParams, FusionParams, MotionParams, OnlineParams
from tracklake.streaming import tracks as S

ONLINE = OnlineParams(fps=1.0, window=12, hop=6, buffer=48, max_missing=10)
BEGIN = datetime(2024, 1, 1, tzinfo=timezone.utc)


def observations():
    rnd = random.Random(4)
    rows = []
    for clip in (0, 1):
        for track in range(6):
            step, near = rnd.randrange(20), False
            while step < 400:
                if rnd.random() < 0.1:
                    near = not near
                d = None if rnd.random() < 0.05 else round(rnd.uniform(0.1, 0.5) if near else rnd.uniform(1.2, 2.5), 3)
                rows.append((clip, track, BEGIN + timedelta(seconds=step), step, d, round(rnd.random() if near else rnd.random() / 4, 3)))
                step += rnd.choice((1, 1, 1, 2, 3)) if rnd.random() < 0.97 else rnd.randrange(5, 40)
        rows.append((clip, 99, BEGIN + timedelta(seconds=600), 600, 1.0, 0.0))  # the clip goes on after the others
    return rows


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.createDataFrame(observations(), "clip long, track long, ts timestamp, step long, d double, obj double")
    batch = rows.drop("ts")
    judged = T.decisions(batch, ONLINE, MotionParams(), FusionParams())
    want = T.events(judged, EventParams(), T.session_ends(batch, ONLINE.max_missing)).where("track <> 99")
    for k, (a, b) in enumerate(((0, 90), (90, 200), (200, 330), (330, 500), (500, 700))):
        rows.where(F.col("step").between(a, b - 1)).coalesce(1).write.parquet(f"{folder}/in/{k}")
        (tmp_path / "in" / f"{k}.parquet").write_bytes(next((tmp_path / "in" / str(k)).glob("part-*")).read_bytes())
    stream = S.observation_stream(spark, f"{folder}/in/*.parquet", files_per_batch=1)
    decided = S.decision_stream(stream, ONLINE, delay="1 second", step_ms=1000)
    decided.writeStream.format("parquet").option("path", f"{folder}/decisions").option("checkpointLocation", f"{folder}/checkpoint-decisions").trigger(availableNow=True).start().awaitTermination()
    columns = ["clip", "track", "session", "step", "obj_score", "mot_score", "decision", "reason"]
    made = spark.read.parquet(f"{folder}/decisions").where("track <> 99")
    assert made.where("decision IS NOT NULL").select(columns).exceptAll(judged.where("track <> 99").select(columns)).count() == 0
    assert made.where("decision IS NOT NULL").count() == judged.where("track <> 99").count() > 100
    stream = lambda: spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/later")
    names = ["clip", "track", "session", "start_step", "end_step", "n_positive"]
    everything = spark.read.parquet(f"{folder}/decisions")
    # the stream stops in the middle and goes on from its checkpoint
    turn = F.coalesce("step", "closed_at")
    for k, part in enumerate((turn <= 150, (turn > 150) & (turn <= 260), turn > 260)):
        everything.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/later")
        S.write_events(stream(), f"{folder}/online").awaitTermination()
        upto = (150, 260, 10_000)[k]
        half = T.events(made.where((F.col("step") <= upto) & F.col("decision").isNotNull()), EventParams()).where("end_step IS NULL")
        gone = everything.where(F.col("closed_at") <= upto).select("clip", "track", "session")
        left = half.join(gone, ["clip", "track", "session"], "left_anti").select("clip", "track", "session", "start_step")
        active = S.open_events(spark, f"{folder}/online/checkpoint").where("track <> 99").select("clip", "track", "session", "start_step")
        assert sorted(map(tuple, active.collect())) == sorted(map(tuple, left.collect())), k
    got = spark.read.parquet(f"{folder}/online/events").where("track <> 99")
    assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, want.select(names).collect())) and got.count() > 5
    rounded = lambda df: sorted((r.clip, r.track, r.start_step, *(round(r[c], 9) for c in ("peak_score", "peak_object", "peak_motion")), sorted(r.triggered_by.items())) for r in df.collect())
    assert rounded(got) == rounded(want)
    for name in ("open", "recent", "negatives", "reasons"):  # sessions that have ended leave nothing behind
        state = spark.read.format("statestore").option("stateVarName", name).load(f"{folder}/online/checkpoint")
        assert {r.track for r in state.select("key.track").collect()} <= {99}, name


def test_late_rows_are_counted(spark, tmp_path):
    """Seven rows come after their step was judged, three more after the watermark has passed them."""
    schema = "clip long, track long, ts timestamp, step long, d double, obj double"
    row = lambda track, step: (1, track, BEGIN + timedelta(seconds=step), step, 1.0, 0.5)
    batches = [[row(t, s) for t in (1, 2) for s in range(0, 60)], [row(1, s) for s in (50, 51, 52, 53)] + [row(2, s) for s in (57, 58, 59)] + [row(2, 60)], [row(1, 300)], [row(1, s) for s in (3, 4, 5)] + [row(1, 301)]]
    late = S.LateRows()
    spark.streams.addListener(late)
    try:
        query = None
        for k, rows in enumerate(batches):
            (tmp_path / "in").mkdir(exist_ok=True)
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/one/{k}")
            (tmp_path / "in" / f"{k}.parquet").write_bytes(next((tmp_path / "one" / str(k)).glob("part-*")).read_bytes())
            stream = S.observation_stream(spark, f"{tmp_path}/in", files_per_batch=1)
            query = S.decision_stream(stream, ONLINE, delay="30 seconds", step_ms=1000).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
            query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert (late.judged, late.dropped) == (7, 3)
    finally:
        spark.streams.removeListener(late)


def test_active_tracks(spark):
    found = spark.createDataFrame([(1, 0, 5, 9), (2, 0, 5, None), (3, 0, 8, 12)], "track long, session long, start_step long, end_step long")
    assert sorted(r.track for r in T.active_tracks(found, F.lit(9)).collect()) == [2, 3]

"""The slope scene over a stream under shuffled arrival gives the rows of the batch scan."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tachyline.plans import drive_queries as D, scenes as SC
from tachyline.streaming import machines

pytest.importorskip("google.protobuf")
SF = "/root/testdata/sf0.001"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, before)


def streamed(spark, frame, tmp_path, batches, enough, **own):
    """Rows of the stream over ``batches`` (frames), one file each, read one after another, until there are ``enough`` of them."""
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got = []
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    found = machines.slope_scenes(stream, "PHEV", **own)
    query = found.writeStream.foreachBatch(lambda rows, _: got.extend(rows.collect())).option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="1 second").start()
    try:
        for _ in range(120):
            if len(got) >= enough or query.awaitTermination(1):
                break
    finally:
        query.stop()
    return got


def test_shuffled_arrival_gives_the_batch_rows(spark, rocks, tmp_path):
    users = [r.recording_id for r in SC.slope_no_front(D.drives(spark, SF)).select("recording_id").distinct().limit(3).collect()]
    frame = D.drives(spark, SF).where(F.col("recording_id").isin(users)).select("recording_id", "us", "in_control", "moving_flag", "slope_acc", "curv_speed_limit", "ego_speed_mps", "set_speed", "front_valid", "cutin_valid", "front_range", "front_ttc", "cutin_ttc").cache()
    rng, rows = random.Random(1), frame.toPandas()
    # Arrival is out of order by less than the delay: time plus up to 9 s.
    rows["at"] = rows.us + [rng.randrange(9_000_000) for _ in range(len(rows))]
    rows = rows.sort_values("at")
    last = rows[rows.recording_id == users[0]].us.max()
    late = rows[(rows.recording_id == users[0]) & (rows.us == last)].assign(us=0)
    cut = len(rows) // 2
    batches = [spark.createDataFrame(part.drop(columns="at"), frame.schema) for part in (rows.iloc[:cut], rows.iloc[cut:], late)]
    want = SC.slope_candidates(frame, "PHEV").collect()
    got = streamed(spark, frame, tmp_path, batches, len(want) + 1, idle_s=20.0)
    assert sorted((r.recording_id, r.start_us, r.end_us, r.candidate_us) for r in got if r.kind == "scene") == sorted((str(r.recording_id), r.start_us, r.end_us, r.candidate_us) for r in want) != []
    assert [(r.recording_id, r.start_us) for r in got if r.kind == "late"] == [(str(users[0]), 0)]


def test_the_machine_steps_as_the_generator_does():
    from collections import namedtuple

    from tachyline.operators import automata as M

    sample, rng = namedtuple("sample", "t on v target"), random.Random(4)
    rows = [sample(k, rng.random() > 0.02, rng.choice([1.0] * 9 + [3.0]), rng.choice([1.0] * 60 + [2.0])) for k in range(4000)]
    machine = M.steady_band("on", "v", "target", 0.5, 2, 3, 5)()
    next(machine)
    want = [x for r in [*rows, None] for x in machine.send(r)]
    state, got = M.SteadyBand(0.5, 2, 3, 5, 1e-9), []
    for r in rows:
        got += state.step(*r)
        state = M.SteadyBand(**pd.Series(vars(state), dtype=object).to_dict())
    assert got + state.step(None, None, None, None) == want != []

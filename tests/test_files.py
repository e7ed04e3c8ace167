"""Dumps by byte range, and recordings that can't be read."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tachyline.plans import scenes as SC, stitched as ST
from tachyline.sources import files as FS, recordings as R, topics as T


def dump(n, word="w"):
    return "before the first\n" + "".join(f"{1700000000000000000 + k} header: {'' if k % 3 else chr(10)}line {k} {word}\r\n" + "x" * (k % 50) + " \n\n" for k in range(n))


def whole(text):
    import re

    found = list(re.finditer(r"([0-9]{19})\s+header:\s*", text))
    ends = [m.start() for m in found[1:]] + [len(text)]
    clean = lambda k, body: body.replace("\r\n", "\n") if k + 1 == len(found) else body.replace("\r\n", "\n").rstrip()
    return [(len(text[: m.start()].encode()), m[1], clean(k, text[m.end() : e])) for k, (m, e) in enumerate(zip(found, ends, strict=True))]


def rows(frame):
    return sorted((r.position, r.stamp, r.paragraph) for r in frame.collect())


def test_ranges_give_what_the_whole_file_gives(spark, tmp_path):
    text = dump(200, "日本")
    (tmp_path / "a_topic.txt").write_bytes(text.encode())
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "other.bin").write_bytes(b"1700000000000000000 header: no text file")
    for size in (300, 1000, 1 << 20):
        got = FS.read_messages(spark, [str(tmp_path)], "header", split_bytes=size)
        assert rows(got) == whole(text)
        assert got.rdd.getNumPartitions() == -(-len(text.encode()) // size)
    assert FS.read_messages(spark, [str(tmp_path / "empty.txt")], "header").count() == 0


def test_every_cut_through_a_header_keeps_it_once(tmp_path):
    text = dump(3)
    path = tmp_path / "x.txt"
    path.write_bytes(text.encode())
    want = [(p, s.encode()) for p, s, _ in whole(text)]
    store, inner = FS._store(str(path))
    n = len(text.encode())
    for cut in range(1, n):
        with store.open_input_file(inner) as file:
            got = [m[:2] for a, b in ((0, cut), (cut, n)) for m in FS.messages_of(file, "header", a, b)]
        assert got == want, cut


def test_a_message_longer_than_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FS, "LOOK", 16)
    text = f"{1700000000000000000} seq: {'y' * 5000}\n{1700000000000000001} seq: z"
    (tmp_path / "a.txt").write_text(text)
    got = FS.read_messages(spark, [str(tmp_path / "a.txt")], "seq", split_bytes=100).orderBy("position").collect()
    assert [(r.stamp[-1], len(r.paragraph)) for r in got] == [("0", 5000), ("1", 1)]


def test_a_file_that_is_not_utf8_is_gbk_throughout(spark, tmp_path):
    plain, chinese = f"{1700000000000000000} seq: plain\n", "汽车联通"
    (tmp_path / "g.txt").write_bytes(plain.encode() + f"{1700000000000000001} seq: {chinese}\n".encode("gbk") + f"{1700000000000000002} seq: 联通".encode("gbk"))
    (tmp_path / "u.txt").write_bytes(f"{1700000000000000000} seq: {chinese}é".encode())
    for size in (7, 1 << 20):
        got = {(os.path.basename(r.path), r.paragraph) for r in FS.read_messages(spark, [str(tmp_path)], "seq", split_bytes=size).collect()}
        assert got == {("g.txt", "plain"), ("g.txt", chinese), ("g.txt", "联通"), ("u.txt", chinese + "é")}


def test_only_the_columns_asked_for_are_made(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text(dump(5))
    got = FS.read_messages(spark, [f"file://{tmp_path}/a.txt"], "header", "stamp string")
    assert got.columns == ["stamp"] and got.count() == 5


def test_messages_feed_the_parsers(spark, tmp_path):
    from .test_topics import CHASSIS

    (tmp_path / "x_chassis.txt").write_text(CHASSIS * 3)
    got = T.chassis(FS.read_messages(spark, [str(tmp_path)], "header", split_bytes=64)).collect()
    want = T.chassis(spark.createDataFrame([("x", CHASSIS)], "path string, text string")).first()
    assert len(got) == 3 and {(r.at_ms, r.acceleration, r.speed, r.still) for r in got} == {(want.at_ms, want.acceleration, want.speed, want.still)}


@pytest.fixture
def recordings(tmp_path):
    t = [round(0.1 * k, 6) for k in range(100)]
    for name in "abcd":
        table = pa.table({"recording_id": [name] * 100, "t": t, "ego_speed": [36.0] * 100, "set_speed": [100.0] * 100, "acc_active": [1.0] * 100, "curv_enable": [1.0] * 100, "left_lane_c2": [0.003] * 100, "right_lane_c2": [0.003] * 100})
        pq.write_table(table, tmp_path / f"{name}.parquet")
    (tmp_path / "b.parquet").write_bytes(b"PAR1 not a table")
    os.remove(tmp_path / "d.parquet")
    return [str(tmp_path / f"{n}.parquet") for n in "abcd"]


COLUMNS = "recording_id string, t double, acceleration double, ego_speed double, set_speed double, acc_active double, pedal_override double, slope_deg double, front_target_id double, front_range double, front_velocity_abs double, flt1_cutin_flag double, curv_enable double, curv_speed_limit double, left_lane_c2 double, right_lane_c2 double, odometer double"


def test_files_that_fail_give_a_row_that_says_so(spark, recordings):
    got = FS.read_recordings(spark, recordings, COLUMNS, retries=1, delay=0.01)
    files = spark.createDataFrame([(p, n, "car", 10_000_000 * k) for k, (p, n) in enumerate(zip(recordings, "abcd", strict=True))], "src_path string, recording_id string, vehicle string, started_us long")
    data, listed = FS.parted(got, files)
    assert {r.recording_id: r.ok for r in listed.collect()} == {"a": True, "b": False, "c": True, "d": False}
    assert all(r.error_type and r.error for r in listed.where("not ok").collect())
    assert data.count() == 200 and data.where("odometer is not null").count() == 0
    assert R.manifest(listed).first().asDict() == {"inputs": 4, "failed": 2, "complete": False}
    frame = SC.prepare(data.withColumn("acceleration", F.lit(0.0)).na.fill(0.0, ["pedal_override", "front_target_id", "flt1_cutin_flag"]))
    chain = {r.recording_id: (r.continuous, r.has_previous) for r in ST.continuity(frame, listed).collect()}
    assert chain == {"a": (False, False), "b": (False, False), "c": (False, False), "d": (False, False)}
    assert sorted((r.recording_id, r.start_us, r.end_us) for r in ST.scene(frame, listed, "curvature").collect()) == [("a", 0, 9_900_000), ("c", 0, 9_900_000)]


def test_a_file_is_tried_again(recordings, monkeypatch):
    reader = FS._RecordingReader({"files": "[]", "retries": "2", "delay": "0"}, StructType.fromDDL("recording_id string, t double, src_path string, error_type string, error string"))
    calls, plain = [], FS._store

    def late(path):
        calls.append(path)
        if len(calls) < 3:
            raise OSError("busy")
        return plain(path)

    monkeypatch.setattr(FS, "_store", late)
    got = list(reader.read(FS.OneFile(recordings[0])))
    assert len(calls) == 3 and len(got) == 100 and got[0][-2:] == (None, None)
    calls.clear()
    monkeypatch.setattr(FS, "_store", lambda path: (_ for _ in ()).throw(OSError("gone")))
    assert list(reader.read(FS.OneFile("x"))) == [(None, None, "x", "OSError", "gone")]

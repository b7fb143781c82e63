"""A record log and the source that reads it by offsets."""
import datetime as dt
import functools

import pytest

from volcast.sources import records as rec
from volcast.sources.messages import dealt_partition
from volcast.streaming import live

START = dt.datetime(2024, 1, 1)
SCHEMA = "key binary, value binary, time timestamp_ntz, extra int"


def rows_of(spark, numbers, key=lambda i: b"k%d" % (i % 5)):
    return spark.createDataFrame([(key(i), b"v%06d" % i, START + dt.timedelta(hours=i // 3), i) for i in numbers], SCHEMA)


def run(spark, root, base, most=None, starting="earliest", trigger=None):
    """Read to the end of the log; the rows kept so far, in the order of partition and offset."""
    sink = functools.partial(live.keep_batch, path=f"{base}/read")
    q = (rec.record_messages(spark, root, starting, most).writeStream.foreachBatch(sink)
         .option("checkpointLocation", f"{base}/ck").trigger(**(trigger or {"processingTime": "0 seconds"})).start())
    if trigger:
        q.awaitTermination()
    else:
        q.processAllAvailable()
        q.stop()
    return kept(spark, base)


def kept(spark, base):
    read = live.read_sink(spark, f"{base}/read", f"{rec.RECORD_SCHEMA}, batch_id long")
    return sorted(tuple(r) for r in read.select("partition_no", "offset", "key", "value", "time", "batch_id").collect())


def nulls_first(value):
    return (value is not None, value) if value is not None else (False,)


def in_log(frames, partitions):
    """The log by plain Python: each append's rows of a partition in the order of time, key and value."""
    out = {}
    for frame in frames:
        dealt = frame.select(dealt_partition(partitions).alias("p"), "key", "value", "time").collect()
        for p, key, value, time in sorted(dealt, key=lambda r: [nulls_first(x) for x in (r.time, r.key, r.value)]):
            held = out.setdefault(p, [])
            held.append((p, len(held), key, value, time))
    return sorted(row for rows in out.values() for row in rows)


def test_batches_restart_and_appends(spark, tmp_dir):
    root, first, second = f"{tmp_dir}/log", rows_of(spark, range(300)), rows_of(spark, range(300, 450), lambda i: b"new%d" % (i % 2))
    rec.append(first, root, 4, segment_rows=16)
    got = run(spark, root, f"{tmp_dir}/a", most=50)
    assert [r[:5] for r in got] == in_log([first], 4)
    sizes = [sum(r[5] == b for r in got) for b in range(max(r[5] for r in got) + 1)]
    assert len(sizes) >= 6 and max(sizes) <= 54
    rec.append(second, root, 4, segment_rows=16)
    again = run(spark, root, f"{tmp_dir}/a", most=50)
    assert [r[:5] for r in again] == in_log([first, second], 4)
    assert [r for r in again if r[5] < len(sizes)] == got, "what was read stays"
    assert run(spark, root, f"{tmp_dir}/a", most=50) == again, "nothing new"


def test_one_bounded_batch_a_run(spark, tmp_dir):
    root = f"{tmp_dir}/log"
    rec.append(rows_of(spark, range(100)), root, 3, segment_rows=10)
    counts = [len(run(spark, root, f"{tmp_dir}/a", most=40, trigger={"availableNow": True})) for _ in range(4)]
    assert counts[0] <= 43 and counts[0] < counts[1] < counts[2] == counts[3] == 100


def test_starting_offsets(spark, tmp_dir):
    root, early = f"{tmp_dir}/log", rows_of(spark, range(60))
    rec.append(early, root, 3)
    log = in_log([early], 3)
    p = log[0][0]
    got = run(spark, root, f"{tmp_dir}/from", starting='{"%d": 5}' % p)
    assert [r[:5] for r in got] == [r for r in log if r[0] != p or r[1] >= 5]
    now = {"availableNow": True}
    assert run(spark, root, f"{tmp_dir}/latest", starting="latest", trigger=now) == []
    rec.append(rows_of(spark, range(60, 90)), root, 3)
    assert len(run(spark, root, f"{tmp_dir}/latest", starting="latest", trigger=now)) == 30


def test_nulls_repeats_hot_key_and_empty(spark, tmp_dir):
    odd = spark.createDataFrame([(None, b"a", START, 1), (None, None, None, 2), (b"", b"", START, 3), (b"k", b"x", START, 4),
                                 (b"k", b"x", START, 4), (b"k", None, None, 5)] + [(b"hot", b"%d" % (i % 7), START, i) for i in range(200)], SCHEMA)
    root = f"{tmp_dir}/log"
    rec.append(odd.limit(0), root, 2)
    assert run(spark, root, f"{tmp_dir}/e") == []
    rec.append(odd, root, 2, segment_rows=8)
    got = run(spark, root, f"{tmp_dir}/e", most=30)
    assert [r[:5] for r in got] == in_log([odd], 2)
    index = rec.index_rows(spark, root).collect()
    assert max(r.end - r.start for r in index) <= 8


def test_offsets_that_are_gone_are_an_error(spark, tmp_dir):
    root = f"{tmp_dir}/log"
    rec.append(rows_of(spark, range(30)), root, 1)
    reader = rec.RecordLogReader({"path": root})
    with pytest.raises(ValueError, match="does not hold all offsets"):
        reader.partitions({"0": 0}, {"0": 31})
    assert reader.partitions({"0": 30}, {"0": 30}) == []


def test_shares():
    assert rec.shared_out({0: 0, 1: 0}, {0: 900, 1: 100}, 100) == {0: 90, 1: 10}
    assert rec.shared_out({0: 0, 1: 5}, {0: 10 ** 6, 1: 6}, 10) == {0: 9, 1: 6}
    assert rec.shared_out({0: 3}, {0: 8}, 5) == {0: 8}

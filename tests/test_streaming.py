"""Windows and double spends over streams: restarts, failures half-way, late rows, order of arrival."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from steward.operators.analytics import double_spend
from steward.session import scratch_path
from steward.sources.commits import read_committed
from steward.streaming import double_spend as double_spend_module
from steward.streaming import windows
from steward.streaming.double_spend import double_spend_stream
from steward.streaming.windows import count_windows

START = datetime(2024, 1, 1)
SCHEMA = "id long, k string, ts timestamp_ntz"


def batches(seed=1, n=5, rows=60):
    """Each batch goes on where the one before stopped; a third of the rows are up to 100 s older, some have no time."""
    rng = random.Random(seed)
    out = []
    for b in range(n):
        times = [START + timedelta(seconds=b * 40 + rng.randrange(120) / 2 - rng.choice([0, 0, rng.randrange(100)])) for _ in range(rows)]
        out.append([(b * 1000 + i, rng.choice(["a", "b", None]), t if rng.random() > 0.03 else None) for i, t in enumerate(times)])
    return out


class Source:
    def __init__(self, spark):
        self.spark, self.path, self.n = spark, scratch_path(spark, "source"), 0

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.path}/{self.n}")
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/*")


def replay(given, lateness, width=None, gap=None):
    """What must be closed, open and late, by loops."""
    high, kept, late = None, defaultdict(list), []
    for rows in given:
        mark = high and high - timedelta(seconds=lateness)
        for i, k, t in rows:
            start = t and datetime(1970, 1, 1) + (t - datetime(1970, 1, 1)) // timedelta(seconds=width or 1) * timedelta(seconds=width or 1)
            if t is None or (mark and (start + timedelta(seconds=width) <= mark if width else t < mark)):
                late.append(i)
            else:
                kept[k, start if width else None].append(t)
        high = max([t for _, _, t in rows if t] + ([high] if high else []))
    found = []
    for (k, start), times in kept.items():
        if width:
            found.append((k, start, start + timedelta(seconds=width), len(times)))
            continue
        times.sort()
        at = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] >= times[i - 1] + timedelta(seconds=gap):
                found.append((k, times[at], times[i - 1] + timedelta(seconds=gap), i - at))
                at = i
    final = high - timedelta(seconds=lateness)
    order = lambda r: tuple(map(str, r))
    return sorted([f for f in found if f[2] <= final], key=order), sorted([f for f in found if f[2] > final], key=order), sorted(late)


def contents(spark, tables):
    order = lambda r: tuple(map(str, r))
    closed, open_ = (sorted(map(tuple, df.collect()), key=order) for df in (tables.closed(spark), tables.open(spark)))
    return closed, open_, sorted(r.id for r in tables.late(spark).collect())


@pytest.mark.parametrize("kind", [dict(width=10), dict(gap=7)])
def test_windows_equal_a_replay_and_restart_repeats_nothing(spark, kind):
    given, source, root = batches(), Source(spark), scratch_path(spark, "windows")
    options = {f"{k}_seconds": v for k, v in kind.items()}

    def run():
        running, tables = count_windows(source.stream(), root, ["k"], "ts", 20, **options)
        running.awaitTermination()
        return tables

    for rows in given[:3]:
        source.add(rows)
    assert contents(spark, run()) == replay(given[:3], 20, **kind)
    run()  # nothing new
    for rows in given[3:]:
        source.add(rows)
    closed, open_, late = contents(spark, run())
    assert (closed, open_, late) == replay(given, 20, **kind) and closed and open_ and len(late) > 10


@pytest.mark.parametrize("failing", [1, 2, 3, 4, 5, 6])
def test_a_batch_that_broke_off_is_finished_once(spark, monkeypatch, failing):
    """A failure before or after each of the commits of a batch; the next start finishes it."""
    given, source, root = batches(seed=3, n=2), Source(spark), scratch_path(spark, "windows")
    for rows in given:
        source.add(rows)
    calls = []

    def breaking(change):
        def once(*args):
            calls.append(1)
            if len(calls) == failing and failing % 2:
                raise OSError("lost before")
            out = change(*args)
            if len(calls) == failing and not failing % 2:
                raise OSError("lost after")
            return out

        return once

    with monkeypatch.context() as patch:
        patch.setattr(windows, "append_once", breaking(windows.append_once))
        patch.setattr(windows, "replace_once", breaking(windows.replace_once))
        running, _ = count_windows(source.stream(), root, ["k"], "ts", 20, width_seconds=10)
        with pytest.raises(Exception, match="lost"):
            running.awaitTermination()
    running, tables = count_windows(source.stream(), root, ["k"], "ts", 20, width_seconds=10)
    running.awaitTermination()
    assert contents(spark, tables) == replay(given, 20, width=10)
    high = max(t for rows in given for _, _, t in rows if t)
    progress = {r["batch"]: r["high"] for r in read_committed(spark, tables.at("progress")).collect()}
    assert progress.keys() == {0, 1} and progress[1] == (high - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def test_sessions_across_slices(spark, monkeypatch):
    monkeypatch.setattr(windows, "SLICE_GAPS", 1)
    given, source = batches(seed=5, n=2), Source(spark)
    for rows in given:
        source.add(rows)
    running, tables = count_windows(source.stream(), scratch_path(spark, "windows"), ["k"], "ts", 20, gap_seconds=7)
    running.awaitTermination()
    assert contents(spark, tables) == replay(given, 20, gap=7)


def test_arguments(spark):
    source = Source(spark)
    source.add([(1, "a", START)])
    for bad in ({}, dict(width_seconds=1, gap_seconds=1), dict(width_seconds=-1), dict(width_seconds=0)):
        with pytest.raises(ValueError):
            count_windows(source.stream(), scratch_path(spark, "w"), ["k"], "ts", 1, **bad)
    with pytest.raises(ValueError):
        double_spend_stream(source.stream(), ["k"], "ts", "id", -1)


def spends(spark, source, out, checkpoint, lateness):
    found = double_spend_stream(source.stream(), ["k"], "ts", "id", 0.5, lateness)
    running = found.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    running.awaitTermination()
    return running, sorted(map(tuple, spark.read.schema(found.schema).parquet(out).collect()), key=str)


def test_double_spends_equal_the_batch_operator(spark):
    """Rows out of order within the lateness, a restart in between; then a row far ahead, after which no state is left."""
    given, source = batches(seed=2, n=4), Source(spark)
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    for rows in given[:2]:
        source.add(rows)
    spends(spark, source, out, checkpoint, 150)
    for rows in given[2:]:
        source.add(rows)
    source.add([(-1, "end", START + timedelta(days=1))])
    running, got = spends(spark, source, out, checkpoint, 150)
    df = spark.createDataFrame([r for rows in given for r in rows], SCHEMA)
    want = double_spend(df, ["k"], "ts", "id", 0.5).select("k", "id", "ts", "previous_id", "gap_micros")
    assert got == sorted(map(tuple, want.collect()), key=str) and len(got) > 20
    # Only the group of the last row itself may still have state.
    assert running.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 1


def test_double_spends_that_come_too_late_are_left_out(spark):
    source = Source(spark)
    source.add([(1, "a", START), (2, "a", START + timedelta(milliseconds=400))])
    for i, seconds in enumerate((100, 200)):  # late rows are judged by the watermark of the batch before
        source.add([(10 + i, "b", START + timedelta(seconds=seconds))])
    source.add([(4, "a", START + timedelta(milliseconds=500))])
    source.add([(5, "b", START + timedelta(seconds=300))])
    _, got = spends(spark, source, scratch_path(spark, "out"), scratch_path(spark, "checkpoint"), 1)
    assert [(r[1], r[3], r[4]) for r in got] == [(2, 1, 400_000)]


def test_many_groups_share_a_bounded_number_of_states(spark, monkeypatch):
    """With a state, and so a call of Python, for each group a batch took as long as there were groups."""
    monkeypatch.setattr(double_spend_module, "BUCKETS", 3)
    rng, source = random.Random(8), Source(spark)
    given = [[(b * 1000 + i, rng.choice(["", None, "é", *map(str, range(40))]), START + timedelta(seconds=b * 20 + rng.randrange(80) / 4)) for i in range(200)] for b in range(3)]
    for rows in given:
        source.add(rows)
    running, _ = spends(spark, source, scratch_path(spark, "open"), scratch_path(spark, "checkpoint"), 30)
    assert 1 <= running.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    source.add([(-1, "end", START + timedelta(days=1))])
    _, got = spends(spark, source, scratch_path(spark, "out"), scratch_path(spark, "checkpoint"), 30)
    df = spark.createDataFrame([r for rows in given for r in rows], SCHEMA)
    want = double_spend(df, ["k"], "ts", "id", 0.5).select("k", "id", "ts", "previous_id", "gap_micros")
    assert got == sorted(map(tuple, want.collect()), key=str) and len(got) > 20

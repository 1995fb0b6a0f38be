"""Exactly-once appends and keyed merges: broken-off attempts, retries, two writers, files that stay."""

import pytest
from pyspark.sql import functions as F

from steward.operators.coerce import REJECT
from steward.session import scratch_path
from steward.sources import commits
from steward.sources.commits import append_once, classified, create_committed, current_version, merge_once, read_committed
from steward.sources.sinks import KeyViolation

SCHEMA = "id long, v string, n int"


def made(spark, rows=(), key=("id",), buckets=4):
    root = scratch_path(spark, "committed")
    create_committed(spark, root, spark.createDataFrame([], SCHEMA).schema, key, buckets)
    if rows:
        append_once(spark.createDataFrame(list(rows), SCHEMA), root, "first")
    return root


def held(spark, root):
    return sorted(map(tuple, read_committed(spark, root).collect()))


ROWS = [(i, f"v{i}", i % 3) for i in range(40)]


@pytest.mark.parametrize("key", [("id",), ()])
def test_an_append_counts_once(spark, key):
    root = made(spark, key=key)
    rows = spark.createDataFrame(ROWS, SCHEMA)
    assert held(spark, root) == []
    first = append_once(rows, root, "b1")
    assert (first.applied, first.version) == (True, 1)
    assert not append_once(rows, root, "b1").applied and held(spark, root) == ROWS
    more = spark.createDataFrame([(100, "x", None)], SCHEMA)
    append_once(more, root, "b2")
    # The batch before the newest is known, too.
    assert not append_once(rows, root, "b1").applied and not append_once(more, root, "b2").applied
    assert held(spark, root) == [*ROWS, (100, "x", None)] and current_version(spark, root).number == 2
    assert sorted(map(tuple, read_committed(spark, root, 1).collect())) == ROWS


@pytest.mark.parametrize("where", ["_write", "_publish", "publish"])
def test_an_attempt_that_broke_off_adds_nothing(spark, monkeypatch, where):
    root = made(spark, ROWS[:10])
    rows = spark.createDataFrame(ROWS[10:], SCHEMA)

    def broken(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if where == "_write":  # after the rows were written, before anything names them
            write = commits._write
            patch.setattr(commits, "_write", lambda *a: (write(*a), broken())[0])
        elif where == "_publish":
            patch.setattr(commits, "_publish", broken)
        else:
            patch.setattr(commits._Files, "publish", broken)
        with pytest.raises(OSError):
            append_once(rows, root, "second")
    assert held(spark, root) == ROWS[:10]
    assert append_once(rows, root, "second").applied and held(spark, root) == ROWS


def test_a_failure_after_the_switch_is_known_on_the_next_run(spark, monkeypatch):
    root = made(spark)
    publish = commits._publish

    def then_lost(*args):
        publish(*args)
        raise OSError("the answer was lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "_publish", then_lost)
        with pytest.raises(OSError):
            append_once(spark.createDataFrame(ROWS, SCHEMA), root, "b")
    assert not append_once(spark.createDataFrame(ROWS, SCHEMA), root, "b").applied and held(spark, root) == ROWS


def test_two_writers(spark, monkeypatch):
    """Another writer takes the version between reading and publishing; the change starts again and both are in."""
    root = made(spark, ROWS[:5])
    write, done = commits._write, []

    def slow(rows, *rest):
        out = write(rows, *rest)
        if not done:
            done.append(1)
            append_once(spark.createDataFrame([(7, "theirs", 0)], SCHEMA), root, "theirs")
        return out

    monkeypatch.setattr(commits, "_write", slow)
    report = append_once(spark.createDataFrame([(7, "ours", 0), (8, "ours", 0)], SCHEMA), root, "ours")
    # The key that the other writer took meanwhile is rejected.
    assert report.version == 3 and [r.id for r in report.rejects.collect()] == [7]
    assert held(spark, root) == [*ROWS[:5], (7, "theirs", 0), (8, "ours", 0)]


def test_compaction_and_clean_up(spark, monkeypatch):
    root = made(spark, ROWS[:10])
    for i in (1, 2, 3):
        append_once(spark.createDataFrame(ROWS[10 * i : 10 * i + 10], SCHEMA), root, f"b{i}")
    assert len(current_version(spark, root).folders) == 4
    write, done = commits._write, []

    def slow(rows, *rest):
        out = write(rows, *rest)
        if not done:
            done.append(1)
            append_once(spark.createDataFrame([(77, "meanwhile", 0)], SCHEMA), root, "meanwhile")
        return out

    with monkeypatch.context() as patch:
        patch.setattr(commits, "_write", slow)
        number = commits.compact(spark, root)
    assert held(spark, root) == [*ROWS, (77, "meanwhile", 0)] and len(current_version(spark, root).folders) == 1
    assert commits.compact(spark, root) == number
    commits.clean_up(spark, root, versions=1)
    files = commits._Files(spark, root)
    assert held(spark, root) == [*ROWS, (77, "meanwhile", 0)] and len(files.names("data")) == 1 and len([n for n in files.names("_versions") if n.endswith(".json") and n[0] != "."]) == 1
    assert not any(append_once(spark.createDataFrame(ROWS, SCHEMA), root, b).applied for b in ("first", "b1", "b2", "b3", "meanwhile"))
    assert not commits.replace_once(spark.createDataFrame([], SCHEMA), root, "b2")
    assert commits.replace_once(spark.createDataFrame(ROWS[:2], SCHEMA), root, "anew") and held(spark, root) == ROWS[:2]


def test_rejects(spark):
    root = made(spark, ROWS[:3])
    texts = spark.createDataFrame([("1", "taken", "1"), ("50", "fine", "2"), ("51", "bad", "x"), (None, "no key", "1"), ("60", "a", "1"), ("60", "b", "1")], "id string, v string, n string")
    report = append_once(texts, root, "b")
    assert held(spark, root) == [*ROWS[:3], (50, "fine", 2)]
    assert sorted(r.v for r in report.rejects.collect()) == ["a", "b", "bad", "no key", "taken"]
    assert all(r[REJECT] for r in report.rejects.collect())


CHANGES = [(0, "new", 0, False), (1, "v1", 1, False), (2, None, None, True), (99, "in", None, None), (98, "x", 1, True)]
CHANGED = "id long, v string, n int, gone boolean"


def test_merge_equals_a_loop(spark):
    root = made(spark, ROWS)
    changes = spark.createDataFrame(CHANGES, CHANGED)
    report = merge_once(changes, root, "m", deletes="gone")
    want = {r[0]: r for r in ROWS}
    for i, v, n, gone in CHANGES:
        want.pop(i, None) if gone else want.__setitem__(i, (i, v, n))
    assert held(spark, root) == sorted(want.values())
    assert report.counts == {"insert": 1, "update": 1, "delete": 1, "same": 1, "absent": 1}
    assert not merge_once(changes, root, "m", deletes="gone").applied and held(spark, root) == sorted(want.values())


def paths(spark, root):
    return {f.rpartition("/data/")[2] for f in read_committed(spark, root).inputFiles()}


def test_untouched_files_keep_their_names(spark):
    root = made(spark, [(i, "a", 0) for i in range(2000)], buckets=16)
    before = paths(spark, root)
    report = merge_once(spark.createDataFrame([(5, "b", 0), (6, "a", 0)], SCHEMA), root, "m")
    after = paths(spark, root)
    (bucket,) = report.rewritten  # the row that is as it was leaves its bucket alone
    assert len(before) == 16 and len(before & after) == 15
    assert all(f"_bucket={bucket}/" in p for p in before ^ after)
    assert merge_once(spark.createDataFrame([(6, "a", 0)], SCHEMA), root, "same").rewritten == () and paths(spark, root) == after
    gone = read_committed(spark, root).withColumn("gone", F.lit(True))
    assert merge_once(gone, root, "all gone", deletes="gone").counts["delete"] == 2000 and held(spark, root) == []


def test_merge_breaks_off_whole(spark, monkeypatch):
    root = made(spark, ROWS)
    changes = spark.createDataFrame(CHANGES, CHANGED)
    with monkeypatch.context() as patch:
        patch.setattr(commits._Files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge_once(changes, root, "m", deletes="gone")
    assert held(spark, root) == ROWS and merge_once(changes, root, "m", deletes="gone").applied


def test_merge_refuses_unclear_changes(spark):
    root = made(spark, ROWS)
    for bad in ([(1, "a", 0), (1, "b", 0)], [(None, "a", 0)]):
        with pytest.raises(KeyViolation):
            merge_once(spark.createDataFrame(bad, SCHEMA), root, "m")
    with pytest.raises(ValueError):
        merge_once(spark.createDataFrame(ROWS, SCHEMA), made(spark, key=()), "m")
    with pytest.raises(ValueError):
        append_once(spark.createDataFrame(ROWS, SCHEMA), root, "")
    with pytest.raises(ValueError):
        create_committed(spark, scratch_path(spark, "t"), spark.createDataFrame([], SCHEMA).schema, ["no"])
    with pytest.raises(ValueError):
        current_version(spark, scratch_path(spark, "t"))
    with pytest.raises(commits.Conflict):
        create_committed(spark, root, spark.createDataFrame([], SCHEMA).schema)
    assert held(spark, root) == ROWS


def test_classes_come_from_one_join(spark):
    old = spark.createDataFrame(ROWS, SCHEMA)
    new = spark.createDataFrame(CHANGES, CHANGED)
    plan = classified(old, new, ["id"], "gone")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join ") == 1

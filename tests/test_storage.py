"""Files, tables and appends."""

import importlib
import json
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.operators.coerce import REJECT, accepted, rejected
from steward.plans.load import load_fresh
from steward.sources import files, schemas, sinks, tables

session_module = importlib.import_module("steward.session")

CSV = (
    "﻿id,name,amt,ts,flag\n"
    '1,"a, b",10.555,2024-01-01T00:00:00.123000,t\n'
    "2,,5,2024-01-01T00:00:01,\n"
    '3,"",7.1,,f\n'
    "4\n"
    "5,x,1,2024-01-01T00:00:01,t,EXTRA\n"
    '6,"two\nlines",1,,t\n'
)
TYPED = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("amt", T.DecimalType(18, 2)),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("flag", T.StringType()),
    ]
)


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


@pytest.fixture
def new_table(spark):
    made = []

    def make(schema):
        name = f"t{len(made)}_{abs(hash(str(schema))) % 10**8}_{datetime.now().strftime('%H%M%S%f')}"
        schemas.declare_table(spark, name, schema)
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_csv_is_all_text(spark, csv_path):
    df = files.read_csv(spark, csv_path)
    assert df.columns == ["id", "name", "amt", "ts", "flag", REJECT]
    assert {kind for name, kind in df.dtypes if name != REJECT} == {"string"}
    rows = {r.id: r for r in df.collect()}
    assert len(rows) == 6
    assert rows["1"].name == "a, b" and rows["2"].name is None and rows["3"].name is None
    assert rows["4"].name is None and rows["6"].name == "two\nlines"
    assert {i for i, r in rows.items() if r[REJECT]} == {"4", "5"}


def test_notes_do_not_depend_on_the_columns_read(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,name,n\n1,a,1\n2\n3,c,3,EXTRA\nx,d,4\n5,e,5\n")
    for df in (
        files.read_typed_csv(spark, str(path), T.StructType.fromDDL("id int, name string, n int")),
        files.read_csv(spark, str(path), newline_free=True).where("id <> 'x'"),
    ):
        good, bad = accepted(df), rejected(df)
        expected = 3 if "int" in dict(df.dtypes).values() else 2
        for part, n in ((good, 2), (bad, expected)):
            assert part.count() == n and len(part.collect()) == n
            for column in part.columns:
                assert len(part.select(column).collect()) == n


def test_records_keep_their_notes_whatever_is_read(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"id": 1, "n": "y"}\n{"id": "bad", "n": "y"}\n{"id": 3\n{"n": "z", "l": [1, 2]}\n')
    schema = T.StructType.fromDDL("id long, n string, l array<int>")
    df = files.read_json(spark, str(tmp_path / "r.json"), schema, lines=True)
    for part, n in ((accepted(df), 2), (rejected(df), 2)):
        assert part.count() == n
        for column in part.columns:
            assert len(part.select(column).collect()) == n
    assert accepted(df).where("id IS NULL").first() == (None, "z", [1, 2])


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path)).collect()


def test_ragged_lines_are_not_loaded(spark, tmp_path, new_table):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n2\n3,z,EXTRA\n4,w\n")
    name = new_table(KEYED)
    report = load_fresh(spark, str(tmp_path / "a.csv"), ".csv", name)
    assert report.append.appended == 2 and report.unreadable.count() == 2
    assert {r.id for r in report.unreadable.collect()} == {2, 3}


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    assert session_module.is_local("local[8]") and session_module.is_local("local")
    assert not any(map(session_module.is_local, ("local-cluster[2,1,1024]", "yarn", "spark://x:7077")))
    held = session_module.stored(spark.range(3), "kept")
    assert held.count() == 3
    session_module.remove_scratch(held)
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        held.count()


class _Cluster:
    """What :func:`scratch_root` asks of a session, as a cluster answers."""

    def __init__(self, folder):
        self.conf = self
        self.sparkContext = self
        self.master, self.folder = "yarn", folder

    def get(self, name, default):
        return self.folder if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return None


def test_scratch_root_of_a_cluster():
    assert session_module.scratch_root(_Cluster("hdfs://x/tmp")) == "hdfs://x/tmp"
    with pytest.raises(RuntimeError):
        session_module.scratch_root(_Cluster(None))


def test_typed_csv_flags_lines_that_do_not_fit(spark, csv_path):
    rows = {r.id: r for r in files.read_typed_csv(spark, csv_path, TYPED).collect()}
    assert rows[1].amt == Decimal("10.56") and rows[1].ts == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert {i for i, r in rows.items() if r[REJECT]} == {4, 5}
    assert "EXTRA" in rows[5][REJECT][0]


def test_load_appends_good_lines_and_reports_the_others(spark, csv_path, new_table):
    name = new_table(TYPED)
    report = sinks.load_csv(spark, csv_path, name)
    assert (report.attempted, report.appended, report.rejected) == (6, 4, 2)
    assert {r.id for r in report.rejects.collect()} == {4, 5}
    sinks.load_csv(spark, csv_path, name)
    assert spark.table(name).count() == 8
    sinks.load_csv(spark, csv_path, name, mode="overwrite")
    assert spark.table(name).count() == 4


def test_columns_are_matched_by_position(spark, tmp_path, new_table):
    path = tmp_path / "p.csv"
    path.write_text("wrong,names\n1,x\n")
    name = new_table(T.StructType().add("a", "integer").add("b", "string"))
    sinks.load_csv(spark, str(path), name)
    assert spark.table(name).first() == (1, "x")


def test_json_array_and_lines(spark, tmp_path):
    records = [{"a": 1, "b": "x"}, {"a": 2, "c": True}]
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    want = Counter([(1, "x", None), (2, None, True)])
    assert bag(accepted(files.read_json(spark, str(tmp_path / "array.json")))) == want
    assert bag(accepted(files.read_json(spark, str(tmp_path / "lines.json"), lines=True))) == want
    assert bag(accepted(files.read_records(spark, str(tmp_path / "array.json"), ".json"))) == want


def test_guards(spark, tmp_path):
    assert files.check_format(".CSV") == ".csv"
    for bad in (".txt", ".xml", ".parquet"):
        with pytest.raises(ValueError):
            files.read_records(spark, str(tmp_path), bad)
    assert files.check_database("Postgres") == "postgres"
    with pytest.raises(ValueError):
        files.check_database("oracle")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "absent.csv"))


def test_write_and_read_back(spark, tmp_path):
    rows = [(1, ' padded "quoted", ', datetime(2024, 1, 1, 0, 0, 0, 1), [1, 2]), (2, "two\nlines", None, None)]
    df = spark.createDataFrame(rows, "i int, s string, t timestamp_ntz, l array<int>")
    sinks.write_csv(df, str(tmp_path / "out.csv"))
    got = {r.i: r for r in files.read_csv(spark, str(tmp_path / "out.csv")).collect()}
    assert got["1"][1:-1] == (' padded "quoted", ', "2024-01-01T00:00:00.000001", "[1,2]")
    assert got["2"][1:-1] == ("two\nlines", None, None)
    sinks.write_records(df, str(tmp_path / "out.json"), ".json")
    with pytest.raises(ValueError):
        sinks.write_records(df, str(tmp_path / "out.xml"), ".xml")
    assert bag(accepted(files.read_json(spark, str(tmp_path / "out.json"), df.schema, lines=True)).drop("l")) == bag(df.drop("l"))


def test_header_repair(spark):
    assert files.repair_header(spark.createDataFrame([(1, 2)], "`﻿id` int, n int")).columns == ["id", "n"]


KEYED = T.StructType().add("id", "long").add("v", "string")


def test_append_with_key(spark, new_table):
    name = new_table(KEYED)
    first = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, "d"), ("x", "e")], "id string, v string")
    report = sinks.append_rows(first, name, ["id"])
    assert (report.attempted, report.appended) == (5, 1)
    assert bag(spark.table(name)) == Counter([(1, "a")])
    assert {r.v for r in report.rejects.collect()} == {"b", "c", "d", "e"}
    assert all(r[REJECT] for r in report.rejects.collect())
    again = sinks.append_rows(spark.createDataFrame([(1, "z"), (3, "y")], KEYED), name, ["id"])
    assert (again.attempted, again.appended) == (2, 1)
    assert [r.v for r in again.rejects.collect()] == ["z"]
    assert bag(spark.table(name)) == Counter([(1, "a"), (3, "y")])


def test_append_that_must_not_violate_the_key(spark, new_table):
    name = new_table(KEYED)
    with pytest.raises(sinks.KeyViolation):
        sinks.append_rows(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], KEYED), name, ["id"], on_violation="fail")
    assert spark.table(name).count() == 0
    report = sinks.append_rows(spark.createDataFrame([(1, "a"), (2, "c")], KEYED), name, ["id"], on_violation="fail")
    assert report.appended == 2 and report.rejects.count() == 0


def test_overwrite_ignores_the_stored_keys(spark, new_table):
    name = new_table(KEYED)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], KEYED)
    sinks.append_rows(rows, name, ["id"])
    assert sinks.append_rows(rows, name, ["id"], mode="overwrite").appended == 2
    assert spark.table(name).count() == 2


def test_append_without_stored_copy(spark, new_table):
    name = new_table(KEYED)
    rows = spark.createDataFrame([("1", "a"), ("x", "b")], "id string, v string")
    report = sinks.append_rows(rows, name, stage=False)
    assert (report.attempted, report.appended) == (2, 1)
    assert [r.v for r in report.rejects.collect()] == ["b"]


@pytest.mark.parametrize("by_digest", [False, True])
def test_file_to_table_and_again(spark, tmp_path, new_table, by_digest):
    name = new_table(TYPED)
    path = tmp_path / "rows.csv"
    path.write_text("id,name,amt,ts,flag\n1,a,1.50,2024-01-01T00:00:00,t\n1,a,1.5,2024-01-01T00:00:00,t\nx,b,2,,f\n2,,3,,f\n")
    report = load_fresh(spark, str(path), ".csv", name, by_digest=by_digest)
    assert report.append.appended == 3
    assert [r.name for r in report.unreadable.collect()] == ["b"]
    assert bag(spark.table(name).select("id", "name")) == Counter({(1, "a"): 2, (2, None): 1})
    assert load_fresh(spark, str(path), ".csv", name, by_digest=by_digest).append.appended == 0
    path.write_text(path.read_text() + "3,new,1,,t\n1,a,1.5,2024-01-01T00:00:00,t\n")
    assert load_fresh(spark, str(path), ".csv", name, by_digest=by_digest).append.appended == 2


def test_rejects_stay_when_the_table_changes(spark, tmp_path, new_table):
    name = new_table(KEYED)
    sinks.append_rows(spark.createDataFrame([(1, "a")], KEYED), name)
    path = tmp_path / "rows.csv"
    path.write_text("id,v\n1,a\n1,b\n2,c\n")
    report = load_fresh(spark, str(path), ".csv", name, key=["id"])
    assert report.append.appended == 1
    assert [r.v for r in report.append.rejects.collect()] == ["b"]


def test_declare(spark, new_table):
    name = new_table(KEYED)
    schemas.declare_table(spark, name, KEYED)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        schemas.declare_table(spark, name, KEYED, if_absent=False)
    assert tables.extract_table(spark, name, "default").dtypes == [("id", "bigint"), ("v", "string")]


def test_sql(spark, tmp_path):
    spark.createDataFrame([(1, "it's"), (2, "x")], KEYED).createOrReplaceTempView("bound")
    got = tables.bound_query(spark, "SELECT id FROM bound WHERE v = :v AND id < :top", v="it's", top=5)
    assert [r.id for r in got.collect()] == [1]
    (tmp_path / "a.sql").write_text("SELECT 1 AS a;\n")
    (tmp_path / "b.sql").write_text("SELECT count(*) AS n FROM bound")
    results = tables.run_statement_files(spark, [tmp_path / "a.sql", tmp_path / "b.sql"])
    assert [r.first()[0] for r in results] == [1, 2]
    with pytest.raises(FileNotFoundError):
        tables.run_statement_files(spark, [tmp_path / "absent.sql"])


def test_database_options():
    hosts, databases = {"STAGING": "stage.example", "PRODUCTION": "prod.example"}, {"TEST": "t", "DEV": "d", "PROD": "p"}
    db = tables.Database(hosts, databases, "me", "secret", 5433)
    assert db.options()["url"] == "jdbc:postgresql://stage.example:5433/t"
    assert db.options("PRODUCTION", "PROD")["url"] == "jdbc:postgresql://prod.example:5433/p"
    assert db.options()["user"] == "me" and "secret" not in repr(db)
    with pytest.raises(ValueError):
        tables.Database(hosts, databases, "me", "secret", kind="mysql").options()


def test_split_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        tables.read_database(spark, {"url": "jdbc:none"}, "t", split_column="id")

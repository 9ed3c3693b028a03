"""Documents of many parts: JSON arrays read in splits, CSV with a mark, reports, overwriting."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import documents, register, sinks
from tests.conftest import rows

SCHEMA = "n bigint, s string, tags array<string>, inner struct<a: string, b: array<struct<c: bigint>>>"
NASTY = ['', '"', '\\', '\\"', '}', '{', '[]', '},{', '"}', '\\\\"}', '\n', ' ', 'é😀', '}' * 50, '\\' * 7, 'x' * 300, None, ',[{"n": 1}]']


def records(number, seed=1):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(NASTY) or "" for _ in range(rng.randrange(5)))
    return [
        {
            "n": i,
            "s": rng.choice(NASTY),
            "tags": [text() for _ in range(rng.randrange(3))] or None,
            "inner": {"a": text(), "b": [{"c": k} for k in range(rng.randrange(3))]} if rng.random() < 0.8 else None,
        }
        for i in range(number)
    ]


def plain(df):
    return sorted((json.dumps(r.asDict(True), sort_keys=True) for r in df.collect()))


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (str(size), "1"))]
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", [211, 1 << 20])
@pytest.mark.parametrize("indent", [None, 1])
def test_one_file_read_in_splits(spark, tmp_path, small_splits, size, indent):
    data = records(40)
    end = "" if indent else "\n"
    (tmp_path / "list.json").write_text(json.dumps(data, ensure_ascii=indent is None, indent=indent) + end, encoding="utf-8")
    small_splits(size)
    got = documents.read_json_array(spark, str(tmp_path / "list.json"), SCHEMA)
    assert plain(got) == sorted(json.dumps(r, sort_keys=True) for r in data)


def test_many_splits_are_few_tasks(spark, tmp_path, small_splits, monkeypatch):
    files, cut = [], documents.cut

    def counted(df):
        table = cut(df)
        files.append(len(table.inputFiles()))  # one per task with rows
        return table

    monkeypatch.setattr(documents, "cut", counted)
    data, path = records(60, 4), str(tmp_path / "list.json")
    (tmp_path / "list.json").write_text(json.dumps(data), encoding="utf-8")
    small_splits(100)
    assert spark.read.text(path, lineSep="}").rdd.getNumPartitions() > 100
    got = documents.read_json_array(spark, path, SCHEMA)
    assert plain(got) == sorted(json.dumps(r, sort_keys=True) for r in data)
    assert len(files) == 3 and max(files) <= 4
    files.clear()
    monkeypatch.setattr(documents, "TASK_BYTES", 1000)
    assert documents.read_json_array(spark, path, SCHEMA).count() == 60
    assert 8 <= max(files) <= 100


def test_pieces_are_weighed_a_few_at_a_time(monkeypatch):
    values = [t for r in records(30, 5) for t in json.dumps(r, ensure_ascii=False).split("}")]
    batch = pa.RecordBatch.from_pydict({"value": values, "block": list(range(len(values)))})
    weighed = {}
    for size in (1, 200, 1 << 18):
        monkeypatch.setattr(documents, "WEIGHED_BYTES", size)
        parts = list(documents._weighed(iter([batch.slice(0, 0), batch])))
        weighed[size] = parts[0].schema.names, [r for p in parts for r in p.to_pylist()]
        assert len(parts) == len(values) if size == 1 else (len(parts) == 1) == (size > 200)
    assert weighed[1] == weighed[200] == weighed[1 << 18]


def test_states_that_are_not_broadcast(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(documents, "BROADCAST_SPLITS", 0)
    data = records(20, 2)
    (tmp_path / "list.json").write_text(json.dumps(data), encoding="utf-8")
    small_splits(150)
    assert plain(documents.read_json_array(spark, str(tmp_path / "list.json"), SCHEMA)) == sorted(json.dumps(r, sort_keys=True) for r in data)


def test_written_arrays_come_back(spark, tmp_path, small_splits):
    data = records(60, 3)
    df = spark.createDataFrame([json.dumps(r) for r in data], "string").select(F.from_json("value", SCHEMA).alias("r")).select("r.*")
    path = str(tmp_path / "out")
    documents.write_json_array(df, path, ["n"])
    manifest = json.loads((tmp_path / "out" / documents.MANIFEST).read_text())["parts"]
    assert len(manifest) > 3 and all((tmp_path / "out" / p["name"]).stat().st_size == p["bytes"] for p in manifest)
    whole = "".join((tmp_path / "out" / p["name"]).read_text(encoding="utf-8") for p in manifest)
    assert json.loads(whole) == data
    small_splits(500)
    assert plain(documents.read_json_array(spark, path, SCHEMA)) == sorted(json.dumps(r, sort_keys=True) for r in data)
    documents.write_json_array(df.where("false"), str(tmp_path / "none"), ["n"])
    assert documents.read_json_array(spark, str(tmp_path / "none"), SCHEMA).count() == 0


@pytest.mark.parametrize("text", ['{"n": 1}', '"x"', "[1, 2]", '[{"n": 1}', '[{"n": 1}]]', "", '[{"n": 1} x]', '[[{"n": 1}], {"n": 2}]'])
def test_anything_but_a_list_of_records_fails(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text, encoding="utf-8")
    with pytest.raises(Exception):
        documents.read_json_array(spark, str(tmp_path / "bad.json"), SCHEMA).collect()


def test_csv_has_one_mark_and_one_header(spark, tmp_path):
    data = [(i, v) for i, v in enumerate(NASTY)]
    df = spark.createDataFrame(data, "n int, s string")
    documents.write_csv_document(df, str(tmp_path / "csv"), ["s", "n"], ["n"])
    parts = json.loads((tmp_path / "csv" / documents.MANIFEST).read_text())["parts"]
    raw = b"".join((tmp_path / "csv" / p["name"]).read_bytes() for p in parts)
    assert raw.startswith(b"\xef\xbb\xbfs,n\n") and raw.count(b"\xef\xbb\xbf") == 1
    got = list(csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline="")))
    assert [r[1] for r in got[1:]] == [str(i) for i, _ in data]
    assert [r[0] for r in got[1:]] == [v or "" for _, v in data]


def test_report_of_many_tasks(spark, tmp_path):
    df = spark.range(50).select("id", F.concat(F.lit("l"), "id").alias("label"))
    one = df.agg(F.count("*").alias("n"), F.lit(None).cast("string").alias("nothing"))
    lists = {"rows": (df, ["id"]), 'odd "name"': (df.where("id < 0"), ["id"])}
    documents.write_report_document(spark, str(tmp_path / "report"), one, lists)
    parts = json.loads((tmp_path / "report" / documents.MANIFEST).read_text())["parts"]
    told = json.loads("".join((tmp_path / "report" / p["name"]).read_text() for p in parts))
    assert told["summary"] == {"n": 50, "nothing": None} and told['odd "name"'] == []
    assert told["rows"] == [{"id": i, "label": f"l{i}"} for i in range(50)]


def test_a_run_that_breaks_off_leaves_the_old_output(spark, tmp_path):
    path, df = str(tmp_path / "out"), spark.range(10).withColumn("x", F.lit(1))
    documents.write_json_array(df, path, ["id"])
    with pytest.raises(FileExistsError):
        documents.write_json_array(df, path, ["id"])
    bad = df.withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        documents.write_json_array(bad, path, ["id"], mode="overwrite")
    assert documents.read_json_array(spark, path, "id bigint").count() == 10
    documents.write_json_array(df.where("id < 3"), path, ["id"], mode="overwrite")
    assert documents.read_json_array(spark, path, "id bigint").count() == 3
    root = str(tmp_path / "tables")
    sinks.write_tables({"a": df, "b": df}, root)
    with pytest.raises(Exception, match="broken"):
        documents.overwrite_tables({"a": df.where("id < 1"), "b": bad}, root)
    tables = register.load_register(spark, root, ["a", "b"])
    assert tables["a"].count() == tables["b"].count() == 10
    documents.overwrite_tables({"a": df.where("id < 1"), "b": tables["b"].where("id < 2")}, root)
    tables = register.load_register(spark, root, ["a", "b"])
    assert (rows(tables["a"], "id"), tables["b"].count()) == ([(0,)], 2)


def test_stable_samples_of_many_strata(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("n"), F.lit("x").alias("s")).repartition(7)
    strata = {"low": (df.where("n < 20"), ["n"]), "few": (df.where("n > 97"), ["s", "n"]), "none": (df.where("n > 200"), ["n"])}
    got = register.stable_samples(strata, 3)
    want = [("few", k, json.dumps({"n": 98 + k - 1, "s": "x"})) for k in (1, 2)] + [("low", k, json.dumps({"n": k - 1, "s": "x"})) for k in (1, 2, 3)]
    assert [(a, b, json.dumps(json.loads(c))) for a, b, c in rows(got)] == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Exchange") <= 2 + plan.count("RoundRobin")

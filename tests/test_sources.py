from __future__ import annotations

import csv
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import integrity, metrics
from corpusloom.sources import folders, labelled_files, tables

TEXTS = {
    "train/pos/0_9.txt": "Good<br />film".encode(), "train/pos/10_8.txt": b"fine\r\nlines\rhere", "train/pos/2_7.txt": b"ok \xff",
    "train/neg/0_2.txt": b"bad", "test/pos/0_10.txt": b"", "test/neg/1_1.txt": "quote \" comma, café".encode(),
}


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "corpus"
    for name, content in TEXTS.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    (root / "train/unsup").mkdir()
    (root / "train/unsup/5_0.txt").write_text("unlabelled")
    (root / "train/pos/notes.md").write_text("no text file")
    return str(root)


def test_list_files(spark, tree):
    files = labelled_files.list_files(spark, tree)
    assert files.columns == ["path", "length"] and files.count() == 8


def test_read_labelled_text(spark, tree):
    got = {(r["split"], r["Unique_ID"]): (r["POS"], r["Score"], r["Review"]) for r in labelled_files.read_labelled_text(spark, tree).collect()}
    assert got == {
        ("train", "POS0"): (1, 9, "Good<br />film"), ("train", "POS10"): (1, 8, "fine\nlines\nhere"),
        ("train", "POS2"): (1, 7, "ok �"), ("train", "NEG0"): (0, 2, "bad"), ("test", "POS0"): (1, 10, ""),
        ("test", "NEG1"): (0, 1, 'quote " comma, café'),
    }


def test_files_are_listed_by_tasks(spark, tree, monkeypatch):
    monkeypatch.setattr(labelled_files, "_binary", None)
    files = {r["path"].split("/corpus/")[1]: r["length"] for r in labelled_files.list_files(spark, "file:" + tree).collect()}
    assert files == {k: len(v) for k, v in TEXTS.items()} | {"train/unsup/5_0.txt": 10, "train/pos/notes.md": 12}
    assert folders.list_below(spark, tree, "*.md").count() == 1 and folders.list_below(spark, tree, "?_?.txt").count() == 5
    one = labelled_files.read_bytes(spark, f"{tree}/train/pos/0_9.txt").collect()
    assert [bytes(r["content"]) for r in one] == [TEXTS["train/pos/0_9.txt"]]
    with pytest.raises(Exception, match="FileNotFound"):
        folders.list_below(spark, tree + "/none").count()


def test_stores_that_only_spark_opens(spark, tree, monkeypatch):
    want = sorted(map(str, labelled_files.read_labelled_text(spark, tree).collect()))
    assert not folders.reachable("viewfs://somewhere/x")
    monkeypatch.setattr(folders, "reachable", lambda root: False)
    assert sorted(map(str, labelled_files.read_labelled_text(spark, tree).collect())) == want
    assert labelled_files.list_files(spark, tree).count() == 8


def test_written_texts(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.txt", "é"), ("a/b/y.txt", None), ("z.txt", "1\r\n2")], "n string, t string").repartition(2)
    for _ in range(2):
        sizes = {r["path"]: r["length"] for r in folders.write_texts(rows, "n", "t", str(tmp_path / "w")).collect()}
    assert sizes == {"a/x.txt": 2, "a/b/y.txt": 0, "z.txt": 4}
    assert (tmp_path / "w/z.txt").read_bytes() == b"1\r\n2" and folders.list_below(spark, str(tmp_path / "w")).count() == 3


def test_sort_by_id(spark, tree):
    rows = labelled_files.sort_by_id(labelled_files.read_labelled_text(spark, tree).where("split = 'train'")).collect()
    assert [r["Unique_ID"] for r in rows] == ["NEG0", "POS0", "POS2", "POS10"]


def test_checksums(spark, tmp_path):
    (tmp_path / "a.tar.gz").write_bytes(b"archive")
    manifest = spark.createDataFrame(
        [("a.tar.gz", hashlib.md5(b"archive").hexdigest().upper()), ("b.tar.gz", "00")], "name string, md5 string")
    files = labelled_files.read_bytes(spark, str(tmp_path))
    assert {r["name"]: r["ok"] for r in integrity.checksum_report(files, manifest).collect()} == {"a.tar.gz": True, "b.tar.gz": False}


TRICKY = [
    (1, "POS1", 7, 'a "quoted", text'), (0, "NEG1", 3, "line\nbreak\r\nand \\ back\\"), (1, "POS2", 9, "NA"), (0, "NEG2", 1, ""),
    (1, "POS3", 5, "null"), (0, "NEG3", 2, " padded "), (1, "POS4", 6, "café, ☃"),
]


@pytest.mark.parametrize("quote_all", [True, False])
def test_csv_round_trip(spark, tmp_path, quote_all):
    path = str(tmp_path / "t.csv")
    tables.write_csv(spark.createDataFrame(TRICKY, tables.RAW_SCHEMA), path, quote_all)
    assert sorted(map(tuple, tables.read_csv_typed(spark, path, tables.RAW_SCHEMA).collect())) == sorted(TRICKY)
    text = tables.read_csv_text(spark, path)
    assert dict(text.dtypes) == {c: "string" for c in tables.FOUR_NAMES}
    assert sorted(r["Review"] for r in text.collect()) == sorted(r[3] for r in TRICKY)


def test_fully_quoted_csv_is_readable_elsewhere(spark, tmp_path):
    tables.write_csv(spark.createDataFrame(TRICKY, tables.RAW_SCHEMA).coalesce(1), str(tmp_path / "t.csv"), True)
    part = next((tmp_path / "t.csv").glob("part-*.csv"))
    lines = part.read_text().splitlines()
    assert lines[0] == '"POS","Unique_ID","Score","Review"' or lines[0] == "POS,Unique_ID,Score,Review"
    with part.open(newline="", encoding="utf-8") as f:
        rows = list(csv.reader(f))
    assert rows[0] == list(tables.FOUR_NAMES)
    assert sorted(r[3] for r in rows[1:]) == sorted(r[3] for r in TRICKY)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_strict_csv_finds_short_and_long_rows(spark, tmp_path):
    path = write(tmp_path / "x.csv", 'POS,Unique_ID,Score,Review\n1,POS1,7,ok\n1,POS2,7\n0,NEG1,3,a,b\n0,NEG2,3,"x, y"\n')
    strict = tables.read_csv_strict(spark, path)
    assert tables.count_bad_rows(strict) == 2
    good = strict.where(F.col(tables.BAD_ROW).isNull()).select("Unique_ID", "Review").collect()
    assert sorted(map(tuple, good)) == [("NEG2", "x, y"), ("POS1", "ok")]


def test_headers(spark, tmp_path):
    head = "POS,Unique_ID,Score,Review"
    assert tables.require_header(spark, write(tmp_path / "a.csv", head + ",validation_set\n1,a,2,b,0\n"))[-1] == "validation_set"
    with pytest.raises(AssertionError, match="expected"):
        tables.require_header(spark, write(tmp_path / "b.csv", "POS,Review\n1,x\n"))
    with pytest.raises(AssertionError, match="end in .csv"):
        tables.require_header(spark, write(tmp_path / "c.txt", head))
    with pytest.raises(AssertionError, match="no header"):
        tables.require_header(spark, write(tmp_path / "d.csv", ""))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.require_header(spark, str(tmp_path / "missing.csv"))


def test_typed_csv_rejects_bad_values(spark, tmp_path):
    path = write(tmp_path / "bad.csv", "POS,Unique_ID,Score,Review\nx,POS1,7,ok\n")
    with pytest.raises(Exception):
        tables.read_csv_typed(spark, path, tables.RAW_SCHEMA).collect()


def test_runs_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "validation_metrics")
    df = spark.createDataFrame([(1, 1), (0, 0)], "pos int, prediction int")
    schema = ", ".join(f"`{c}` {'string' if c in ('timestamp', 'model') else 'double'}" for c in metrics.VALIDATION_COLUMNS)
    assert tables.read_runs(spark, path, schema).columns == ["run", *metrics.VALIDATION_COLUMNS]
    for run, model in (("one", "A"), ("two", "B"), ("one", "C")):
        tables.append_run(metrics.evaluate(df, model, training_seconds=0.5), path, run)
    (tmp_path / "validation_metrics" / "run=three").mkdir()  # a run that did not end
    rows = tables.read_runs(spark, path, schema)
    assert rows.columns == ["run", *metrics.VALIDATION_COLUMNS]
    assert sorted((r["run"], r["model"], r["TP"]) for r in rows.collect()) == [("one", "C", 1.0), ("two", "B", 1.0)]
    with pytest.raises(ValueError):
        tables.append_run(df, path, "a/b")


def test_run_metadata_json(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 0), (1, 1)], "pos int, prediction int")
    counts = metrics.with_quality(metrics.confusion_counts(df, "pos", "prediction"))
    row = metrics.run_metadata(
        counts, model_name="m", max_length=500, epochs=1, lr=1e-5, weight_decay=0.01, train_size=20, val_size=5, training_seconds=2.0)
    tables.write_json(row, str(tmp_path / "j"))
    got = json.loads(next((tmp_path / "j").glob("part-*.json")).read_text())
    assert got["confusion_matrix"] == [[1, 1], [1, 2]] and got["max_length"] == 500 and got["lr"] == 1e-5
    assert got["metrics"]["eval_accuracy"] == 0.6 and set(got["metrics"]) == {"eval_accuracy", "eval_precision", "eval_recall", "eval_f1"}


def test_rewrite_refuses_its_own_input(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in")).withColumn("x", F.lit(1))
    with pytest.raises(ValueError):
        tables.rewrite(df, str(tmp_path / "in"))
    assert tables.rewrite(df, str(tmp_path / "out")).count() == 3
    assert spark.read.parquet(str(tmp_path / "in")).columns == ["id"]

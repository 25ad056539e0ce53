from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import integrity, quality


def as_dict(report):
    return {(r["subset"], r["check"]): (r["violations"], r["sample"]) for r in report.collect()}


def listing(spark, names, folder="train/pos"):
    return spark.createDataFrame([(f"file:/x/corpus/{folder}/{n}",) for n in names], "path string")


def test_file_report(spark):
    files = listing(spark, ["3_2.txt", "a_2.txt", "3.txt", "3_2_1.txt", "01_2.txt", "1_3.txt", "5_0.txt", "6_11.txt",
                            "7_2.md", "12500_3.TXT", "8_x.txt"])
    got = as_dict(quality.file_report(files, expected_count=11))
    one = {check: got[("train_pos", check)] for subset, check in got if subset == "train_pos"}
    assert one["folder_missing"] == (0, None)
    assert one["not_txt"] == (1, "7_2.md")
    assert one["name_parts"] == (2, "3.txt")
    assert one["id_not_digits"] == (1, "a_2.txt")
    assert one["score_not_digits"] == (1, "8_x.txt")
    assert one["id_out_of_range"] == (1, "12500_3.TXT")
    assert one["score_out_of_range"] == (2, "5_0.txt")
    assert one["duplicate_id"] == (1, "01_2.txt")
    assert one["file_count"] == (0, "11")
    assert got[("test_neg", "folder_missing")] == (1, None)
    assert got[("test_neg", "file_count")] == (11, "0")
    with pytest.raises(quality.QualityError, match="not_txt"):
        quality.require(quality.file_report(files))


def test_huge_digit_strings_do_not_raise(spark):
    files = listing(spark, ["99999999999999999999_5.txt"])
    assert as_dict(quality.file_report(files))[("train_pos", "id_out_of_range")][0] in (0, 1)


def test_good_files_pass(spark):
    names = [f"{i}_{1 + i % 10}.txt" for i in range(5)]
    files = None
    for split in ("train", "test"):
        for folder in ("pos", "neg"):
            part = listing(spark, names, f"{split}/{folder}")
            files = part if files is None else files.union(part)
    report = quality.require(quality.file_report(files, expected_count=5))
    assert report.count() == 36


def test_first_offenders_are_limited(spark):
    files = listing(spark, [f"{i}_1.md" for i in range(9)] + ["1_1.txt"])
    rows = quality.first_offenders(files).orderBy("rank").collect()
    assert [r["name"] for r in rows] == [f"{i}_1.md" for i in range(5)]


def table(spark, rows):
    return spark.createDataFrame(rows, "POS string, Unique_ID string, Score string, Review string")


def test_table_report(spark):
    df = table(spark, [
        ("1", "POS1", "7", "fine"), ("0", "NEG1", "11", "bad"), ("1", "POS1", "0", "x"), ("2", "POS3", "x", "  \t"),
        (None, "POS4", None, None), ("1", "POS5", " 3 ", ""),
    ])
    got = {check: v for (_, check), v in as_dict(quality.table_report(df, "train", expected_rows=6, expected_pos=3, expected_neg=2)).items()}
    assert got["duplicate_id"] == (1, "POS1")
    assert got["empty_text"] == (3, "POS3")
    assert got["label_not_0_1"] == (2, "POS3")
    assert got["score_not_int"] == (2, "POS3")
    assert got["score_out_of_range"] == (2, "NEG1")
    assert got["row_count"] == (0, "6")
    assert got["pos_count"] == (0, "3")
    assert got["neg_count"] == (1, "1")
    row = quality.table_summary(df).first()
    assert (row["row_count"], row["pos_count"], row["neg_count"], row["unique_ids"], row["all_have_text"]) == (6, 3, 1, 5, False)


def test_empty_table(spark):
    got = {c: v for (_, c), v in as_dict(quality.table_report(table(spark, []), "train")).items()}
    assert got["row_count"] == (25_000, "0") and got["duplicate_id"] == (0, None)


def test_split_report(spark):
    good = spark.createDataFrame([(i % 2, int(i < 2)) for i in range(10)], "POS int, validation_set int")
    quality.require(quality.split_report(good))
    quality.require(quality.split_report(good, label="POS"))
    bad = spark.createDataFrame([("true",), ("False",), ("2",), (None,)], "validation_set string")
    got = {c: v for (_, c), v in as_dict(quality.split_report(bad)).items()}
    assert got["split_null"][0] == 1 and got["split_invalid"][0] == 1 and got["validation_count"] == (1, "1")
    none = spark.createDataFrame([(0,), (0,)], "validation_set int")
    got = {c: v for (_, c), v in as_dict(quality.split_report(none)).items()}
    assert got["no_validation_rows"][0] == 1 and got["no_train_rows"][0] == 0


def test_count_empty_and_required_columns(spark):
    df = spark.createDataFrame([("",), ("x",), ("",)], "t string")
    assert tuple(quality.count_empty(df, "t").first()) == (2, 3)
    with pytest.raises(KeyError, match="validation_set"):
        quality.require_columns(["a"], ["a", "validation_set"])


def sources(spark):
    return spark.createDataFrame(
        [("train", "pos", 1, 7, "same"), ("train", "neg", 2, 3, "other"), ("test", "pos", 3, 9, "elsewhere")],
        "split string, folder string, number long, score int, text string",
    )


def test_hash_check(spark):
    rows = table(spark, [("1", "POS1", "7", "same"), (" 0", "NEG2", "3", "changed"), ("1", "POS3", "9", "elsewhere")])
    checked = integrity.hash_check(rows.withColumn("validation_set", F.lit(0)), sources(spark), split="train")
    assert checked.columns == [
        "POS", "Unique_ID", "Score", "Review", "validation_set", "hash_csv_review", "hash_original_file", "hash_match"]
    got = {r["Unique_ID"]: (r["hash_original_file"], r["hash_match"]) for r in checked.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {"POS1": (sha("same"), "TRUE"), "NEG2": (sha("other"), "FALSE"), "POS3": (None, "FALSE")}
    assert tuple(integrity.match_counts(checked).first()) == (1, 2)


def test_strict_hash_check_raises_on_a_missing_file(spark):
    rows = table(spark, [("1", "POS3", "9", "elsewhere")])
    with pytest.raises(Exception, match="source file missing for POS3"):
        integrity.hash_check(rows, sources(spark), split="train", strict=True).collect()


def test_numbers_too_long_for_a_type_are_out_of_range(spark):
    files = spark.createDataFrame([("/c/train/pos/99999999999999999999_5.txt",), ("/c/train/pos/3_99999999999.txt",)], "path string")
    got = {(r["subset"], r["check"]): r["violations"] for r in quality.file_report(files).collect()}
    assert got["train_pos", "id_out_of_range"] == 1 and got["train_pos", "score_out_of_range"] == 1
    assert got["train_pos", "id_not_digits"] == 0

import random

import pytest
from pyspark.sql import functions as F

from riskframe import schema
from riskframe.sources import (
    check_snapshot, coerce_date, coerce_numeric, coercion_report, load_policies, malformed_report, policies, preview,
    read_csv_records, read_policies, read_snapshot, snapshot_table, stage, synthetic_policies, table_diff, table_fingerprint, write_result,
)


@pytest.fixture()
def csv(tmp_path):
    def write(text):
        path = tmp_path / "policies.csv"
        path.write_text(text)
        return str(path)
    return write


GOOD = (
    "PolicyID,TransactionMonth,Gender,TotalPremium,TotalClaims\n"
    "1,2015-03-01,Male,100.5,0\n"
    "2,2015-13-01,NA,x,NaN\n"
    "3,,,,7e1\n"
)


def test_load_coerces_and_counts_bad_cells(spark, csv):
    path = csv(GOOD)
    rows = load_policies(spark, path).orderBy("PolicyID").collect()
    assert [r.TotalPremium for r in rows] == [100.5, None, None]
    assert [r.TotalClaims for r in rows] == [0.0, None, 70.0]
    assert [r.Gender for r in rows] == ["Male", None, None]
    assert [str(r.TransactionMonth)[:10] if r.TransactionMonth else None for r in rows] == ["2015-03-01", None, None]
    report = {r.column_name: r for r in coercion_report(
        read_policies(spark, path), ["TransactionMonth"], ["TotalPremium", "TotalClaims"]).collect()}
    assert (report["TransactionMonth"].n_missing, report["TransactionMonth"].n_invalid) == (1, 2)
    assert (report["TotalPremium"].n_missing, report["TotalPremium"].n_invalid) == (1, 2)
    assert (report["TotalClaims"].n_missing, report["TotalClaims"].n_invalid) == (1, 1)


def test_load_errors(spark, csv, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_policies(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="empty"):
        load_policies(spark, csv("PolicyID,TotalPremium,TotalClaims\n"))
    with pytest.raises(ValueError, match="TotalClaims"):
        load_policies(spark, csv("PolicyID,TotalPremium\n1,2\n"))
    assert load_policies(spark, csv("PolicyID,TotalPremium\n1,2\n"), validate=False).count() == 1


def test_nan_in_doubles_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert sorted(r.v is None for r in coerce_numeric(df, ["v", "absent"]).collect()) == [False, True, True]


def test_dates_with_formats(spark):
    df = spark.createDataFrame([("31/01/2015",), ("2015-02-01",), ("?",)], "d string")
    dates = [r.d for r in coerce_date(df, "d", ["dd/MM/yyyy", "yyyy-MM-dd"]).collect()]
    assert [str(d)[:10] if d else None for d in dates] == ["2015-01-31", "2015-02-01", None]


def test_catalog():
    assert [len(c) for c in schema.COLUMN_GROUPS.values()] == [3, 9, 5, 22, 11, 2]
    assert len(schema.catalog_schema().fields) == 52
    assert schema.catalog_schema("financial").fieldNames() == ["TotalPremium", "TotalClaims"]


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "x", True)], "PolicyID long, TotalPremium string, flag boolean")
    ok, missing, absent = schema.check_columns(df)
    assert (ok, missing) == (False, ["TotalClaims"]) and "Gender" in absent
    ok, mismatches = schema.check_types(df)
    assert not ok and list(mismatches) == ["TotalPremium"]
    assert schema.select_by_kind(df, "numeric") == ["PolicyID"]
    assert schema.select_by_kind(df, "categorical") == ["TotalPremium"]


@pytest.mark.parametrize("kind,rows", [("eda", 1000), ("tests", 5000), ("models", 10000)])
def test_demo_tables(spark, kind, rows):
    df = synthetic_policies(spark, kind=kind)
    assert df.count() == rows
    again = synthetic_policies(spark, kind=kind).repartition(3)
    assert df.exceptAll(again).count() == 0
    low, high, share = df.agg(
        F.min("TotalPremium"), F.max("TotalPremium"), F.avg((F.col("TotalClaims") > 0).cast("int"))).first()
    assert 5000 <= low and high < 50000
    if kind != "eda":
        assert abs(share - 0.3) < 0.03


def test_snapshots_and_results(spark, tmp_path):
    root = str(tmp_path / "snap")
    one = spark.createDataFrame([(1, "a")], "id int, t string")
    two = spark.createDataFrame([(1, "b"), (2, "c")], "id int, t string")
    snapshot_table(one, root, "1")
    snapshot_table(two, root, "2")
    assert read_snapshot(spark, root, "1").collect() == one.collect()
    assert read_snapshot(spark, root).count() == 3
    with pytest.raises(Exception, match="exists"):
        snapshot_table(one, root, "1")
    write_result(two, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_stage_keeps_rows(spark, sf_small):
    df = policies(spark, sf_small).select("PolicyID", "TotalClaims")
    assert stage(df).exceptAll(df).count() == 0 and stage(df).count() == df.count()


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("t"))
    same = table_fingerprint(df.repartition(5)).collect()
    assert sorted(table_fingerprint(df).collect()) == sorted(same)
    changed = df.withColumn("t", F.when(F.col("id") == 3, "x").otherwise(F.col("t")))
    hashes = {r.column_name: r.content_hash for r in table_fingerprint(changed).collect()}
    before = {r.column_name: r.content_hash for r in same}
    assert hashes["id"] == before["id"] and hashes["t"] != before["t"]


def test_diff_counts_copies_and_changes(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d"), (3, None)], "k int, v string")
    plain = {(r.k, r.v, r.change, r.copies) for r in table_diff(old, new).collect()}
    assert plain == {(1, "a", "removed", 2), (2, "b", "removed", 1), (2, "c", "added", 1), (4, "d", "added", 1)}
    keyed = {(r.k, r.v, r.change) for r in table_diff(old, new, ["k"]).collect()}
    assert keyed == {(1, "a", "removed"), (2, "b", "changed_from"), (2, "c", "changed_to"), (4, "d", "added")}


def test_preview(spark):
    assert [r.id for r in preview(spark.range(100).repartition(4), 3).collect()] == [0, 1, 2]


def test_quoted_cells_stay_whole(spark, csv):
    path = csv('PolicyID,Make,TotalPremium,TotalClaims\n1,"A ""x"", B",5,0\n2,"two\nlines",6,1\n')
    rows = load_policies(spark, path).orderBy("PolicyID").collect()
    assert [(r.Make, r.TotalPremium, r.TotalClaims) for r in rows] == [('A "x", B', 5.0, 0.0), ("two\nlines", 6.0, 1.0)]


def records_file(path, rng, rows, end):
    import csv as plain

    with open(path, "w", newline="") as f:
        w = plain.writer(f, lineterminator=end)
        w.writerow(["a", "b", "c, d"])
        for i in range(rows):
            n = rng.choice([0, 1, 5, 30, 4000 if i % 97 == 0 else 3])
            cell = "".join(rng.choice(["x", "\n", ",", '"', "yy ", "é"]) for _ in range(n)).strip() or "q"
            row = (str(i), cell, rng.choice(["p", "s t"]))
            w.writerow(row)
            yield row


def test_one_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(before, ("1500", "1")):
        spark.conf.set(k, v)
    try:
        expected = [r for name, end in (("x", "\r\n"), ("y", "\n")) for r in records_file(f"{tmp_path}/{name}.csv", rng, 400, end)]
        df = read_csv_records(spark, str(tmp_path))
        assert df.columns == ["a", "b", "c, d", "_malformed"] and spark.read.text(str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 10
        assert sorted(tuple(r)[:3] for r in df.collect()) == sorted(expected)
        with open(tmp_path / "y.csv", "a") as f:
            f.write("1,2\n\n7,8,9,10\n")
        assert tuple(malformed_report(spark, str(tmp_path)).head()) == (802, 2)
        (tmp_path / "z.csv").write_text("a,c,b\n1,2,3\n")
        with pytest.raises(Exception, match="headers"):
            read_csv_records(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_snapshot_that_was_changed_is_found(spark, tmp_path):
    root = str(tmp_path / "snap")
    snapshot_table(spark.range(10).repartition(2), root, "1")
    assert read_snapshot(spark, root, "1", check=True).count() == 10
    spark.range(3).write.mode("append").parquet(f"{root}/version=1")
    assert sorted({r.status for r in check_snapshot(spark, root, "1").collect()}) == ["added", "ok"]
    with pytest.raises(ValueError, match="manifest"):
        read_snapshot(spark, root, "1", check=True)
    (p for p in (tmp_path / "snap" / "version=1").glob("part-*.parquet") if p.stat().st_size).__next__().unlink()
    assert {"missing", "added"} & {r.status for r in check_snapshot(spark, root, "1").collect()}


def test_only_decimal_finite_numbers(spark):
    cells = {"12D": None, "5f": None, "0x1p3": None, "inf": None, "1e999": None, " +1.5e2 ": 150.0, ".5": 0.5, "7.": 7.0, "-3": -3.0, "": None}
    df = spark.createDataFrame([(c, c) for c in cells], "raw string, v string")
    assert {r.raw: r.v for r in coerce_numeric(df, ["v"]).collect()} == cells
    doubles = spark.createDataFrame([(float("inf"),), (-2.5,)], "v double")
    assert {r.v for r in coerce_numeric(doubles, ["v"]).collect()} == {None, -2.5}


def test_default_date_forms(spark):
    cells = {
        "2015-03-01": "2015-03-01 00:00:00", "2015-03-01 10:30:00": "2015-03-01 10:30:00", "3/1/2015 12:00:00 AM": "2015-03-01 00:00:00",
        "3/1/2015": "2015-03-01 00:00:00", "20150301": "2015-03-01 00:00:00", "March 1, 2015": "2015-03-01 00:00:00",
        "10:30": None, "2015-13-01": None, "n/a": None,
    }
    df = spark.createDataFrame([(c, c) for c in cells], "raw string, d string")
    assert {r.raw: str(r.d) if r.d else None for r in coerce_date(df, "d").collect()} == cells


def test_table_diff_in_blocks(spark, monkeypatch):
    from riskframe.sources import tables

    old = spark.range(300).select((F.col("id") % 100).alias("k"), F.when(F.col("id") % 7 > 0, F.lit(-0.0)).alias("v"))
    new = spark.range(400).select((F.col("id") % 110).alias("k"), F.when(F.col("id") % 5 > 0, F.lit(0.0)).alias("v"))
    for keys in (None, ["k"]):
        whole = sorted(map(str, table_diff(old, new, keys).collect()))
        with monkeypatch.context() as m:
            m.setattr(tables, "DIFF_ROWS", 100)
            found = table_diff(old, new, keys)
            assert "xxhash64" in found._jdf.queryExecution().toString() or keys
            assert sorted(map(str, found.collect())) == whole and len(whole) > 100


def test_written_policies_are_not_gathered_in_a_fixed_number_of_parts(spark, sf_small, monkeypatch):
    from riskframe.checks import quality

    rows = quality.policies(spark, sf_small).repartition(7, "PolicyID")
    monkeypatch.setattr(quality, "policies", lambda s, sf: rows)
    files = spark.read.text(quality._csv(spark, sf_small)).inputFiles()
    assert len(files) == 7

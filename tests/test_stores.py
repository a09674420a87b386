"""Sources and sinks: ingest report, repeatable snapshots, mixed layouts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from creditloom import session
from creditloom.sources import ingest, scans, sinks, stores
from creditloom.streaming import snapshots


def frame(spark, value, days=(1, 2, 3)):
    rows = [(f"c{k}", dt.date(2024, 1, d), value) for d in days for k in range(4)]
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, v int")


def totals(spark, path):
    df = spark.read.parquet(path).groupBy("snapshot_date").agg(F.sum("v").alias("v"))
    return {str(r["snapshot_date"]): r["v"] for r in df.collect()}


def test_snapshots_are_replaced_one_by_one(spark):
    path = session.scratch_dir(spark, "test")
    sinks.write_snapshots(frame(spark, 1), path)
    once = totals(spark, path)
    sinks.write_snapshots(frame(spark, 1), path)
    assert totals(spark, path) == once == {"2024-01-01": 4, "2024-01-02": 4, "2024-01-03": 4}
    sinks.write_snapshots(frame(spark, 5, days=(2,)), path)
    assert totals(spark, path) == {"2024-01-01": 4, "2024-01-02": 20, "2024-01-03": 4}


def test_a_rebuild_drops_what_the_source_no_longer_holds(spark, tmp_path):
    path = session.scratch_dir(spark, "test")
    sinks.write_snapshots(frame(spark, 1), path)
    sinks.write_snapshots(frame(spark, 5, days=(2,)), path, rebuild=True)
    assert totals(spark, path) == {"2024-01-02": 20}
    root = session.scratch_dir(spark, "test")
    for rows in (3, 2):
        lines = [f"l{k},2024-0{k + 1}-01" for k in range(rows)]
        (tmp_path / "loans.csv").write_text("\n".join(["loan_id,snapshot_date", *lines]))
        assert ingest.ingest_bronze(spark, {"loans": str(tmp_path / "loans.csv")}, root) == {"loans": rows}


def test_clean_deletes_scratch_folders(spark, monkeypatch):
    monkeypatch.setattr(session, "_HANDED_OUT", [])
    path = session.scratch_dir(spark, "test")
    sinks.write_table(frame(spark, 1), path)
    session.clean(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_skipped_files_are_listed(spark):
    path = session.scratch_dir(spark, "test")
    frame(spark, 1).coalesce(1).write.parquet(f"{path}/a.parquet")
    spark.createDataFrame([("PAR1 but not really",)], "value string").coalesce(1).write.text(f"{path}/text")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    text = [f.getPath() for f in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/text")) if "part-" in f.getPath().getName()]
    fs.rename(text[0], spark._jvm.org.apache.hadoop.fs.Path(f"{path}/broken.parquet"))
    schema = spark.read.parquet(f"{path}/a.parquet").schema
    assert schema and [r["path"].rsplit("/", 1)[1] for r in stores.skipped_files(spark, path).collect()] == ["broken.parquet"]


def test_snapshot_filters_prune_directories(spark, capsys):
    path = session.scratch_dir(spark, "test")
    sinks.write_snapshots(frame(spark, 1), path)
    stored = spark.read.parquet(path)
    assert scans.snapshot(stored, "2024-01-02").count() == 4
    assert scans.snapshot_range(stored, "2024-01-02", "2024-01-03").count() == 8
    assert scans.snapshots_until(stored, "2024-01-02").count() == 8
    scans.snapshot(stored, "2024-01-02").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_ingest_reports_counts_skips_and_unknown_names(spark, tmp_path):
    root = session.scratch_dir(spark, "test")
    (tmp_path / "loans.csv").write_text("loan_id,snapshot_date,extra\nl1,2024-01-01,007\nl2,2024-02-01,\n")
    sources = {"loans": str(tmp_path / "loans.csv"), "attributes": str(tmp_path / "none.csv")}
    assert ingest.ingest_bronze(spark, sources, root) == {"loans": 2, "attributes": None}
    assert ingest.ingest_bronze(spark, sources, root, only="loans") == {"loans": 2}
    assert set(ingest.ingest_bronze(spark, sources, root, only="nothing")) == set(sources)
    back = ingest.read_bronze(spark, root, "loans")
    # Text stays text, so leading zeros survive, and columns the code does not know pass through.
    assert {r["extra"] for r in back.collect()} == {"007", None}


def test_other_ingest_errors_are_raised(spark):
    with pytest.raises(Exception, match="(?i)nosuchscheme"):
        ingest.ingest_bronze(spark, {"bad": "nosuchscheme://x/y.csv"}, session.scratch_dir(spark, "test"))


def test_unreadable_files_are_skipped(spark, tmp_path):
    path = tmp_path / "store"
    frame(spark, 1).coalesce(1).write.parquet(str(path / "good.parquet"))
    (path / "bad.parquet").write_bytes(b"not a parquet file")
    df = stores.read_all(spark, [str(path / "good.parquet"), str(path / "bad.parquet")])
    assert df.count() == 12


def test_old_and_new_layouts_meet_in_one_schema(spark, tmp_path):
    old = spark.createDataFrame([("a", 0.7)], "Customer_ID string, model_predictions double")
    new = spark.createDataFrame([("b", 0.4, 0)], "Customer_ID string, prediction_probability double, prediction_class int")
    old.write.parquet(str(tmp_path / "old.parquet"))
    new.write.parquet(str(tmp_path / "new.parquet"))
    got = stores.read_predictions(spark, str(tmp_path)).orderBy("Customer_ID")
    assert [(r["Customer_ID"], r["prediction_probability"], r["prediction_class"]) for r in got.collect()] == [
        ("a", 0.7, 1),
        ("b", 0.4, 0),
    ]
    only_old = stores.read_predictions(spark, str(tmp_path / "old.parquet")).first()
    assert (only_old["prediction_probability"], only_old["prediction_class"]) == (0.7, 1)


def test_appended_runs_accumulate(spark):
    path = session.scratch_dir(spark, "test")
    for _ in range(2):
        sinks.append_run(frame(spark, 1), path)
    assert spark.read.parquet(path).count() == 24


def test_new_ledger_files_become_snapshots(spark, tmp_path):
    header = "loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date\n"
    folder, silver, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "checkpoint"))
    (tmp_path / "in").mkdir()

    def arrive(name, month, overdue):
        line = f"l1,c1,2023-01-01,10,{month},1000,100,0,{overdue},500,2024-{month:02}-01\n"
        (tmp_path / "in" / name).write_text(header + line)
        snapshots.ingest_new_snapshots(spark, folder, silver, checkpoint).awaitTermination()
        return {str(r["snapshot_date"]): r["dpd"] for r in spark.read.parquet(silver).collect()}

    assert arrive("a.csv", 3, 0) == {"2024-03-01": 0}
    assert arrive("b.csv", 4, 200) == {"2024-03-01": 0, "2024-04-01": 60}
    assert arrive("c.csv", 4, 0) == {"2024-03-01": 0, "2024-04-01": 0}


def test_rows_that_travel_as_one_text_arrive_whole(spark, tmp_path):
    rows = ['l1,2024-01-01,"a ""b"", c",\x01\t| ', 'l2,2024-01-01,"",', ',,,"é\\n,"', "l4,2024-02-01, x ,\\"]
    (tmp_path / "odd.csv").write_text("\n".join(["loan.id,snapshot_date,a`b,Type of", *rows]) + "\n")
    odd, root = ingest.read_csv(spark, str(tmp_path / "odd.csv")), session.scratch_dir(spark, "test")
    moved = sinks.rebalanced(odd, ["snapshot_date"], lines=True)
    assert moved.columns == odd.columns and moved.dtypes == odd.dtypes
    assert sorted(map(str, moved.collect())) == sorted(map(str, odd.collect()))
    shuffled = moved._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[1].splitlines()[1]
    assert "array_join" in shuffled
    assert ingest.ingest_bronze(spark, {"odd": str(tmp_path / "odd.csv")}, root) == {"odd": 4}
    back = ingest.read_bronze(spark, root, "odd").select(*["`" + c.replace("`", "``") + "`" for c in odd.columns])
    kept = back.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))

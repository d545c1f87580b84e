from datetime import datetime

from pyspark.sql import functions as F

from ledgerlens.operators import clean as C
from ledgerlens.operators import quality as Q
from ledgerlens.schemas import RAW
from ledgerlens.sources import files, manifest as log

NOON = "2022-11-04 10:00:00"


def raw(spark, rows):
    """Rows of (id, datetime, customer, terminal, amount)."""
    return spark.createDataFrame([(*r, 1, 1, 0, 0) for r in rows], RAW)


DIRTY = [
    (1, NOON, 5, "7", 10.0),
    (2, NOON, 5, None, 10.0),
    (3, NOON, 5, "Err", 10.0),
    (4, NOON, -1, "7", 10.0),
    (5, "2022-11-04 24:00:00", 5, "7", 10.0),
    (6, "garbage", 5, "7", 10.0),
    (7, NOON, 5, "7", 0.0),
    (8, NOON, 5, "7", 10.0),
    (8, "2022-11-04 11:00:00", 5, "7", 10.0),
    (None, NOON, 5, "7", 10.0),
    (None, NOON, 5, "7", 10.0),
    (9, NOON, None, "7", 10.0),
    (10, NOON, 5, "7", -1.0),
    (11, NOON, 5, "7", None),
    (12, NOON, 5, "7", float("nan")),
    (13, "2022-11-04", 5, "7", 10.0),
]


def test_one_row_per_rule(spark):
    df = C.clean(raw(spark, DIRTY))
    kept = {r.tranaction_id: r for r in df.collect()}
    assert set(kept) == {1, 5, 8, None, 12, 13} and df.count() == 6
    assert kept[5].tx_datetime == datetime(2022, 11, 4)
    assert kept[8].tx_datetime == datetime(2022, 11, 4, 10)
    assert kept[13].tx_datetime == datetime(2022, 11, 4)
    assert dict(df.dtypes)["terminal_id"] == "int" and df.columns == RAW.fieldNames()


def test_survivor_ignores_layout(spark):
    rows = [(i % 50, f"2022-11-{1 + i % 28:02d} 10:00:00", i, str(i), 1.0 + i) for i in range(600)]
    df = raw(spark, rows)
    one = sorted(map(tuple, C.clean(df).collect()))
    assert one == sorted(map(tuple, C.clean(df.repartition(13, "tx_amount")).collect()))


def test_works_with_ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert C.clean(raw(spark, DIRTY)).count() == 6
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_fault_counts_and_rows(spark):
    df = raw(spark, DIRTY)
    counts = {r.fault: r.rows for r in Q.fault_counts(df).collect()}
    assert counts == {
        "total": 16, "null_terminal": 1, "non_numeric_terminal": 1, "negative_customer": 1,
        "invalid_date": 2, "zero_amount": 1,
    }
    for fault in Q.faults():
        assert Q.faulty_rows(df, fault).count() == counts[fault]


def test_duplicates_with_and_without_hot_keys(spark):
    rows = [(None if i % 3 == 0 else i % 40, NOON, i, "7", 1.0) for i in range(300)] + [(1000, NOON, 1, "7", 1.0)]
    df = raw(spark, rows)
    plain = sorted(map(str, Q.duplicate_rows(df).collect()))
    assert plain == sorted(map(str, Q.duplicate_rows(df, min_rows=20).collect()))
    assert len(plain) == 300 and {r.dup_count for r in Q.duplicate_rows(df).filter("tranaction_id IS NULL").collect()} == {100}


def test_summary(spark):
    rows = {r["column"]: r for r in Q.summary(raw(spark, DIRTY[:4])).collect()}
    assert rows["tranaction_id"]["mean"] == 2.5 and rows["tranaction_id"]["max"] == 4.0
    assert rows["terminal_id"]["count"] == 3 and rows["terminal_id"]["mean"] == 7.0
    assert rows["terminal_id"]["max_text"] == "Err" and rows["terminal_id"]["min"] is None


def test_raw_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text(
        f"# tranaction_id | tx_datetime\n1,{NOON},5,7,10.5,1,2,0,0\nx,{NOON},5,7,10.5,1,2,0,0\n2,{NOON}\n"
    )
    (tmp_path / "b.txt").write_text(f"# header\n3,{NOON},5,Err,1,1,2,1,3\n")
    both = files.read_raw(spark, str(tmp_path / "*.txt"))
    assert both.count() == 4
    listed = files.read_raw(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    assert sorted(map(str, both.collect())) == sorted(map(str, listed.collect()))
    short = both.filter("tranaction_id = 2").first()
    assert short.terminal_id is None and short.tx_datetime == NOON
    assert both.filter("tranaction_id IS NULL").count() == 1


def test_file_discovery(spark, tmp_path):
    for name in ("a.txt", "b.txt", "c.txt", "note.md"):
        (tmp_path / name).write_text("x")
    listing = files.list_files(spark, str(tmp_path))
    manifest = spark.createDataFrame([("a.txt",), ("gone.txt",)], "file string")
    new = files.new_files(listing, manifest)
    assert sorted(r.file for r in new.collect()) == ["b.txt", "c.txt"]
    log.commit(manifest, str(tmp_path / "m"), 1)
    log.commit(new, str(tmp_path / "m"), 2)
    done, version = log.latest(spark, str(tmp_path / "m"))
    assert version == 2
    assert sorted(r.file for r in done.collect()) == ["a.txt", "b.txt", "c.txt", "gone.txt"]
    assert files.new_files(listing, done).isEmpty()


def test_clean_files_prune_by_date(spark, tmp_path):
    rows = [(i, f"2022-11-{1 + i % 3:02d} 10:00:00", 5, "7", 1.0) for i in range(30)]
    path = str(tmp_path / "clean")
    files.write_clean(C.clean(raw(spark, rows)), path)
    day = files.read_clean(spark, path).filter(F.col("tx_date") == "2022-11-02")
    assert day.count() == 10
    assert "PartitionFilters: [isnotnull(tx_date" in day._jdf.queryExecution().executedPlan().toString()


def test_run_log_and_error_text(spark, tmp_path):
    facts = spark.createDataFrame([(0.5, 10)], "alpha double, n int")
    path = str(tmp_path / "log")
    files.append_run_log(files.run_log_rows(facts, "r1", "param"), path)
    files.append_run_log(files.run_log_rows(facts, "r2", "metric"), path)
    rows = {(r.run_id, r.kind, r.key): r.value for r in spark.read.parquet(path).collect()}
    assert rows[("r1", "param", "alpha")] == "0.5" and rows[("r2", "metric", "n")] == "10" and len(rows) == 4
    files.write_error_text(spark.createDataFrame([("bad",)], "line string"), str(tmp_path / "err"))
    assert spark.read.text(str(tmp_path / "err")).first()[0] == "bad"

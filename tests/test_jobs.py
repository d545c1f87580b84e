import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import scoring as S
from ledgerlens.plans import derive as D
from ledgerlens.plans import jobs
from ledgerlens.schemas import RAW
from ledgerlens.sources import files, manifest as log


@pytest.fixture(scope="module")
def clean_path(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    files.write_raw(D.raw_transactions(spark, "/root/testdata/sf0.01"), str(base / "raw"))
    jobs.clean_files(spark, str(base / "raw"), str(base / "clean"))
    return str(base / "clean")


def lines(first, last, hour=10):
    rows = [f"{i},2022-11-{1 + i % 5:02d} {hour}:00:00,5,7,{i}.5,1,1,0,0" for i in range(first, last)]
    return "# header\n" + "\n".join(rows) + "\n"


@pytest.mark.parametrize("incremental", [False, True])
def test_new_files_only(spark, tmp_path, incremental):
    folder, out, manifest = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "manifest")
    folder.mkdir()
    (folder / "a.txt").write_text(lines(1, 21))

    def run():
        return jobs.clean_new_files(spark, str(folder), out, manifest, incremental)

    assert run() and not run()
    (folder / "b.txt").write_text(lines(11, 31, hour=9))  # ten ids known, ten new
    assert run() and not run()
    df = files.read_clean(spark, out)
    assert df.count() == 30 and df.select("tranaction_id").distinct().count() == 30
    names, version = log.latest(spark, manifest)
    assert version == 2 and sorted(r.file for r in names.collect()) == ["a.txt", "b.txt"]
    # ten of the second file's rows are the earlier copies, and replace those of the first
    assert df.filter("hour(tx_datetime) = 9").count() == 20


def test_train_then_validate(spark, clean_path, tmp_path):
    log = str(tmp_path / "log")
    metrics = jobs.train_model(spark, clean_path, str(tmp_path / "m1"), log, "run-1").first()
    assert metrics.auc > 0.9
    versions = spark.createDataFrame([("fraud", "9", "run-1", str(tmp_path / "m1"))], "model string, version string, run_id string, path string")
    assert jobs.validate_model(spark, clean_path, versions, "fraud", log, "val-0") is None
    # the tenth version is fitted to flipped labels: much worse than the ninth
    rows = jobs.model_rows(spark, clean_path)
    worse = S.pipeline().fit(rows.withColumn("tx_fraud", 1 - F.col("tx_fraud")))
    S.save_model(worse, str(tmp_path / "m2"))
    more = versions.unionByName(versions.withColumns({"version": F.lit("10"), "path": F.lit(str(tmp_path / "m2"))}))
    verdict = jobs.validate_model(spark, clean_path, more, "fraud", log, "val-1", replicates=5).first()
    assert verdict.is_significant and not verdict.should_deploy and verdict.improvement < 0
    logged = {(r.run_id, r.kind, r.key): r.value for r in spark.read.parquet(log).collect()}
    assert logged[("run-1", "param", "maxIter")] == "10" and float(logged[("run-1", "metric", "auc")]) == metrics.auc
    assert logged[("val-1", "param", "candidate_version")] == "10" and logged[("val-1", "metric", "should_deploy")] == "false"


def test_scratch_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from ledgerlens.session import scratch_dir

    def session(**conf):
        context = SimpleNamespace(getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)

    with pytest.raises(ValueError):
        scratch_dir(session(**{"spark.master": "local-cluster[3,2,1024]"}), "t")
    assert scratch_dir(session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///c"}), "t").startswith("hdfs:///c/t-")
    assert scratch_dir(session(**{"spark.master": "local[2]"}), "t").startswith("/tmp/run-")


def test_manifest_has_one_winner_and_passes_over_the_dead(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)

    def names(*files_):
        return spark.createDataFrame([(f,) for f in files_], "file string")

    def found():
        df, version = log.latest(spark, folder)
        return sorted(r.file for r in df.collect()), version

    assert found() == ([], 0)
    log.commit(names("a"), folder, 1)
    # a run that died before its commit, and one that died within it
    names("lost").write.json(f"{folder}/names/00000002-dead")
    assert found() == (["a"], 1)
    log.commit(names("b", "a"), folder, 2)
    with pytest.raises(log.VersionTaken):
        log.commit(names("late"), folder, 2)
    assert log.create_once(spark, f"{folder}/commits/00000003", "") and found() == (["a", "b"], 3)
    with pytest.raises(log.VersionTaken):
        log.commit(names("c"), folder, 3)
    monkeypatch.setattr(log, "EVERY", 4)
    log.commit(names("c"), folder, 4)
    log.commit(names("d"), folder, 5)
    assert found() == (["a", "b", "c", "d"], 5)
    # the reader needs nothing from before the last whole list
    for old in ("1", "2"):
        assert len(list((tmp_path / "names").glob(f"0000000{old}-*"))) >= 1
    import shutil

    for path in (tmp_path / "names").glob("0000000[12]-*"):
        shutil.rmtree(path)
    assert found() == (["a", "b", "c", "d"], 5)


def test_incremental_cleaning_equals_cleaning_everything(spark, tmp_path):
    """Ids come back in later files with earlier and later times, on other dates, and without an id."""
    rng = random.Random(8)
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        rows = []
        for _ in range(60):
            i = rng.choice(["", *range(40)])
            rows.append(f"{i},2022-11-{rng.randrange(1, 6):02d} {rng.randrange(24):02d}:00:00,{rng.randrange(3)},7,{rng.randrange(3)}.5,1,1,0,0")
        (folder / f"{n}.txt").write_text("# header\n" + "\n".join(rows) + "\n")
    # the last file moves the only row of a date away
    (folder / "1.txt").write_text((folder / "1.txt").read_text() + "999,2022-12-24 10:00:00,1,7,5.0,1,1,0,0\n")
    (folder / "2.txt").write_text((folder / "2.txt").read_text() + "999,2022-12-23 10:00:00,1,7,5.0,1,1,0,0\n")
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    jobs.clean_files(spark, str(folder / "0.txt"), step)
    for name in ("1.txt", "2.txt", "2.txt"):  # the last one is repeated
        jobs.add_to_clean(spark, [str(folder / name)], step)
    jobs.clean_files(spark, str(folder), whole)

    def rows_of(path):
        return sorted(map(str, files.read_clean(spark, path).select(*RAW.fieldNames(), "tx_date").collect()))

    assert rows_of(step) == rows_of(whole)
    assert not (tmp_path / "step" / "tx_date=2022-12-24").exists()


def test_rejects_keep_their_text(spark):
    import json

    from ledgerlens.plans.derive import CHAMPION
    from ledgerlens.streaming import REJECTED, score_messages

    texts = ["not json", '{"tranaction_id":5,"tx_amount":"abc"}']
    rows = spark.createDataFrame([(t,) for t in texts], "value string").selectExpr("value", "current_timestamp() AS timestamp")
    out = score_messages(rows, CHAMPION.score).collect()
    found = {json.loads(r["value"])["message"]: json.loads(r["value"])["reason"] for r in out if r["topic"] == REJECTED}
    assert found == {texts[0]: "no readable id", texts[1]: "unusable feature"}

"""Files under their own names, runs that append, versions that two writers ask for."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tagweave import session
from tagweave.operators import runs
from tagweave.sources import files, images, tables


def listed(folder):
    return sorted(n for n in os.listdir(folder) if not n.startswith((".", "_")))


def test_named_files_are_written_and_scanned(spark):
    folder = session.new_path(spark, "named")
    rows = [("a.jpg", b"one"), ("B.PNG", b""), ("c.txt", b"text"), ("d e.jpeg", None), ("\u00e9.jpg", b"\xff" * 100_000)]
    df = spark.createDataFrame(rows, "filename string, content binary").repartition(3)
    files.write_files(df, folder)
    assert listed(folder) == sorted(n for n, _ in rows) and "_SUCCESS" in os.listdir(folder)
    os.chmod(f"{folder}/a.jpg", 0)
    open(f"{folder}/.hidden.jpg", "wb").close()
    got = {r.filename: (r.length, r.content) for r in files.scan_files(spark, folder).collect()}
    unread = None if os.geteuid() else b"one"  # the owner of all files reads it nevertheless
    want = {n: (len(c or b""), c or None) for n, c in rows if n != "c.txt"}
    assert got == {**want, "a.jpg": (3, unread)}
    # The glob of the built-in source leaves out the same files, and empty ones besides.
    assert {r.filename for r in images.scan_images(spark, folder).collect()} == {"a.jpg", "\u00e9.jpg"}
    assert files.scan_files(spark, folder, []).count() == 5 and files.scan_files(spark, folder, ["gif"]).count() == 0
    files.write_files(df.where("filename = 'a.jpg'").withColumn("content", F.lit(b"two")), folder, overwrite=False)
    assert len(listed(folder)) == 5 and open(f"{folder}/a.jpg", "rb").read() == b"two"
    files.write_files(df.where("filename = 'c.txt'"), "file://" + folder)
    assert listed(folder) == ["c.txt"]
    files.write_files(df.limit(0), folder)
    assert listed(folder) == []


def test_a_failed_job_leaves_no_file(spark):
    folder = session.new_path(spark, "failed")
    rows = [(f"f{i}.jpg", b"x") for i in range(40)] + [("no/folder.jpg", b"x")]
    with pytest.raises(Exception, match="not a file name"):
        files.write_files(spark.createDataFrame(rows, "filename string, content binary").repartitionByRange(4, "filename"), folder)
    left = listed(folder)
    # Tasks that were cut short may leave files; a repeated job writes the same names, none twice.
    files.write_files(spark.createDataFrame(rows[:-1], "filename string, content binary"), folder, overwrite=False)
    assert set(left) <= set(listed(folder)) == {n for n, _ in rows[:-1]}
    with pytest.raises(Exception, match="rows are"):
        spark.range(1).write.format("named_files").mode("append").save(folder)


def test_a_repeated_run_replaces_its_own_rows_only(spark):
    path = session.new_path(spark, "runs")
    rows = lambda run, *values: spark.createDataFrame([(run, f"m{i}", v) for i, v in enumerate(values)], "run_id string, name string, value double")
    for df in (rows("1", 1.0, 2.0), rows("2", 3.0), rows("1", 4.0), rows("1", 5.0, 6.0), rows("10", 7.0)):
        tables.append_runs(df, path)
    got = tables.scan_runs(spark, path, rows("1", 1.0).schema)
    assert sorted(map(tuple, got.collect())) == [("1", "m0", 5.0), ("1", "m1", 6.0), ("10", "m0", 7.0), ("2", "m0", 3.0)]
    assert "PartitionFilters: [isnotnull(run_id" in got.where("run_id = '2'")._jdf.queryExecution().executedPlan().toString()


def test_two_writers_get_two_versions(spark):
    registry = session.new_path(spark, "registry")
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda _: runs.claim_version(spark, registry, 4), range(24)))
    assert sorted(taken) == list(range(5, 29))
    assert runs.claim_version(spark, registry, 100) == 101 and runs.claim_version(spark, registry) == 102
    versions = spark.createDataFrame([("9",), ("7",), ("x",)], "version string")
    weights = lambda x: spark.createDataFrame([("image", 0, [x])], "head string, row int, weights array<double>")
    other = session.new_path(spark, "registry")
    with ThreadPoolExecutor(2) as pool:
        heads = list(pool.map(lambda x: runs.publish_head(weights(x), versions, other, "READY", f"r{x}").first(), (1.0, 2.0)))
    assert {h.version for h in heads} == {"10", "11"} and {h.weights[0] for h in heads} == {1.0, 2.0}
    assert runs.publish_head(weights(3.0), versions.limit(0), other, "READY", "r").first().version == "12"


def test_a_task_reads_many_small_files(spark):
    folder = session.new_path(spark, "small")
    os.makedirs(folder)
    for i in range(2_500):
        with open(f"{folder}/f{i}.jpg", "wb") as out:
            out.write(b"x" * (i % 7))
    parts = files.NamedFilesReader(folder, ["jpg"]).partitions()
    assert len(parts) <= 4 and sum(len(p.paths) for p in parts) == 2_500
    assert {r.n for r in files.scan_files(spark, folder).selectExpr("sum(length) AS n").collect()} == {sum(i % 7 for i in range(2_500))}

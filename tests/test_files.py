from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tidemark.sources import files as FS

FILES = "path string, file_name string, day date, mtime timestamp, length bigint"


def _files(spark, names_times):
    rows = []
    for path, t in names_times:
        rows.append((path, path.split("/")[-1], t.date(), t, 1))
    return spark.createDataFrame(rows, FILES)


def test_window_is_inclusive_and_checks_folders(spark):
    t = datetime(2024, 1, 10)
    df = _files(spark, [
        ("r/2024-01-10/BACK.a", datetime(2024, 1, 10, 0, 0)),
        ("r/2024-01-10/BACK.b", datetime(2024, 1, 10, 5, 0)),
        ("r/2024-01-11/BACK.c", datetime(2024, 1, 11, 12, 0)),
        ("r/2024-01-11/BACK.d", datetime(2024, 1, 11, 12, 0, 1)),
    ])
    got = sorted(r.path for r in FS.select_window(df, t, datetime(2024, 1, 11, 12, 0), zone="UTC").collect())
    assert got == ["r/2024-01-10/BACK.a", "r/2024-01-10/BACK.b", "r/2024-01-11/BACK.c"]
    assert FS.select_window(df, datetime(2024, 1, 11), datetime(2024, 1, 11)).count() == 0
    assert FS.select_window(df, None, datetime(2024, 1, 10, 5)).count() == 2
    assert FS.select_window(df, datetime(2024, 1, 10, 5), None).count() == 3


def test_classify_ignores_other_names_and_uses_dataset_folder(spark):
    df = _files(spark, [
        ("r/d/INIT.01.avro", datetime(2024, 1, 1)),
        ("r/d/BACK.02.avro", datetime(2024, 1, 1)),
        ("r/d/OTHER.03.avro", datetime(2024, 1, 1)),
        ("r/d/BACK.04/part-0000.parquet", datetime(2024, 1, 1)),
        ("r/BACK.TABLE/OTHER.05", datetime(2024, 1, 1)),
    ])
    got = {r.path.split("/")[-1] if "part" not in r.path else "part": r.kind for r in FS.classify(df).collect()}
    assert got == {"INIT.01.avro": "snapshot", "BACK.02.avro": "change", "part": "change"}


def test_isolated_batches_of_57_files(spark):
    """Files 3, 4, 20 and 56 stand alone; the others come in fives, counted anew after each of them."""
    base = datetime(2024, 1, 1)
    names = [f"r/2024-01-01/BACK.{i:03d}" for i in range(57)]
    df = _files(spark, [(n, base.replace(minute=i % 60, second=i // 60)) for i, n in enumerate(names)])
    got = FS.batch_files_isolated(df, 5, FS.special_files(["BACK.003;BACK.004, BACK.020", "r/2024-01-01/BACK.056"]))
    batches: dict[int, list[int]] = {}
    for r in got.orderBy("ordinal").collect():
        batches.setdefault(r.batch_id, []).append(int(r.path[-3:]))
    ends = [(0, 2), (3, 3), (4, 4), (5, 9), (10, 14), (15, 19), (20, 20), (21, 25), (26, 30), (31, 35), (36, 40), (41, 45), (46, 50), (51, 55), (56, 56)]
    assert batches == {k: list(range(a, b + 1)) for k, (a, b) in enumerate(ends)}
    plain = FS.batch_files(df, 10)
    assert plain.agg(F.max("batch_id")).collect()[0][0] == 5


def test_files_without_special_ones_and_with_only_special_ones(spark):
    df = _files(spark, [(f"r/2024-01-01/BACK.{i}", datetime(2024, 1, 1, i)) for i in range(7)])
    none = FS.batch_files_isolated(df, 3, FS.special_files([]))
    assert [r.batch_id for r in none.orderBy("ordinal").collect()] == [0, 0, 0, 1, 1, 1, 2]
    all_of_them = FS.batch_files_isolated(df, 3, F.lit(True))
    assert [r.batch_id for r in all_of_them.orderBy("ordinal").collect()] == list(range(7))


def test_files_are_ordered_by_arrival_then_path(spark):
    df = _files(spark, [("r/d/BACK.b", datetime(2024, 1, 2)), ("r/d/BACK.a", datetime(2024, 1, 2)), ("r/d/BACK.z", datetime(2024, 1, 1))])
    assert [r.file_name for r in FS.order_files(df).collect()] == ["BACK.z", "BACK.a", "BACK.b"]


def test_window_takes_folders_by_local_day(spark):
    """20:30 UTC on the 1st is 03:30 on the 2nd at the source, so the file lies in that day's folder."""
    rows = [("r/2026-01-02/BACK.a", "a", date(2026, 1, 2), datetime(2026, 1, 1, 20, 30, tzinfo=timezone.utc), 1)]
    df = spark.createDataFrame(rows, FILES)
    window = ("2026-01-01 20:00:00", "2026-01-01 21:00:00")
    assert FS.day_folders(*window) == ["2026-01-02"]
    assert FS.select_window(df, *window).count() == 1
    assert FS.select_window(df, *window, zone="UTC").count() == 0


def test_retry_floor_null_means_from_start(spark):
    df = spark.createDataFrame(
        [("A", "a1", datetime(2024, 1, 1)), ("A", "a2", datetime(2024, 1, 5)), ("B", "b1", datetime(2024, 1, 1)),
         ("B", "b2", datetime(2024, 1, 5)), ("C", "c1", datetime(2024, 1, 1)), ("C", "c2", datetime(2024, 1, 5))],
        "table_name string, path string, mtime timestamp",
    )
    failed = spark.createDataFrame([("A", datetime(2024, 1, 2)), ("B", None)], "table_name string, failed_from timestamp")
    got = sorted(r.path for r in FS.retry_floor(df, failed, datetime(2024, 1, 4), datetime(2024, 1, 6)).collect())
    assert got == ["a2", "b1", "b2", "c2"]


def test_force_select_names(spark):
    df = spark.createDataFrame([("CLICK", "p1", datetime(2024, 1, 1)), ("VIEW", "p2", datetime(2024, 1, 1))], "table_name string, path string, mtime timestamp")
    assert [r.path for r in FS.force_select(df, "click_ETL; nosuch").collect()] == ["p1"]
    assert FS.force_select(df, "").count() == 0


def test_list_files_reads_metadata_only(spark, tmp_dir):
    import os

    for day, name in [("2024-01-01", "BACK.1"), ("2024-01-02", "INIT.2"), ("2024-01-05", "BACK.3")]:
        os.makedirs(f"{tmp_dir}/{day}", exist_ok=True)
        with open(f"{tmp_dir}/{day}/{name}", "w") as fh:
            fh.write("x")
    listed = FS.list_files(spark, tmp_dir, datetime(2024, 1, 1), datetime(2024, 1, 2, 23), zone="UTC")
    assert sorted(r.file_name for r in listed.collect()) == ["BACK.1", "INIT.2"]
    assert "content" not in FS.list_files(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1][:80]
    assert FS.list_files(spark, f"{tmp_dir}/missing", datetime(2024, 1, 1), datetime(2024, 1, 2)).count() == 0

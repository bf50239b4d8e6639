from __future__ import annotations

from pyspark.sql import functions as F

from tidebook.operators.lookup import LookupTable


def scanned(df):
    """(files, rows) that the scan of a collected frame read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = [p for p in (plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())) if p.metrics().contains("numFiles")]
    value = lambda p, name: p.metrics().apply(name).value()
    return sum(value(p, "numFiles") for p in scans), sum(value(p, "numOutputRows") for p in scans)


def test_a_lookup_opens_one_folder_and_skips_row_groups(spark, tmp_path, monkeypatch):
    from tidebook.operators import lookup

    monkeypatch.setattr(lookup, "GROUP_BYTES", 1 << 16)
    table = LookupTable(spark, str(tmp_path / "facts"), slots=8)
    # A third of the rows are one customer's; wide enough for many row groups.
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("customer_id"), F.sha2(F.col("id").cast("string"), 256).alias("note"), "id"
    )
    table.write(rows)
    assert table.read().count() == 60_000 and set(table.read().columns) == set(rows.columns)
    for who in (7, 8, 4999):
        assert sorted(r["id"] for r in table.of(who).collect()) == sorted(r["id"] for r in rows.where(F.col("customer_id") == who).collect())
    whole = spark.read.parquet(str(tmp_path / "facts"))
    all_files, all_rows = scanned(whole.select("customer_id", "note"))
    files, seen = scanned(table.of(8).select("customer_id", "note"))
    assert all_rows == 60_000 and files <= all_files / 4
    slot = whole.where("customer_id = 8").select("_slot").first()[0]
    assert 0 < seen < whole.where(F.col("_slot") == slot).count()  # row groups of other customers stay closed
    assert scanned(table.of(123_456).select("note"))[1] == 0


def test_keys_of_other_types_and_null(spark, tmp_path):
    table = LookupTable(spark, str(tmp_path / "t"), "name", slots=4)
    table.write(spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "name string, n int"))
    assert sorted(r["n"] for r in table.of("a").collect()) == [1, 4]
    assert table.of("z").count() == 0 and table.of(None).count() == 0 and table.read().count() == 4

from datetime import date
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerlens.catalogue import views
from ledgerlens.catalogue.queries import REGISTRY
from ledgerlens.functions.keys import fingerprint
from ledgerlens.operators.loans import raw_schema
from ledgerlens.sources import files, landing, tables


def book(spark, *rows):
    return spark.createDataFrame(
        [(date.fromisoformat(d), i, D(str(v))) for d, i, v in rows],
        "snapshot_date date, exposure_id string, amount decimal(18,2)",
    )


def stored(spark, root):
    return sorted(
        (str(r["snapshot_date"]), r["exposure_id"], float(r["amount"]))
        for r in spark.read.parquet(root).collect()
    )


def test_rerun_converges_and_neighbours_stay(spark, root):
    path = f"{root}/t"
    first = book(spark, ("2018-11-30", "a", 1), ("2018-12-31", "a", 2), ("2018-12-31", "b", 3))
    files.write_partitions(first, path, "snapshot_date")
    files.write_partitions(first, path, "snapshot_date")
    assert len(stored(spark, path)) == 3
    smaller = book(spark, ("2018-12-31", "b", 4))
    files.replace_partition(smaller, path, "snapshot_date", "2018-12-31")
    assert stored(spark, path) == [("2018-11-30", "a", 1.0), ("2018-12-31", "b", 4.0)]


def test_an_empty_result_clears_its_partition_only(spark, root):
    path = f"{root}/t"
    files.write_partitions(
        book(spark, ("2018-11-30", "a", 1), ("2018-12-31", "a", 2)), path, "snapshot_date"
    )
    nothing = book(spark, ("2018-12-31", "a", 2)).filter("false")
    files.replace_partition(nothing, path, "snapshot_date", "2018-12-31")
    assert stored(spark, path) == [("2018-11-30", "a", 1.0)]


def test_a_write_that_fails_midway_changes_nothing(spark, root):
    path = f"{root}/t"
    files.write_partitions(
        book(spark, ("2018-12-31", "a", 1), ("2018-12-31", "b", 2)), path, "snapshot_date"
    )
    before = stored(spark, path)
    failing = spark.range(0, 100, 1, 4).select(
        F.lit("2018-12-31").cast("date").alias("snapshot_date"),
        F.col("id").cast("string").alias("exposure_id"),
        F.when(F.col("id") == 99, F.raise_error(F.lit("boom")).cast("decimal(18,2)"))
        .otherwise(F.lit(D("1.00"))).alias("amount"),
    )
    with pytest.raises(Exception, match="boom"):
        files.write_partitions(failing, path, "snapshot_date")
    assert stored(spark, path) == before


def test_reading_a_partition_prunes_and_keeps_its_date(spark, root):
    path = f"{root}/t"
    files.write_partitions(
        book(spark, ("2018-11-30", "a", 1), ("2018-12-31", "b", 2)), path, "snapshot_date"
    )
    df = files.read_partition(spark, path, "2018-12-31")
    assert [(r["exposure_id"], r["snapshot_date"]) for r in df.collect()] == [
        ("b", date(2018, 12, 31))
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_rebalanced_write_merges_small_files(spark, root):
    rows = spark.range(0, 4000, 1, 8).select(
        F.date_add(F.lit("2018-12-01").cast("date"), (F.col("id") % 10).cast("int"))
        .alias("snapshot_date"), F.col("id"),
    )
    files.write_partitions(rows, f"{root}/a", "snapshot_date")
    files.write_partitions(rows, f"{root}/b", "snapshot_date", rebalance=True)
    assert files.file_inventory(spark, f"{root}/a").count() == 80
    assert files.file_inventory(spark, f"{root}/b").count() == 10
    assert spark.read.parquet(f"{root}/b").count() == 4000


def test_landing_loads_what_differs(spark, root):
    path = f"{root}/landed"
    source = book(spark, ("2018-10-31", "a", 1), ("2018-11-30", "a", 2), ("2018-12-31", "a", 3))

    def states(df):
        return {str(r["snapshot_date"]): r["state"] for r in df.collect()}

    assert set(states(landing.land(spark, source, path, dry_run=True)).values()) == {"would load"}
    assert not files.exists(spark, path)
    only = landing.land(spark, source, path, only="2018-10-31")
    assert states(only) == {"2018-10-31": "new"}
    assert states(landing.land(spark, source, path)) == {
        "2018-10-31": "present", "2018-11-30": "new", "2018-12-31": "new"
    }
    assert set(states(landing.land(spark, source, path)).values()) == {"present"}
    # Same row count and size, other content.
    changed = source.withColumn(
        "amount", F.when(F.month("snapshot_date") == 12, D("9.00")).otherwise(F.col("amount"))
    )
    assert states(landing.land(spark, changed, path)) == {
        "2018-10-31": "present", "2018-11-30": "present", "2018-12-31": "replaced"
    }
    assert stored(spark, path)[-1] == ("2018-12-31", "a", 9.0)
    forced = landing.land(spark, changed, path, force=True)
    assert set(states(forced).values()) == {"replaced"}
    assert len(stored(spark, path)) == 3


def test_landing_sees_a_duplicated_row(spark):
    one = book(spark, ("2018-12-31", "a", 1), ("2018-12-31", "b", 1))
    twice = book(spark, ("2018-12-31", "a", 1), ("2018-12-31", "a", 1))
    assert landing.landing_plan(twice, one).first()["state"] == "replaced"
    swapped = one.select("amount", "snapshot_date", "exposure_id")
    assert landing.landing_plan(swapped, one).first()["state"] == "present"


def test_csv_keeps_the_id_as_text(spark, root):
    path = f"{root}/raw.csv"
    with open(path, "w") as f:
        f.write("member,id,issue_d,loan_amnt,zip\n1,0012,Dec-2018,5000.5,x\n2,Total,,,\n")
    df = files.read_csv(spark, path, raw_schema(["id", "issue_d", "loan_amnt"]))
    assert df.columns == ["id", "issue_d", "loan_amnt"]
    assert [(r["id"], r["loan_amnt"]) for r in df.collect()] == [("0012", 5000.5), ("Total", None)]


def test_compaction_keeps_rows_and_merges_files(spark, root):
    rows = spark.range(0, 3000, 1, 12).select(F.col("id"), (F.col("id") % 3 == 0).alias("big"))
    rows.write.partitionBy("big").parquet(f"{root}/many")
    report = files.compact(spark, f"{root}/many", f"{root}/few", ["big"]).first()
    assert report["files_before"] == 24 and report["files_after"] == 2
    assert spark.read.parquet(f"{root}/few").select("id", "big").exceptAll(rows).isEmpty()
    split = files.compact(spark, f"{root}/many", f"{root}/split", ["big"], target_bytes=3000).first()
    assert 2 < split["files_after"] < 24
    flat = files.compact(spark, f"{root}/many", f"{root}/flat").first()
    assert flat["files_after"] == 1


def test_inventory_reads_versions_from_paths(spark, root):
    spark.range(10).withColumn("version", F.lit(3)).write.partitionBy("version").parquet(f"{root}/v")
    rows = files.file_inventory(spark, f"{root}/v").collect()
    assert {r["version"] for r in rows} == {3} and all(r["bytes"] > 0 for r in rows)


def test_catalog_tables(spark):
    assert tables.split_name("lake.silver.exposure") == ("lake", "silver.exposure")
    assert tables.split_name("exposure") == (None, "exposure")
    tables.ensure_namespace(spark, "risk.t")
    tables.ensure_namespace(spark, "risk.t")
    spark.sql("DROP TABLE IF EXISTS risk.t")
    rows = tables.rows(spark, [("a", 1)], "k string, v int")
    tables.append_or_create(rows, "risk.t")
    tables.append_or_create(rows.select("v", "k"), "risk.t")
    assert [tuple(r) for r in spark.table("risk.t").collect()] == [("a", 1), ("a", 1)]
    tables.create_or_replace(rows.filter("v > 1"), "risk.t")
    assert spark.table("risk.t").count() == 0
    spark.sql("DROP TABLE risk.t")


def test_catalog_slice_replacement(spark):
    tables.ensure_namespace(spark, "risk.s")
    spark.sql("DROP TABLE IF EXISTS risk.s")
    one = book(spark, ("2018-12-31", "a", 1), ("2018-12-31", "b", 2))
    tables.replace_slice(one, "risk.s", "snapshot_date", "2018-12-31")
    tables.replace_slice(book(spark, ("2018-11-30", "c", 1)), "risk.s", "snapshot_date", "2018-11-30")
    tables.replace_slice(book(spark, ("2018-12-31", "a", 5)), "risk.s", "snapshot_date", "2018-12-31")
    assert {r["exposure_id"] for r in spark.table("risk.s").collect()} == {"a", "c"}
    december = tables.read_slice(spark, "risk.s", "snapshot_date", "2018-12-31")
    assert [r["exposure_id"] for r in december.collect()] == ["a"]
    tables.replace_slice(one.filter("false"), "risk.s", "snapshot_date", "2018-12-31")
    assert {r["exposure_id"] for r in spark.table("risk.s").collect()} == {"c"}
    spark.sql("DROP TABLE risk.s")


def test_csv_files_are_grouped_by_header(spark, root):
    import gzip

    schema = StructType([StructField("grade", StringType()), StructField("purpose", StringType()), StructField("amount", DoubleType())])
    for name, text in (("a", "grade,purpose,amount\nA,car,1\n"), ("b", '"purpose",extra,amount,grade\nhouse,x,2.5,B\n'),
                       ("c", "grade,purpose,amount\nC,,\n"), ("none", "")):
        Path(f"{root}/{name}.csv").write_text(text)
    Path(f"{root}/d.csv.gz").write_bytes(gzip.compress(b"amount,grade,purpose\n4,D,boat\n"))
    got = sorted(tuple(r) for r in files.read_csv(spark, root, schema).collect())
    assert got == [("A", "car", 1.0), ("B", "house", 2.5), ("C", None, None), ("D", "boat", 4.0)]
    with pytest.raises(ValueError, match="b.csv lacks the declared columns region"):
        files.read_csv(spark, f"{root}/b.csv", schema.add("region", StringType()))
    assert files.read_csv(spark, f"{root}/none.csv", schema).collect() == []


def test_a_landing_without_change_reads_no_landed_row(spark, root):
    path = f"{root}/landed"
    source = book(spark, ("2018-10-31", "a", 1), ("2018-11-30", "a", 2))
    landing.land(spark, source, path)
    # Landed before there was a manifest: it is read once and noted.
    files.remove(spark, f"{landing.manifest_path(path)}/snapshot_date=2018-10-31")
    assert {r["state"] for r in landing.land(spark, source, path).collect()} == {"present"}
    assert {r["state"] for r in landing.land(spark, source, path).collect()} == {"present"}
    for f in Path(path).glob("snapshot_date=*/*.parquet"):
        f.write_bytes(b"unreadable")
    assert {r["state"] for r in landing.land(spark, source, path).collect()} == {"present"}
    # A partition that is gone is loaded again, whatever the manifest says.
    files.remove(spark, f"{path}/snapshot_date=2018-11-30")
    states = {str(r["snapshot_date"]): r["state"] for r in landing.land(spark, source, path).collect()}
    assert states == {"2018-10-31": "present", "2018-11-30": "new"}


def test_landings_from_a_staged_source_make_its_rows_once(spark, root, monkeypatch):
    made, months = spark.sparkContext.accumulator(0), views.silver_months

    def counted(spark, sf):
        rows = months(spark, sf)

        def run(batches):
            for b in batches:
                made.add(b.num_rows)
                yield b

        return rows.mapInArrow(run, rows.schema)

    monkeypatch.setattr(views, "silver_months", counted)
    stored = REGISTRY["landed_partitions"](spark, "/root/testdata/sf0.001").collect()
    assert made.value == sum(r["row_count"] for r in stored) > 0


def test_a_staged_source_has_its_rows_and_types(spark, root):
    rows = book(spark, ("2018-10-31", "a", 1), ("2018-10-31", "a", 1), ("2018-11-30", "b", 2))
    # Text stays text, also where it looks like a date; nulls stay.
    odd = rows.select("amount", F.col("snapshot_date").cast("string"), F.nullif("exposure_id", F.lit("b")).alias("id"))
    for source in (rows, odd, rows.filter("false")):
        want = sorted(map(repr, source.collect()))
        with landing.staged(source, f"{root}/staged") as kept:
            assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in source.schema]
            assert sorted(map(repr, kept.collect())) == want
        assert not files.exists(spark, f"{root}/staged")
    with pytest.raises(RuntimeError, match="stop"), landing.staged(rows, f"{root}/staged"):
        raise RuntimeError("stop")
    assert not files.exists(spark, f"{root}/staged")


def test_fingerprints_of_parts_add_up(spark):
    rows = book(spark, *[("2018-10-31", "a", i) for i in range(9)], ("2018-11-30", "b", 1))
    parts = [landing.fingerprints(rows.where(F.col("amount") % 3 == k), "snapshot_date") for k in range(3)]
    added = landing.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), "snapshot_date")
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, landing.fingerprints(rows, "snapshot_date").collect()))


def test_fingerprints_see_where_a_null_stands(spark):
    schema = "a string, b string"
    one, other = ([tuple(r) for r in spark.createDataFrame([row], schema).agg(*fingerprint(["a", "b"])).collect()]
                  for row in ((None, "x"), ("x", None)))
    assert one != other


def test_partitions_are_written_without_a_sort_of_the_rows(spark, root, monkeypatch):
    """A sort holds all rows of a task: the more, the larger a table's files are."""
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(key)
    from pyspark.sql import DataFrameWriter

    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(key)), write(self, *a, **k))[1])
    rows = spark.range(100).selectExpr("id", "id % 12 as part")
    files.write_partitions(rows, f"{root}/loose", "part")
    files.compact(spark, f"{root}/loose", f"{root}/few", ["part"])
    assert [int(n) for n in seen] == [files.OPEN_FILES] * 2 and spark.conf.get(key) == before
    # Also where a task meets more partitions than it holds open.
    assert sorted(map(tuple, spark.read.parquet(f"{root}/few").collect())) == sorted((i, i % 12) for i in range(100))

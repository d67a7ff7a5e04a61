"""Tables switch at once: readers and dying runs see the old lake or the new one, never a mixture."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from conftest import FIXTURE_LANDING
from strata.plans import pipeline
from strata.plans.pipeline import ENTITY_COLUMNS, SILVER_NAME, Tables, run_pipeline
from strata.sources import sinks
from strata.sources.store import Overtaken, Versions

GOLD = ["dim_customer", "dim_product", "dim_warehouse", "dim_date", "fct_sales", "fct_inventory_movements", "validation_run_log"]


def numbers(spark, n):
    return spark.range(n)


def test_versions_switch_prune_and_detect_a_second_writer(spark, tmp_path):
    root = str(tmp_path)
    numbers(spark, 2).write.parquet(f"{root}/a/b")  # a table from before there were versions
    old = Versions(spark, root)
    assert spark.read.parquet(old.path("a/b")).count() == 2
    for n in (3, 4, 5):
        v = Versions(spark, root)
        numbers(spark, n).write.parquet(v.stage("a/b"))
        numbers(spark, 10 * n).write.parquet(v.stage("c"))
        reader = Versions(spark, root)
        assert reader.number == n - 3 and spark.read.parquet(reader.path("a/b")).count() == (n - 1 if n > 3 else 2)
        assert v.publish(keep=2) == n - 2
        assert spark.read.parquet(reader.path("a/b")).count() == (n - 1 if n > 3 else 2)  # resolved before
    now = Versions(spark, root)
    assert [spark.read.parquet(now.path(t)).count() for t in ("a/b", "c")] == [5, 50]
    assert len([x for x in os.listdir(f"{root}/c") if x.startswith("v")]) == 2 and len(now.store.numbers("_versions")) == 2

    slow, fast = Versions(spark, root), Versions(spark, root)
    for v, n in ((slow, 7), (fast, 8)):
        numbers(spark, n).write.parquet(v.stage("c"))
    fast.publish()
    with pytest.raises(Overtaken):
        slow.publish()
    assert spark.read.parquet(Versions(spark, root).path("c")).count() == 8
    # a run that died: its folder goes with the next version of its number or later
    dead = Versions(spark, root)
    numbers(spark, 9).write.parquet(dead.stage("c"))
    live = Versions(spark, root)
    numbers(spark, 10).write.parquet(live.stage("c"))
    live.publish()
    assert not os.path.exists(dead.path("c")) and spark.read.parquet(live.path("c")).count() == 10


def lake(spark, out):
    """Rows of every table of the lake, as someone finds it who comes now."""
    t = Tables(spark, out)
    frames = {f"bronze.{e}": t.raw(e) for e in ENTITY_COLUMNS} | {f"gold.{g}": t.read("gold", g) for g in GOLD}
    frames |= {f"silver.{e}": t.silver(e) for e in SILVER_NAME} | {f"quarantine.{e}": t.quarantine(e) for e in ENTITY_COLUMNS}
    frames["history"] = t.customer_history
    return {k: sorted(map(repr, df.collect())) for k, df in frames.items()}


class Died(Exception):
    pass


def test_a_run_that_dies_after_any_write_leaves_the_old_lake(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "lake")
    run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out, dt.datetime(2024, 3, 1))
    before = lake(spark, out)
    writes = []

    def watched(write):
        def run(*args, **kw):
            got = write(*args, **kw)
            writes.append(args[-1])
            # whoever reads at this moment, or after a death here, finds these files
            if len(writes) % 5 == 1:
                assert lake(spark, out) == before
            else:
                assert Tables(spark, out).versions.number == 1
            return got

        return run

    monkeypatch.setattr(sinks, "write_counted", watched(sinks.write_counted))
    monkeypatch.setattr(sinks, "write_split", watched(sinks.write_split))
    publish = Versions.publish
    monkeypatch.setattr(Versions, "publish", lambda *a, **k: (_ for _ in ()).throw(Died()))
    with pytest.raises(Died):
        run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out, dt.datetime(2024, 3, 2))
    assert len(writes) >= 26 and lake(spark, out) == before
    monkeypatch.undo()
    assert Versions.publish is publish

    for k in range(2):
        assert run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out, dt.datetime(2024, 3, 3 + k)).passed
    after = lake(spark, out)
    assert len(after["gold.fct_sales"]) == 9 and len(after["gold.validation_run_log"]) == 12
    # two versions are kept; those before and that of the dead run are gone
    folders = [x for x in os.listdir(f"{out}/gold/fct_sales") if x.startswith("v")]
    assert len(folders) == 2 and Tables(spark, out).versions.number == 3


def test_rejected_lines_are_a_table_of_the_lake(spark, tmp_path):
    landing = tmp_path / "landing"
    for batch in ("batch_1", "batch_2"):
        (landing / batch).mkdir(parents=True)
        for entity in ENTITY_COLUMNS:
            text = open(os.path.join(FIXTURE_LANDING, batch, f"{entity}.csv")).read()
            (landing / batch / f"{entity}.csv").write_text(text + ("O9,too,few\n" if (batch, entity) == ("batch_1", "orders") else ""))
    run = run_pipeline(spark, str(landing), ["batch_1", "batch_2"], str(tmp_path / "lake"), dt.datetime(2024, 3, 1), "demo")
    assert run.passed and run.counts["bronze.orders"] == 8 and run.counts["quarantine.orders_lines"] == 1
    line = Tables(spark, str(tmp_path / "lake")).read("quarantine", "orders_lines").first()
    assert (line.raw_line, line.rejected_reason, line.batch_id, line.source_system) == ("O9,too,few", "column count", "batch_1", "demo")
    assert "vv_quarantine.orders_lines" in pipeline.register_layers(spark, str(tmp_path / "lake"), "vv_")
    assert spark.table("vv_quarantine.orders_lines").count() == 1 and spark.table("vv_bronze.orders").count() == 8


def test_catalog_tables_are_replaced_without_a_gap(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS replaced_here")
    name = "replaced_here.t"
    for n in (2, 3, 4):
        assert sinks.replace_table_as(spark.range(n), name) == n
        assert spark.table(name).count() == n
    assert sinks.replace_table_as(spark.table(name).where("id > 0"), name) == 3  # from itself
    assert sinks.replace_table_as(spark.range(2).withColumn("x", F.lit("a")), name) == 2
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 2
    spark.sql("DROP SCHEMA replaced_here CASCADE")


def test_rebuilding_checks_the_schema_before_it_writes(spark, tmp_path):
    schema = StructType([StructField("id", LongType())])
    root = str(tmp_path)
    assert sinks.rebuild_versioned(spark.range(3), root, "h", schema) == 3
    with pytest.raises(ValueError, match="schema mismatch"):
        sinks.rebuild_versioned(spark.range(3).selectExpr("cast(id as int) AS id"), root, "h", schema)
    assert spark.read.parquet(Versions(spark, root).path("h")).count() == 3

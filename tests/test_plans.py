"""Physical plans: no cross joins, no single-partition windows, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from slotwise.operators import cleaning, history
from slotwise.plans import history as plans
from slotwise.sources import demo
from slotwise.sources.stages import staged
from verification import inputs

LAZY = [
    "intraday_agg", "interval_mart", "raw_history", "clean", "feature_table", "top3_drivers", "row_index", "time_folds",
    "psi_drift", "date_split", "future_split", "left_new_hire_fanout", "log_gap_agg", "validity_range_join", "slot_end",
    "metrics_document", "correlation_matrix", "histogram", "programs_in_all_runs", "bi_frontend", "plan_vs_model",
    "extreme_rows", "waterfall", "inference_run_linear", "benchmark_run_linear",
]


@pytest.fixture(autouse=True)
def full_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_global_window(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # A Window line ends with [partition keys], [order keys]; empty keys mean one task for all rows.
    assert not re.search(r"Window \[.*\], \[\], \[", plan)


def test_scans_read_only_their_columns(spark, sf_dir):
    plan = plan_of(entry.queries()["people_two_level"](spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "l_extendedprice" not in plan and "l_shipdate" not in schema


def test_one_window_exchange_for_all_history_features(spark, sf_dir):
    rows = inputs.rows(spark, sf_dir)
    plan = plan_of(history.lag_and_rolling(rows))
    main = [line for line in plan.splitlines() if re.search(r"Window \[lag\(", line)]
    assert len(main) == 1  # 15 lags and rolling statistics share one pass
    by_bucket = [line for line in plan.splitlines() if "hashpartitioning(program_id" in line and "_bucket" in line]
    assert len(by_bucket) == 2  # rows with halo, and bucket tails


def test_stage_partition_is_pruned(spark, sf_dir, tmp_path):
    from slotwise.sources.stages import read_stage, stage_sink

    df = inputs.light(spark, sf_dir)
    path = stage_sink(df, str(tmp_path / "clean"), "ref_date")
    plan = plan_of(read_stage(spark, path, df.schema).where("ref_date >= DATE '2024-01-25'"))
    assert re.search(r"PartitionFilters: \[[^\]]*ref_date", plan)


@pytest.mark.parametrize("mode", ["inference", "training"])
def test_run_scope_reaches_every_source(spark, sf_dir, mode):
    """Window (both bounds where there are two), programs and channel stand below each aggregate of the computed mart."""
    plan = inputs.live_mart(spark, sf_dir, mode)._jdf.queryExecution().optimizedPlan().toString()
    sources = plan.split("Join FullOuter")[1]
    tops = re.split(r"Aggregate \[", sources)[1:]
    assert len(tops) >= 3
    for part in tops:
        if "Relation [" not in part:
            continue
        filters = " ".join(line for line in part.splitlines() if "Filter" in line)
        assert "IN (" in filters or "INSET" in filters, part
        assert filters.count(">=") >= 1 and ("<=" in filters or mode == "training"), part


def test_broadcast_is_never_forced():
    import pathlib

    root = pathlib.Path(entry.__file__).parent / "slotwise"
    code = "\n".join(p.read_text() for p in root.rglob("*.py"))
    for word in ("broadcast(", "localCheckpoint", "crossJoin", ".rdd"):
        assert word not in code, word


def test_clean_needs_no_udf(spark, sf_dir):
    plan = plan_of(cleaning.clean(inputs.live_mart(spark, sf_dir), demo.config("training")))
    assert "Python" not in plan


FACTS = ["encoding_lookup", "encoding_override", "active_semi", "slot_end", "psi_drift", "recent_window"]


@pytest.mark.parametrize("name", FACTS)
def test_program_facts_need_no_exchange_of_rows(spark, sf_dir, name):
    """Facts of programs come as one map: no join on the program, and both forms give the same rows."""
    from slotwise.operators import encoding, metrics, reports, windows

    rows = inputs.light(spark, sf_dir, "training").withColumn("role", F.when(F.col("ref_date") < "2024-01-25", "train").otherwise("test"))
    rows = staged(rows.withColumn("program_enc", F.lit(0.5)), "rows")
    enc = staged(inputs.stored_encoding(spark, sf_dir), "encoding")
    forms = {
        "encoding_lookup": lambda many: encoding.encoding_lookup(rows, enc, many=many),
        "encoding_override": lambda many: encoding.encoding_override(rows, enc, many=many),
        "active_semi": lambda many: cleaning.active_semi(rows, many), "slot_end": lambda many: reports.slot_end(rows, many),
        "psi_drift": lambda many: metrics.psi_drift(rows, many=many),
        "recent_window": lambda many: windows.recent_window(rows, days=7, per_program=True, many=many),
    }
    one, two = (forms[name](many) for many in (False, True))
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Join" in two._jdf.queryExecution().optimizedPlan().toString()
    assert one.columns == two.columns and one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and not one.isEmpty()


def test_too_many_programs_ask_for_the_join(spark, monkeypatch):
    from slotwise.operators import columns

    monkeypatch.setattr(columns, "MAP_PROGRAMS", 3)
    facts = spark.range(5).selectExpr("cast(id as int) as program_id", "id as fact")
    with pytest.raises(Exception, match="many=True"):
        columns.with_program_facts(facts.drop("fact"), facts).collect()
    rows = columns.with_program_facts(facts.select("program_id").unionByName(spark.createDataFrame([(9,), (None,)], "program_id int")), facts, many=True)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([(k, k) for k in range(5)] + [(9, None), (None, None)], key=repr)

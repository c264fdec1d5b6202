import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from slotwise.operators import reports
from slotwise.sources import database, forecast, stages, stores

KEYS = "ref_date date, slot int, program_id int, channel_id int, sl_pred double"
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def rows(spark, data):
    return spark.createDataFrame(data, KEYS)


def content(df):
    return sorted((r.ref_date, r.slot, r.program_id, r.sl_pred) for r in df.collect())


@pytest.fixture
def existing(spark):
    return rows(spark, [(D1, 0, 1, 7, 0.1), (D1, 600, 1, 7, 0.1), (D1, 600, 2, 7, 0.1), (D2, 0, 1, 7, 0.1), (D3, 30, 2, 7, 0.1)])


def test_rolling_overwrite_scopes(spark, existing):
    batch = rows(spark, [(D1, 600, 1, 7, 0.9), (D2, 30, 1, 7, 0.9)])
    got = content(forecast.rolling_overwrite(existing, batch))
    assert got == sorted([(D1, 0, 1, 0.1), (D1, 600, 1, 0.9), (D2, 0, 1, 0.1), (D2, 30, 1, 0.9), (D3, 30, 2, 0.1)])
    by_program = content(forecast.rolling_overwrite(existing, batch, "program"))
    assert (D1, 600, 2, 0.1) in by_program and len(by_program) == 6


def test_publish_is_idempotent(spark, existing):
    path = stages.new_stage(spark, "t")
    batch = rows(spark, [(D1, 600, 1, 7, 0.9)])
    forecast.publish(spark, path, existing)
    forecast.publish(spark, path, batch)
    once = content(forecast.read_forecast(spark, path, batch.schema))
    forecast.publish(spark, path, batch)
    assert content(forecast.read_forecast(spark, path, batch.schema)) == once
    assert once == content(forecast.rolling_overwrite(existing, batch))


def test_publish_empty_batch_keeps_table(spark, existing):
    path = stages.new_stage(spark, "t")
    forecast.publish(spark, path, existing)
    forecast.publish(spark, path, existing.limit(0))
    assert content(forecast.read_forecast(spark, path, existing.schema)) == content(existing)


def test_fact_schema_rejects_overflow(spark):
    wide = spark.range(1).select(*[
        F.lit("x").alias(n) if t == "string" else F.lit(dt.date(2024, 1, 1)).alias(n) if t == "date" else F.lit(0.12345).alias(n)
        for n, t in forecast.FACT_FIELDS if n != "updated_at"])
    r = forecast.fact_schema(wide.withColumn("slot", F.lit(30)), dt.datetime(2024, 1, 1)).first()
    assert str(r.sl_pred) == "0.1235" and len(r) == 35
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        forecast.fact_schema(wide.withColumn("impact_volume", F.lit(12.0)).withColumn("slot", F.lit(0))).collect()


def test_program_dim(spark, tmp_path):
    f = tmp_path / "programs.csv"
    f.write_text(" 11 ; First \n12;Other\n;no code\n13;  \n11;Last\n")
    assert {(r.code, r.name) for r in stores.program_dim(spark, str(f)).collect()} == {("11", "Last"), ("12", "Other")}
    assert stores.program_dim(spark, str(tmp_path / "absent.csv")).count() == 0
    named = stores.with_program_name(spark.createDataFrame([(11,), (99,)], "program_id int"), stores.program_dim(spark, str(f)))
    assert {(r.program_id, r.program_name) for r in named.collect()} == {(11, "Last"), (99, "")}


def doc(**meta):
    body = {c: 1.0 for c in stores.METRIC_COLUMNS} | {"n_rows": 5}
    return json.dumps({"overall": body, "by_program": {"1": body, "2": body}, **({"metadata": meta} if meta else {})}, indent=2)


def test_metric_docs(spark, tmp_path):
    (tmp_path / "metrics_7d.json").write_text(doc())
    (tmp_path / "metrics_20240114_030000_7d.json").write_text(doc())
    (tmp_path / "metrics_x.json").write_text(doc(suffix="20240121_030000_14d", executed_at="2024-01-21 03:05:00", days=14))
    (tmp_path / "metrics_bad.json").write_text('{"overall": ')
    docs = stores.scan_metric_docs(spark, f"{tmp_path}/metrics_*.json")
    got = {r.suffix: (r.executed_at, r.days) for r in docs.collect()}
    assert got == {"7d": ("desconhecida", 7), "20240114_030000_7d": ("2024-01-14 03:00:00", 7),
                   "20240121_030000_14d": ("2024-01-21 03:05:00", 14)}
    assert reports.run_evolution_by_program(docs).count() == 6
    assert [r.executed_at is None for r in reports.run_evolution(docs).collect()] == [True, False, False]
    dated = docs.where("executed_at <> 'desconhecida'")
    assert reports.latest_run(dated).first().suffix == "20240121_030000_14d"


def test_encoding_fallback(spark):
    enc = spark.createDataFrame([(1, 0.7, 0.6, 10)], "program_id int, enc double, global_mean double, n bigint")
    own, other = stages.new_stage(spark, "enc"), stages.new_stage(spark, "enc")
    assert stores.load_encoding(spark, own, other).count() == 0
    stores.save_encoding(enc, other)
    assert stores.load_encoding(spark, own, other).first().enc == 0.7
    stores.save_encoding(enc.withColumn("enc", F.lit(0.2)), own)
    assert stores.load_encoding(spark, own, other).first().enc == 0.2


def test_empty_stage_keeps_schema(spark):
    df = spark.createDataFrame([], "a int, ref_date date")
    path = stages.stage_sink(df, stages.new_stage(spark, "empty"), "ref_date")
    assert stages.read_stage(spark, path, df.schema).columns == ["a", "ref_date"]


def test_programs_in_all_runs(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3), ("b", 2)], "suffix string, program_id int")
    assert [r.program_id for r in reports.programs_in_all_runs(df).collect()] == [2]


def test_registry_helpers():
    grown = reports.with_exclusions({1: ["a"]}, 2, ["b"])
    assert grown == {1: ["a"], 2: ["b"]}
    assert reports.configured_programs(grown, {"x": None, "y": [7, 1]}) == [1, 2, 7]


def test_named_queries(spark, tmp_path):
    f = tmp_path / "queries.ini"
    f.write_text("[mart]\nquery =\n    SELECT * FROM {mart}\n    WHERE program_id = :program\n      AND slot < 100 -- 50% of it\n")
    text = database.load_queries(str(f))["mart"]
    mart = rows(spark, [(D1, 0, 1, 7, 0.1), (D1, 600, 1, 7, 0.1), (D1, 0, 2, 7, 0.1)])
    assert database.run_query(spark, text, {"program": 1}, mart=mart).count() == 1
    with pytest.raises(FileNotFoundError):
        database.load_queries(str(tmp_path / "absent.ini"))


def test_day_predicates_cover_the_window_once():
    p = database.day_predicates("d", dt.date(2024, 1, 30), dt.date(2024, 2, 3), 2)
    assert p == ["d >= '2024-01-30' AND d < '2024-02-01'", "d >= '2024-02-01' AND d < '2024-02-03'", "d >= '2024-02-03' AND d < '2024-02-04'"]


def test_encoding_documents(spark, tmp_path):
    rows = [(347851, 0.9, 0.8, 30), (5, 0.25, 0.8, 4)]
    df = spark.createDataFrame(rows, "program_id int, enc double, global_mean double, n bigint")
    back = stores.load_encoding_documents(spark, stores.save_encoding_documents(df, str(tmp_path / "docs")))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    folder = tmp_path / "foreign"
    folder.mkdir()
    for name, program, mean in (("target_encoding_1.json", 1, 0.6), ("target_encoding_2.json", 2, 0.7)):
        (folder / name).write_text('{\n  "programa": %d,\n  "encoding": 0.5,\n  "media_global": %s,\n  "n_amostras": 9\n}' % (program, mean))
    found = stores.load_encoding_documents(spark, str(folder)).collect()
    assert {(r.program_id, r.global_mean) for r in found} == {(1, 0.7), (2, 0.7)}
    (tmp_path / "all.json").write_text('{"7": 0.1, "__media_global__": 0.4, "8": 0.2}')
    found = stores.load_global_encoding_document(spark, str(tmp_path / "all.json")).collect()
    assert {tuple(r)[:3] for r in found} == {(7, 0.1, 0.4), (8, 0.2, 0.4)}
    (tmp_path / "bare.json").write_text('{"7": 0.1}')
    assert stores.load_global_encoding_document(spark, str(tmp_path / "bare.json")).first().global_mean == 0.5


def test_attributions_keep_the_transform_flag(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, [("a", 0.5)], 0.1)], "program_id int, row_num bigint, contribs array<struct<feature: string, impact: double>>, base_value double")
    for flag in (True, False):
        path = stores.save_attributions(df, str(tmp_path / str(flag)), target_transform=flag)
        assert stores.load_attributions(spark, path).first().target_transform is flag


def test_reader_never_sees_half_a_publish(spark, existing, monkeypatch):
    """Between the folder writes and the manifest, readers have the old version; after it, all of the new one."""
    path = stages.new_stage(spark, "forecast")
    forecast.publish(spark, path, existing)
    before, seen, commit = content(forecast.read_forecast(spark, path, existing.schema)), [], forecast.commit
    batch = existing.withColumn("sl_pred", F.lit(0.125).cast(existing.schema["sl_pred"].dataType))

    def watched(spark, path, version, folders):
        seen.append(content(forecast.read_forecast(spark, path, existing.schema)))
        return commit(spark, path, version, folders)

    monkeypatch.setattr(forecast, "commit", watched)
    assert forecast.publish(spark, path, batch) == 2
    assert seen == [before]
    assert content(forecast.read_forecast(spark, path, existing.schema)) == content(batch)
    assert content(forecast.read_forecast(spark, path, existing.schema, version=1)) == before


def test_two_writers_lose_no_rows(spark, existing, monkeypatch):
    """A writer whose base is no longer the newest version starts again from the newest."""
    path = stages.new_stage(spark, "forecast")
    dates = sorted(r[0] for r in existing.select("ref_date").distinct().collect())
    first, second = (existing.where(F.col("ref_date") == d) for d in dates[:2])
    commit, calls = forecast.commit, []

    def beaten(spark, path, version, folders):
        calls.append(version)
        if len(calls) == 1:  # another writer commits while this one is about to
            monkeypatch.setattr(forecast, "commit", commit)
            forecast.publish(spark, path, second)
            monkeypatch.setattr(forecast, "commit", beaten)
        return commit(spark, path, version, folders)

    monkeypatch.setattr(forecast, "commit", beaten)
    forecast.publish(spark, path, first)
    assert len(calls) == 2 and calls[1] > calls[0]
    assert content(forecast.read_forecast(spark, path, existing.schema)) == content(first.unionByName(second))
    assert forecast.versions(spark, path) == [1, 2]


def test_failed_writer_leaves_the_table(spark, existing, monkeypatch):
    path = stages.new_stage(spark, "forecast")
    forecast.publish(spark, path, existing)
    monkeypatch.setattr(forecast, "commit", lambda *a: False)
    with pytest.raises(RuntimeError, match="other writers"):
        forecast.publish(spark, path, existing.limit(1))
    assert content(forecast.read_forecast(spark, path, existing.schema)) == content(existing)
    assert forecast.read_forecast(spark, stages.new_stage(spark, "nothing"), existing.schema).count() == 0

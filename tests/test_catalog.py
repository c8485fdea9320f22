"""The layers by their names in SQL."""

import pytest
from test_pipeline import AT, survey

from tallywork.operators.dedupe import latest_per_key
from tallywork.plans import catalog, marts, pipeline
from tallywork.registry.queries import ADOPTION_SQL


def test_names_follow_the_current_snapshot(spark, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(spark, survey(tmp_path / "a.csv", 150), out, AT)
    names = catalog.publish(spark, out, "first_")
    assert set(names) == set(catalog.TABLES) | set(catalog.VIEWS)
    assert names["languages"] == "first_intermediate.int_languages_exploded"
    for layer, df in pipeline.layers(spark, out).items():
        assert sorted(map(str, spark.table(names[layer]).collect())) == sorted(map(str, df.collect())), layer
    mart = spark.table(names["adoption"])
    by_sql = spark.sql(ADOPTION_SQL.format(**names)).select(*mart.columns)
    assert sorted(by_sql.collect()) == sorted(mart.collect()) and mart.count() > 0
    # Buckets are known under these names too: by its key, the raw layer needs no shuffle.
    plan = latest_per_key(spark.table(names["raw"]), "response_id", "loaded_at")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

    pipeline.run(spark, survey(tmp_path / "b.csv", 120), out, AT)
    assert spark.table(names["staging"]).count() == 150  # until it is published
    assert catalog.publish(spark, out, "first_") == names
    assert spark.table(names["staging"]).count() == 120


def test_only_what_is_stored_has_a_name(spark, tmp_path):
    out = str(tmp_path / "out")
    pipeline.ingest(spark, survey(tmp_path / "a.csv", 10), out, AT)
    assert set(catalog.publish(spark, out, "raw_only_")) == {"raw"}


ITEMS = ["C", "c++;C", " a b ;;x", ";", "", None, "100%;a_b", r"back\slash;\%", "Java;JavaScript", "é;É", "\t;tab"]
WANTED = ["JavaScript", "c;C++", None, "100 %; axb", r"a\slash", "é", "x\t"]


@pytest.mark.parametrize("layer", ["languages", "databases"])
def test_exploded_views_equal_the_layers(spark, layer):
    rows = [(str(i), have, want) for i, (have, want) in enumerate((h, w) for h in ITEMS for w in WANTED)]
    kind = {"languages": "language", "databases": "database"}[layer]
    stg = spark.createDataFrame(rows, f"response_id string, {kind}_have_worked string, {kind}_want_work string").selectExpr(
        "*", "'X' AS country", "1 AS years_code_pro", "2 AS comp_total_usd", "'d' AS dev_type"
    )
    stg.createOrReplaceTempView("odd_staging")
    got = spark.sql(catalog.exploded_sql("odd_staging", layer))
    want = getattr(marts, f"{layer}_exploded")(stg)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

import pytest

from oreworks.__main__ import main


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("plant_id,quantity,prod_dt\np1,5,2024-01-05\np2,3,2024-01-06\n")
    return str(folder)


def test_run_and_gate(spark, schema, raw, tmp_path, capsys):
    rules = tmp_path / "rules.json"
    rules.write_text('{"quality_rules": {"min_rows": 2, "primary_key": "plant_id"}}')
    common = ["manufacturing", "--raw", raw, "--schema", schema, "--audit", f"{schema}.audit"]
    assert main([*common, "--layer", "silver", "--require-gate"], spark) == 1
    assert "did not pass" in capsys.readouterr().err
    assert main([*common, "--rules", f"gold={rules}"], spark) == 0
    assert "gold pk_unique_plant_id: PASS (total=2, distinct=2)" in capsys.readouterr().out
    assert spark.table(f"{schema}.gold_output_metrics").count() == 2
    declared = ["--raw-schema", "plant_id string, quantity int, prod_dt date"]
    assert main([*common, "--rules", f"bronze={rules}", *declared], spark) == 0
    rules.write_text('{"quality_rules": {"min_rows": 9}}')
    assert main([*common, "--rules", f"silver={rules}"], spark) == 1
    assert "row_count: FAIL (rows=6, min_required=9)" in capsys.readouterr().err


def test_schema_policy_from_the_rules_file(spark, schema, raw, tmp_path):
    common = ["manufacturing", "--raw", raw, "--schema", schema, "--audit", f"{schema}.audit"]
    assert main(common, spark) == 0
    (tmp_path / "in" / "a.csv").write_text("plant_id,quantity,prod_dt,shift\np1,5,2024-01-05,7\n")
    assert main(common, spark) == 1
    config = tmp_path / "policy.json"
    config.write_text('{"schema_evolution": {"allowed_additions": ["shift"]}}')
    assert main([*common, "--rules", f"bronze={config}", "--rules", f"silver={config}"], spark) == 0
    assert spark.table(f"{schema}.silver_production").columns == ["plant_id", "quantity", "production_date", "shift"]
    assert spark.table(f"{schema}.bronze_production").filter("shift IS NULL").count() == 2


def test_unknown_layer_of_rules(raw):
    with pytest.raises(SystemExit):
        main(["manufacturing", "--raw", raw, "--rules", "platinum=x"])


def test_csv_in_another_column_order_is_refused(spark, schema, raw):
    common = ["manufacturing", "--raw", raw, "--schema", schema, "--audit", f"{schema}.audit"]
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        main([*common, "--raw-schema", "quantity int, plant_id string, prod_dt date"], spark)

"""The spark-submit entry point runs the whole pipeline and reports counts."""

from conftest import FIXTURE_LANDING
from strata.plans import cli


def test_cli_pipeline(spark, tmp_path, capsys):
    code = cli.main(["pipeline", "--landing", FIXTURE_LANDING, "--batches", "batch_1,batch_2",
                     "--out", str(tmp_path / "lake"), "--source-system", "demo", "--facts-by-month"])
    out = capsys.readouterr().out
    assert code == 0
    assert "gold.fct_sales\t9" in out and "quarantine.order_items\t1" in out
    assert "41/41 checks passed" in out

"""Command line entry point on an empty warehouse."""

from vitrine.__main__ import main


def test_health_and_hourly_on_empty_warehouse(spark, tmp_root, capsys):
    assert main(["health", "--root", tmp_root]) == 0
    assert main(["hourly", "--root", tmp_root, "--triggered-by", "TEST"]) == 0
    out = capsys.readouterr().out
    assert "batch 1 refreshed the daily aggregate" in out
    assert main(["steps", "--root", tmp_root, "--batch", "1"]) == 0
    assert "REFRESH_AGG_DAILY_SALES" in capsys.readouterr().out


def test_run_loads_exported_feeds(spark, tmp_root, capsys):
    import tempfile

    from star_cases import SF_SMALL
    from vitrine.plans.warehouse import Warehouse
    from vitrine.sources import fixtures as FX
    from vitrine.sources import ingest as I

    feeds = tempfile.mkdtemp(prefix="feeds-")
    I.export_feeds(FX.staging(spark, SF_SMALL), feeds)
    assert main(["run", "--root", tmp_root, "--feeds", feeds, "--as-of", FX.FIXTURE_AS_OF]) == 0
    assert "batch 1 loaded" in capsys.readouterr().out
    wh = Warehouse(spark, tmp_root)
    assert wh.read("fact_orders").count() > 0 and wh.current("agg_daily_sales").count() > 0

import os

import pytest

from tidemark.plans import marts, registry, reports

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_descriptive_report(spark):
    tables = reports.descriptive_report(registry.positive(spark, SF_DIR), ["event_id"])
    assert tables["central"].count() == 6
    assert {tables[x].count() for x in ("dispersion", "shape", "volatility", "outliers", "median_pivot")} == {5}
    assert tables["daily_volume"].count() == 30


def test_inferential_report(spark):
    rows = {name: df.count() for name, df in reports.inferential_report(registry.positive(spark, SF_DIR)).items()}
    assert rows["welch"] == rows["mann_whitney"] == rows["effects"] == 10
    assert rows["anova"] == rows["kruskal"] == rows["levene"] == rows["category_anova"] == 1
    assert rows["confidence"] == rows["normality"] == rows["power"] == 5 and rows["log_price_model"] == 3


def test_published_marts(spark, tmp_path):
    written = marts.publish_marts(registry.raw(spark, SF_DIR), str(tmp_path), "2024-01-30", ["event_id"])
    assert {name: df.count() for name, df in written.items()} == {
        "current_prices": 15, "price_history": 397, "price_stats": 5, "price_alerts": 53,
    }
    assert "scraped_date=2024-01-05" in os.listdir(tmp_path / "price_history")

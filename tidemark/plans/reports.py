"""The two statistic reports as sets of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import descriptive as d
from tidemark.operators import inference as i
from tidemark.operators.staging import positive_price


def descriptive_report(df: DataFrame, tie_break: list[str] | None = None) -> dict[str, DataFrame]:
    rows = positive_price(df)
    return {
        "central": d.central_tendency(rows),
        "dispersion": d.dispersion(rows),
        "shape": d.shape(rows),
        "category_summary": d.category_summary(rows),
        "daily_average": d.daily_average(rows),
        "daily_volume": d.daily_volume(rows),
        "volatility": d.change_volatility(d.observed_changes(rows, tie_break)),
        "outliers": d.outlier_summary(rows),
        "full_summary": d.full_summary(rows),
        "median_pivot": d.median_pivot(rows),
    }


def inferential_report(df: DataFrame) -> dict[str, DataFrame]:
    rows = positive_price(df)
    return {
        "normality": i.shapiro(rows),
        "levene": i.levene(rows),
        "welch": i.welch_t(rows),
        "mann_whitney": i.mann_whitney(rows),
        "anova": i.anova(rows),
        "kruskal": i.kruskal(rows),
        "category_anova": i.category_anova(rows),
        "category_kruskal": i.category_kruskal(rows),
        "category_means": i.category_means(rows),
        "confidence": i.confidence_interval(rows),
        "rating_regression": i.linregress(rows, "price", "rating", "source"),
        "time_regression": i.trend(rows),
        "log_price_model": i.log_price_model(rows),
        "power": i.power_adequacy(rows),
        "effects": i.cohens_d(rows),
    }

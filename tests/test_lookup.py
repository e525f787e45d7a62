import pytest

from sparkledger.operators import asset_map, key_subset, lookup_scalar, map_values, to_period_id
from tests.conftest import rows


def test_map_values_in_place_and_unmapped(spark):
    df = spark.createDataFrame([("AAPL", 1.0), ("ZZZZ", 2.0)], "symbol string, price double")
    m = spark.createDataFrame([("AAPL", 7), ("MSFT", 8)], "sym string, id long")
    out = map_values(df, "symbol", m, key="sym", value="id")
    assert out.columns == ["symbol", "price"] and dict(out.dtypes)["symbol"] == "bigint"
    assert rows(out) == [(7, 1.0), (None, 2.0)]


def test_to_period_id_drops_unmatched(spark):
    periods = spark.createDataFrame([(100, 1, 2024, "Q1"), (101, 1, 2024, "Q2")],
                                    "id long, asset_id long, fiscal_year long, period string")
    payload = spark.createDataFrame([(1, 2024, "Q1", 5), (1, 2024, "Q3", 6)],
                                    "asset_id long, fiscal_year long, period string, revenue long")
    out = to_period_id(payload, periods)
    assert out.columns == ["revenue", "reporting_period_id"]
    assert rows(out) == [(5, 100)]


def test_asset_map_filters_and_duplicates(spark):
    assets = spark.createDataFrame(
        [(1, "AAPL", 1, True, True), (2, "AAPL", 1, True, True), (3, "SPY", 2, True, True), (4, "OLD", 1, False, True)],
        "id long, symbol string, asset_cat_id long, has_financials boolean, has_chart boolean")
    cats = spark.createDataFrame([(1, "Equity", "UNKNOWN"), (2, "Fund", "ETF")], "id long, cat string, sub_cat string")
    assert rows(asset_map(assets, cats, "has_financials")) == [("AAPL", 2)]
    assert rows(asset_map(assets, cats, "has_chart")) == [("AAPL", 2), ("OLD", 4)]
    with pytest.raises(ValueError, match="SPY"):
        asset_map(assets, cats, "has_chart", symbols=["AAPL", "SPY"])


def test_key_subset_and_lookups(spark):
    m = spark.createDataFrame([("AAPL", 1), ("MSFT", 2)], "symbol string, id long")
    assert rows(key_subset(m, ["MSFT"], "symbol")) == [("MSFT", 2)]
    assert lookup_scalar(m.filter("symbol = 'MSFT'"), "id") == 2
    with pytest.raises(LookupError):
        lookup_scalar(m.filter("symbol = 'NONE'"), "id")

"""Fixed values and target table schemas.

The constants below must equal the behaviour we reproduce; they are stated
plainly in one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the reproduced behaviour)
# ---------------------------------------------------------------------------
# Placeholder reporting period meaning "not reported yet".
SENTINEL_DATE = "4000-12-31"
SENTINEL_YEAR = 4000
SENTINEL_PERIOD = "NA"
# Earnings are eligible for a reported period up to two weeks after the
# asset's latest report.
ALIGN_GRACE = "2 weeks"
# Endpoint depth per symbol.
STATEMENT_PERIODS = 20  # 5 years x 4 quarters
EARNING_ROWS = 22  # 20 quarters + 2 estimates
PRICE_DAYS = 1825  # 5 x 365 days
CPI_YEARS = 10
# Stock screener defaults.
SCREEN_MIN_MKT_CAP = 1_000_000_000
SCREEN_LIMIT = 5000
SCREEN_COUNTRY = "US"
# Consumer-price series.
CPI_SERIES_ID = "CUUR0000SA0"
CPI_SERIES_NAME = "cpi-u"
CPI_DAY_OF_MONTH = 14
PAYLOAD_OK_STATUS = "REQUEST_SUCCEEDED"
# Category lookup used for new assets.
ASSET_CAT = "Equity"
ASSET_SUB_CAT = "UNKNOWN"

# Natural keys used to diff each stored table.
TABLE_KEYS = {
    "cpi": ["year", "month"],
    "asset": ["symbol"],
    "equity_profile": ["asset_id"],
    "reporting_period": ["asset_id", "fiscal_year", "period"],
    "income_statement": ["reporting_period_id"],
    "balance_sheet_statement": ["reporting_period_id"],
    "cash_flow_statement": ["reporting_period_id"],
    "earning": ["reporting_period_id"],
    "eod_price": ["asset_id", "end_date"],
    "earning_report": ["symbol", "date"],
}
# Storage partition of a row, a function of its natural key: the column and the
# width of a bucket (None: the year of a date).  A commit rewrites only the
# partitions its payload touches; tables not listed are one partition.
TABLE_PARTS = {
    "cpi": ("year", 1),
    "equity_profile": ("asset_id", 100_000),
    "reporting_period": ("fiscal_year", 1),
    "income_statement": ("reporting_period_id", 100_000),
    "balance_sheet_statement": ("reporting_period_id", 100_000),
    "cash_flow_statement": ("reporting_period_id", 100_000),
    "earning": ("reporting_period_id", 100_000),
    "eod_price": ("end_date", None),
    "earning_report": ("symbol", 64),
}
# Tables whose storage partition is a hash of the column, in that many buckets.
HASHED_PARTS = {"earning_report"}
# Tables whose rows carry their own surrogate ``id`` (assigned on insert).
TABLES_WITH_ID = {"cpi", "asset", "reporting_period", "eod_price"}

# ---------------------------------------------------------------------------
# Target schemas.  The stored tables' DDL lives elsewhere; these list the
# columns the pipelines prove, with Spark types.
# ---------------------------------------------------------------------------
L, D, S, B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TABLE_SCHEMAS: dict[str, T.StructType] = {
    "cpi": _schema(("id", L), ("year", L), ("month", L), ("series_id", S),
                   ("series_name", S), ("series_value", D), ("period_name", S),
                   ("ref_date", DATE)),
    "asset_cat": _schema(("id", L), ("cat", S), ("sub_cat", S)),
    "asset": _schema(("id", L), ("symbol", S), ("description", S), ("asset_cat_id", L),
                     ("has_financials", B), ("has_chart", B)),
    "equity_profile": _schema(("asset_id", L), ("company_name", S), ("currency", S),
                              ("exchange", S), ("industry", S), ("sector", S),
                              ("country", S), ("mkt_cap", L), ("price", D), ("beta", D),
                              ("exchange_short_name", S), ("vol_avg", L), ("last_div", D),
                              ("ipo_date", DATE), ("description", S)),
    "reporting_period": _schema(("id", L), ("asset_id", L), ("fiscal_year", L), ("period", S),
                                ("end_date", DATE), ("filing_date", DATE), ("accepted_date", TS)),
    "income_statement": _schema(("reporting_period_id", L), ("revenue", L),
                                ("cost_of_revenue", L), ("gross_profit", L),
                                ("operating_income", L), ("net_income", L), ("eps", D),
                                ("eps_diluted", D), ("cik", S), ("weighted_average_shs_out", L),
                                ("weighted_average_shs_out_dil", L)),
    "balance_sheet_statement": _schema(("reporting_period_id", L), ("total_assets", L),
                                       ("total_liabilities", L), ("total_equity", L)),
    "cash_flow_statement": _schema(("reporting_period_id", L), ("operating_cash_flow", L),
                                   ("capital_expenditure", L), ("free_cash_flow", L)),
    "earning": _schema(("reporting_period_id", L), ("ref_date", DATE), ("eps_actual", D),
                       ("eps_estimated", D), ("revenue_actual", L), ("revenue_estimated", L)),
    "eod_price": _schema(("id", L), ("asset_id", L), ("end_date", DATE), ("open", D),
                         ("high", D), ("low", D), ("close", D), ("volume", L)),
    # State of the earnings update: the newest fetch of every report.
    "earning_report": _schema(("symbol", S), ("date", S), ("eps_actual", D), ("eps_estimated", D),
                              ("revenue_actual", L), ("revenue_estimated", L), ("fetched_at", TS)),
}

# Nested consumer-price payload (one JSON document per request).
SERIES_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("status", S),
    T.StructField("Results", T.StructType([
        T.StructField("series", T.ArrayType(T.StructType([
            T.StructField("seriesID", S),
            T.StructField("data", T.ArrayType(T.StructType([
                T.StructField("year", S),
                T.StructField("period", S),
                T.StructField("periodName", S),
                T.StructField("value", S),
            ]))),
        ]))),
    ])),
])


# Payload rows of every endpoint, under the names of the payload.  A missing field reads
# as null, an unlisted one is not read.
_STATEMENT = [("date", S), ("symbol", S), ("reportedCurrency", S), ("cik", S), ("filingDate", S), ("acceptedDate", S),
              ("fiscalYear", S), ("period", S)]
PAYLOAD_SCHEMAS: dict[str, T.StructType] = {
    "screener": _schema(("symbol", S), ("companyName", S), ("marketCap", D), ("country", S), ("isEtf", B), ("isFund", B),
                        ("isActivelyTrading", B)),
    "search": _schema(("symbol", S), ("name", S), ("query", S), ("position", L)),
    "profile": _schema(("symbol", S), ("companyName", S), ("currency", S), ("exchange", S), ("exchangeShortName", S),
                       ("industry", S), ("sector", S), ("country", S), ("ipoDate", S), ("description", S), ("mktCap", L),
                       ("volAvg", L), ("price", D), ("beta", D), ("lastDiv", D)),
    "income_statement": _schema(*_STATEMENT, ("revenue", L), ("costOfRevenue", L), ("grossProfit", L),
                                ("operatingIncome", L), ("netIncome", L), ("eps", D), ("epsDiluted", D),
                                ("weightedAverageShsOut", L), ("weightedAverageShsOutDil", L)),
    "balance_sheet_statement": _schema(*_STATEMENT, ("totalAssets", L), ("totalLiabilities", L), ("totalEquity", L)),
    "cash_flow_statement": _schema(*_STATEMENT, ("operatingCashFlow", L), ("capitalExpenditure", L), ("freeCashFlow", L)),
    "earnings": _schema(("symbol", S), ("date", S), ("epsActual", D), ("epsEstimated", D), ("revenueActual", L),
                        ("revenueEstimated", L)),
    "historical_price": _schema(("symbol", S), ("date", S), ("open", D), ("high", D), ("low", D), ("close", D),
                                ("volume", L)),
}

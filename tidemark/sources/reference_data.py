"""Reference values: asset universe, sectors, symbol and series names.

All of these are fixed values that results must equal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scale import broadcast_if_small

# fixed values: symbol, sector, industry of the equities
SECTORS: tuple[tuple[str, str, str], ...] = (
    ("AAPL", "Technology", "Consumer Electronics"),
    ("MSFT", "Technology", "Software—Infrastructure"),
    ("GOOGL", "Communication Services", "Internet Content & Information"),
    ("AMZN", "Consumer Cyclical", "Internet Retail"),
    ("NVDA", "Technology", "Semiconductors"),
    ("META", "Communication Services", "Internet Content & Information"),
    ("TSLA", "Consumer Cyclical", "Auto Manufacturers"),
    ("LLY", "Healthcare", "Drug Manufacturers—General"),
    ("V", "Financial Services", "Credit Services"),
    ("UNH", "Healthcare", "Healthcare Plans"),
    ("JPM", "Financial Services", "Banks—Diversified"),
    ("JNJ", "Healthcare", "Drug Manufacturers—General"),
    ("WMT", "Consumer Defensive", "Discount Stores"),
    ("XOM", "Energy", "Oil & Gas Integrated"),
    ("PG", "Consumer Defensive", "Household & Personal Products"),
    ("AVGO", "Technology", "Semiconductors"),
    ("HD", "Consumer Cyclical", "Home Improvement Retail"),
    ("CVX", "Energy", "Oil & Gas Integrated"),
    ("ORCL", "Technology", "Software—Infrastructure"),
    ("MRK", "Healthcare", "Drug Manufacturers—General"),
    ("KO", "Consumer Defensive", "Beverages—Non-Alcoholic"),
    ("ABBV", "Healthcare", "Drug Manufacturers—General"),
    ("PEP", "Consumer Defensive", "Beverages—Non-Alcoholic"),
    ("COST", "Consumer Defensive", "Discount Stores"),
    ("BAC", "Financial Services", "Banks—Diversified"),
    ("ADBE", "Technology", "Software—Application"),
    ("MCD", "Consumer Cyclical", "Restaurants"),
    ("CSCO", "Technology", "Communication Equipment"),
    ("AMD", "Technology", "Semiconductors"),
    ("NFLX", "Communication Services", "Entertainment"),
    ("CRM", "Technology", "Software—Application"),
    ("TMO", "Healthcare", "Diagnostics & Research"),
    ("ABT", "Healthcare", "Medical Devices"),
    ("NKE", "Consumer Cyclical", "Footwear & Accessories"),
    ("DIS", "Communication Services", "Entertainment"),
    ("CMCSA", "Communication Services", "Entertainment"),
    ("PFE", "Healthcare", "Drug Manufacturers—General"),
    ("DHR", "Healthcare", "Diagnostics & Research"),
    ("INTU", "Technology", "Software—Application"),
    ("WFC", "Financial Services", "Banks—Diversified"),
    ("VZ", "Communication Services", "Telecom Services"),
    ("AMGN", "Healthcare", "Drug Manufacturers—Specialty & Generic"),
    ("TXN", "Technology", "Semiconductors"),
    ("PM", "Consumer Defensive", "Tobacco"),
    ("COP", "Energy", "Oil & Gas E&P"),
    ("MS", "Financial Services", "Capital Markets"),
    ("HON", "Industrials", "Conglomerates"),
    ("AMAT", "Technology", "Semiconductor Equipment"),
    ("CAT", "Industrials", "Farm & Heavy Construction Machinery"),
    ("LMT", "Industrials", "Aerospace & Defense"),
)

# fixed values: the equity universe is the list above, in that order
EQUITIES: tuple[str, ...] = tuple(symbol for symbol, _, _ in SECTORS)

# fixed values: coin ids and their traded pairs
CRYPTO_PAIRS: dict[str, str] = {
    "bitcoin": "BTC/USD",
    "ethereum": "ETH/USD",
    "binancecoin": "BNB/USD",
    "ripple": "XRP/USD",
    "cardano": "ADA/USD",
    "solana": "SOL/USD",
    "polkadot": "DOT/USD",
    "dogecoin": "DOGE/USD",
    "avalanche-2": "AVAX/USD",
    "chainlink": "LINK/USD",
}
CRYPTO_COINS: tuple[str, ...] = tuple(CRYPTO_PAIRS)

# fixed values: macro series and their names
MACRO_SERIES: dict[str, str] = {
    "FEDFUNDS": "Federal Funds Rate",
    "CPIAUCSL": "Consumer Price Index (CPI)",
    "UNRATE": "Unemployment Rate",
    "GDP": "Gross Domestic Product",
    "DGS10": "10-Year Treasury Yield",
    "DGS2": "2-Year Treasury Yield",
    "VIXCLS": "CBOE Volatility Index (VIX)",
    "M2SL": "M2 Money Supply",
    "DCOILWTICO": "WTI Crude Oil Price",
    "DEXUSEU": "USD/EUR Exchange Rate",
}

# fixed values: display names
ASSET_NAMES: dict[str, str] = {
    "AAPL": "Apple Inc.",
    "MSFT": "Microsoft Corporation",
    "GOOGL": "Alphabet Inc.",
    "AMZN": "Amazon.com Inc.",
    "META": "Meta Platforms Inc.",
    "NVDA": "NVIDIA Corporation",
    "TSLA": "Tesla Inc.",
    "BTC-USD": "Bitcoin",
    "ETH-USD": "Ethereum",
    "SOL-USD": "Solana",
    "BTC/USD": "Bitcoin",
    "ETH/USD": "Ethereum",
    "SOL/USD": "Solana",
}

# fixed values: candidate tickers of each news search
NEWS_GROUPS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apple OR Microsoft OR Google OR Amazon OR NVIDIA",
     ("AAPL", "MSFT", "GOOGL", "AMZN", "NVDA")),
    ("Meta OR Tesla OR Eli Lilly OR Visa OR UnitedHealth",
     ("META", "TSLA", "LLY", "V", "UNH")),
    ("JPMorgan OR Johnson stock OR Walmart stock OR ExxonMobil OR Procter",
     ("JPM", "JNJ", "WMT", "XOM", "PG")),
    ("Broadcom OR Home Depot OR Chevron OR Oracle OR Merck",
     ("AVGO", "HD", "CVX", "ORCL", "MRK")),
    ("Coca-Cola OR AbbVie OR Pepsi OR Costco OR Bank of America",
     ("KO", "ABBV", "PEP", "COST", "BAC")),
    ("Adobe OR McDonald OR Cisco OR AMD OR Netflix stock",
     ("ADBE", "MCD", "CSCO", "AMD", "NFLX")),
    ("Salesforce OR Thermo Fisher OR Abbott OR Nike OR Disney",
     ("CRM", "TMO", "ABT", "NKE", "DIS")),
    ("Bitcoin OR Ethereum OR Solana OR crypto market",
     ("BTC", "ETH", "SOL", "CRYPTO")),
)


def sectors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SECTORS), "symbol string, sector string, industry string")


def pairs(spark: SparkSession, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")


def asset_names(spark: SparkSession) -> DataFrame:
    return pairs(spark, ASSET_NAMES, "symbol", "asset_name")


def universe(spark: SparkSession) -> DataFrame:
    rows = [(s, "equity") for s in EQUITIES] + [(CRYPTO_PAIRS[c], "crypto") for c in CRYPTO_COINS]
    return spark.createDataFrame(rows, "symbol string, asset_class string")


def in_universe(df: DataFrame, symbols: DataFrame | Sequence[str]) -> DataFrame:
    """Rows whose symbol belongs to the universe."""
    if isinstance(symbols, DataFrame):
        return df.join(broadcast_if_small(symbols.select("symbol")), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(list(symbols)))

"""Small static dimensions: exchanges, stages, contract months, categories.

Each is fixed reference data with a handful of rows, so joining any of them
with ``F.broadcast`` is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Exchange metadata.
EXCHANGE_COLUMNS = "exchange full_name timezone currency trading_hours market_code country region".split()
EXCHANGES = [
    ("LSE", "London Stock Exchange", "Europe/London", "GBP", "08:00-16:30", "XLON", "GB", "Europe"),
    ("CME", "Chicago Mercantile Exchange", "America/Chicago", "USD", "17:00-16:15", "XCME", "US", "Americas"),
    ("NYQ", "New York Stock Exchange", "America/New_York", "USD", "09:30-16:00", "XNYS", "US", "Americas"),
    ("NSQ", "NASDAQ Stock Market", "America/New_York", "USD", "09:30-16:00", "XNAS", "US", "Americas"),
]

# Processing stages each exchange publishes.
EXCHANGE_STAGES = {
    "LSE": ["extraction", "ingestion", "normalization", "transformation"],
    "CME": ["ingestion"],
    "NYQ": ["ingestion"],
}
LOADED_EXCHANGES = list(EXCHANGE_STAGES)


def exchanges_of(df: DataFrame) -> list[str]:
    """Exchanges that occur in a table, sorted: one pass over one column, a row per exchange comes back."""
    return sorted(r[0] for r in df.select("exchange").where("exchange IS NOT NULL").distinct().collect())


# Futures month codes, January first.
MONTH_CODES = "FGHJKMNQUVXZ"
QUARTERLY_CODES = "HMUZ"
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Product names users type, and the contract root they mean.
PRODUCT_ROOTS = {
    "bitcoin": ("BTC", "standard"),
    "standard bitcoin": ("BTC", "standard"),
    "btc": ("BTC", "standard"),
    "micro bitcoin": ("MBT", "micro"),
    "mbt": ("MBT", "micro"),
}
BITCOIN_ROOTS = ["BTC", "MBT"]
ETHEREUM_ROOTS = ["ETE", "HTE", "MTE"]

# Symbol categories.
CATEGORIES = {
    "bitcoin_futures": {
        "description": "Bitcoin futures contracts",
        "symbols": ["MBTF25", "BTCF25", "MBTG25", "BTCG25"],
        "exchanges": ["CME"],
    },
    "ethereum_futures": {
        "description": "Ethereum futures contracts",
        "symbols": ["HTEF25", "ETEF25", "MTEF25", "ETEG25"],
        "exchanges": ["CME"],
    },
    "crypto_futures": {
        "description": "All cryptocurrency futures contracts",
        "symbols": ["MBTF25", "BTCF25", "MBTG25", "BTCG25", "HTEF25", "ETEF25", "MTEF25", "ETEG25"],
        "exchanges": ["CME"],
    },
    "micro_bitcoin": {
        "description": "Micro Bitcoin futures (smaller contract sizes)",
        "symbols": ["MBTF25", "MBTG25"],
        "exchanges": ["CME"],
    },
    "standard_bitcoin": {
        "description": "Standard Bitcoin futures (full contract sizes)",
        "symbols": ["BTCF25", "BTCG25"],
        "exchanges": ["CME"],
    },
    "micro_ethereum": {
        "description": "Micro Ethereum futures (smaller contract sizes)",
        "symbols": ["HTEF25", "MTEF25"],
        "exchanges": ["CME"],
    },
    "standard_ethereum": {
        "description": "Standard Ethereum futures (full contract sizes)",
        "symbols": ["ETEF25", "ETEG25"],
        "exchanges": ["CME"],
    },
}


def exchange_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXCHANGES, ", ".join(f"{c} string" for c in EXCHANGE_COLUMNS))


def stage_dim(spark: SparkSession) -> DataFrame:
    """One row per (exchange, stage) that exists."""
    rows = [(ex, stage) for ex, stages in EXCHANGE_STAGES.items() for stage in stages]
    return spark.createDataFrame(rows, "exchange string, processing_stage string")


def category_dim(spark: SparkSession) -> DataFrame:
    """One row per (category, exchange, symbol); a symbol may repeat."""
    rows = [
        (name, c["description"], c["symbols"], c["exchanges"])
        for name, c in CATEGORIES.items()
    ]
    schema = (
        "category string, description string, symbols array<string>, exchanges array<string>"
    )
    wide = spark.createDataFrame(rows, schema)
    return (
        wide.withColumn("exchange", F.explode("exchanges"))
        .withColumn("symbol", F.explode("symbols"))
        .select("category", "description", "exchange", "symbol")
    )


def category_symbols(category: str, exchange: str | None = None) -> list[str]:
    """Symbols of a category; unknown names and unsupported exchanges raise."""
    if category not in CATEGORIES:
        raise ValueError(f"unknown category {category!r}; known: {sorted(CATEGORIES)}")
    entry = CATEGORIES[category]
    if exchange is not None and exchange.upper() not in entry["exchanges"]:
        raise ValueError(f"category {category!r} trades on {entry['exchanges']}, not {exchange!r}")
    return list(entry["symbols"])

"""Values that must equal the published behaviour for results to match.

Everything below is a fixed value: limits, labels, word lists and formats.
Operators take them as default arguments, so a caller can replace any of them.
"""

from __future__ import annotations

# --- fixed values: bars ---------------------------------------------------

# Bar widths, in seconds.
INTERVAL_SECONDS = {
    "1m": 60,
    "3m": 180,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "2h": 7200,
    "4h": 14400,
    "6h": 21600,
    "12h": 43200,
    "1d": 86400,
}

# Open times above this are microseconds; the valid range is in milliseconds.
MICROSECOND_FLOOR = 10_000_000_000_000
MIN_OPEN_TIME_MS = 1483228800000
MAX_OPEN_TIME_MS = 4102444800000

LOCAL_ZONE = "Europe/Berlin"

TICKER_EVENT_TYPE = "ticker"
KLINE_EVENT_TYPE = "kline"
FEED_SOURCE = "binance"
MESSAGE_KEY_FALLBACK = "event"

# --- fixed values: macro events -------------------------------------------

MACRO_SENTIMENT_SOURCE = "macro_sentiment"
DECISION_CLASSES = ("hike", "cut", "hold")

# --- fixed values: posts --------------------------------------------------

CRYPTO_KEYWORDS = [
    "bitcoin", "btc", "crypto", "cryptocurrency", "blockchain", "exchange", "etf",
    "token", "tokens", "mining", "miners", "halving", "stablecoin", "stablecoins",
]
MACRO_KEYWORDS = [
    "fed", "federal reserve", "interest rate", "rates", "cpi", "inflation",
    "unemployment", "jobs", "gdp", "recession", "treasury", "bond", "bonds",
    "tariff", "tariffs", "trade", "sanctions", "deficit", "debt", "dollar",
]

POST_EVENT_TYPE = "TRUMP_TRUTH_ECON"
POST_PLATFORM = "truthsocial"
POST_USER_HANDLE = "realDonaldTrump"
POST_LANGUAGE = "en"
POST_PLACEHOLDERS = ("[Video]", "[Image]")
POSTS_SINCE = "2025-01-20T00:00:00Z"

MIN_WORDS = 4
MIN_LETTERS = 20

CHUNK_TOKENS = 512
CHUNK_OVERLAP = 64

NEGATIVE_AT_MOST = -0.3
POSITIVE_AT_LEAST = 0.3

# --- fixed values: statistics ---------------------------------------------

CI_Z = 1.96
TAIL_THRESHOLD = 0.10
MIN_FORECAST_HISTORY = 10
MIN_KS_OBSERVATIONS = 10
MIN_EXPECTED_COUNT = 5.0
CHI_SQUARE_BINS = 40
HISTOGRAM_BINS = 80
HISTORY_TAIL = 250
SIGNIFICANCE = 0.05
DRAWDOWN = -0.30
VAR_LEVEL = 0.05
SCENARIO_DAYS = 30
SCENARIO_PATHS = 10_000
SCENARIO_SCALE_CUT = 0.20
SCENARIO_SEED = 42

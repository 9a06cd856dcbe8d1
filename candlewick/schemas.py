"""Column layouts of every table the engine reads or writes, and its fixed values."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, kind, True, {"comment": comment} if comment else None)


BAR = T.StructType([
    _field("Date", T.DateType(), "trading day"),
    _field("Ticker", T.StringType(), "symbol, without exchange suffix or index prefix"),
    _field("Nama_Saham", T.StringType(), "company name"),
    _field("Open", T.DoubleType(), "opening price"),
    _field("High", T.DoubleType(), "highest price"),
    _field("Low", T.DoubleType(), "lowest price"),
    _field("Close", T.DoubleType(), "closing price"),
    _field("Volume", T.LongType(), "traded volume"),
    _field("Daily_Change", T.DoubleType(), "Close - Open"),
    _field("Daily_Change_Pct", T.DoubleType(), "Daily_Change in percent of Open"),
])

# Bars before anything is typed: input of the type and date checks.
RAW_BAR = T.StructType([_field(f.name, T.StringType()) for f in BAR.fields])

TICK = T.StructType([
    _field("timestamp", T.StringType(), "ISO-8601 text"),
    _field("ticker", T.StringType()),
    _field("open", T.DoubleType()),
    _field("high", T.DoubleType()),
    _field("low", T.DoubleType()),
    _field("close", T.DoubleType()),
    _field("volume", T.LongType()),
])

TRADER = T.StructType([
    _field("user_id", T.LongType()),
    _field("nama_lengkap", T.StringType(), "full name"),
    _field("email", T.StringType()),
    _field("no_telepon", T.StringType(), "phone"),
    _field("alamat", T.StringType(), "postal address"),
    _field("saldo_investasi", T.LongType(), "invested amount"),
    _field("risk_profile", T.StringType()),
])

AUDIT = T.StructType([
    _field("timestamp", T.TimestampType()),
    _field("action", T.StringType()),
    _field("status", T.StringType()),
    _field("user", T.StringType()),
    _field("details", T.MapType(T.StringType(), T.StringType())),
])

RUN = T.StructType([
    _field("run_id", T.StringType()),
    _field("timestamp", T.TimestampType()),
    _field("pipeline", T.StringType()),
    _field("status", T.StringType()),
    _field("params", T.MapType(T.StringType(), T.StringType())),
    _field("metrics", T.MapType(T.StringType(), T.DoubleType())),
    _field("artifact", T.StringType(), "path of the saved model"),
])

METRIC = T.StructType([
    _field("measurement", T.StringType()),
    _field("tags", T.MapType(T.StringType(), T.StringType())),
    _field("field", T.StringType()),
    _field("value", T.DoubleType()),
    _field("ts", T.TimestampType()),
])

FORECAST = T.StructType([
    _field("prediction_date", T.TimestampType()),
    _field("latest_close", T.DoubleType()),
    _field("predictions", T.MapType(T.StringType(), T.DoubleType()), "value by yyyy-MM-dd"),
    _field("days_to_target", T.IntegerType()),
    _field("model", T.StringType()),
    _field("seq_len", T.IntegerType()),
])

# Company name by symbol.
SYMBOL_NAMES = {
    "JKSE": "IHSG",
    "BBCA": "Bank Central Asia",
    "BBRI": "Bank Rakyat Indonesia",
    "BMRI": "Bank Mandiri",
    "TLKM": "Telkom Indonesia",
    "ASII": "Astra International",
}

# Columns that must hold numbers in a raw bar file.
NUMERIC_BAR_COLUMNS = ("Open", "High", "Low", "Close", "Volume", "Daily_Change", "Daily_Change_Pct")

# Model inputs of the clustering job, and of its variant on the ETL features.
CLUSTER_FEATURES = (
    "Returns_1d", "Returns_5d", "Volatility_5d", "Volume_Change", "Price_Range_Pct",
    "Close_Open_Ratio", "SMA_Cross", "RSI", "Volume",
)
ETL_CLUSTER_FEATURES = (
    "Close", "Open", "High", "Low", "Volume", "SMA_7", "SMA_30", "Volatility", "Price_Range",
)

# Lower bound and label of each amount band.
AMOUNT_BANDS = ((100_000_000, "> 100 juta"), (50_000_000, "50-100 juta"))
AMOUNT_BELOW = "< 50 juta"

# Lowest cluster number of each risk level.
RISK_BANDS = ((3, "high"), (2, "medium"))
RISK_BELOW = "low"

# Status colours by quality score and by days left to the target.
SCORE_BANDS = ((95, "green"), (80, "yellow"))
SCORE_BELOW = "red"
DAYS_BANDS = ((5, "yellow"), (2, "green"))
DAYS_BELOW = "red"

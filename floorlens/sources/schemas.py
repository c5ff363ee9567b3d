"""Declared schemas.  The wide mart schema is generated from the window list."""

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW = _struct(
    ("id", _S, False),
    ("date", T.DateType(), False),
    ("hole", _S, False),
    ("machine", _S, False),
    ("machine_number", _L, False),
    ("diff", _L, True),
    ("game", _L, True),
    ("big", _L, True),
    ("reg", _L, True),
    ("combined_rate", _S, True),
    ("max_my", _L, True),
    ("max_mdia", _L, True),
    ("win", _L, True),
    ("source", _S, False),
    ("timestamp", T.TimestampType(), False),
)

CORRECTION = T.StructType(
    RAW.fields
    + [
        T.StructField("failure_id", _S),
        T.StructField("corrected_at", T.TimestampType()),
        T.StructField("notes", _S),
    ]
)

FAILURE = _struct(
    ("id", _S, False),
    ("date", T.DateType(), False),
    ("hole", _S, False),
    ("hole_code", _S, True),
    ("machine", _S, True),
    ("machine_url", _S, True),
    ("error_type", _S, True),
    ("error_message", _S, True),
    ("failed_at", T.TimestampType(), True),
    ("status", _S, False),
    ("resolved_at", T.TimestampType(), True),
    ("resolved_method", _S, True),
)

EVENT = _struct(
    ("id", _S, False),
    ("date", T.DateType(), False),
    ("hole", _S, False),
    ("event", _S, False),
    ("description", _S, True),
    ("created_at", T.TimestampType(), True),
    ("updated_at", T.TimestampType(), True),
)

EVENT_TYPE = _struct(
    ("id", _S, False), ("name", _S, False), ("sort_order", _L, True), ("created_at", T.TimestampType(), True)
)

VENUE = _struct(
    ("name", _S, False),
    ("code", _S, True),
    ("priority", _S, False),
    ("region", _S, True),
    ("active", T.BooleanType(), False),
    ("late_update", T.BooleanType(), False),
)

REMAP = _struct(
    ("hole", _S, False), ("valid_to", T.DateType(), False), ("old_number", _L, False), ("new_number", _L, False)
)

HOLIDAY = _struct(("holiday_date", T.DateType(), False))

CELL = T.StructType(
    [
        T.StructField("row", T.IntegerType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("type", _S),
        T.StructField("number", _L),
        T.StructField("subtype", _S),
        T.StructField("label", _S),
        T.StructField("text", _S),
    ]
)

LAYOUT = T.StructType(
    [
        T.StructField("version", _S),
        T.StructField("hole", _S),
        T.StructField("floor", _S),
        T.StructField("updated", _S),
        T.StructField("description", _S),
        T.StructField(
            "grid",
            T.StructType([T.StructField("rows", T.IntegerType()), T.StructField("cols", T.IntegerType())]),
        ),
        T.StructField("walls", T.ArrayType(_S)),
        T.StructField("cells", T.ArrayType(CELL)),
    ]
)

# --- mart windows ---
TRAILING_DAYS = [2, 3, 4, 5, 6, 7, 14, 28]
WINDOW_PREFIXES = ["d1"] + [f"d{n}" for n in TRAILING_DAYS] + ["mtd", "all"]


def window_columns(prefix: str) -> list[tuple[str, T.DataType]]:
    base = prefix.removeprefix("prev_")
    cols = [(f"{prefix}_diff", _L), (f"{prefix}_game", _L)]
    if base != "d1":
        cols.append((f"{prefix}_win_rate", _D))
    cols.append((f"{prefix}_payout_rate", _D))
    if base == "all":
        cols.append((f"{prefix}_days", _L))
    return cols


MART_KEYS = ["target_date", "hole", "machine_number"]
_MART_HEAD = [
    ("target_date", T.DateType()),
    ("hole", _S),
    ("machine_number", _L),
    ("machine", _S),
    ("start_date", T.DateType()),
    ("end_date", T.DateType()),
    ("target_year", _L),
    ("target_month", _L),
    ("target_day", _L),
    ("target_day_last_digit", _L),
    ("is_month_day_repdigit", T.BooleanType()),
    ("is_day_repdigit", T.BooleanType()),
    ("day_of_week_jp", _S),
    ("day_type", _S),
]
MART = T.StructType(
    [
        T.StructField(n, t, n not in MART_KEYS)
        for n, t in _MART_HEAD
        + [c for p in WINDOW_PREFIXES for c in window_columns(p)]
        + [c for p in WINDOW_PREFIXES for c in window_columns(f"prev_{p}")]
    ]
)

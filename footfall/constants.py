"""Fixed values that must equal the original pipeline's for equal results.

They are stated here once, in the order the original uses them.
"""

# --- fixed values -----------------------------------------------------------
# lookback windows (days) of the 7-statistic visitor features
LOOKBACKS = [7, 14, 28, 56, 600]
# windows (days) of the day-over-day difference statistics
DIFF_WINDOWS = [58, 600]
# lookback (days) of decay, day-of-week, holiday and first/last features
LONG_WINDOW = 600
# decay weights, store and genre level
DECAY_WEIGHTS = [0.85, 0.9, 0.95, 0.985, 0.97, 0.98, 0.99, 0.999, 0.9999]
# decay weights, store x day-of-week and genre x day-of-week level
DOW_DECAY_WEIGHTS = [0.9, 0.95, 0.97, 0.98, 0.985, 0.99, 0.999, 0.9999]
# calendar offsets (days) joined onto label dates as ahead_* columns
CALENDAR_OFFSETS = [14, 7, 3, 2, 1, -1, -7, -14]
# smoothing constant of the mean ratios
RATIO_EPS = 0.01
# ratio features: (name, numerator, denominator)
RATIOS = [
    ("store_mean_7_14_rate", "store_mean7", "store_mean14"),
    ("store_mean_7_28_rate", "store_mean7", "store_mean28"),
    ("store_mean_7_600_rate", "store_mean7", "store_mean600"),
    ("store_mean_14_28_rate", "store_mean14", "store_mean28"),
    ("store_mean_28_56_rate", "store_mean28", "store_mean56"),
    ("store_mean_56_600_rate", "store_mean56", "store_mean600"),
    ("genre_mean_7_14_rate", "genre_mean7", "genre_mean14"),
    ("genre_mean_7_28_rate", "genre_mean7", "genre_mean28"),
    ("genre_mean_7_600_rate", "genre_mean7", "genre_mean600"),
    ("genre_mean_14_28_rate", "genre_mean14", "genre_mean28"),
    ("genre_mean_28_56_rate", "genre_mean28", "genre_mean56"),
    ("sgenre_mean_56_600_rate", "genre_mean56", "genre_mean600"),
]
# weather measures and the fill value of unmatched weather rows
WEATHER_MEASURES = [
    "precipitation", "low_temperature", "avg_temperature", "high_temperature",
    "hours_sunlight", "solar_radiation", "avg_wind_speed", "avg_vapor_pressure",
    "avg_local_pressure", "avg_humidity", "avg_sea_pressure", "cloud_cover",
]
WEATHER_FILL = -1.0
# training anchors: 58 weekly anchors back from the start (horizon 39),
# 5 forward weekly anchors (horizon 42 - 7 i), test anchor at +42 (horizon 39)
TRAIN_BACK_WEEKS = 58
TRAIN_HORIZON = 39
FORWARD_WEEKS = 5
FORWARD_HORIZON_BASE = 42
TEST_OFFSET_DAYS = 42
# split / fold seed-free settings: hold-out share and fold count
HOLDOUT_TEST_BUCKETS = 5      # 1 of 5 md5 buckets -> 20 % test
N_FOLDS = 3
# cost matrix of the threshold sweep: false positive 1, false negative 10
COST_FP = 1.0
COST_FN = 10.0
N_THRESHOLDS = 21
# -----------------------------------------------------------------------------


def fmt_weight(w: float) -> str:
    """Weight as it appears in feature names (Python's shortest repr)."""
    return repr(float(w))

"""Fixed values of the hourly weather data set: columns, rules and defaults."""

# Hourly measurement columns.
WEATHER_COLUMNS = [
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "pressure_msl",
    "surface_pressure",
    "precipitation",
    "rain",
    "snowfall",
    "cloud_cover",
    "wind_speed_10m",
    "wind_direction_10m",
    "wind_gusts_10m",
]
WEATHER_TARGET = "temperature_2m"

# Columns a weather table must have, and accepted (low, high) ranges.
WEATHER_REQUIRED = ["temperature_2m", "relative_humidity_2m", "pressure_msl", "wind_speed_10m"]
WEATHER_RANGES = {
    "temperature_2m": (-60.0, 60.0),
    "relative_humidity_2m": (0.0, 100.0),
    "pressure_msl": (870.0, 1084.0),
    "wind_speed_10m": (0.0, 200.0),
    "precipitation": (0.0, 500.0),
}
MAX_NULL_FRACTION = 0.1

# Fixed values: (low, high) limits of one scoring request; None is unlimited.
REQUEST_LIMITS = {
    "temperature_2m": (None, None),
    "relative_humidity_2m": (0.0, 100.0),
    "dew_point_2m": (None, None),
    "apparent_temperature": (None, None),
    "pressure_msl": (870.0, 1084.0),
    "surface_pressure": (None, None),
    "precipitation": (0.0, None),
    "rain": (0.0, None),
    "snowfall": (0.0, None),
    "cloud_cover": (0.0, 100.0),
    "wind_speed_10m": (0.0, None),
    "wind_direction_10m": (0.0, 360.0),
    "wind_gusts_10m": (0.0, None),
    "hour": (0.0, 23.0),
}
REQUEST_DEFAULTS = {"hour": 12}

# Feature defaults.
LAGS = (1, 2, 3, 6, 12, 24)
ROLLING_WINDOWS = (3, 6, 12, 24)

# Drift defaults.
DRIFT_ALPHA = 0.05
DRIFT_FEATURES = ["temperature_2m", "relative_humidity_2m", "pressure_msl", "wind_speed_10m"]
DRIFT_MIN_ROWS = 10

# Training defaults. A depth of None is no limit.
TEST_SIZE = 0.2
CV_FOLDS = 5
SEED = 42
PARAM_GRID = {
    "numTrees": [50, 100, 200],
    "maxDepth": [10, 20, 30, None],
    "minRowsToSplit": [2, 5, 10],
    "minInstancesPerNode": [1, 2, 4],
}

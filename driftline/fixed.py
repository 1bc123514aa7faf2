"""Names, lists, thresholds and texts that must equal the
original pipeline's for results to line up. Kept together, in their natural
order, as plain data. Nothing here is logic.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — source payload fields and their canonical column names
# ---------------------------------------------------------------------------
POLLUTANT_FIELDS = {
    "pm10": "pm10",
    "pm2_5": "pm2_5",
    "carbon_monoxide": "co",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
    "us_aqi": "aqi_us",
}
WEATHER_FIELDS = {
    "temperature_2m": "temp_C",
    "relative_humidity_2m": "humidity_%",
    "wind_speed_10m": "windspeed_kph",
    "precipitation": "precip_mm",
}
PAYLOAD_TIME_FIELD = "time"
TIME_COL = "datetime"

# FIXED VALUES — raw hourly table (12 columns)
RAW_COLUMNS = [
    "datetime", "pm10", "pm2_5", "co", "no2", "so2", "o3", "aqi_us",
    "temp_C", "humidity_%", "windspeed_kph", "precip_mm",
]

# FIXED VALUES — feature engineering lists
LOG_COLUMNS = ["co", "pm2_5", "pm10", "precip_mm", "so2", "no2", "windspeed_kph"]
SCALE_COLUMNS = [
    "temp_C", "humidity_%", "log_windspeed_kph", "log_pm2_5", "log_pm10",
    "log_precip_mm", "log_co", "log_no2", "log_so2", "o3",
]
LAG_SOURCES = ["aqi_us", "scaled_log_pm10", "scaled_log_pm2_5"]
LAGS = [1, 12, 24]
INTERACTION_PAIRS = [
    ("log_pm2_5", "scaled_log_windspeed_kph"),
    ("scaled_temp_C", "scaled_o3"),
    ("scaled_temp_C", "scaled_log_windspeed_kph"),
]
CYCLE_HOURS = 24
WEEKEND_DAYS = [5, 6]  # Monday = 0

# FIXED VALUES — the 18 selected columns, in order
SELECTED_COLUMNS = [
    "datetime",
    "aqi_us_lag1", "aqi_us_lag12", "aqi_us_lag24",
    "scaled_log_pm2_5_lag1", "scaled_log_pm2_5_lag12", "scaled_log_pm2_5_lag24",
    "scaled_log_pm10_lag1", "scaled_log_pm10_lag12", "scaled_log_pm10_lag24",
    "scaled_humidity_%", "scaled_temp_C_scaled_log_windspeed_kph", "scaled_log_so2",
    "day_of_week", "scaled_temp_C", "scaled_temp_C_scaled_o3", "scaled_log_no2",
    "aqi_us",
]

# FIXED VALUES — time formats
FMT_ISO = "yyyy-MM-dd HH:mm:ss"
FMT_PAYLOAD = "yyyy-MM-dd'T'HH:mm"
FMT_DAY_FIRST = "dd/MM/yyyy HH:mm"
FMT_MONTH_FIRST = "MM/dd/yyyy HH:mm"

# own choice: shapes that mixed parsing accepts, day-first before month-first; d, M and H
# take one or two digits
MIXED_FORMATS = [FMT_ISO, "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", FMT_PAYLOAD, "yyyy-MM-dd",
                 "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy",
                 "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy"]

# ---------------------------------------------------------------------------
# FIXED VALUES — drift monitoring
# ---------------------------------------------------------------------------
DRIFT_THRESHOLD = 0.15
KS_THRESHOLD = 0.2
RECENT_DAYS = 7
BASELINE_DAYS = 90
DRIFT_REGISTRY = {
    "raw": ["temp_C", "humidity_%", "windspeed_kph", "precip_mm",
            "pm10", "pm2_5", "co", "no2", "so2", "o3"],
    "logged": ["log_co", "log_pm2_5", "log_pm10", "log_precip_mm",
               "log_so2", "log_windspeed_kph", "log_no2", "log_o3"],
    "scaled": ["scaled_temp_C", "scaled_humidity_%", "scaled_log_windspeed_kph",
               "scaled_log_pm2_5", "scaled_log_pm10", "scaled_log_precip_mm",
               "scaled_log_co", "scaled_log_no2", "scaled_log_so2", "scaled_o3"],
    "lags": ["aqi_us_lag1", "aqi_us_lag12", "aqi_us_lag24",
             "scaled_log_pm2_5_lag1", "scaled_log_pm2_5_lag12", "scaled_log_pm2_5_lag24",
             "scaled_log_pm10_lag1", "scaled_log_pm10_lag12", "scaled_log_pm10_lag24"],
    "time_encoding": ["hour_sin", "hour_cos", "hour", "day_of_week", "is_weekend"],
    "interactions": ["log_pm2_5_scaled_log_windspeed_kph", "scaled_temp_C_scaled_o3",
                     "scaled_temp_C_scaled_log_windspeed_kph"],
}
DRIFT_FEATURES = [f for group in DRIFT_REGISTRY.values() for f in group]
NO_DRIFT_TEXT = "No significant drift detected."
SUMMARY_LINE_FORMAT = ("- Feature: %s, Drift Type: %s, Mean Shift: %.3f, "
                       "Variance Shift: %.3f, KS Statistic: %.3f")

# ---------------------------------------------------------------------------
# FIXED VALUES — feature-source discovery
# ---------------------------------------------------------------------------
MAX_ATTEMPTS = 3
SIMILARITY_THRESHOLD = 0.7
ALIAS_SCORE = 0.8
EXACT_SCORE = 1.0
FUZZY_CAP = 0.7
TOP_N_SCORES = 5
NAME_SUFFIXES = ["index", "data", "measurements"]

# canonical name -> aliases
ALIASES = {
    "sea_surface_temperature": ["sst", "ocean_temp", "water_temp", "surface_temp"],
    "air_temperature": ["temp", "temp_C", "temperature", "air_temp"],
    "relative_humidity_at_10m": ["humidity_%", "RH", "rel_humidity", "humid", "rh_percent"],
    "specific_humidity": ["q", "spec_humid", "moisture_content"],
    "wind_direction": ["wind_dir", "wd", "wind_bearing", "wind_deg"],
    "wind_speed": ["ws", "wind_vel", "wind_m_s", "wind_velocity"],
    "atmospheric_pressure": ["pressure", "atm_press", "bp", "barometric_pressure"],
    "sea_level_pressure": ["slp", "mslp", "pressure_sea_level"],
    "traffic_volume_index": ["traffic_count", "vehicle_density", "traffic_flow", "cars_per_hour"],
    "industrial_emissions_index": ["industry_emissions", "factory_pollution", "industrial_activity"],
    "construction_activity_index": ["construction_dust", "building_activity", "development_index"],
    "particulate_matter": ["pm25", "pm10", "pm_2_5", "pm_10", "particles"],
    "nitrogen_dioxide": ["no2", "nox", "nitrogen_oxide"],
    "sulfur_dioxide": ["so2", "sulfur_oxide"],
    "ozone": ["o3", "ground_ozone"],
}

# probe outcomes and their reason texts
REASON_NO_CANDIDATE = "No candidate API to validate"
REASON_BAD_URL = "Invalid URL format"
REASON_401 = "API requires authentication (valid but needs API key)"
REASON_403 = "API exists but access forbidden (may need API key or different endpoint)"
REASON_NOT_FOUND = "API endpoint not found (status: %d)"
REASON_UNEXPECTED = "API returned unexpected status: %d"
REASON_TIMEOUT = "API timeout - server not responding within 15 seconds"
REASON_CONNECTION = "API connection failed - server unreachable"
REASON_REQUEST = "API request failed: %s"
REASON_OTHER = "Validation error: %s"
REASON_EXISTS = "Feature already exists in dataset"
REASON_MISSING = "Feature not found in existing columns"
VALID_STATUSES = [200, 401, 403]
NOT_FOUND_STATUSES = [404, 410]
URL_PREFIXES = ["http://", "https://"]

# dispositions
STATUS_EXISTS = "already_exists"
STATUS_MISSING = "missing"
STATUS_ERROR = "error"
FINAL_FOUND = "found"
FINAL_NOT_FOUND = "not_found"
CATEGORY_EXISTING = "features_already_existing"
CATEGORY_NEW = "new_apis_discovered"
CATEGORY_NOT_FOUND = "features_not_found"

#: Fields of one detailed mapping of the discovery report, in order.
MAPPING_FIELDS = [
    "original_feature", "normalization_status", "mapped_to", "similarity_scores", "normalization_confidence",
    "search_keywords", "api_found", "api_details", "confidence_score", "reason", "suggested_alternatives",
    "search_attempts", "final_status",
]

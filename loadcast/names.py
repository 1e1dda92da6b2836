"""Column names, source vocabularies and status codes."""

from __future__ import annotations

# The nine energy columns, in file order.
ENERGY_COLUMNS = [
    "branch_code",
    "direction_code",
    "group_name",
    "client",
    "direction_text",
    "trade_date",
    "kind",
    "trade_hour",
    "actual",
]

# The same nine columns as named in source files that carry proper headers.
SOURCE_ENERGY_COLUMNS = [
    "oddzial_code",
    "kierunek_code",
    "grupa",
    "klient_nazwa",
    "kierunek_energii",
    "doba_handlowa",
    "rodzaj",
    "godzina_handlowa",
    "wartosc_rzeczywista",
]

WEATHER_FEATURES = [
    "temperature",
    "wind_speed",
    "wind_dir",
    "cloud",
    "precip",
    "visibility",
    "rad_total",
    "rad_direct",
    "albedo",
    "snow",
]

# Accepted source headers per column, compared after token normalisation (case, accents and
# punctuation do not matter). The first alias found wins.
WEATHER_ALIASES = {
    "exec_id": ["execId", "exec_id"],
    "issue_local": ["czasDanychZrodlaCET", "weather_issue_time", "issue_local"],
    "issue_utc": ["czasDanychZrodlaUTC", "weather_issue_time_utc", "issue_utc"],
    "w_valid_local": ["dataGodzinaCET", "weather_valid_time", "valid_local", "w_valid_local"],
    "w_valid_utc": ["dataGodzinaTUTC", "dataGodzinaUTC", "weather_valid_time_utc", "valid_utc", "w_valid_utc"],
    "w_trade_date": ["dataCET", "weather_trade_date", "w_trade_date"],
    "w_trade_hour": ["godzinaHandlowa25", "weather_trade_hour", "w_trade_hour"],
    "point": ["punkt", "miasto", "lokalizacja", "point"],
    "temperature": ["temperatura", "temperature"],
    "wind_speed": ["predkoscWiatru", "wind_speed"],
    "wind_dir": ["kierunekWiatru", "wind_dir"],
    "cloud": ["zachmurzenie", "cloud"],
    "precip": ["intensywnoscOpadowKonwekcyjnych", "opad_konwekcyjny", "precip"],
    "visibility": ["widocznosc", "visibility"],
    "rad_total": ["calkowitePromieniowanieSloneczneGodzinowe", "promieniowanie_calkowite", "rad_total"],
    "rad_direct": ["bezposredniePromieniowanieSloneczneGodzinowe", "promieniowanie_bezposrednie", "rad_direct"],
    "albedo": ["albedoPrognozowane", "albedo"],
    "snow": ["warstwaSniegu", "snow"],
}

# Mapping file headers.
MAPPING_ALIASES = {
    "branch_code": ["oddzial_code", "branch_code"],
    "point": ["punkt", "point"],
    "status": ["status"],
    "note": ["uwaga", "note"],
}

# Tokens that identify the direction text.
IMPORT_TOKEN = "pobran"
EXPORT_TOKEN = "oddani"

# Weather points of the warehouse extract.
WEATHER_POINTS = ["Białystok", "Rzeszów", "Zamość", "Skarżysko-Kamienna", "Lublin", "Łódź"]

IMPORT, EXPORT = "IMPORT", "EXPORT"
DIRECTIONS = [IMPORT, EXPORT]

SRC_TEXT, SRC_SIGN, SRC_NONE = "TEXT", "SIGN", "NONE"

W_MATCHED = "MATCHED"
W_MISSING = "MISSING_IN_RANGE"
W_BEFORE = "BEFORE_START"
W_NO_TIME = "NO_TIME_KEY"
W_NO_MAP = "NO_MAPPING"

P_WARMUP = "WARMUP"
P_GAP = "HISTORICAL_GAP"
P_AWAITING = "AWAITING_FINAL"
P_NO_UTC = "NO_UTC"
P_NO_DIRECTION = "NO_DIRECTION"
P_OOF = "OOF"
P_FUTURE = "FUTURE"

S_HYBRID = "HYBRID"
S_BASELINE = "BASELINE_FALLBACK"
S_HYBRID_FINAL = "HYBRID_FINAL"
S_BASELINE_FINAL = "BASELINE_FALLBACK_FINAL"

R_FEW_CALIBRATION = "TOO_FEW_CALIBRATION"
R_PERFECT = "BASELINE_PERFECT_OR_INVALID"
R_NO_GAIN = "NO_CONFIRMED_GAIN"
R_CHOSEN = "HYBRID_CHOSEN"
R_FEW_FIT = "TOO_FEW_FIT_ROWS"
R_NO_CALIBRATION = "NO_CALIBRATION_WINDOW"
R_NO_OOF = "NO_OOF_FOR_FINAL"
R_FEW_FINAL = "TOO_FEW_FINAL_ROWS"

M_HYBRID = "HYBRID"
M_RAW = "RAW_CORRECTION"
M_LAG = "LAG_MEAN"

MISSING = "__MISSING__"
SERIES_COLUMNS = ["branch_code", "group_name", "client", "direction", "kind"]
CATEGORICAL = ["branch_code", "point", "group_name", "client", "direction", "kind"]

# Extra headers of the warehouse view.
WAREHOUSE_ALIASES = {
    "owner": ["wlasciciel", "owner"],
    "forecast_type": ["typ", "forecast_type"],
    "is_last_in_batch": ["czyOstatniNaCzasDanych", "is_last_in_batch"],
}

"""Results in the vocabulary of the source system, for readers that expect its column names and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast import names as N

# Output column names of the source system.
COLUMNS = {
    **dict(zip(N.ENERGY_COLUMNS, N.SOURCE_ENERGY_COLUMNS)),
    "point": "punkt",
    "direction": "kierunek_energii_norm",
    "valid_local": "valid_timestamp",
    "model_utc": "model_timestamp_utc",
    "forecast": "wartosc_przewidywana",
    "baseline": "wartosc_bazowa",
    "baseline_backtest": "wartosc_bazowa_backtest",
    "full_model": "wartosc_model_pelny",
    "full_model_in_sample": "model_pelny_jest_insample",
    "lag_count": "liczba_lagow_bazowych",
    "residual_actual": "residuum_rzeczywiste",
    "correction": "korekta_ml_surowa",
    "raw_candidate": "wartosc_ml_przed_blendem",
    "strategy": "strategia_predykcji",
    "calibration_n": "kalibracja_n",
    "calibration_improvement": "kalibracja_poprawa_mae",
    "calibration_reason": "kalibracja_powod",
    "error": "blad",
    "abs_error": "blad_bezwzgledny",
    "prediction_status": "status_predykcji",
    "without_weather": "prognoza_bez_pogody",
    "weather_matched": "pogoda_dopasowana",
    "weather_available": "pogoda_dostepna",
    "feature_count": "liczba_cech_pogodowych",
    "issue_local": "weather_issue_time",
    "issue_utc": "weather_issue_time_utc",
    "w_valid_local": "weather_valid_time",
    "lead_hours": "weather_lead_hours",
    "temperature": "temperatura",
    "wind_speed": "predkosc_wiatru",
    "wind_dir": "kierunek_wiatru",
    "cloud": "zachmurzenie",
    "precip": "opad_konwekcyjny",
    "visibility": "widocznosc",
    "rad_total": "promieniowanie_calkowite",
    "rad_direct": "promieniowanie_bezposrednie",
    "snow": "warstwa_sniegu",
    "scope": "zakres",
    "value": "wartosc_zakresu",
    "check": "kontrola",
    "count": "liczba",
    "details": "szczegoly",
    "feature": "cecha",
    "importance": "waznosc_permutacyjna_residuum_mae",
    "spread_over_folds": "odchylenie_miedzy_foldami",
    "n_folds": "liczba_foldow",
    "status": "status",
    "note": "uwaga",
}

_DIRECTION = {N.IMPORT: "POBRANIE", N.EXPORT: "ODDANIE", N.MISSING: "__BRAK__"}
_WEATHER = {
    N.W_MATCHED: "DOPASOWANA",
    N.W_MISSING: "BRAK_POGODY_W_ZAKRESIE",
    N.W_BEFORE: "PRZED_STARTEM_POGODY",
    N.W_NO_TIME: "BRAK_KLUCZA_CZASU",
    N.W_NO_MAP: "BRAK_MAPOWANIA",
}

# Codes of the source system per column.
CODES = {
    "direction": _DIRECTION,
    "direction_source": {
        N.SRC_TEXT: "kolumna_E",
        N.SRC_SIGN: "fallback_kolumna_B",
        N.SRC_NONE: "brak",
    },
    "weather_status": _WEATHER,
    "prediction_status": {
        N.P_WARMUP: "WARMUP_BEZ_OOF",
        N.P_GAP: "HISTORYCZNY_BRAK_TARGETU",
        N.P_AWAITING: "OCZEKUJE_NA_MODEL_PRZYSZLY",
        N.P_NO_UTC: "BRAK_POPRAWNEGO_CZASU_UTC",
        N.P_NO_DIRECTION: "BRAK_KIERUNKU",
        N.P_OOF: "OOF_BACKTEST",
        N.P_FUTURE: "PROGNOZA_PRZYSZLA",
    },
    "strategy": {
        N.S_HYBRID: "HYBRYDA",
        N.S_BASELINE: "BASELINE_FALLBACK",
        N.S_HYBRID_FINAL: "HYBRYDA_FINALNA",
        N.S_BASELINE_FINAL: "BASELINE_FALLBACK_FINALNY",
    },
    "calibration_reason": {
        N.R_FEW_CALIBRATION: "ZA_MALO_KALIBRACJI",
        N.R_PERFECT: "BASELINE_IDEALNY_LUB_NIEPOPRAWNY",
        N.R_NO_GAIN: "BRAK_POTWIERDZONEJ_POPRAWY",
        N.R_CHOSEN: "HYBRYDA_WYBRANA",
        N.R_FEW_FIT: "ZA_MALO_DANYCH_DO_MODELU",
        N.R_NO_CALIBRATION: "BRAK_OKNA_KALIBRACYJNEGO",
        N.R_NO_OOF: "BRAK_OOF_DO_KALIBRACJI_FINALNEJ",
        N.R_FEW_FINAL: "ZA_MALO_DANYCH_DO_MODELU_KONCOWEGO",
    },
    "model": {
        N.M_HYBRID: "HYBRYDA_OOF",
        N.M_RAW: "KOREKTA_ML_SUROWA_OOF",
        N.M_LAG: "SREDNIA_ANALOGICZNYCH_D3_D14",
    },
    "scope": {
        "DIRECTION": "KIERUNEK",
        "POINT": "MIASTO",
        "WEATHER": "POGODA",
        "MACRO_CLIENT": "MAKRO_KLIENT",
    },
    "value": {**_DIRECTION, **_WEATHER, "mean over clients": "średnia po klientach"},
}


def to_source_vocabulary(df: DataFrame) -> DataFrame:
    """Translate codes and rename columns; everything without an entry stays as it is."""
    translated = {}
    for column, codes in CODES.items():
        if column in df.columns:
            translated[column] = F.col(column)
            for ours, theirs in codes.items():
                translated[column] = F.when(F.col(column) == ours, theirs).otherwise(translated[column])
    return df.withColumns(translated).withColumnsRenamed({k: v for k, v in COLUMNS.items() if k in df.columns})

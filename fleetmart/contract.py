"""Column names, placeholders and limits of the telemetry data contract."""

from __future__ import annotations

# Raw feed field -> typed column name.
POSITION_FIELDS = {
    "LT": "latitude",
    "LG": "longitude",
    "NV": "numero_do_veiculo",
    "NL": "cod_linha",
    "HR": "datahora_raw",
}

# Typed columns.
LATITUDE = "latitude"
LONGITUDE = "longitude"
VEHICLE = "numero_do_veiculo"
LINE = "cod_linha"
RAW_TIME = "datahora_raw"
EVENT_TIME = "event_timestamp"
OPERATOR = "consorcio"
LINE_NAME = "nome_linha"
INGESTED_AT = "_ingestion_timestamp"
PROCESSED_AT = "_processed_at"
LANDING_DAY = "partition_date"
EVENT_DAY = "_event_day"
EVENT_PART = "_event_part"

# Register columns (the operator header comes with or without its accent).
REGISTER_LINE = "LINHA"
REGISTER_OPERATOR = ("CONCESSIONÁRIA", "CONCESSIONARIA")

# Timestamp layout of the feed.
COMPACT_TIME = "yyyyMMddHHmmss"

# Placeholders.
UNKNOWN_OPERATOR = "Desconhecido"
NO_LINE_NAME = "N/A - Ver MCO"
UNENRICHED = ("Desconhecido", "N/A")

# A position row is refined only when all of these exist.
ESSENTIAL = (LATITUDE, LONGITUDE, VEHICLE, EVENT_TIME)
POSITION_KEY = (VEHICLE, EVENT_TIME)

# Enrichment-rate bands in percent, report size, oldest resource year.
RATE_ALERT_BELOW = 1.0
RATE_WARN_BELOW = 50.0
REPORT_SIZE = 10
OLDEST_RESOURCE_YEAR = 2022

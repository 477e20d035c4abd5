"""The given tables in the roles the operators need, in Spark and in SQL.

``events`` gives raw positions and ``customer`` the trip register.  The tables hold no
NULLs and no malformed text, so both are made dirty by rules on their keys; every row
takes part.  The register lists even line numbers only, so odd lines find no operator,
and lower-case position codes match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.catalog.registry import table


def _comma_text(number: str) -> Column:
    return F.replace(F.col(number).cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))


def raw_positions(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Events as an all-text feed: LT, LG, NV, NL, HR, plus event_id, event_type and ``more``."""
    every = lambda n: F.col("event_id") % n == 0
    code = F.when(F.col("event_type") == "error", "sc").otherwise("SC")
    return table(spark, sf_dir, "events").select(
        F.when(every(97), "None").when(every(89), "1,2,3").otherwise(_comma_text("value")).alias("LT"),
        F.when(every(101), "nan").otherwise(F.concat(F.lit("-"), _comma_text("value"))).alias("LG"),
        F.when(~every(59), F.col("user_id").cast("string")).alias("NV"),
        F.when(~every(61), F.concat(code, F.get_json_object("props", "$.k"))).alias("NL"),
        F.when(every(83), "None")
        .otherwise(F.date_format(F.date_trunc("hour", "ts"), "yyyyMMddHHmmss"))
        .alias("HR"),
        "event_type",
        "event_id",
        *more,
    )


RAW_POSITIONS = """
raw_positions AS (
    SELECT CASE WHEN event_id % 97 = 0 THEN 'None' WHEN event_id % 89 = 0 THEN '1,2,3'
                ELSE replace(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END AS LT,
           CASE WHEN event_id % 101 = 0 THEN 'nan'
                ELSE '-' || replace(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END AS LG,
           CASE WHEN event_id % 59 <> 0 THEN CAST(user_id AS VARCHAR) END AS NV,
           CASE WHEN event_id % 61 <> 0
                THEN CASE WHEN event_type = 'error' THEN 'sc' ELSE 'SC' END
                     || regexp_extract(props, '"k": *([0-9]+)', 1) END AS NL,
           CASE WHEN event_id % 83 = 0 THEN 'None'
                ELSE strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') END AS HR,
           event_type, event_id, ts
    FROM events)
"""

TYPED_POSITIONS = f"""
{RAW_POSITIONS},
typed_positions AS (
    SELECT TRY_CAST(replace(LT, ',', '.') AS DOUBLE) AS latitude,
           TRY_CAST(replace(LG, ',', '.') AS DOUBLE) AS longitude,
           NV AS numero_do_veiculo, NL AS cod_linha, HR AS datahora_raw,
           event_type, event_id,
           try_strptime(HR, '%Y%m%d%H%M%S') AS event_timestamp
    FROM raw_positions)
"""

POSITIONS = f"""
{TYPED_POSITIONS},
positions AS (
    SELECT * FROM typed_positions
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY numero_do_veiculo, event_timestamp ORDER BY event_id) = 1)
"""


def raw_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a trip register with codes in several spellings."""
    key = F.col("c_custkey")
    number = (key % 60 * 2).cast("string")
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 7 == 1, F.concat(F.lit("sc"), number, F.lit(" ")))
        .when(key % 7 == 2, F.concat(F.lit(" SC"), number))
        .otherwise(F.concat(F.lit("SC"), number))
        .alias("LINHA"),
        F.when(key % 11 == 3, F.lower(segment))
        .when(key % 11 == 4, F.concat(segment, F.lit(" ")))
        .otherwise(segment)
        .alias("CONCESSIONÁRIA"),
        F.col("c_name").alias("VIAGEM"),
    )


RAW_REGISTER = """
raw_register AS (
    SELECT CASE WHEN c_custkey % 7 = 1 THEN 'sc' || (c_custkey % 60 * 2) || ' '
                WHEN c_custkey % 7 = 2 THEN ' SC' || (c_custkey % 60 * 2)
                ELSE 'SC' || (c_custkey % 60 * 2) END AS linha,
           CASE WHEN c_custkey % 11 = 3 THEN lower(c_mktsegment)
                WHEN c_custkey % 11 = 4 THEN c_mktsegment || ' '
                ELSE c_mktsegment END AS concessionaria
    FROM customer)
"""

REGISTER = f"""
{RAW_REGISTER},
register AS (
    SELECT trim(upper(linha)) AS cod_linha, trim(upper(concessionaria)) AS consorcio,
           'N/A - Ver MCO' AS nome_linha
    FROM (SELECT DISTINCT linha, concessionaria FROM raw_register))
"""

ACTIVITY = f"""
{POSITIONS},
{REGISTER},
activity AS (
    SELECT cod_linha, consorcio, count(numero_do_veiculo) AS total_pings,
           max(event_timestamp) AS last_seen, min(latitude) AS min_lat, max(latitude) AS max_lat
    FROM positions LEFT JOIN register USING (cod_linha)
    GROUP BY cod_linha, consorcio)
"""

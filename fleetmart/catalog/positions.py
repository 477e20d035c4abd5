"""Queries: parsing, cleaning, deduplication, activity and the report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.catalog import roles
from fleetmart.catalog.registry import query, table, zoneless
from fleetmart.functions.parse import compact_timestamp, decimal_comma
from fleetmart.operators import cleaning, dimensions, enrich
from fleetmart.sinks.scratch import scratch_path
from fleetmart.sources.tables import if_present, load_table

NOW = datetime(2024, 6, 1, 12, 0, 0)


def _now():
    return F.lit("2024-06-01 12:00:00").cast("timestamp")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined positions; the lowest event id survives."""
    return cleaning.refine_positions(roles.raw_positions(spark, sf_dir), order_by=["event_id"])


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = dimensions.extract_dimension(roles.raw_register(spark, sf_dir))
    return enrich.line_activity(positions(spark, sf_dir), register)


@query("decimal_comma_parse", f"""WITH {roles.TYPED_POSITIONS}
    SELECT event_id, latitude, coalesce(isnan(longitude), FALSE) AS is_nan,
           CASE WHEN NOT isnan(longitude) THEN longitude END AS longitude FROM typed_positions""")
def decimal_comma_parse(spark, sf_dir):
    raw = roles.raw_positions(spark, sf_dir)
    longitude = decimal_comma(F.col("LG"))
    return raw.select(
        "event_id",
        decimal_comma(F.col("LT")).alias("latitude"),
        F.isnan(longitude).alias("is_nan"),
        F.when(~F.isnan(longitude), longitude).alias("longitude"),
    )


@query("compact_ts_parse", f"""WITH {roles.TYPED_POSITIONS}
    SELECT event_id, datahora_raw, event_timestamp FROM typed_positions""")
def compact_ts_parse(spark, sf_dir):
    raw = roles.raw_positions(spark, sf_dir)
    parsed = raw.select("event_id", F.col("HR").alias("datahora_raw"), compact_timestamp(F.col("HR")).alias("event_timestamp"))
    return parsed.select("event_id", "datahora_raw", zoneless("event_timestamp"))


@query("rename_guarded", "SELECT event_id, ts, user_id AS numero_do_veiculo, event_type, value, props AS payload FROM events")
def rename_guarded(spark, sf_dir):
    # "TS" is not renamed: names are compared with their case
    names = {"user_id": "numero_do_veiculo", "props": "payload", "TS": "time", "absent": "gone"}
    return cleaning.rename_exact(table(spark, sf_dir, "events"), names)


@query("stringify_all", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
    o_orderpriority, '2024-06-01T12:00:00' AS _ingestion_timestamp FROM orders""")
def stringify_all(spark, sf_dir):
    return cleaning.stringify_all(cleaning.stamp_landing(table(spark, sf_dir, "orders"), NOW))


@query("drop_null_coords", f"""WITH {roles.TYPED_POSITIONS}
    SELECT event_id, latitude, isnan(longitude) AS is_nan FROM typed_positions
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def drop_null_coords(spark, sf_dir):
    typed = cleaning.type_positions(cleaning.rename_exact(roles.raw_positions(spark, sf_dir)))
    return cleaning.keep_located(typed).select("event_id", "latitude", F.isnan("longitude").alias("is_nan"))


@query("fallback_event_time", f"""WITH {roles.TYPED_POSITIONS}
    SELECT numero_do_veiculo, TIMESTAMP '2024-06-01 12:00:00' AS event_timestamp, min(event_id) AS event_id
    FROM typed_positions WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY numero_do_veiculo""")
def fallback_event_time(spark, sf_dir):
    raw = roles.raw_positions(spark, sf_dir).drop("HR")
    refined = cleaning.refine_positions(raw, now=_now(), order_by=["event_id"])
    return refined.select("numero_do_veiculo", zoneless("event_timestamp"), "event_id")


@query("missing_cols_passthrough", f"""WITH {roles.TYPED_POSITIONS}
    SELECT latitude, numero_do_veiculo, cod_linha, datahora_raw, event_type, event_id, event_timestamp
    FROM typed_positions""")
def missing_cols_passthrough(spark, sf_dir):
    refined = cleaning.refine_positions(roles.raw_positions(spark, sf_dir).drop("LG"))
    return refined.drop("_processed_at").withColumn("event_timestamp", zoneless("event_timestamp"))


@query("dedup_by_key", """SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""")
def dedup_by_key(spark, sf_dir):
    return cleaning.dedup_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("refined_positions", f"""WITH {roles.POSITIONS}
    SELECT latitude, isnan(longitude) AS is_nan, numero_do_veiculo, cod_linha, datahora_raw, event_type, event_id,
           event_timestamp, TIMESTAMP '2024-06-01 12:00:00' AS _processed_at FROM positions""")
def refined_positions(spark, sf_dir):
    raw = roles.raw_positions(spark, sf_dir)
    refined = cleaning.refine_positions(raw, processed_at=_now(), order_by=["event_id"])
    return refined.select(
        "latitude", F.isnan("longitude").alias("is_nan"), "numero_do_veiculo", "cod_linha", "datahora_raw",
        "event_type", "event_id", zoneless("event_timestamp"), zoneless("_processed_at"),
    )


@query("activity_agg", f"WITH {roles.ACTIVITY} SELECT * FROM activity")
def activity_agg(spark, sf_dir):
    return activity(spark, sf_dir).withColumn("last_seen", zoneless("last_seen"))


_TOP = f"""WITH {roles.ACTIVITY}
    SELECT cod_linha, consorcio, total_pings, last_seen FROM activity
    ORDER BY total_pings DESC, cod_linha NULLS FIRST, consorcio NULLS FIRST LIMIT 10"""


@query("topk_activity", _TOP)
def topk_activity(spark, sf_dir):
    return enrich.busiest_lines(activity(spark, sf_dir)).withColumn("last_seen", zoneless("last_seen"))


@query("topk_activity_sql", _TOP)
def topk_activity_sql(spark, sf_dir):
    return enrich.busiest_lines_sql(activity(spark, sf_dir)).withColumn("last_seen", zoneless("last_seen"))


@query("enrich_no_dim", f"""WITH {roles.POSITIONS}
    SELECT cod_linha, 'Desconhecido' AS consorcio, count(numero_do_veiculo) AS total_pings,
           max(event_timestamp) AS last_seen, min(latitude) AS min_lat, max(latitude) AS max_lat
    FROM positions GROUP BY cod_linha""")
def enrich_no_dim(spark, sf_dir):
    register = if_present(load_table, spark, scratch_path(spark, "no-register"))
    return enrich.line_activity(positions(spark, sf_dir), register).withColumn("last_seen", zoneless("last_seen"))

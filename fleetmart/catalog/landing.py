"""Queries: landing and table writers read back, and a whole run through its tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fleetmart.catalog import roles
from fleetmart.catalog.positions import activity
from fleetmart.catalog.registry import query, zoneless
from fleetmart.plans import medallion
from fleetmart.plans.layout import Layout
from fleetmart.sinks import writers
from fleetmart.sinks.scratch import scratch_path
from fleetmart.sources.tables import load_table, scan_landing

_DAY_1 = datetime(2024, 6, 1, 6, 0, 0)
_DAY_1_LATER = datetime(2024, 6, 1, 18, 30, 0)
_DAY_2 = datetime(2024, 6, 2, 6, 0, 0)
_DAY_3 = datetime(2024, 6, 3, 6, 0, 0)
_FIELDS = ["LT", "LG", "NV", "NL", "HR"]


def _landed_sql(stamp: str) -> str:
    return f"""SELECT LT, LG, NV, NL, HR, event_type, CAST(event_id AS VARCHAR) AS event_id,
        '{stamp}' AS _ingestion_timestamp, '{stamp[:10]}' AS partition_date FROM raw_positions"""


def _with_day_as_text(landed):
    return landed.withColumn("partition_date", F.col("partition_date").cast("string"))


@query("scan_landing", f"""WITH {roles.RAW_POSITIONS}
    SELECT LT, LG, NV, NL, HR, event_type, CAST(event_id AS VARCHAR) AS event_id,
           '2024-06-01T06:00:00' AS _ingestion_timestamp FROM raw_positions""")
def scan_of_landing(spark, sf_dir):
    base = scratch_path(spark, "landing")
    raw = roles.raw_positions(spark, sf_dir, "ts")
    writers.append_landing(raw, base, _DAY_1, day=F.to_date("ts"))
    return scan_landing(spark, base).drop("ts")


@query("landing_append", f"""WITH {roles.RAW_POSITIONS}
    {_landed_sql('2024-06-01T06:00:00')} UNION ALL {_landed_sql('2024-06-01T18:30:00')}""")
def landing_append(spark, sf_dir):
    base = scratch_path(spark, "landing")
    raw = roles.raw_positions(spark, sf_dir)
    writers.append_landing(raw, base, _DAY_1)
    writers.append_landing(raw, base, _DAY_1_LATER)
    return _with_day_as_text(scan_landing(spark, base, keep_day=True))


@query("landing_replace", f"""WITH {roles.RAW_POSITIONS}
    {_landed_sql('2024-06-01T18:30:00')} UNION ALL {_landed_sql('2024-06-02T06:00:00')}""")
def landing_replace(spark, sf_dir):
    base = scratch_path(spark, "landing")
    raw = roles.raw_positions(spark, sf_dir)
    for run_ts in (_DAY_1, _DAY_2, _DAY_1_LATER):
        writers.replace_landing_day(raw, base, run_ts)
    return _with_day_as_text(scan_landing(spark, base, keep_day=True))


@query("overwrite_schema", f"WITH {roles.ACTIVITY} SELECT cod_linha AS line, total_pings * 2 AS pings FROM activity")
def overwrite_schema(spark, sf_dir):
    path = scratch_path(spark, "activity")
    writers.overwrite_table(activity(spark, sf_dir), path)
    # the new table is made of the old one at the same path
    doubled = load_table(spark, path).select(F.col("cod_linha").alias("line"), (F.col("total_pings") * 2).alias("pings"))
    writers.overwrite_table(doubled, path)
    return load_table(spark, path)


@query("clustered_write", f"WITH {roles.ACTIVITY} SELECT * FROM activity")
def clustered_write(spark, sf_dir):
    path = scratch_path(spark, "activity")
    writers.write_clustered(activity(spark, sf_dir), path, ["cod_linha"])
    return load_table(spark, path).withColumn("last_seen", zoneless("last_seen"))


@query("medallion_activity", f"""WITH {roles.TYPED_POSITIONS},
    positions AS (
        SELECT * FROM typed_positions WHERE latitude IS NOT NULL AND longitude IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY numero_do_veiculo, event_timestamp ORDER BY datahora_raw, longitude,
            latitude, cod_linha NULLS FIRST, event_type) = 1),
    {roles.REGISTER}
    SELECT cod_linha, consorcio, count(numero_do_veiculo) AS total_pings, max(event_timestamp) AS last_seen,
           min(latitude) AS min_lat, max(latitude) AS max_lat
    FROM positions LEFT JOIN register USING (cod_linha) GROUP BY cod_linha, consorcio""")
def medallion_activity(spark, sf_dir):
    """Feed bodies and a register file through all stages and gates.

    Feed fields land in name order (one of them unknown to the contract), and the survivor of
    duplicates is the first by the columns in that order.
    """
    base = scratch_path(spark, "run")
    layout = Layout(base)
    raw = roles.raw_positions(spark, sf_dir)
    record = F.struct("event_id", F.to_json(F.struct(*_FIELDS, "event_type")).alias("json"))
    listed = raw.groupBy(F.floor(F.col("event_id") / 40)).agg(F.array_sort(F.collect_list(record)).alias("r"))
    bodies = listed.select(F.concat(F.lit('{"records": ['), F.array_join("r.json", ", "), F.lit("]}")).alias("body"))
    as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    register_file = f"{base}/incoming/register"
    roles.raw_register(spark, sf_dir).write.options(sep=";", header=True, **as_is).csv(register_file)
    medallion.run_daily(spark, layout, _DAY_1, bodies=bodies, register=register_file)
    return load_table(spark, layout.path("activity")).withColumn("last_seen", zoneless("last_seen"))


_REFINED_TWO_DAYS = f"""WITH {roles.RAW_POSITIONS},
    landed AS (SELECT * FROM raw_positions UNION ALL SELECT * REPLACE (replace(LT, ',', ',0') AS LT) FROM raw_positions),
    typed AS (
        SELECT TRY_CAST(replace(LT, ',', '.') AS DOUBLE) AS latitude, TRY_CAST(replace(LG, ',', '.') AS DOUBLE) AS longitude,
               NV AS numero_do_veiculo, NL AS cod_linha, event_type, CAST(event_id AS VARCHAR) AS event_id,
               try_strptime(HR, '%Y%m%d%H%M%S') AS event_timestamp FROM landed)
    SELECT latitude, numero_do_veiculo, cod_linha, event_type, event_id, event_timestamp FROM typed
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY numero_do_veiculo, event_timestamp
        ORDER BY latitude, longitude, cod_linha NULLS FIRST, event_type, event_id) = 1"""


@query("refine_new_days", _REFINED_TWO_DAYS)
def refine_new_days(spark, sf_dir):
    """A second landing day with smaller latitudes, refined into the table of the first."""
    return _two_days(spark, sf_dir, Layout(scratch_path(spark, "run"), by_event_day=True))


@query("refine_in_parts", _REFINED_TWO_DAYS)
def refine_in_parts(spark, sf_dir):
    """The same with each event day cut into four parts by the key."""
    return _two_days(spark, sf_dir, Layout(scratch_path(spark, "run"), by_event_day=True, parts=4))


def _two_days(spark, sf_dir, layout):
    raw = roles.raw_positions(spark, sf_dir)
    landed = layout.path("landed_positions")
    writers.append_landing(raw, landed, _DAY_1)
    medallion.refine_new_positions(spark, layout, f"{_DAY_1:%Y-%m-%d}")
    writers.append_landing(raw.withColumn("LT", F.replace("LT", F.lit(","), F.lit(",0"))), landed, _DAY_2)
    medallion.refine_new_positions(spark, layout, f"{_DAY_2:%Y-%m-%d}")
    refined = load_table(spark, layout.path("positions"))
    return refined.select("latitude", "numero_do_veiculo", "cod_linha", "event_type", "event_id", zoneless("event_timestamp"))


@query("refine_many_days", f"""WITH {roles.RAW_POSITIONS},
    landed AS (
        SELECT LT, LG, NV, NL, HR, event_id FROM raw_positions UNION ALL
        SELECT LT, LG, NV, NL, strftime(TIMESTAMP '2000-01-01' + INTERVAL 1 DAY * CAST(event_id % 1500 AS INTEGER), '%Y%m%d%H%M%S'),
               event_id FROM raw_positions),
    typed AS (
        SELECT TRY_CAST(replace(LT, ',', '.') AS DOUBLE) AS latitude, TRY_CAST(replace(LG, ',', '.') AS DOUBLE) AS longitude,
               NV AS numero_do_veiculo, NL AS cod_linha, CAST(event_id AS VARCHAR) AS event_id,
               try_strptime(HR, '%Y%m%d%H%M%S') AS event_timestamp FROM landed)
    SELECT latitude, numero_do_veiculo, cod_linha, event_id, event_timestamp FROM typed
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY numero_do_veiculo, event_timestamp
        ORDER BY latitude, longitude, cod_linha NULLS FIRST, event_id) = 1""")
def refine_many_days(spark, sf_dir):
    """1,500 event days at once into a table whose earlier landing days have been archived."""
    layout = Layout(scratch_path(spark, "run"), by_event_day=True)
    raw = roles.raw_positions(spark, sf_dir).select(*_FIELDS, "event_id")
    landed = layout.path("landed_positions")
    writers.append_landing(raw, landed, _DAY_1)
    medallion.refine_new_positions(spark, layout, f"{_DAY_1:%Y-%m-%d}")
    writers.remove(spark, f"{landed}/partition_date={_DAY_1:%Y-%m-%d}")
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("event_id") % 1500).cast("int"))
    writers.append_landing(raw.withColumn("HR", F.date_format(day, "yyyyMMddHHmmss")), landed, _DAY_2)
    medallion.refine_new_positions(spark, layout, f"{_DAY_2:%Y-%m-%d}")
    refined = load_table(spark, layout.path("positions"))
    return refined.select("latitude", "numero_do_veiculo", "cod_linha", "event_id", zoneless("event_timestamp"))


@query("landing_new_field", f"""WITH {roles.RAW_POSITIONS}
    SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type,
           CASE WHEN event_id % 2 = 1 THEN try_strptime(HR, '%Y%m%d%H%M%S') END AS event_timestamp
    FROM raw_positions WHERE TRY_CAST(replace(LT, ',', '.') AS DOUBLE) IS NOT NULL
        AND TRY_CAST(replace(LG, ',', '.') AS DOUBLE) IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY event_id) = 1""")
def landing_new_field(spark, sf_dir):
    """A field, and the time, come with the second landing day only, into the same tables."""
    layout = Layout(scratch_path(spark, "run"), by_event_day=True)
    # every event is a vehicle of its own, so that none is a duplicate
    raw = roles.raw_positions(spark, sf_dir).withColumn("NV", F.col("event_id").cast("string"))
    landed = layout.path("landed_positions")
    writers.append_landing(raw.filter("event_id % 2 = 0").drop("HR", "event_type"), landed, _DAY_1)
    writers.append_landing(raw.filter("event_id % 2 = 1"), landed, _DAY_2)
    medallion.refine_positions(spark, layout)
    medallion.refine_new_positions(spark, layout, f"{_DAY_2:%Y-%m-%d}")
    refined = load_table(spark, layout.path("positions"))
    return refined.select("event_id", "event_type", zoneless("event_timestamp"))


@query("landing_replace_empty", f"""WITH {roles.RAW_POSITIONS}
    {_landed_sql('2024-06-02T06:00:00')}""")
def landing_replace_empty(spark, sf_dir):
    base = scratch_path(spark, "landing")
    raw = roles.raw_positions(spark, sf_dir)
    for run_ts in (_DAY_1, _DAY_2):
        writers.replace_landing_day(raw, base, run_ts)
    writers.replace_landing_day(raw.filter("event_id < 0"), base, _DAY_1_LATER)
    return _with_day_as_text(scan_landing(spark, base, keep_day=True))


@query("landing_compaction", f"""WITH {roles.RAW_POSITIONS}
    {_landed_sql('2024-06-01T06:00:00')} UNION ALL {_landed_sql('2024-06-01T18:30:00')} UNION ALL {_landed_sql('2024-06-02T06:00:00')}""")
def landing_compaction(spark, sf_dir):
    base = scratch_path(spark, "landing")
    raw = roles.raw_positions(spark, sf_dir)
    for run_ts in (_DAY_1, _DAY_1_LATER, _DAY_2):
        writers.append_landing(raw.repartition(8), base, run_ts)
    writers.compact_landing_day(spark, base, f"{_DAY_1:%Y-%m-%d}", files=2)
    return _with_day_as_text(scan_landing(spark, base, keep_day=True))


_TWO_DAYS_ACTIVITY = f"""WITH {roles.RAW_POSITIONS},
    landed AS (SELECT * FROM raw_positions UNION ALL SELECT * REPLACE (replace(LT, ',', ',0') AS LT) FROM raw_positions),
    typed AS (
        SELECT TRY_CAST(replace(LT, ',', '.') AS DOUBLE) AS latitude, TRY_CAST(replace(LG, ',', '.') AS DOUBLE) AS longitude,
               NV AS numero_do_veiculo, NL AS cod_linha, event_type, CAST(event_id AS VARCHAR) AS event_id,
               try_strptime(HR, '%Y%m%d%H%M%S') AS event_timestamp FROM landed),
    refined AS (
        SELECT * FROM typed WHERE latitude IS NOT NULL AND longitude IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY numero_do_veiculo, event_timestamp
            ORDER BY latitude, longitude, cod_linha NULLS FIRST, event_type, event_id) = 1),
    {roles.REGISTER}
    SELECT cod_linha, consorcio, count(numero_do_veiculo) AS total_pings, max(event_timestamp) AS last_seen,
           min(latitude) AS min_lat, max(latitude) AS max_lat
    FROM refined LEFT JOIN register USING (cod_linha) GROUP BY cod_linha, consorcio"""


@query("daily_activity", _TWO_DAYS_ACTIVITY)
def daily_activity(spark, sf_dir):
    """A whole run, then one that refines, checks and counts the touched event days alone."""
    layout = Layout(scratch_path(spark, "run"), by_event_day=True)
    raw, landed = roles.raw_positions(spark, sf_dir), layout.path("landed_positions")
    writers.replace_landing_day(roles.raw_register(spark, sf_dir), layout.path("landed_register"), _DAY_1)
    writers.append_landing(raw, landed, _DAY_1)
    medallion.run_daily(spark, layout, _DAY_1)
    writers.append_landing(raw.withColumn("LT", F.replace("LT", F.lit(","), F.lit(",0"))), landed, _DAY_2)
    medallion.run_daily(spark, layout, _DAY_2, since=f"{_DAY_2:%Y-%m-%d}")
    return load_table(spark, layout.path("activity")).withColumn("last_seen", zoneless("last_seen"))


@query("activity_after_stopped_run", _TWO_DAYS_ACTIVITY.replace("SELECT * REPLACE (replace(LT, ',', ',0') AS LT) FROM raw_positions)", """
        SELECT * REPLACE (replace(LT, ',', ',0') AS LT) FROM raw_positions
        UNION ALL SELECT * REPLACE ('20231130120000' AS HR, 'late' AS NL) FROM raw_positions WHERE event_id % 50 = 0)"""))
def activity_after_stopped_run(spark, sf_dir):
    """The second of three runs stops after refining; the third, on other event days, serves its days too."""
    layout = Layout(scratch_path(spark, "run"), by_event_day=True)
    raw, landed = roles.raw_positions(spark, sf_dir), layout.path("landed_positions")
    writers.replace_landing_day(roles.raw_register(spark, sf_dir), layout.path("landed_register"), _DAY_1)
    writers.append_landing(raw, landed, _DAY_1)
    medallion.run_daily(spark, layout, _DAY_1)
    writers.append_landing(raw.withColumn("LT", F.replace("LT", F.lit(","), F.lit(",0"))), landed, _DAY_2)
    medallion.refine_new_positions(spark, layout, f"{_DAY_2:%Y-%m-%d}")
    other_day = raw.filter("event_id % 50 = 0").withColumns({"HR": F.lit("20231130120000"), "NL": F.lit("late")})
    writers.append_landing(other_day, landed, _DAY_3)
    medallion.run_daily(spark, layout, _DAY_3, since=f"{_DAY_3:%Y-%m-%d}")
    return load_table(spark, layout.path("activity")).withColumn("last_seen", zoneless("last_seen"))

"""Queries: quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.catalog import roles
from fleetmart.catalog.positions import activity, positions
from fleetmart.catalog.registry import query, table
from fleetmart.operators import cleaning, enrich, quality

def _rule_sql(rule: str, severity: str, observed: str, broken: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{severity}' AS severity, CAST({observed} AS DOUBLE) AS observed,
        CAST(0 AS DOUBLE) AS threshold, CASE WHEN {broken} THEN '{severity}' ELSE 'ok' END AS status"""


_VOLUME = _rule_sql("volume", "fail", "count(*)", "count(*) = 0")
_NULLS = "count(*) FILTER (latitude IS NULL OR longitude IS NULL)"
_NULL_COORDS = _rule_sql("null_coordinates", "warn", _NULLS, f"{_NULLS} > 0")
_LATE = "count(*) FILTER (event_timestamp > TIMESTAMP '2024-01-15 00:00:00')"
_FUTURE = _rule_sql("future_timestamps", "warn", _LATE, f"{_LATE} > 0")
_DUPLICATES = _rule_sql("duplicate_keys", "warn", "count(*)", "count(*) > 0")


def _as_of():
    return F.lit("2024-01-15 00:00:00").cast("timestamp")


def _typed(spark, sf_dir):
    return cleaning.type_positions(cleaning.rename_exact(roles.raw_positions(spark, sf_dir)))


@query("dq_volume", _VOLUME + " FROM events")
def dq_volume(spark, sf_dir):
    return quality.positions_scan_checks(_typed(spark, sf_dir)).filter("rule = 'volume'")


@query("dq_null_coords", f"WITH {roles.TYPED_POSITIONS} {_NULL_COORDS} FROM typed_positions")
def dq_null_coords(spark, sf_dir):
    return quality.positions_scan_checks(_typed(spark, sf_dir)).filter("rule = 'null_coordinates'")


@query("dq_future_ts", f"WITH {roles.TYPED_POSITIONS} {_FUTURE} FROM typed_positions")
def dq_future_ts(spark, sf_dir):
    return quality.positions_scan_checks(_typed(spark, sf_dir), as_of=_as_of()).filter("rule = 'future_timestamps'")


@query("dq_pk_duplicates", f"""{_DUPLICATES} FROM (
    SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def dq_pk_duplicates(spark, sf_dir):
    return quality.duplicate_key_check(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("pk_duplicate_groups", """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_duplicate_groups(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _all_rules_sql(positions: str) -> str:
    groups = f"(SELECT 1 FROM {positions} GROUP BY numero_do_veiculo, event_timestamp HAVING count(*) > 1)"
    parts = [f"{rule} FROM {positions}" for rule in (_VOLUME, _NULL_COORDS, _FUTURE)]
    return " UNION ALL ".join([*parts, f"{_DUPLICATES} FROM {groups}"])


@query("dq_positions", f"WITH {roles.TYPED_POSITIONS} {_all_rules_sql('typed_positions')}")
def dq_positions(spark, sf_dir):
    return quality.positions_checks(_typed(spark, sf_dir), as_of=_as_of())


@query("dq_refined_positions", f"WITH {roles.POSITIONS} {_all_rules_sql('positions')}")
def dq_refined_positions(spark, sf_dir):
    return quality.positions_checks(positions(spark, sf_dir), as_of=_as_of())


def _rate_sql(source: str, label: str) -> str:
    return f"""SELECT 'enrichment_rate' AS rule, CASE WHEN rate < 1 THEN 'alert' ELSE 'warn' END AS severity,
        rate AS observed, CAST(CASE WHEN rate < 1 THEN 1 ELSE 50 END AS DOUBLE) AS threshold,
        CASE WHEN rate < 1 THEN 'alert' WHEN rate < 50 THEN 'warn' ELSE 'ok' END AS status
    FROM (SELECT CASE WHEN count(*) = 0 THEN 0.0 ELSE
              CAST(count(*) - count(*) FILTER ({label} IS NULL OR {label} IN ('Desconhecido', 'N/A')) AS DOUBLE)
              / count(*) * 100 END AS rate
          FROM {source})"""


@query("dq_match_rate", f"WITH {roles.ACTIVITY} {_rate_sql('activity', 'consorcio')}")
def dq_match_rate(spark, sf_dir):
    return quality.enrichment_check(activity(spark, sf_dir))


@query("dq_match_rate_labels", f"""WITH labelled AS (
    SELECT CASE WHEN quality = 0 THEN 'N/A' ELSE CAST(quality AS VARCHAR) END AS label
    FROM documents LEFT JOIN labels USING (doc_id)) {_rate_sql('labelled', 'label')}""")
def dq_match_rate_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labelled = enrich.left_enrich(documents, table(spark, sf_dir, "labels"), "doc_id").select(
        F.when(F.col("quality") == 0, "N/A").otherwise(F.col("quality").cast("string")).alias("label")
    )
    return quality.enrichment_check(labelled, "label")


@query("enrichment_counts", f"""WITH {roles.ACTIVITY}
    SELECT count(*) AS total, count(*) FILTER (consorcio IS NULL OR consorcio IN ('Desconhecido', 'N/A')) AS unknown,
           CAST(count(*) - count(*) FILTER (consorcio IS NULL OR consorcio IN ('Desconhecido', 'N/A')) AS DOUBLE)
           / count(*) * 100 AS match_rate FROM activity""")
def enrichment_counts(spark, sf_dir):
    return quality.enrichment_rate(activity(spark, sf_dir))


@query("report_nonempty", f"""WITH {roles.ACTIVITY},
    top AS (SELECT * FROM activity ORDER BY total_pings DESC LIMIT 10)
    {_rule_sql('report_nonempty', 'fail', 'count(*)', 'count(*) = 0')} FROM top""")
def report_nonempty(spark, sf_dir):
    return quality.report_check(enrich.busiest_lines(activity(spark, sf_dir)))

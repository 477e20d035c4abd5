"""Queries: dimension extraction and left enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.catalog import roles
from fleetmart.catalog.positions import positions
from fleetmart.catalog.registry import query, table, zoneless
from fleetmart.operators import cleaning, dimensions, enrich


@query("dim_extract", f"WITH {roles.REGISTER} SELECT * FROM register")
def dim_extract(spark, sf_dir):
    return dimensions.extract_dimension(roles.raw_register(spark, sf_dir))


@query("dim_extract_normalized", f"""WITH {roles.RAW_REGISTER}
    SELECT DISTINCT trim(upper(linha)) AS cod_linha, trim(upper(concessionaria)) AS consorcio,
           'N/A - Ver MCO' AS nome_linha FROM raw_register""")
def dim_extract_normalized(spark, sf_dir):
    plain_header = roles.raw_register(spark, sf_dir).withColumnRenamed("CONCESSIONÁRIA", "CONCESSIONARIA")
    return dimensions.extract_dimension(plain_header, normalize_first=True)


@query("left_enrich", """SELECT doc_id, text, lang, source, n_chars, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)""")
def left_enrich(spark, sf_dir):
    labelled = enrich.left_enrich(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return labelled.withColumns({name: F.col(name).cast("string") for name in ("quality", "toxic")})


@query("left_enrich_salted", f"""WITH {roles.POSITIONS}, {roles.REGISTER}
    SELECT event_id, cod_linha, consorcio, nome_linha FROM positions LEFT JOIN register USING (cod_linha)""")
def left_enrich_salted(spark, sf_dir):
    register = dimensions.extract_dimension(roles.raw_register(spark, sf_dir))
    refined = positions(spark, sf_dir).select("event_id", "cod_linha")
    return enrich.left_enrich(refined, register, "cod_linha", salts=4)


@query("fanout_enrich", f"""WITH {roles.TYPED_POSITIONS},
    orders_of AS (SELECT CAST(o_custkey AS VARCHAR) AS cod_linha, o_orderpriority AS consorcio FROM orders),
    pings AS (SELECT numero_do_veiculo AS cod_linha, event_type AS numero_do_veiculo, event_timestamp, latitude
              FROM typed_positions)
    SELECT cod_linha, consorcio, count(numero_do_veiculo) AS total_pings, max(event_timestamp) AS last_seen,
           min(latitude) AS min_lat, max(latitude) AS max_lat
    FROM pings LEFT JOIN orders_of USING (cod_linha) GROUP BY cod_linha, consorcio""")
def fanout_enrich(spark, sf_dir):
    typed = cleaning.type_positions(cleaning.rename_exact(roles.raw_positions(spark, sf_dir)))
    pings = typed.select(
        F.col("numero_do_veiculo").alias("cod_linha"),
        F.col("event_type").alias("numero_do_veiculo"),
        "event_timestamp",
        "latitude",
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("cod_linha"), F.col("o_orderpriority").alias("consorcio")
    )
    return enrich.line_activity(pings, orders).withColumn("last_seen", zoneless("last_seen"))

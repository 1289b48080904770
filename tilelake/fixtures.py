"""Bronze tiles and a gazetteer derived from the provided star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KEY = "(l_orderkey*1000003 + l_partkey*104729 + l_linenumber*7919) % 4294967296"

# The same text runs on both engines; only these two expressions are spelled differently.
SPARK_DIALECT = {
    "QK": f"lpad(conv(cast({_KEY} as string),10,4),16,'0')",
    "YMD": "date_format(l_shipdate,'yyyy-MM-dd')",
}
DUCKDB_DIALECT = {
    "QK": f"to_base({_KEY},4,16)",
    "YMD": "strftime(l_shipdate,'%Y-%m-%d')",
}

TILES_SQL = """
WITH k AS (SELECT *, {QK} AS qk, l_orderkey*31 + l_linenumber*7 + l_partkey AS h FROM {lineitem})
SELECT
  CASE WHEN h%97=0 THEN NULL WHEN h%89=0 THEN '' WHEN h%83=0 THEN concat('  ',qk,' ')
       WHEN h%79=0 THEN substr(qk,1,8) WHEN h%73=0 THEN concat('4',substr(qk,2,15))
       WHEN h%71=0 THEN concat(qk,qk) ELSE qk END AS quadkey,
  CASE WHEN h%67=0 THEN '2019-' WHEN h%61=0 THEN ''
       ELSE concat({YMD},'_performance_',CASE WHEN l_linestatus='O' THEN 'mobile' ELSE 'fixed' END,'_tiles')
       END AS tile,
  CASE WHEN h%59=0 THEN NULL WHEN h%53=0 THEN 0 WHEN h%47=0 THEN -5
       ELSE CAST(floor(l_extendedprice*10) AS BIGINT) END AS avg_d_kbps,
  CASE WHEN h%43=0 THEN 0 ELSE CAST(floor(l_extendedprice*5) AS BIGINT) END AS avg_u_kbps,
  CASE WHEN h%41=0 THEN NULL WHEN h%37=0 THEN -1
       ELSE CAST((l_suppkey*13 + l_linenumber*17 + l_orderkey) % 1100 AS BIGINT) END AS avg_lat_ms,
  CASE WHEN h%29=0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS tests,
  CASE WHEN h%31=0 THEN 0 ELSE CAST(1 + (l_orderkey % 9) AS BIGINT) END AS devices
FROM k
"""

GAZETTEER_SQL = """
SELECT s_name AS name, n_name AS admin1, upper(substr(r_name,1,2)) AS cc,
  CAST((s_suppkey*7919) % 1600 AS DOUBLE)/10 - 80 AS glat,
  CAST((s_suppkey*104729) % 3600 AS DOUBLE)/10 - 180 AS glon
FROM {supplier} JOIN {nation} ON s_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze tiles with every kind of dirty value, one per line item.

    A source file with fewer splits than cores is dealt out first.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate"
    )
    cores = spark.sparkContext.defaultParallelism
    if lines.rdd.getNumPartitions() < cores:
        lines = lines.repartition(cores)
    return spark.sql(TILES_SQL.format(lineitem="{lineitem}", **SPARK_DIALECT), lineitem=lines)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places, one per supplier."""
    return spark.sql(GAZETTEER_SQL, **{n: table(spark, sf_dir, n) for n in ("supplier", "nation", "region")})


def boxes(gazetteer: DataFrame) -> DataFrame:
    """A bounding box of 6 by 8 degrees around each place; some cross the 180th meridian."""
    west, east = F.col("glon") - 4.0, F.col("glon") + 4.0
    return gazetteer.select(
        "name",
        (F.col("glat") - 3.0).alias("lat_min"),
        (F.col("glat") + 3.0).alias("lat_max"),
        F.when(west < -180.0, west + 360.0).otherwise(west).alias("lon_min"),
        F.when(east > 180.0, east - 360.0).otherwise(east).alias("lon_max"),
    )


#: A boundary's rings around its place, as parts of its size: a notched outline, a hole in it, and an island.
RINGS = (
    ((-1.013, -0.517), (-0.211, -0.873), (0.419, -0.331), (1.027, -0.711), (0.787, 0.293), (1.139, 0.911), (0.173, 0.457), (-0.823, 0.967)),
    ((-0.307, -0.287), (0.193, -0.171), (0.047, 0.223), (-0.419, 0.139)),
    ((1.301, -0.207), (1.507, 0.103), (1.223, 0.311)),
)


def polygons(gazetteer: DataFrame) -> DataFrame:
    """A boundary of three rings around each place, 2 to 6 degrees in size; some cross the 180th meridian."""
    size = F.col("size")
    east = lambda x: F.col("glon") + size * x
    corner = lambda x, y: F.struct(
        F.when(east(x) >= 180.0, east(x) - 360.0).when(east(x) < -180.0, east(x) + 360.0).otherwise(east(x)).alias("lon"),
        (F.col("glat") + size * y).alias("lat"),
    )
    rings = F.array(*(F.array(*(corner(x, y) for x, y in ring)) for ring in RINGS))
    sized = gazetteer.withColumn("size", 2.0 + F.pmod(F.floor("glat"), F.lit(5)))
    return sized.select("name", F.explode(rings).alias("ring"))


def addresses(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Address parts with every pattern of missing and empty ones, one per supplier."""
    part = lambda i, value: F.when(F.col("s_suppkey") % 7 == i, F.lit("")).when(F.col("s_suppkey") % 5 >= i, value)
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "s_suppkey",
            part(4, F.concat(F.lit("city of "), "s_name")).alias("city"),
            part(3, F.concat(F.lit("town of "), "s_name")).alias("town"),
            part(2, F.concat(F.lit("village of "), "s_name")).alias("village"),
            part(1, F.col("n_name")).alias("state"),
            F.when(F.col("s_suppkey") % 3 != 0, F.col("r_name")).alias("country"),
        )
    )

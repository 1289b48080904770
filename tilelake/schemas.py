"""Table schemas of the lake and the bronze schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BRONZE = T.StructType(
    [
        T.StructField("quadkey", T.StringType()),
        T.StructField("tile", T.StringType()),
        T.StructField("avg_d_kbps", T.LongType()),
        T.StructField("avg_u_kbps", T.LongType()),
        T.StructField("avg_lat_ms", T.LongType()),
        T.StructField("tests", T.LongType()),
        T.StructField("devices", T.LongType()),
    ]
)

SILVER = T.StructType(
    BRONZE.fields
    + [
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("data_quality_score", T.IntegerType()),
        T.StructField("is_outlier_download", T.BooleanType()),
        T.StructField("is_outlier_upload", T.BooleanType()),
        T.StructField("is_high_latency", T.BooleanType()),
        T.StructField("download_mbps", T.DoubleType()),
        T.StructField("upload_mbps", T.DoubleType()),
        T.StructField("tests_per_device", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("city_lookup_success", T.BooleanType()),
        T.StructField("partition_year", T.StringType()),
        T.StructField("partition_month", T.StringType()),
    ]
)

GAZETTEER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("admin1", T.StringType()),
        T.StructField("cc", T.StringType()),
        T.StructField("glat", T.DoubleType()),
        T.StructField("glon", T.DoubleType()),
    ]
)

PARTITION_COLUMNS = ["partition_year", "partition_month"]
#: What a silver row was loaded with: its quarter of origin, or its micro-batch.
ORIGIN = "load_unit"


def validate_schema(df: DataFrame, required: T.StructType = BRONZE, check_types: bool = False) -> bool:
    """Raise ``ValueError`` unless ``df`` has every required column.

    Extra columns are allowed. With ``check_types`` the column types must match too.
    """
    missing = sorted(set(required.names) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    if check_types:
        wrong = [
            f"{f.name}: expected {f.dataType.simpleString()}, found {df.schema[f.name].dataType.simpleString()}"
            for f in required.fields
            if df.schema[f.name].dataType != f.dataType
        ]
        if wrong:
            raise ValueError(f"Wrong column types: {wrong}")
    return True

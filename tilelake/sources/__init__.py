from tilelake.sources.bronze import read_with_fallback, require_rows, resolve_bronze_path, scan_bronze, scan_quarter
from tilelake.sources.files import check_bronze, file_count, freshness, list_files, validate_files, verify_silver
from tilelake.sources.footers import footers, list_parquet, schema_report
from tilelake.sources.landing import land_bronze, landed_files, read_landed

__all__ = [
    "check_bronze",
    "file_count",
    "footers",
    "freshness",
    "land_bronze",
    "landed_files",
    "list_files",
    "list_parquet",
    "read_landed",
    "read_with_fallback",
    "require_rows",
    "resolve_bronze_path",
    "scan_bronze",
    "scan_quarter",
    "schema_report",
    "validate_files",
    "verify_silver",
]

"""DuckDB statements that give the same results as the registered queries.

Nearest places are found by comparing every distinct location with every place.
"""

from __future__ import annotations

from tilelake.fixtures import DUCKDB_DIALECT, GAZETTEER_SQL, RINGS, TILES_SQL

_CLEAN = """length(trim(quadkey)) BETWEEN 1 AND 30 AND avg_d_kbps > 0 AND avg_u_kbps > 0
  AND avg_lat_ms >= 0 AND tests > 0 AND devices > 0"""
_HAS_LOCATION = "regexp_full_match(trim(quadkey), '[0-3]{1,30}')"
_SCORE = """100 - CASE WHEN length(trim(quadkey)) < 10 THEN 10 ELSE 0 END
  - CASE WHEN avg_d_kbps > 1000000 OR avg_u_kbps > 500000 THEN 20 ELSE 0 END"""
_FLAGS = """coalesce(avg_d_kbps > 1000000, false) AS is_outlier_download,
  coalesce(avg_u_kbps > 500000, false) AS is_outlier_upload,
  coalesce(avg_lat_ms > 1000, false) AS is_high_latency"""
_METRICS = """avg_d_kbps / 1024e0 AS download_mbps, avg_u_kbps / 1024e0 AS upload_mbps,
  tests / CAST(devices AS DOUBLE) AS tests_per_device"""
_YEAR = "CASE WHEN length(tile) > 4 THEN substr(tile, 1, 4) ELSE '2019' END AS partition_year"
_MONTH = "CASE WHEN length(tile) > 7 THEN substr(tile, 6, 2) ELSE '01' END AS partition_month"
_LABEL = "concat(coalesce(name, 'Unknown'), ', ', coalesce(admin1, ''), ', ', coalesce(cc, ''))"
_AVERAGES = """round(avg(avg_d_kbps), 6) AS avg_download_kbps, round(avg(avg_u_kbps), 6) AS avg_upload_kbps,
  round(avg(avg_lat_ms), 6) AS avg_latency_ms, CAST(sum(tests) AS BIGINT) AS total_tests, count(*) AS tile_count"""


def _center(digits: str, latitude: str = "linear") -> str:
    """Latitude and longitude of a text of digits 0-3; null for empty or null text."""
    x = f"(CAST('0b' || translate({digits}, '0123', '0101') AS BIGINT) + 0.5e0)"
    y = f"(CAST('0b' || translate({digits}, '0123', '0011') AS BIGINT) + 0.5e0)"
    cells = f"pow(2e0, length({digits}))"
    if latitude == "linear":
        lat = f"85.05112878e0 - {y} * 170.10225756e0 / {cells}"
    else:
        lat = f"degrees(atan(sinh(pi() * (1e0 - 2e0 * {y} / {cells}))))"
    return f"{lat} AS lat, {x} * 360e0 / {cells} - 180e0 AS lon"


def _with(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n"


_TABLES = {n: n for n in ("lineitem", "supplier", "nation", "region")}
_TILES = ("tiles", TILES_SQL.format(**_TABLES, **DUCKDB_DIALECT))
_GAZETTEER = ("gazetteer", GAZETTEER_SQL.format(**_TABLES))
_CLEANED = (
    "cleaned",
    f"""SELECT trim(quadkey) AS quadkey, trim(tile) AS tile, avg_d_kbps, avg_u_kbps, avg_lat_ms, tests, devices,
  {_SCORE} AS data_quality_score, {_FLAGS}, {_METRICS} FROM tiles WHERE {_CLEAN}""",
)
_LOCATED = (
    "located",
    f"""SELECT * EXCLUDE (lat, lon), lat AS latitude, lon AS longitude
  FROM (SELECT *, {_center('quadkey')} FROM cleaned WHERE {_HAS_LOCATION})""",
)


def _vector(lat: str, lon: str, prefix: str) -> str:
    return f"""cos(radians({lat})) * cos(radians({lon})) AS {prefix}x,
  cos(radians({lat})) * sin(radians({lon})) AS {prefix}y, sin(radians({lat})) AS {prefix}z"""


_PLACES = ("places", f"SELECT {_LABEL} AS label, {_vector('glat', 'glon', 'p')} FROM gazetteer")
_DISTANCE = "CAST(floor(sqrt((qx-px)*(qx-px) + (qy-py)*(qy-py) + (qz-pz)*(qz-pz)) * 1e12) AS BIGINT)"


def _nearest(source: str) -> tuple[tuple[str, str], ...]:
    return (
        (
            "locations",
            f"""SELECT latitude, longitude, {_vector('latitude', 'longitude', 'q')}
  FROM (SELECT DISTINCT latitude, longitude FROM {source})""",
        ),
        (
            "nearest",
            f"""SELECT latitude, longitude, min((d, label)) AS best
  FROM (SELECT latitude, longitude, {_DISTANCE} AS d, label FROM locations CROSS JOIN places)
  GROUP BY latitude, longitude""",
        ),
        (
            "with_city",
            f"""SELECT s.*, struct_extract_at(best, 2) AS city, true AS city_lookup_success
  FROM {source} s JOIN nearest n ON s.latitude = n.latitude AND s.longitude = n.longitude""",
        ),
    )


_SILVER_PARTS = (
    _TILES,
    _GAZETTEER,
    _PLACES,
    _CLEANED,
    _LOCATED,
    *_nearest("located"),
    ("silver", f"SELECT *, {_YEAR}, {_MONTH} FROM with_city"),
)
_BRONZE = _with(_TILES)
_SILVER = _with(*_SILVER_PARTS)
_SILVER_ROWS = (
    _SILVER
    + "SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM silver"
)
_CITIES = f"SELECT quadkey, tile, city, city_lookup_success FROM silver"
# The provided tables, one parquet file each.
_FILES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part "
    "region supplier"
).split()
_QUARTER = "concat(CAST(year(d) AS VARCHAR), '-q', CAST(quarter(d) AS VARCHAR))"


def _quarter_of(tile: str) -> str:
    day = f"substr(trim({tile}), 1, 10)"
    date = rf"try_cast(CASE WHEN regexp_full_match({day}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN {day} END AS DATE)"
    return f"CASE WHEN {date} IS NULL THEN 'undated' ELSE {_QUARTER.replace('(d)', f'({date})')} END"


_QUARTERED = _with(_TILES, ("quartered", f"SELECT *, NULL AS d, {_quarter_of('tile')} AS quarter FROM tiles"))


def _describe(column: str, source: str, value: str | None = None) -> str:
    v = f"CAST({value or column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", count({v}) AS "count", round(avg({v}), 6) AS mean,
  round(stddev_samp({v}), 6) AS stddev, min({v}) AS "min", max({v}) AS "max" FROM {source}"""


def _describe_text(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", min({column}) AS "min",
  max({column}) AS "max" FROM tiles"""


def _centers(digits: str, latitude: str = "linear", usable: str = "true") -> str:
    return (
        _BRONZE
        + f"""SELECT quadkey, round(coalesce(lat, 0e0), 6) AS latitude, round(coalesce(lon, 0e0), 6) AS longitude
  FROM (SELECT quadkey, {_center('digits', latitude)}
        FROM (SELECT trim(quadkey) AS quadkey, CASE WHEN {usable} THEN nullif({digits}, '') END AS digits FROM tiles))"""
    )


def _address(i: int, value: str) -> str:
    return f"CASE WHEN s_suppkey % 7 = {i} THEN '' WHEN s_suppkey % 5 >= {i} THEN {value} END"


def statements() -> dict[str, str]:
    tiles = lambda condition: _BRONZE + f"SELECT * FROM tiles WHERE {condition}"
    stats = _SILVER + f"SELECT city, {_AVERAGES} FROM silver GROUP BY city"
    speed = (
        _SILVER
        + """SELECT city, round(avg(download_mbps), 6) AS avg_download_mbps, count(quadkey) AS tile_count
  FROM silver GROUP BY city"""
    )
    in_box = (
        _with(_TILES, _GAZETTEER, _CLEANED, _LOCATED)
        + """SELECT name, count(*) AS tile_count, CAST(sum(tests) AS BIGINT) AS total_tests
  FROM located JOIN gazetteer ON latitude BETWEEN glat - 3e0 AND glat + 3e0
  AND (longitude BETWEEN glon - 4e0 AND glon + 4e0
       OR (glon - 4e0 < -180e0 AND longitude >= glon - 4e0 + 360e0)
       OR (glon + 4e0 > 180e0 AND longitude <= glon + 4e0 - 360e0))
  GROUP BY name"""
    )
    edges = ", ".join(
        f"({a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)" for ring in RINGS for a, b in zip(ring, (*ring[1:], ring[0]))
    )
    # every tile against every edge, longitudes counted from the place
    in_polygon = (
        _with(
            _TILES, _GAZETTEER, _CLEANED, _LOCATED,
            ("shapes", "SELECT *, 2e0 + ((CAST(floor(glat) AS BIGINT) % 5) + 5) % 5 AS size FROM gazetteer"),
            ("edges", f"SELECT name, glon, size, glat, size*u1 AS x1, glat + size*v1 AS y1, size*u2 AS x2, glat + size*v2 AS y2 "
                      f"FROM shapes, (VALUES {edges}) AS e(u1, v1, u2, v2)"),
            ("spots", "SELECT latitude, longitude, count(*) AS tiles, sum(tests) AS tests FROM located GROUP BY ALL"),
            ("near", "SELECT *, longitude - glon + CASE WHEN longitude - glon > 180e0 THEN -360e0 WHEN longitude - glon < -180e0 "
                     "THEN 360e0 ELSE 0e0 END AS x FROM spots JOIN edges ON latitude < y1 + 12e0"),
            ("inside", "SELECT name, latitude, longitude, any_value(tiles) AS tiles, any_value(tests) AS tests FROM near "
                       "WHERE (x1 > x) <> (x2 > x) AND latitude < y1 + (x - x1) * (y2 - y1) / (x2 - x1) "
                       "GROUP BY name, latitude, longitude HAVING count(*) % 2 = 1"),
        )
        + "SELECT name, CAST(sum(tiles) AS BIGINT) AS tile_count, CAST(sum(tests) AS BIGINT) AS total_tests FROM inside GROUP BY name"
    )
    by_quarter = (
        _QUARTERED + "SELECT quarter, count(*) AS rows, CAST(sum(tests) AS BIGINT) AS total_tests FROM quartered GROUP BY quarter"
    )
    gold = (
        _SILVER
        + """SELECT city, partition_year, partition_month, count(*) AS tile_count,
  CAST(sum(tests) AS BIGINT) AS total_tests, CAST(sum(devices) AS BIGINT) AS total_devices,
  sum(download_mbps * tests) / CAST(sum(tests) AS DOUBLE) AS avg_download_mbps,
  sum(upload_mbps * tests) / CAST(sum(tests) AS DOUBLE) AS avg_upload_mbps,
  CAST(sum(avg_lat_ms * tests) AS DOUBLE) / CAST(sum(tests) AS DOUBLE) AS avg_latency_ms
  FROM silver GROUP BY city, partition_year, partition_month"""
    )
    union = " UNION ALL ".join
    return {
        "scan_bronze": _BRONZE + "SELECT * FROM tiles",
        "list_files": union(
            f"SELECT '{n}.parquet' AS file_name, true AS is_parquet, true AS has_bytes" for n in _FILES
        ),
        "file_count": "SELECT count(*) AS files, count(*) > 0 AS path_exists FROM ("
        + union(f"SELECT '{n}' AS n" for n in _FILES)
        + ")",
        "validate_files": "SELECT count(*) AS total_objects, count(*) AS parquet_files, true AS valid, "
        "string_agg(f, ',' ORDER BY f) FILTER (WHERE f <= 'orders.parquet') AS files FROM ("
        + union(f"SELECT '{n}.parquet' AS f" for n in _FILES)
        + ")",
        "freshness": "SELECT * FROM (VALUES (24, true), (25, false)) x(hours, is_fresh)",
        "read_with_fallback": _BRONZE + "SELECT * FROM tiles",
        "land_two_quarters": by_quarter,
        "land_corrected": by_quarter,
        "scan_bronze_mixed": _BRONZE + "SELECT * FROM tiles",
        "schema_report": _BRONZE
        + """SELECT CASE ((avg_d_kbps % 3) + 3) % 3 WHEN 0 THEN '' WHEN 1 THEN 'devices,tests' ELSE 'devices' END AS missing,
  count(*) AS rows, false AS damaged FROM tiles GROUP BY 1""",
        "scan_landed_quarter": _QUARTERED + "SELECT * EXCLUDE (d, quarter) FROM quartered WHERE quarter = '1995-q2'",
        "scan_bronze_nested": _BRONZE + "SELECT * FROM tiles",
        "rerun_quarter": _SILVER_ROWS,
        "catalog_silver": _SILVER_ROWS,
        "incremental_two_sources": _SILVER_ROWS,
        "incremental_two_runs": _SILVER_ROWS,
        "nearest_city_dense": _with(
            _TILES,
            ("sparse", GAZETTEER_SQL.format(**_TABLES)),
            (
                "gazetteer",
                """SELECT * FROM sparse UNION ALL
  SELECT * REPLACE (40 + glat / 100000 AS glat, -90 + glon / 100000 AS glon) FROM sparse""",
            ),
            _PLACES,
            _CLEANED,
            _LOCATED,
            *_nearest("located"),
        )
        + "SELECT quadkey, tile, city, city_lookup_success FROM with_city",
        "land_bronze": _BRONZE
        + f"""SELECT CASE WHEN d IS NULL THEN 'undated' ELSE {_QUARTER} END AS quarter, count(*) AS rows,
  CAST(sum(tests) AS BIGINT) AS total_tests, count(*) AS rows_with_source
  FROM (SELECT tests, try_cast(CASE WHEN regexp_full_match(substr(trim(tile), 1, 10), '\\d{{4}}-\\d{{2}}-\\d{{2}}')
        THEN substr(trim(tile), 1, 10) END AS DATE) AS d FROM tiles) GROUP BY 1""",
        "landing_manifest": _BRONZE + "SELECT count(*) AS rows, true AS only_parquet FROM tiles",
        "trim_keys": _BRONZE + "SELECT trim(quadkey) AS quadkey, trim(tile) AS tile FROM tiles",
        "filter_quadkey": tiles("length(trim(quadkey)) BETWEEN 1 AND 30"),
        "filter_speed": tiles("avg_d_kbps > 0 AND avg_u_kbps > 0"),
        "filter_latency": tiles("avg_lat_ms >= 0"),
        "filter_counts": tiles("tests > 0 AND devices > 0"),
        "filter_bad_quadkey": tiles(_HAS_LOCATION),
        "flags": _BRONZE + f"SELECT avg_d_kbps, avg_u_kbps, avg_lat_ms, {_FLAGS} FROM tiles",
        "quality_score": _BRONZE + f"SELECT quadkey, avg_d_kbps, avg_u_kbps, {_SCORE} AS data_quality_score FROM tiles",
        "derived_metrics": _BRONZE
        + f"SELECT avg_d_kbps, avg_u_kbps, tests, devices, {_METRICS} FROM tiles WHERE {_CLEAN}",
        "clean": _with(_TILES, _CLEANED) + "SELECT * FROM cleaned",
        "cleaning_report": _BRONZE
        + f"""SELECT n AS initial_rows, k AS cleaned_rows, n - k AS removed_rows,
  round(CASE WHEN n > 0 THEN (n - k) * 100e0 / n ELSE 0e0 END, 6) AS removal_pct
  FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {_CLEAN}) AS k FROM tiles)""",
        "partition_columns": _BRONZE + f"SELECT tile, {_YEAR}, {_MONTH} FROM (SELECT trim(tile) AS tile FROM tiles)",
        "quarter_of": f"SELECT o_orderkey, {_QUARTER} AS quarter FROM (SELECT o_orderkey, o_orderdate AS d FROM orders)",
        "place_preference": f"""SELECT s_suppkey, CASE WHEN city <> '' THEN city WHEN town <> '' THEN town
  WHEN village <> '' THEN village WHEN state <> '' THEN state ELSE coalesce(country, 'Unknown') END AS place
  FROM (SELECT s_suppkey, {_address(4, "concat('city of ', s_name)")} AS city,
  {_address(3, "concat('town of ', s_name)")} AS town, {_address(2, "concat('village of ', s_name)")} AS village,
  {_address(1, 'n_name')} AS state, CASE WHEN s_suppkey % 3 <> 0 THEN r_name END AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
        "quadkey_center": _centers("trim(quadkey)", usable="regexp_full_match(trim(quadkey), '[0-3]+')"),
        "quadkey_center_lenient": _centers("regexp_replace(trim(quadkey), '[^0-3]', '', 'g')"),
        "quadkey_center_mercator": _centers(
            "trim(quadkey)", "mercator", "regexp_full_match(trim(quadkey), '[0-3]+')"
        ),
        "place_index": _with(
            _GAZETTEER,
            _PLACES,
            ("spots", "SELECT DISTINCT glat AS latitude, glon AS longitude FROM gazetteer"),
            *_nearest("spots"),
        )
        + "SELECT latitude, longitude, city, 1e0 AS covered FROM with_city",
        "nearest_city": _SILVER + _CITIES,
        "nearest_city_shuffled": _SILVER + _CITIES,
        "city_unavailable": _with(_TILES)
        + f"""SELECT trim(quadkey) AS quadkey, 'Unknown' AS city, false AS city_lookup_success
  FROM tiles WHERE {_CLEAN} AND {_HAS_LOCATION}""",
        "tiles_in_box": in_box,
        "tiles_in_box_shuffled": in_box,
        "tiles_in_polygons": in_polygon,
        "tiles_in_polygons_shuffled": in_polygon,
        "city_stats": stats,
        "city_stats_sample": _with(
            *_SILVER_PARTS,
            (
                "sample",
                """SELECT * FROM silver ORDER BY quadkey, tile, avg_d_kbps, avg_u_kbps, avg_lat_ms, tests, devices, city
  LIMIT 100""",
            ),
        )
        + f"SELECT city, {_AVERAGES} FROM sample GROUP BY city ORDER BY avg_download_kbps DESC, city LIMIT 20",
        "city_dict_agg": speed,
        "top_cities_download": stats + " ORDER BY avg_download_kbps DESC, city LIMIT 30",
        "top_cities_tiles": stats + " ORDER BY tile_count DESC, city LIMIT 30",
        "top10_cities_mbps": speed + " ORDER BY avg(download_mbps) DESC, city LIMIT 10",
        "describe_tiles": _BRONZE
        + union(_describe(c, "tiles") for c in ("avg_d_kbps", "avg_u_kbps", "avg_lat_ms", "tests", "devices")),
        "describe_text": _BRONZE + union(_describe_text(c) for c in ("quadkey", "tile")),
        "describe_quality": _SILVER
        + union(
            [_describe("data_quality_score", "silver")]
            + [
                _describe(c, "silver", f"CAST({c} AS INTEGER)")
                for c in ("is_outlier_download", "is_outlier_upload", "city_lookup_success")
            ]
        ),
        "quality_histogram": _with(_TILES, _CLEANED)
        + """SELECT data_quality_score, is_outlier_download, is_outlier_upload, is_high_latency, count(*) AS rows
  FROM cleaned GROUP BY ALL""",
        "run_statistics": _SILVER
        + """SELECT b AS bronze_rows, s AS silver_rows, b - s AS filtered_rows, round(s * 100e0 / b, 6) AS retention_pct,
  avg_quality_score, round(found * 100e0 / s, 6) AS city_success_pct, avg_download_mbps, avg_upload_mbps,
  avg_latency_ms, default_partition_rows
  FROM (SELECT (SELECT count(*) FROM tiles) AS b, count(*) AS s, count(*) FILTER (WHERE city_lookup_success) AS found,
  round(avg(data_quality_score), 6) AS avg_quality_score, round(avg(download_mbps), 6) AS avg_download_mbps,
  round(avg(upload_mbps), 6) AS avg_upload_mbps, round(avg(avg_lat_ms), 6) AS avg_latency_ms,
  count(*) FILTER (WHERE coalesce(length(tile) <= 7, true)) AS default_partition_rows FROM silver)""",
        "silver_sample": _SILVER
        + """SELECT quadkey, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, city, download_mbps,
  upload_mbps, avg_lat_ms, data_quality_score, partition_year, partition_month FROM (SELECT * FROM silver
  ORDER BY quadkey, latitude, longitude, city, download_mbps, upload_mbps, avg_lat_ms, data_quality_score,
  partition_year, partition_month LIMIT 10)""",
        "gold_city_month": gold,
        "gold_kept_up": gold,
        "nearest_city_kept": _SILVER + _CITIES,
        "write_silver_roundtrip": _SILVER_ROWS,
        "write_flat_roundtrip": _with(
            _TILES,
            _GAZETTEER,
            _PLACES,
            (
                "lenient",
                f"""SELECT * EXCLUDE (lat, lon, digits), coalesce(lat, 0e0) AS latitude, coalesce(lon, 0e0) AS longitude
  FROM (SELECT *, {_center('digits')}
        FROM (SELECT *, nullif(regexp_replace(quadkey, '[^0-3]', '', 'g'), '') AS digits FROM tiles))""",
            ),
            *_nearest("lenient"),
        )
        + """SELECT * EXCLUDE (city_lookup_success)
  REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM with_city""",
        "scan_silver_pruned": _with(_TILES, _CLEANED)
        + f"""SELECT partition_year, partition_month, count(*) AS rows, CAST(sum(tests) AS BIGINT) AS total_tests
  FROM (SELECT *, {_YEAR}, {_MONTH} FROM cleaned WHERE {_HAS_LOCATION})
  WHERE partition_year = '1995' AND partition_month <= '03' GROUP BY 1, 2""",
        "incremental_silver": _SILVER_ROWS,
    }

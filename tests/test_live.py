"""Loads that replace each other: landed files, mixed layouts, quarters, micro-batches, the catalog."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.test_lake import STAMP, TILES, index, places, same_rows  # noqa: F401
from tilelake.operators import build_place_index
from tilelake.operators.analytics import gold_city_month
from tilelake.operators.geocode import with_cities
from tilelake.plans import bronze_to_silver, kept_cities, locate, read_gold, refresh_gold, to_silver, with_kept_cities
from tilelake.schemas import BRONZE, ORIGIN, PARTITION_COLUMNS
from tilelake.sinks import drop_table, live, read_silver, register_silver, snapshot, write_silver, write_table
from tilelake.sources import check_bronze, land_bronze, landed_files, read_landed, scan_bronze, scan_quarter, schema_report
from tilelake.streaming import incremental_silver, read_incremental

ROWS = [(f"{k:04b}".replace("1", "2"), f"{day}_x", 1024 + k, 512, 10, 5, 2) for k in range(3) for day in ("2019-01-01", "2019-05-01")]


def write(spark, rows, path, **columns):
    """One file of exactly this name."""
    df = spark.createDataFrame(rows, BRONZE).withColumns(columns) if columns else spark.createDataFrame(rows, BRONZE)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    df.toPandas().to_parquet(path, index=False)


def keys(df):
    return sorted((r.quadkey, r.tile) for r in df.select("quadkey", "tile").collect())


def test_a_corrected_and_a_withdrawn_file_leave_their_new_rows(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "landed")
    write(spark, ROWS, f"{raw}/a.parquet")
    write(spark, ROWS[:2], f"{raw}/b c%d.parquet")
    land_bronze(spark, raw, target)
    assert read_landed(spark, target).count() == 8
    write(spark, ROWS[:5:2], f"{raw}/a.parquet")  # three rows in one quarter
    os.remove(f"{raw}/b c%d.parquet")
    land_bronze(spark, raw, target)
    assert read_landed(spark, target).count() == 5  # a file that is only gone stays
    land_bronze(spark, raw, target, withdraw_missing=True)
    assert keys(read_landed(spark, target)) == sorted((r[0], r[1]) for r in ROWS[:5:2])
    assert check_bronze(spark, target, "2019-q1") and not check_bronze(spark, target, "2019-q2")
    assert [r.rows for r in landed_files(spark, target).collect()] == [3]
    write(spark, [], f"{raw}/a.parquet")
    land_bronze(spark, raw, target)
    assert read_landed(spark, target).count() == 0 and scan_bronze(spark, target).count() == 0


def test_a_landing_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "landed")
    write(spark, ROWS, f"{raw}/a.parquet")
    land_bronze(spark, raw, target)
    write(spark, ROWS[:1], f"{raw}/a.parquet")

    def stopped(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(live, "commit", stopped)
        with pytest.raises(RuntimeError, match="lost"):
            land_bronze(spark, raw, target)
    assert read_landed(spark, target).count() == 6 and scan_bronze(spark, target).count() == 6
    os.makedirs(f"{target}/_live/000000000009")  # a snapshot without its last file
    assert read_landed(spark, target).count() == 6
    os.rmdir(f"{target}/_live/000000000009")
    land_bronze(spark, raw, target)
    assert read_landed(spark, target).count() == 1
    assert len([n for n in os.listdir(target) if n.startswith("batch_id=")]) == 1


def test_damaged_files_keep_what_they_had_landed(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "landed")
    write(spark, ROWS, f"{raw}/a.parquet")
    write(spark, ROWS[:1], f"{raw}/b.parquet")
    land_bronze(spark, raw, target)
    with open(f"{raw}/a.parquet", "wb") as f:
        f.write(b"damaged")
    write(spark, ROWS[:3], f"{raw}/b.parquet")
    spark.createDataFrame(ROWS, BRONZE).drop("tests").toPandas().to_parquet(f"{raw}/c.parquet")
    with pytest.raises(ValueError, match="a.parquet cannot be read"):
        land_bronze(spark, raw, target)
    found = {r.source_file.rsplit("/", 1)[1]: (r.rows, r.landed) for r in land_bronze(spark, raw, target, skip_unreadable=True).collect()}
    assert found == {"a.parquet": (0, False), "b.parquet": (3, True), "c.parquet": (0, False)}
    assert read_landed(spark, target).count() == 9


def test_layouts_side_by_side(spark, tmp_path):
    root, raw = str(tmp_path / "root x"), str(tmp_path / "raw")
    write(spark, ROWS[:3], f"{root}/top.parquet")
    write(spark, ROWS[:5], f"{root}/quarter=2019-q1/part.parquet")
    assert scan_bronze(spark, root).count() == 8
    write(spark, ROWS, f"{raw}/a.parquet")
    land_bronze(spark, raw, f"{root}/landed")
    write(spark, ROWS[:4], f"{raw}/a.parquet")
    land_bronze(spark, raw, f"{root}/landed")
    write(spark, ROWS, f"{root}/2019-q3/deep/er/part.parquet", note=F.lit("n"))
    found = scan_bronze(spark, root)
    assert found.count() == 18 and found.filter("note = 'n'").count() == 6
    assert {r[0]: r[1] for r in found.groupBy("quarter").count().collect()} == {None: 9, "2019-q1": 7, "2019-q2": 2}
    origin = {r[0]: r[1] for r in scan_bronze(spark, root, origin=True).groupBy(ORIGIN).count().collect()}
    assert origin == {"2019-q1": 2 + 5 + 2, "2019-q2": 1 + 2, "2019-q3": 6}
    assert scan_quarter(spark, root, "2019-q3").count() == 6


def test_schema_of_every_file(spark, tmp_path):
    root = str(tmp_path / "root")
    write(spark, ROWS, f"{root}/a.parquet")
    write(spark, ROWS, f"{root}/b.parquet", tests=F.col("tests").cast("int"), avg_d_kbps=F.col("avg_d_kbps").cast("smallint"))
    found = scan_bronze(spark, root)
    assert found.count() == 12 and found.schema["tests"].dataType == BRONZE["tests"].dataType
    assert found.agg(F.sum("tests")).first()[0] == 60
    spark.createDataFrame(ROWS[:2], BRONZE).drop("devices").toPandas().to_parquet(f"{root}/lacking.parquet")
    with pytest.raises(ValueError, match=r"Missing required columns: \['devices'\] in 1 files: .*lacking.parquet"):
        scan_bronze(spark, root)
    report = {tuple(r.missing): (r.files, r.rows) for r in schema_report(spark, root).groupBy("missing").agg(F.sum("files").alias("files"), F.sum("rows").alias("rows")).collect()}
    assert report == {(): (2, 12), ("devices",): (1, 2)}
    write(spark, ROWS, f"{root}/lacking.parquet", tests=F.lit("many"))
    with pytest.raises(ValueError, match="Column tests has the types"):
        scan_bronze(spark, root)


def test_full_and_quarter_loads_in_any_order(spark, places, index, tmp_path):  # noqa: F811
    root, silver = str(tmp_path / "root"), str(tmp_path / "silver")
    write(spark, TILES[:2], f"{root}/2019-q1/a.parquet")
    write(spark, TILES[2:], f"{root}/2020-q4/a.parquet")
    every = to_silver(scan_bronze(spark, root), index, STAMP)
    for quarter in ("2020-q4", None, "2019-q1", "2020-q4", None, "2020-q4"):
        bronze_to_silver(spark, root, silver, index=index, processed_at=STAMP, quarter=quarter)
        assert quarter == "2020-q4" and len(keys(read_silver(spark, silver))) == 2 or same_rows(every, read_silver(spark, silver))
    write(spark, TILES[2:3], f"{root}/2020-q4/a.parquet")
    bronze_to_silver(spark, root, silver, index=index, processed_at=STAMP, quarter="2020-q4")
    assert [k for k, _ in keys(read_silver(spark, silver))] == ["0331", "1200", "2130"]
    plan = read_silver(spark, silver).filter("partition_year = '2019'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Join" not in plan
    assert snapshot(spark, silver).filter("live").agg(F.sum("rows")).first()[0] == 3


@pytest.mark.parametrize("old", [["flat"], ["quarter"], ["flat", "quarter"], ["batch"]])
def test_earlier_layouts_are_taken_over(spark, index, tmp_path, old):  # noqa: F811
    path = str(tmp_path / "silver")
    silver = to_silver(spark.createDataFrame(TILES, BRONZE), index, STAMP)
    folders = {"flat": path, "quarter": f"{path}/quarter=2020-q4", "batch": f"{path}/batch_id=7"}
    for layout in old:
        write_table(silver, folders[layout], partitions=PARTITION_COLUMNS, mode="append", fmt="parquet")
    write_silver(silver.limit(0), path, quarter="1999-q9")
    assert read_silver(spark, path).count() == 4 * len(old)
    write_silver(silver, path, quarter="2020-q4")
    assert read_silver(spark, path).count() == {"flat": 3, "quarter": 0, "batch": 4}[old[0]] + 4


def test_the_catalog_has_the_live_rows(spark, index, tmp_path):  # noqa: F811
    path, name = str(tmp_path / "silver"), "live_silver"
    silver = to_silver(spark.createDataFrame(TILES, BRONZE), index, STAMP)
    for quarter in ("2019-q1", None, "2019-q1"):
        write_silver(silver if quarter is None else silver.filter("partition_year = '2019'"), path, quarter=quarter)
        register_silver(spark, name, path)
        assert same_rows(read_silver(spark, path), spark.table(name)) and spark.table(name).count() > 0
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and not spark.catalog.tableExists(f"{name}_files")


def test_two_sources_and_lost_progress(spark, index, tmp_path):  # noqa: F811
    roots, silver = [str(tmp_path / n) for n in ("a", "b")], str(tmp_path / "silver")
    write(spark, TILES[:2], f"{roots[0]}/a.parquet")
    write(spark, TILES[2:], f"{roots[1]}/a.parquet")

    def run(root, progress, **how):
        incremental_silver(spark, root, silver, str(tmp_path / progress), index, STAMP, **how).awaitTermination()
        return read_incremental(spark, silver).count()

    assert [run(r, f"p{i}") for i, r in enumerate(roots)] == [2, 4]
    assert run(roots[0], "p0") == 4
    with pytest.raises(ValueError, match="progress is not in"):
        run(roots[0], "lost")
    with pytest.raises(ValueError, match="another bronze folder"):
        run(roots[0], "p1")
    write(spark, TILES[:1], f"{roots[0]}/b.parquet")
    assert run(f"file://{roots[0]}/", "new", restart=True) == 5
    with pytest.raises(ValueError, match="started anew"):
        run(roots[0], "p0")
    write(spark, TILES[:1], f"{roots[0]}/c.parquet")
    assert run(roots[0], "new") == 6


def test_gold_follows_silver(spark, index, tmp_path):  # noqa: F811
    path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    silver = to_silver(spark.createDataFrame(TILES, BRONZE), index, STAMP)

    def same():
        # sums of multiples of 1/1024 are exact
        return same_rows(gold_city_month(read_silver(spark, path)), read_gold(spark, gold))

    write_silver(silver, path)
    assert refresh_gold(spark, path, gold) == 4 and same()
    assert refresh_gold(spark, path, gold) == 0
    write_silver(silver.filter("partition_year = '2020'").unionByName(silver.filter("partition_year = '2020'")), path, quarter="2020-q4")
    assert refresh_gold(spark, path, gold) == 1 and same()
    write_silver(silver.limit(0), path, quarter="2019-q1")
    assert refresh_gold(spark, path, gold) == 0 and same() and read_gold(spark, gold).agg(F.sum("tile_count")).first()[0] == 3


def test_many_unseen_quadkeys_are_written_where_they_are(spark, index, tmp_path, monkeypatch):  # noqa: F811
    """Neither a join to see whether there are any, nor a shuffle before they are written."""
    kept, written = str(tmp_path / "kept"), []
    located = locate(spark.createDataFrame(TILES, BRONZE), STAMP)

    def recorded(df, *args, **options):
        written.append((df.count(), options.get("rebalance", True)))
        return live.load(df, *args, **options)

    monkeypatch.setattr(kept_cities, "load", recorded)
    monkeypatch.setattr(kept_cities, "_MANY_NEW", 2)
    empty = type(located).isEmpty
    asked = []
    monkeypatch.setattr(type(located), "isEmpty", lambda df: asked.append(df) or empty(df))
    for part in (located.filter("quadkey < '2'"), located, located.filter("quadkey < '2'"), located):
        assert same_rows(with_cities(part, index), with_kept_cities(part, index, kept))
    unseen = [df for df in asked if df.columns == ["quadkey", "latitude", "longitude"]]
    assert written == [(2, False), (2, False)] and len(unseen) == 2
    # few are gathered first
    monkeypatch.setattr(kept_cities, "_MANY_NEW", 3)
    with_kept_cities(located.filter("quadkey < '2'"), index, str(tmp_path / "other"))
    assert written[2:] == [(2, True)]


def test_only_unseen_quadkeys_are_looked_up(spark, index, places, tmp_path):  # noqa: F811
    kept = str(tmp_path / "kept")
    located = locate(spark.createDataFrame(TILES, BRONZE), STAMP)
    expected = with_cities(located, index)

    def added():
        return sorted(r.rows for r in snapshot(spark, kept).filter("live").collect())

    first = located.filter("quadkey < '2'")
    assert same_rows(with_cities(first, index), with_kept_cities(first, index, kept)) and added() == [2]
    for limit in (10**9, 0):
        assert same_rows(expected, with_kept_cities(located, index, kept, limit)) and added() == [2, 2]
    other = build_place_index(places.filter("name <> 'A'"))
    assert same_rows(with_cities(located, other), with_kept_cities(located, other, kept)) and added() == [2, 2, 4]
    assert with_kept_cities(located, None, kept).filter("city = 'Unknown'").count() == 4

"""Scans and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, round_all, rounded, table
from loamline.session import checkpoint_dir
from loamline.sources import sinks, snapshots, tables

ALL = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def scratch(spark) -> str:
    """A new folder next to the checkpoints, on storage all executors share."""
    return f"{checkpoint_dir(spark)}/out-{uuid.uuid4().hex}"


@query(
    "S01_column_scan",
    "SELECT l_orderkey, l_linenumber, round(l_quantity, 6) + 0.0 AS l_quantity FROM lineitem",
)
def column_scan(spark, sf):
    df = tables.read_table(
        spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"]
    )
    return round_all(df)


@query(
    "S02_read_sheets",
    """SELECT 'main' AS sheet, count(*) AS n_rows, count(l_suppkey) AS n_keys FROM lineitem
       UNION ALL SELECT 'coordinates', count(*), count(c_custkey) FROM customer
       UNION ALL SELECT 'dates', count(*), count(o_orderdate) FROM orders""",
)
def read_sheets(spark, sf):
    columns = {
        "main": ["l_suppkey", "l_quantity"], "coordinates": ["c_custkey"],
        "dates": ["o_custkey", "o_orderdate"],
    }
    paths = {"main": "lineitem", "coordinates": "customer", "dates": "orders"}
    sheets = tables.read_sheets(
        spark, {k: f"{sf}/{v}.parquet" for k, v in paths.items()}, columns
    )
    keys = {"main": "l_suppkey", "coordinates": "c_custkey", "dates": "o_orderdate"}
    parts = [
        df.agg(F.lit(k).alias("sheet"), F.count("*").alias("n_rows"), F.count(keys[k]).alias("n_keys"))
        for k, df in sheets.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


RELATIONAL = """SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) + 0.0 AS total
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
GROUP BY n_name"""


@query("S03_relational_views", RELATIONAL.format(orders="orders", customer="customer", nation="nation"))
def relational_views(spark, sf):
    names = ["orders", "customer", "nation"]
    tables.read_tables(spark, {f"src_{n}": f"{sf}/{n}.parquet" for n in names})
    return spark.sql(RELATIONAL.format(**{n: f"src_{n}" for n in names}).replace("+ 0.0", "+ 0D"))


@query(
    "S04_catalog_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
        f"(SELECT count(*) FROM (DESCRIBE {t})) AS n_columns"
        for t in ALL
    ),
)
def catalog_profile(spark, sf):
    return tables.catalog_profile({t: table(spark, sf, t) for t in ALL})


@query(
    "S05_scan_series",
    f"""WITH {S.SERIES}
    SELECT cell_id, ts, round(v, 6) + 0.0 AS v, round(prcp, 6) + 0.0 AS prcp FROM series
    WHERE ts >= TIMESTAMP '1998-01-01' AND ts < TIMESTAMP '1999-01-01'
      AND cell_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
)
def scan_series(spark, sf):
    cells = table(spark, sf, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("cell_id")
    )
    return round_all(
        tables.scan_series(S.series(spark, sf), "1998-01-01", "1999-01-01", ["v", "prcp"], cells)
    )


@query(
    "S06_scan_static",
    'SELECT p_partkey AS cell_id, round(p_retailprice * 0.0001::DOUBLE, 6) + 0.0 AS "AI" FROM part',
)
def scan_static(spark, sf):
    df = table(spark, sf, "part").withColumnRenamed("p_partkey", "cell_id")
    return round_all(tables.scan_static(df, "p_retailprice", "AI", 0.0001))


@query(
    "S07_scan_polygons",
    """SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'ASIA')""",
)
def scan_polygons(spark, sf):
    kept = tables.scan_polygons(S.zones(spark, sf), F.col("lrr").isin("AMERICA", "ASIA"))
    inside = kept.select(F.col("ord").alias("c_nationkey"), F.col("mlra_id").alias("n_name"))
    return table(spark, sf, "customer").join(inside, "c_nationkey").select("c_custkey", "n_name")


MANIFEST = """CASE event_id % 5 WHEN 0 THEN '   ' WHEN 1 THEN '  # ' || event_type
  WHEN 2 THEN '#' ELSE '  ' || event_type || '_' || event_id || '.tif ' END"""


@query(
    "S08_L05_tile_manifest",
    f"""WITH t AS (SELECT trim({MANIFEST}) AS entry FROM events)
        SELECT entry FROM t WHERE entry <> '' AND entry NOT LIKE '#%' ORDER BY entry""",
)
def tile_manifest(spark, sf):
    lines = table(spark, sf, "events").selectExpr(f"{MANIFEST} AS line")
    return tables.sorted_manifest(tables.manifest_lines(lines, "line"))


def pixels(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "concat('t', l_suppkey % 7) AS tile", "l_orderkey AS row", "l_linenumber AS col",
        "l_quantity AS band1", "l_tax AS band2",
    )


@query(
    "S09_scan_tiles",
    """WITH px AS (SELECT 't' || (l_suppkey % 7) AS tile, l_orderkey AS "row", l_linenumber AS col,
                          l_quantity AS band1 FROM lineitem)
       SELECT tile, "row", col, round(band1, 6) + 0.0 AS band1 FROM px
       WHERE tile IN (SELECT 't' || n_nationkey FROM nation WHERE n_regionkey = 2)""",
)
def scan_tiles(spark, sf):
    wanted = table(spark, sf, "nation").where("n_regionkey = 2").selectExpr(
        "concat('t', n_nationkey) AS tile"
    )
    return round_all(tables.scan_tiles(pixels(spark, sf), ["band1"], wanted))


@query(
    "S12_csv_sink",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
              strftime(o_orderdate, '%Y-%m-%d') AS observation_date FROM orders""",
)
def csv_sink(spark, sf):
    path = scratch(spark)
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("observation_date")
    )
    sinks.write_table(df, path)
    return tables.read_table(
        spark, path, schema="o_orderkey STRING, observation_date STRING", fmt="csv"
    )


@query(
    "S13_covariate_sink",
    f"""WITH {S.POINTS} SELECT point_id, round(lat, 6) + 0.0 AS lat,
        strftime(cutoff, '%Y-%m-%d') AS covariate_cutoff_date FROM points""",
)
def covariate_sink(spark, sf):
    path = scratch(spark)
    points = S.points(spark, sf).withColumnRenamed("cutoff", "covariate_cutoff_date")
    sinks.write_covariates(points.select("point_id", "lat", "covariate_cutoff_date"), path)
    back = spark.read.parquet(path)
    return round_all(
        back.select("point_id", "lat", F.col("covariate_cutoff_date").cast("date"))
    )


def map_pixels(spark, sf):
    value = F.col("band1")
    return pixels(spark, sf).withColumns(
        {"depth_cm": 5.0 * F.col("col"), "valid_data_mask": F.when(value > 10, 1.0).otherwise(-9999.0)}
    )


MAP_PIXELS = """px AS (
  SELECT 't' || (l_suppkey % 7) AS tile, l_orderkey AS "row", l_linenumber AS col,
         l_quantity AS band1, l_tax AS band2, 5.0::DOUBLE * l_linenumber AS depth_cm,
         CASE WHEN l_quantity > 10 THEN 1.0::DOUBLE ELSE -9999.0::DOUBLE END AS valid_data_mask
  FROM lineitem)"""


@query(
    "S15_map_sink",
    f"""WITH {MAP_PIXELS} SELECT tile, depth_cm, count(*) AS n, round(sum(band1), 6) + 0.0 AS total
        FROM px GROUP BY tile, depth_cm""",
)
def map_sink(spark, sf):
    path = scratch(spark)
    pixels_ = map_pixels(spark, sf)
    snapshots.publish(pixels_.where("row % 2 = 0"), path)
    snapshots.publish(pixels_.where("row % 2 = 1"), path)
    # One depth is published again in place of the former; the other pairs stay.
    snapshots.publish(pixels_.where("depth_cm = 5"), path, replace=True)
    back = snapshots.read_snapshot(spark, path, pixels_.schema)
    return back.groupBy("tile", "depth_cm").agg(
        F.count("*").alias("n"), rounded(F.sum("band1")).alias("total")
    )


EXACT = "CAST(CAST({c} AS DECIMAL(38,10)) AS VARCHAR)"
NAMED = " || ',' || ".join(['CAST("row" AS VARCHAR)', "CAST(col AS VARCHAR)", *[EXACT.format(c=c) for c in ("band1", "band2", "valid_data_mask")]])


@query(
    "S16_output_qc",
    f"""WITH {MAP_PIXELS},
        leaf AS (
          SELECT depth_cm, tile, count(*) AS n_pixels, count(*) FILTER (valid_data_mask = 1) AS n_valid,
                 CAST(sum(('0x' || substr(sha256({NAMED}), 1, 15))::BIGINT::HUGEINT) AS VARCHAR) AS fingerprint
          FROM px GROUP BY depth_cm, tile),
        leaves AS (
          SELECT *, substr(sha256(tile), 1, 3) AS branch,
                 sha256(tile || '|' || {EXACT.format(c='depth_cm')} || '|' || n_pixels || '|' || fingerprint) AS digest FROM leaf),
        branches AS (SELECT depth_cm, branch, sum(n_pixels) AS n_pixels, sha256(string_agg(digest, '' ORDER BY tile)) AS digest
                     FROM leaves GROUP BY depth_cm, branch),
        depths AS (SELECT depth_cm, sum(n_pixels) AS n_pixels, sha256(string_agg(digest, '' ORDER BY branch)) AS digest
                   FROM branches GROUP BY depth_cm)
        SELECT 'tile' AS level, depth_cm, tile, n_pixels, n_valid, fingerprint, digest FROM leaves
        UNION ALL SELECT 'depth', depth_cm, NULL, n_pixels::BIGINT, NULL, NULL, digest FROM depths
        UNION ALL SELECT 'map', NULL, NULL, sum(n_pixels)::BIGINT, NULL, NULL, sha256(string_agg(digest, '' ORDER BY depth_cm))
        FROM depths""",
)
def output_qc(spark, sf):
    """Counts and fingerprints by tile and depth, and the digests of tiles, depths and map."""
    maps = map_pixels(spark, sf)
    bands = ["band1", "band2", "valid_data_mask"]
    tree = snapshots.merkle(maps, bands).where("level <> 'branch'")
    qc = sinks.output_qc(maps, bands).drop("n_pixels")
    joined = tree.join(qc, ["tile", "depth_cm"], "left")
    return joined.select("level", "depth_cm", "tile", "n_pixels", "n_valid", "fingerprint", "digest")

"""Soil-shaped tables made from the driver tables, in Spark and as SQL text.

The driver tables hold no soil data, so each operator runs on a restatement of them: sites
are customers, horizons are order lines, image series are order lines per supplier, and so
on. The SQL texts say the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table


def lon_of(key: Column) -> Column:
    return F.when(key % 97 == 0, F.lit(0.0)).otherwise(
        F.lit(-125.0) + F.lit(58.0) * ((key * 7919) % 10007) / F.lit(10007.0)
    )


def lat_of(key: Column) -> Column:
    return F.when(key % 97 == 0, F.lit(0.0)).otherwise(
        F.lit(25.0) + F.lit(24.0) * ((key * 104729) % 10009) / F.lit(10009.0)
    )


def lon_sql(key: str) -> str:
    return (
        f"CASE WHEN {key} % 97 = 0 THEN 0.0::DOUBLE "
        f"ELSE -125.0::DOUBLE + 58.0::DOUBLE * (({key} * 7919) % 10007) / 10007.0::DOUBLE END"
    )


def lat_sql(key: str) -> str:
    return (
        f"CASE WHEN {key} % 97 = 0 THEN 0.0::DOUBLE "
        f"ELSE 25.0::DOUBLE + 24.0::DOUBLE * (({key} * 104729) % 10009) / 10009.0::DOUBLE END"
    )


def sites(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("site_id"), lat_of(key).alias("lat"), lon_of(key).alias("lon"),
        F.col("c_mktsegment").alias("landuse"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )


SITES = f"""sites AS (
  SELECT c_custkey AS site_id, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon,
         c_mktsegment AS landuse, c_nationkey AS nation, c_acctbal AS balance
  FROM customer)"""


def horizons(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as horizons, with the order's customer as site and its date."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey",
        "l_returnflag",
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    line = F.col("l_linenumber")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.col("o_custkey").alias("site_id"), lat_of(F.col("o_custkey")).alias("lat"),
        lon_of(F.col("o_custkey")).alias("lon"),
        (10.0 * (line - 1)).alias("top_cm"), (10.0 * line).alias("bottom_cm"),
        (F.col("l_quantity") / 4).alias("c_tot"),
        F.when(F.col("l_tax") > 0, F.col("l_discount") * 100).alias("caco3"),
        F.when(F.col("l_tax") < 0.07, 0.8 + F.col("l_tax") * 10).alias("bd"),
        F.col("o_orderdate").cast("date").alias("observation_date"),
    )


HORIZONS = f"""horizons AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, o_custkey AS site_id,
         {lat_sql('o_custkey')} AS lat, {lon_sql('o_custkey')} AS lon,
         10.0::DOUBLE * (l_linenumber - 1) AS top_cm, 10.0::DOUBLE * l_linenumber AS bottom_cm,
         l_quantity / 4 AS c_tot, CASE WHEN l_tax > 0 THEN l_discount * 100 END AS caco3,
         CASE WHEN l_tax < 0.07::DOUBLE THEN 0.8::DOUBLE + l_tax * 10 END AS bd,
         CAST(o_orderdate AS DATE) AS observation_date
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as one image series per supplier."""
    tmin = 20.0 * F.col("l_discount") / 0.1
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("cell_id"), F.col("l_shipdate").alias("ts"),
        (F.col("l_extendedprice") / 997).alias("v"), F.col("l_linenumber").alias("qa"),
        F.col("l_quantity").alias("prcp"), tmin.alias("tmin"),
        (tmin + 100.0 * F.col("l_tax")).alias("tmax"), (F.col("l_tax") * 10000).alias("vp"),
    )


SERIES = """series AS (
  SELECT l_suppkey AS cell_id, l_shipdate AS ts, l_extendedprice / 997 AS v, l_linenumber AS qa,
         l_quantity AS prcp, 20.0::DOUBLE * l_discount / 0.1::DOUBLE AS tmin,
         20.0::DOUBLE * l_discount / 0.1::DOUBLE + 100.0::DOUBLE * l_tax AS tmax,
         l_tax * 10000 AS vp
  FROM lineitem)"""


def masked(df: DataFrame) -> DataFrame:
    """The series with its value masked where the two low quality bits are set."""
    from loamline.functions.spectral import low_bits_clear

    return df.withColumn("v", F.when(low_bits_clear(F.col("qa"), 2), F.col("v")))


MASKED = SERIES + """, masked AS (
  SELECT cell_id, ts, CASE WHEN (qa & 2) = 0 THEN v END AS v, qa, prcp, tmin, tmax, vp FROM series)"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as points: a supplier's cell, and a cutoff date within two years."""
    cells = table(spark, sf, "supplier").count()
    key = F.col("c_custkey")
    month = F.add_months(F.lit("2000-07-01").cast("date"), -(key % 24).cast("int"))
    return table(spark, sf, "customer").select(
        key.alias("point_id"), lat_of(key).alias("lat"), lon_of(key).alias("lon"),
        (key % cells).alias("cell_id"), F.date_add(month, (key % 28).cast("int")).alias("cutoff"),
    )


POINTS = f"""points AS (
  SELECT c_custkey AS point_id, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon,
         c_custkey % (SELECT count(*) FROM supplier) AS cell_id,
         CAST(DATE '2000-07-01' - to_months(CAST(c_custkey % 24 AS INTEGER)) AS DATE)
           + CAST(c_custkey % 28 AS INTEGER) AS cutoff
  FROM customer), targets AS (SELECT DISTINCT cell_id, cutoff FROM points)"""


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as observed and predicted values with an error scale."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        lat_of(F.col("l_suppkey")).alias("lat"), lon_of(F.col("l_suppkey")).alias("lon"),
        F.when(F.col("l_discount") < 0.1, 10.0 * (F.col("l_linenumber") - 1)).alias("z_mid"),
        (F.col("l_quantity") / 4).alias("observed"),
        F.when(F.col("l_tax") < 0.08, F.col("l_extendedprice") / 8999).alias("predicted"),
        (1 + F.col("l_tax") * 10).alias("scale"), F.col("l_returnflag").alias("dataset"),
    )


PAIRS = f"""pairs AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         {lat_sql('l_suppkey')} AS lat, {lon_sql('l_suppkey')} AS lon,
         CASE WHEN l_discount < 0.1::DOUBLE THEN 10.0::DOUBLE * (l_linenumber - 1) END AS z_mid,
         l_quantity / 4 AS observed,
         CASE WHEN l_tax < 0.08::DOUBLE THEN l_extendedprice / 8999 END AS predicted,
         1 + l_tax * 10 AS scale, l_returnflag AS dataset
  FROM lineitem)"""


def bands(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as reflectance of six bands; the label is the cell."""
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(5)]
    df = table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("bigint").alias("cell_id"),
        F.date_add(F.lit("1999-07-01").cast("date"), (F.col("vec_id") % 500).cast("int"))
        .cast("timestamp_ntz").alias("ts"),
        F.lit(0.06).alias("blue"), *[e[i].alias(f"e{i}") for i in range(5)],
        F.when(F.col("vec_id") % 10 == 0, 8).when(F.col("vec_id") % 10 == 1, 2)
        .otherwise(64).alias("pixel_qa"),
    )
    df = df.withColumn("green", F.col("blue") + 0.02 + 0.1 * F.col("e0"))
    df = df.withColumn("red", F.col("green") + 0.02 + 0.1 * F.col("e1"))
    df = df.withColumn("nir", F.col("red") + 0.02 + 0.1 * F.col("e2"))
    df = df.withColumn("swir1", F.col("nir") + 0.02 + 0.1 * F.col("e3"))
    df = df.withColumn("swir2", F.col("swir1") + 0.1 * F.col("e4"))
    return df.drop(*[f"e{i}" for i in range(5)])


BANDS_SQL = """raw_bands AS (
  SELECT vec_id, label::BIGINT AS cell_id,
         (DATE '1999-07-01' + CAST(vec_id % 500 AS INTEGER))::TIMESTAMP AS ts,
         0.06::DOUBLE AS blue, embedding[1]::DOUBLE AS e0, embedding[2]::DOUBLE AS e1,
         embedding[3]::DOUBLE AS e2, embedding[4]::DOUBLE AS e3, embedding[5]::DOUBLE AS e4,
         CASE WHEN vec_id % 10 = 0 THEN 8 WHEN vec_id % 10 = 1 THEN 2 ELSE 64 END AS pixel_qa
  FROM embeddings),
b1 AS (SELECT *, blue + 0.02::DOUBLE + 0.1::DOUBLE * e0 AS green FROM raw_bands),
b2 AS (SELECT *, green + 0.02::DOUBLE + 0.1::DOUBLE * e1 AS red FROM b1),
b3 AS (SELECT *, red + 0.02::DOUBLE + 0.1::DOUBLE * e2 AS nir FROM b2),
b4 AS (SELECT *, nir + 0.02::DOUBLE + 0.1::DOUBLE * e3 AS swir1 FROM b3),
bands AS (SELECT *, swir1 + 0.1::DOUBLE * e4 AS swir2 FROM b4)"""

FLAGGED = BANDS_SQL + """,
clear_bands AS (
  SELECT vec_id, cell_id, ts, (pixel_qa & 58) = 0 AS clear,
         CASE WHEN (pixel_qa & 58) = 0 THEN blue END AS blue,
         CASE WHEN (pixel_qa & 58) = 0 THEN green END AS green,
         CASE WHEN (pixel_qa & 58) = 0 THEN red END AS red,
         CASE WHEN (pixel_qa & 58) = 0 THEN nir END AS nir,
         CASE WHEN (pixel_qa & 58) = 0 THEN swir1 END AS swir1,
         CASE WHEN (pixel_qa & 58) = 0 THEN swir2 END AS swir2
  FROM bands),
flagged AS (
  SELECT *, CASE WHEN clear THEN
      (nir - red) / nullif(nir + red, 0) BETWEEN -0.10::DOUBLE AND 0.25::DOUBLE
      AND (swir1 - swir2) / nullif(swir1 + swir2, 0) > -0.10::DOUBLE
      AND (swir1 - swir2) / nullif(swir1 + swir2, 0) <= 0.10::DOUBLE
      AND blue < green AND green < red AND red < nir AND nir < swir1
      AND swir2 > blue AND red > 0.05::DOUBLE END AS is_soil
  FROM clear_bands)"""


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as zones on a 5 x 5 raster: rectangles, or triangles in odd regions; the last
    nations of a region also lie over their neighbours, so order matters."""
    k = F.col("n_nationkey")
    grow = F.when(k % 5 == 4, F.lit(6.0)).otherwise(F.lit(0.0))
    x0 = F.lit(-125.0) + F.lit(11.6) * (k % 5) - grow
    y0 = F.lit(25.0) + F.lit(4.8) * F.floor(k / 5)
    x1, y1 = x0 + F.lit(11.6) + grow, y0 + F.lit(4.8)

    def p(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    box = F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1))
    wedge = F.array(p(x0, y0), p(x1, y0), p(x1, y1))
    return (
        table(spark, sf, "nation").join(
            F.broadcast(table(spark, sf, "region")),  # five rows
            F.col("n_regionkey") == F.col("r_regionkey"),
        )
        .select(
            k.cast("bigint").alias("zone_id"), k.alias("ord"), F.col("n_name").alias("mlra_id"),
            F.col("r_name").alias("lrr"), k.alias("aez_id"), F.col("n_regionkey").alias("aez_groupid"),
            F.when(F.col("n_regionkey") % 2 == 0, box).otherwise(wedge).alias("ring"),
        )
    )


ZONES = """corners AS (
  SELECT n_nationkey AS k, n_name, r_name, n_regionkey,
         -125.0::DOUBLE + 11.6::DOUBLE * (n_nationkey % 5)
           - CASE WHEN n_nationkey % 5 = 4 THEN 6.0::DOUBLE ELSE 0.0::DOUBLE END AS x0,
         25.0::DOUBLE + 4.8::DOUBLE * (n_nationkey // 5) AS y0,
         CASE WHEN n_nationkey % 5 = 4 THEN 6.0::DOUBLE ELSE 0.0::DOUBLE END AS grow
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ends AS (SELECT *, x0 + 11.6::DOUBLE + grow AS x1, y0 + 4.8::DOUBLE AS y1 FROM corners),
edges AS (
  SELECT k, x0 AS ax, y0 AS ay, x1 AS bx, y0 AS by_ FROM ends
  UNION ALL SELECT k, x1, y0, x1, y1 FROM ends
  UNION ALL SELECT k, x1, y1, x0, y1 FROM ends WHERE n_regionkey % 2 = 0
  UNION ALL SELECT k, x0, y1, x0, y0 FROM ends WHERE n_regionkey % 2 = 0
  UNION ALL SELECT k, x1, y1, x0, y0 FROM ends WHERE n_regionkey % 2 = 1),
hits AS (
  SELECT s.site_id, e.k
  FROM sites s CROSS JOIN edges e
  WHERE (e.ay <= s.lat) <> (e.by_ <= s.lat)
    AND s.lon < e.ax + (s.lat - e.ay) * (e.bx - e.ax) / (e.by_ - e.ay)
  GROUP BY s.site_id, e.k HAVING count(*) % 2 = 1)"""


def elevation(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as an elevation raster of 50 columns."""
    key = F.col("p_partkey")
    return table(spark, sf, "part").select(
        key.alias("cell_id"), F.floor(key / 50).alias("row"), (key % 50).alias("col"),
        F.when(F.col("p_size") != 50, F.col("p_retailprice")).alias("elv"),
    )

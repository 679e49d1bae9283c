"""Coercions, predicates, labels and scalar formulas."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, round_all, table
from loamline.functions import clean, intervals, physical, spatial, spectral, windows
from loamline.operators import encode, stack

# --- coercions -------------------------------------------------------------------------

NUMBER_TEXT = """CASE event_id % 4 WHEN 0 THEN event_type
  WHEN 1 THEN ' ' || CAST(event_id AS {text}) || '.25 ' WHEN 2 THEN '-1.5e2'
  ELSE substr(props, 7, length(props) - 7) END"""


@query(
    "P01_to_number",
    f"SELECT event_id, round(try_cast(trim({NUMBER_TEXT.format(text='VARCHAR')}) AS DOUBLE), 6) + 0.0"
    " AS number FROM events",
)
def to_number(spark, sf):
    text = F.expr(NUMBER_TEXT.format(text="STRING"))
    return round_all(
        table(spark, sf, "events").select("event_id", clean.to_number(text).alias("number"))
    )


@query(
    "P02_to_day",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS day
       FROM events""",
)
def to_day(spark, sf):
    text = (
        F.when(F.col("event_id") % 3 == 0, F.col("event_type"))
        .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return round_all(table(spark, sf, "events").select("event_id", clean.to_day(text).alias("day")))


@query(
    "P03_mixed_date",
    """SELECT event_id, CASE WHEN event_id % 4 < 2 THEN strftime(ts, '%Y-%m-%d') END AS day
       FROM events""",
)
def mixed_date(spark, sf):
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_id") % 4 == 1, F.expr("string(datediff(ts, DATE'1970-01-01') * 86400L + hour(ts) * 3600)"))
        .when(F.col("event_id") % 4 == 2, F.col("event_type"))
        .otherwise(F.lit("  "))
    )
    return round_all(
        table(spark, sf, "events").select("event_id", clean.mixed_date(text).alias("day"))
    )


# --- predicates and labels -------------------------------------------------------------

@query(
    "P04_P05_valid_rows",
    f"""WITH {S.SITES} SELECT site_id FROM sites
        WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0)
          AND balance >= 0""",
)
def valid_rows(spark, sf):
    return S.sites(spark, sf).where(
        clean.valid_coord(F.col("lat"), F.col("lon")) & clean.non_negative(F.col("balance"))
    ).select("site_id")


@query(
    "P06_P08_range_and_dates",
    f"""WITH {S.HORIZONS} SELECT l_orderkey, l_linenumber, round(c_tot, 6) + 0.0 AS c_tot FROM horizons
        WHERE c_tot >= 0 AND c_tot < 12.5
          AND observation_date BETWEEN DATE '1996-05-01' AND DATE '1998-01-31'""",
)
def range_and_dates(spark, sf):
    df = S.horizons(spark, sf).where(
        clean.measure_range(F.col("c_tot"), 0, 12.5)
        & clean.date_between(F.col("observation_date"), "1996-05-01", "1998-01-31")
    )
    return round_all(df.select("l_orderkey", "l_linenumber", "c_tot"))


@query(
    "P07_carbonate_correct",
    f"""WITH {S.HORIZONS} SELECT l_orderkey, l_linenumber, l_partkey,
        round(CASE WHEN (CASE WHEN caco3 > 0 THEN c_tot - 0.12::DOUBLE * 10 * caco3 ELSE c_tot END) < 0
                   THEN 0.0::DOUBLE
              WHEN caco3 > 0 THEN c_tot - 0.12::DOUBLE * 10 * caco3 ELSE c_tot END, 6) + 0.0 AS soc
        FROM horizons""",
)
def carbonate_correct(spark, sf):
    soc = clean.carbonate_correct(F.col("c_tot"), F.col("caco3"), 0.12 * 10)
    return round_all(
        S.horizons(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", soc.alias("soc"))
    )


@query(
    "P09_valid_target",
    f"""WITH {S.HORIZONS} SELECT l_orderkey, l_linenumber, round(bd, 6) + 0.0 AS bd FROM horizons
        WHERE coalesce(caco3 > 2, FALSE) AND bd IS NOT NULL AND bd <= 1.4""",
)
def valid_target(spark, sf):
    df = S.horizons(spark, sf).where(
        clean.valid_flag(F.col("caco3") > 2) & clean.is_true(F.col("bd") <= 1.4)
    )
    return round_all(df.select("l_orderkey", "l_linenumber", "bd"))


@query("P10_drop_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def drop_duplicates(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query(
    "P11_select_rename",
    """SELECT l_orderkey AS sample_id, l_linenumber AS layer, round(l_quantity, 6) + 0.0 AS top_cm
       FROM lineitem""",
)
def select_rename(spark, sf):
    from loamline.schema import require_safe_names

    df = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS sample_id", "l_linenumber AS layer", "l_quantity AS top_cm"
    )
    return round_all(require_safe_names(df))


@query(
    "P12_rule_label",
    f"""WITH {S.SITES}, named AS (
          SELECT site_id, lat, lon, CASE WHEN site_id % 5 = 0 THEN NULL
            WHEN site_id % 5 = 1 THEN 'S2018KS' || site_id WHEN site_id % 5 = 2 THEN 'S2019MN' || site_id
            ELSE 'P' || site_id END AS pedon,
            CASE WHEN landuse = 'BUILDING' THEN 'OSU' WHEN landuse = 'MACHINERY' THEN NULL
            ELSE landuse END AS project FROM sites)
        SELECT site_id, CASE WHEN starts_with(pedon, 'S2018KS') THEN 'KansasState'
          WHEN starts_with(pedon, 'S2019MN') THEN 'UnivOfMinnesota'
          WHEN lat > 45 AND lon < -110 THEN 'WashingtonState'
          WHEN lon BETWEEN -82 AND -75 AND lat BETWEEN 33 AND 37 THEN 'NCState'
          WHEN lon < -100 AND lat < 37 THEN 'TexasA&MPt-1'
          WHEN project = 'OSU' THEN 'OregonState' ELSE project END AS proxy_project FROM named""",
)
def rule_label(spark, sf):
    from loamline.plans.observations import proxy_project

    k = F.col("site_id")
    pedon = (
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.concat(F.lit("S2018KS"), k))
        .when(k % 5 == 2, F.concat(F.lit("S2019MN"), k)).otherwise(F.concat(F.lit("P"), k))
    )
    project = (
        F.when(F.col("landuse") == "BUILDING", "OSU")
        .when(F.col("landuse") == "MACHINERY", F.lit(None)).otherwise(F.col("landuse"))
    )
    return S.sites(spark, sf).select(
        "site_id", proxy_project(pedon, F.col("lat"), F.col("lon"), project).alias("proxy_project")
    )


@query(
    "P13_coalesce_with_source",
    f"""WITH {S.HORIZONS} SELECT l_orderkey, l_linenumber, l_partkey,
        round(coalesce(caco3, bd), 6) + 0.0 AS value,
        CASE WHEN caco3 IS NOT NULL THEN 'caco3' WHEN bd IS NOT NULL THEN 'bd' ELSE 'missing' END AS origin
        FROM horizons""",
)
def coalesce_with_source(spark, sf):
    value, origin = clean.coalesce_with_source(
        [(F.col("caco3"), "caco3"), (F.col("bd"), "bd")], "missing"
    )
    return round_all(
        S.horizons(spark, sf).select(
            "l_orderkey", "l_linenumber", "l_partkey", value.alias("value"), origin.alias("origin")
        )
    )


@query(
    "P14_P15_F03_depths",
    f"""WITH {S.PAIRS} SELECT l_orderkey, l_linenumber, l_partkey,
        round((z_mid + z_mid + 10) / 2, 6) + 0.0 AS mid,
        CASE WHEN z_mid < 30 THEN '0–30 cm' ELSE '>30 cm' END AS depth_group,
        CAST(floor(z_mid / 10) AS BIGINT) AS depth_bin FROM pairs""",
)
def depths(spark, sf):
    z = F.col("z_mid")
    return round_all(
        S.pairs(spark, sf).select(
            "l_orderkey", "l_linenumber", "l_partkey", clean.depth_mid(z, z + 10).alias("mid"),
            clean.depth_group(z).alias("depth_group"), clean.depth_bin(z).alias("depth_bin"),
        )
    )


COVER = "(CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 10 + (p_partkey % 90) END)"


@query(
    "P19_land_use_group",
    f"""SELECT p_partkey, CAST(CASE WHEN {COVER} IS NULL THEN NULL WHEN {COVER} IN (81, 82) THEN 1
        WHEN {COVER} BETWEEN 41 AND 43 THEN 2 WHEN {COVER} IN (52, 71) THEN 3 ELSE 4 END AS SMALLINT)
        AS land_use FROM part""",
)
def land_use_group(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", encode.land_use_group(F.expr(COVER)).alias("land_use")
    )


@query(
    "P20_decode_codes",
    """SELECT p_partkey, CASE CAST(round_even(p_size / 2, 0) AS INTEGER)
         WHEN 1 THEN 'C' WHEN 2 THEN 'F' WHEN 3 THEN 'R' WHEN 4 THEN 'X' END AS land_use
       FROM part""",
)
def decode_codes(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", encode.decode_codes(F.col("p_size") / 2, encode.LAND_USE).alias("land_use")
    )


MIXED_ID = "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN lang ELSE source || lang || '-' || doc_id END"


@query(
    "P21_numeric_id",
    f"""WITH d AS (SELECT doc_id, regexp_replace(coalesce({MIXED_ID}, ''), '[^0-9]', '', 'g') AS digits
        FROM documents) SELECT doc_id, CASE WHEN length(digits) > 0 THEN CAST(digits AS BIGINT)
        ELSE -999::BIGINT END AS number FROM d""",
)
def numeric_id(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", clean.numeric_id(F.expr(MIXED_ID)).alias("number")
    )


@query(
    "P22_P30_P31_nodata",
    f"""WITH {S.HORIZONS} SELECT l_orderkey, l_linenumber, l_partkey,
        coalesce(round(caco3, 6) + 0.0, -9999.0::DOUBLE) AS caco3,
        coalesce(round(bd, 6) + 0.0, -9999.0::DOUBLE) AS bd, -9999.0::DOUBLE AS fire_freq_win,
        250 AS extraction_scale_m FROM horizons""",
)
def nodata(spark, sf):
    df = stack.ensure_bands(S.horizons(spark, sf), ["bd", "fire_freq_win"])
    df = stack.tag(
        stack.fill_nodata(df, ["caco3", "bd", "fire_freq_win"]), extraction_scale_m=250
    )
    return round_all(
        df.select(
            "l_orderkey", "l_linenumber", "l_partkey", "caco3", "bd", "fire_freq_win", "extraction_scale_m"
        )
    )


@query(
    "P23_valid_mask",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       NOT (l_quantity = 50 OR l_tax = 0 OR l_discount = 0.05::DOUBLE OR l_discount = 0) AS valid
       FROM lineitem""",
)
def valid_mask(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_quantity") == 50, -9999.0).otherwise(F.col("l_quantity")).alias("a"),
        F.when(F.col("l_tax") == 0, float("nan")).otherwise(F.col("l_tax")).alias("b"),
        F.when(F.col("l_discount") == 0, float("inf"))
        .otherwise(F.col("l_discount")).alias("c"),
    )
    return stack.valid_mask(df, ["a", "b", "c"], {"c": 0.05}).drop("a", "b", "c")


@query(
    "P24_P25_P26_masks",
    f"""WITH {S.SERIES} SELECT cell_id, ts,
        round(CASE WHEN qa = 3 THEN v * 0.0001::DOUBLE END, 6) + 0.0 AS by_code,
        round(CASE WHEN (qa & 3) = 0 THEN v * 0.1::DOUBLE END, 6) + 0.0 AS by_low_bits,
        round(CASE WHEN (qa & 58) = 0 THEN v * 0.0000275::DOUBLE - 0.2::DOUBLE END, 6) + 0.0 AS by_bits,
        round(v * 0.00341802::DOUBLE + 149, 6) + 0.0 AS thermal,
        round(v - 273.15::DOUBLE, 6) + 0.0 AS celsius, round(v, 6) + 0.0 AS unmasked FROM series""",
)
def masks(spark, sf):
    v, qa = F.col("v"), F.col("qa")
    return round_all(
        S.series(spark, sf).select(
            "cell_id", "ts",
            physical.rescale(spectral.qa_equals(v, qa, 3), 0.0001).alias("by_code"),
            F.when(spectral.low_bits_clear(qa), physical.rescale(v, 0.1)).alias("by_low_bits"),
            spectral.mask_bits(physical.rescale(v, 0.0000275, -0.2), qa, spectral.PIXEL_QA_BITS).alias("by_bits"),
            physical.rescale(v, 0.00341802, 149.0).alias("thermal"),
            physical.celsius(v).alias("celsius"), spectral.qa_optional(v, None).alias("unmasked"),
        )
    )


@query(
    "P28_before_cutoff",
    """SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-05'
       AND o_orderdate < TIMESTAMP '1998-06-05'""",
)
def before_cutoff(spark, sf):
    cutoff = F.lit("1998-06-05").cast("date")
    return table(spark, sf, "orders").where(
        windows.in_window(F.col("o_orderdate"), windows.years_before(cutoff, 1), cutoff)
    ).select("o_orderkey")


@query(
    "P29_load_points",
    f"""WITH {S.POINTS}, doubled AS (
          SELECT point_id, lat, lon, cutoff FROM points UNION ALL
          SELECT point_id, lat + 1, lon, cutoff FROM points WHERE point_id % 10 = 3)
        SELECT point_id, round(min(lat), 6) + 0.0 AS lat, round(min(lon), 6) + 0.0 AS lon,
               strftime(min(cutoff), '%Y-%m-%d') AS covariate_cutoff_date
        FROM doubled GROUP BY point_id""",
)
def load_points(spark, sf):
    points = S.points(spark, sf).withColumnRenamed("cutoff", "covariate_cutoff_date")
    extra = points.where(F.col("point_id") % 10 == 3).withColumn("lat", F.col("lat") + 1)
    text = points.unionByName(extra).withColumns(
        {c: F.col(c).cast("string") for c in ("lat", "lon")}
    )
    return round_all(stack.load_points(text))


@query(
    "P32_at_depths",
    """SELECT p_partkey, d AS z_mid FROM part
       CROSS JOIN (VALUES (5.0::DOUBLE), (15.0::DOUBLE), (30.0::DOUBLE), (60.0::DOUBLE), (100.0::DOUBLE)) t(d)""",
)
def at_depths(spark, sf):
    return stack.at_depths(table(spark, sf, "part").select("p_partkey"), (5, 15, 30, 60, 100))


# --- formulas --------------------------------------------------------------------------

R = "6378137.0::DOUBLE"
MERCATOR_X = f"{R} * radians(lon)"
MERCATOR_Y = (
    f"CASE WHEN lat IS NOT NULL THEN {R} * ln(tan({math.pi / 4!r}::DOUBLE "
    "+ radians(greatest(least(lat, 85.05112878::DOUBLE), -85.05112878::DOUBLE)) / 2)) END"
)


@query(
    "F01_F02_web_mercator",
    f"""WITH {S.SITES}, far AS (
          SELECT site_id, lon, CASE WHEN site_id % 31 = 0 THEN 89.0::DOUBLE WHEN site_id % 37 = 0
            THEN -89.0::DOUBLE WHEN site_id % 41 = 0 THEN NULL ELSE lat END AS lat FROM sites)
        SELECT site_id, round({MERCATOR_X}, 3) + 0.0 AS x, round({MERCATOR_Y}, 3) + 0.0 AS y,
        CAST(floor({MERCATOR_X} / 250) AS BIGINT) AS pixel_x,
        CAST(floor({MERCATOR_Y} / 250) AS BIGINT) AS pixel_y FROM far""",
)
def web_mercator(spark, sf):
    k = F.col("site_id")
    lat = (
        F.when(k % 31 == 0, 89.0).when(k % 37 == 0, -89.0).when(k % 41 == 0, F.lit(None))
        .otherwise(F.col("lat"))
    )
    x, y = spatial.web_mercator(F.col("lon"), lat)
    df = S.sites(spark, sf).select(
        "site_id", x.alias("x"), y.alias("y"), spatial.pixel_id(x).alias("pixel_x"),
        spatial.pixel_id(y).alias("pixel_y"),
    )
    return round_all(df, 3)


@query(
    "F04_F19_F20_F21_intervals",
    f"""WITH {S.PAIRS}, s AS (
          SELECT *, ln(1 + observed) AS y, CASE WHEN predicted IS NULL THEN NULL
            ELSE greatest(exp(predicted / 10) - 1, 0.01::DOUBLE) END AS held FROM pairs)
        SELECT l_orderkey, l_linenumber, l_partkey, round(y, 6) + 0.0 AS y,
        round(greatest(exp(y) - 1, 0), 6) + 0.0 AS back, round(held, 6) + 0.0 AS held,
        round(abs(observed - predicted), 6) + 0.0 AS error,
        round(abs(observed - predicted) / held, 6) + 0.0 AS score,
        round(CASE WHEN predicted - 2.5::DOUBLE * held < 0 THEN 0 ELSE predicted - 2.5::DOUBLE * held END, 6) + 0.0 AS low,
        round(predicted + 2.5::DOUBLE * held, 6) + 0.0 AS high,
        round(predicted + 2.5::DOUBLE * held
          - CASE WHEN predicted - 2.5::DOUBLE * held < 0 THEN 0 ELSE predicted - 2.5::DOUBLE * held END, 6) + 0.0 AS width
        FROM s""",
)
def interval_functions(spark, sf):
    o, p = F.col("observed"), F.col("predicted")
    y = intervals.log1p_target(o)
    held = intervals.floor_scale(p / 10, 0.01)
    low, high, width = intervals.interval(p, held, 2.5)
    return round_all(
        S.pairs(spark, sf).select(
            "l_orderkey", "l_linenumber", "l_partkey", y.alias("y"),
            intervals.expm1_clip(y).alias("back"), held.alias("held"),
            intervals.absolute_error(o, p).alias("error"),
            intervals.conformity(o, p, held).alias("score"),
            low.alias("low"), high.alias("high"), width.alias("width"),
        )
    )


@query(
    "F05_F06_F07_F08_F09_spectral",
    f"""WITH {S.FLAGGED} SELECT vec_id,
        round((nir - red) / nullif(nir + red, 0), 6) + 0.0 AS ndvi,
        round((swir1 - swir2) / nullif(swir1 + swir2, 0), 6) + 0.0 AS nbr2,
        round((green - nir) / nullif(green + nir, 0), 6) + 0.0 AS ndwi,
        blue < green AND green < red AND red < nir AND nir < swir1 AS trend,
        swir2 > blue AND red > 0.05::DOUBLE AS dry, coalesce(is_soil, FALSE) AS soil FROM flagged""",
)
def spectral_indices(spark, sf):
    from loamline.operators.composite import soil_flags

    b = {n: F.col(n) for n in spectral.BANDS}
    return round_all(
        soil_flags(S.bands(spark, sf)).select(
            "vec_id", spectral.norm_diff(b["nir"], b["red"]).alias("ndvi"),
            spectral.norm_diff(b["swir1"], b["swir2"]).alias("nbr2"),
            spectral.ndwi(b["green"], b["nir"]).alias("ndwi"),
            spectral.spectral_trend(b["blue"], b["green"], b["red"], b["nir"], b["swir1"]).alias("trend"),
            spectral.dry_soil(b["blue"], b["red"], b["swir2"]).alias("dry"),
            clean.is_true(F.col("is_soil")).alias("soil"),
        )
    )


def svp_sql(t: str) -> str:
    return f"0.6108::DOUBLE * exp(17.27::DOUBLE * ({t}) / (({t}) + 237.3::DOUBLE))"


@query(
    "F10_F11_F12_F13_climate",
    f"""WITH {S.SERIES} SELECT cell_id, ts, round((tmin + tmax) / 2, 6) + 0.0 AS tmean,
        round({svp_sql('tmin')}, 6) + 0.0 AS svp,
        round({svp_sql('(tmin + tmax) / 2')} - vp / 1000, 6) + 0.0 AS vpd,
        round({svp_sql('tmax')} - {svp_sql('tmin')}, 6) + 0.0 AS vpd_dew FROM series""",
)
def climate(spark, sf):
    tmin, tmax, vp = F.col("tmin"), F.col("tmax"), F.col("vp")
    return round_all(
        S.series(spark, sf).select(
            "cell_id", "ts", physical.mean_temperature(tmin, tmax).alias("tmean"),
            physical.svp_kpa(tmin).alias("svp"),
            physical.vpd_from_vapour_pressure(tmin, tmax, vp).alias("vpd"),
            physical.vpd_from_dewpoint(tmax, tmin).alias("vpd_dew"),
        )
    )


@query(
    "F14_F16_soil_formulas",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       round(ln((l_quantity + 1) / tan(greatest(l_tax, 0.001::DOUBLE))), 6) + 0.0 AS twi,
       round(100 - l_quantity - l_discount * 100, 6) + 0.0 AS silt FROM lineitem""",
)
def soil_formulas(spark, sf):
    return round_all(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey",
            physical.wetness_index(F.col("l_quantity"), F.col("l_tax")).alias("twi"),
            physical.silt(F.col("l_quantity"), F.col("l_discount") * 100).alias("silt"),
        )
    )


@query(
    "F17_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       strftime(ts, '%Y_%m_%d') AS tag,
       strftime(make_timestamp(epoch_ms(ts) * 1000), '%Y-%m-%d') AS day FROM events""",
)
def date_parts(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return round_all(
        table(spark, sf, "events").select(
            "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
            clean.date_tag(F.col("ts").cast("date")).alias("tag"),
            clean.from_millis(F.unix_millis(ts)).cast("date").alias("day"),
        )
    )


@query(
    "F18_text_functions",
    """SELECT event_id, starts_with(event_type, 'p') AS is_p, trim('  ' || event_type || ' ') AS stripped,
       replace(event_type, 'i', 'I') AS replaced,
       'pt_' || CASE WHEN length(CAST(event_id * 37 AS VARCHAR)) >= 6 THEN CAST(event_id * 37 AS VARCHAR)
         ELSE lpad(CAST(event_id * 37 AS VARCHAR), 6, '0') END AS padded FROM events""",
)
def text_functions(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id", kind.startswith("p").alias("is_p"),
        F.trim(F.concat(F.lit("  "), kind, F.lit(" "))).alias("stripped"),
        F.replace(kind, F.lit("i"), F.lit("I")).alias("replaced"),
        clean.pad_id("pt", F.col("event_id") * 37).alias("padded"),
    )


@query(
    "W04_cutoff_windows",
    f"""WITH {S.POINTS} SELECT point_id,
        strftime(cutoff - INTERVAL 1 YEAR, '%Y-%m-%d') AS y1, strftime(cutoff - INTERVAL 5 YEAR, '%Y-%m-%d') AS y5,
        strftime(cutoff - INTERVAL 10 YEAR, '%Y-%m-%d') AS y10,
        (year(cutoff) - 10) || '-01-01' AS clim_start, year(cutoff) || '-01-01' AS clim_end,
        (year(cutoff) - CASE WHEN month(cutoff) >= 6 THEN 0 ELSE 1 END) || '-03-01' AS spring_start,
        (year(cutoff) - CASE WHEN month(cutoff) >= 6 THEN 0 ELSE 1 END) || '-06-01' AS spring_end
        FROM points""",
)
def cutoff_windows(spark, sf):
    w = windows.cutoff_windows(F.col("cutoff"))
    return round_all(
        S.points(spark, sf).select(
            "point_id", w["1y"][0].alias("y1"), w["5y"][0].alias("y5"), w["10y"][0].alias("y10"),
            w["clim10"][0].alias("clim_start"), w["clim10"][1].alias("clim_end"),
            w["spring"][0].alias("spring_start"), w["spring"][1].alias("spring_end"),
        )
    )


TWO_PI = f"{2 * math.pi!r}::DOUBLE"
T_SQL = "(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) / 365.25::DOUBLE)"


@query(
    "W05_time_basis",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, round({T_SQL}, 6) + 0.0 AS t,
        round(cos({TWO_PI} * {T_SQL}), 6) + 0.0 AS cos1, round(sin({TWO_PI} * {T_SQL}), 6) + 0.0 AS sin1,
        round(cos(2 * {TWO_PI} * {T_SQL}), 6) + 0.0 AS cos2,
        round(sin(2 * {TWO_PI} * {T_SQL}), 6) + 0.0 AS sin2 FROM lineitem""",
)
def time_basis(spark, sf):
    from loamline.operators.harmonic import time_since_start

    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("ts")
    )
    return round_all(time_since_start(rows, F.lit("1995-01-01").cast("date")).drop("ts"))

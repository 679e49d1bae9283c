"""Site tables, joins, profiles, validation, ranks and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, round_all, table
from loamline.functions import clean
from loamline.operators import cleaning, rank, stack
from loamline.operators.quantiles import quantiles
from loamline.plans import observations

# Sites listed twice now and then, with a slightly different coordinate and missing attributes.
SITE_XY = S.SITES + """, site_xy AS (
  SELECT site_id, lat, lon, CASE WHEN site_id % 4 = 0 THEN NULL ELSE landuse END AS landuse,
         site_id * 2 AS ingest_order FROM sites
  UNION ALL SELECT site_id, lat + 0.000002::DOUBLE, lon, 'again', site_id * 2 + 1 FROM sites
  WHERE site_id % 10 = 0
  UNION ALL SELECT NULL, lat, lon, landuse, site_id * 2 FROM sites WHERE site_id % 100 = 7)"""


def site_xy(spark, sf):
    sites = S.sites(spark, sf)
    key = F.col("site_id")
    first = sites.select(
        "site_id", "lat", "lon", F.when(key % 4 != 0, F.col("landuse")).alias("landuse"),
        (key * 2).alias("ingest_order"),
    )
    again = sites.where(key % 10 == 0).select(
        "site_id", (F.col("lat") + 0.000002).alias("lat"), "lon", F.lit("again").alias("landuse"),
        (key * 2 + 1).alias("ingest_order"),
    )
    loose = sites.where(key % 100 == 7).select(
        F.lit(None).cast("bigint").alias("site_id"), "lat", "lon", "landuse",
        (key * 2).alias("ingest_order"),
    )
    return first.unionByName(again).unionByName(loose)


DEDUPED = SITE_XY + """, deduped AS (
  SELECT site_id, avg(lat) AS lat, avg(lon) AS lon,
         arg_min(landuse, ingest_order) FILTER (landuse IS NOT NULL) AS landuse
  FROM site_xy WHERE site_id IS NOT NULL GROUP BY site_id)"""


@query(
    "A01_dedupe_sites",
    f"WITH {DEDUPED} SELECT site_id, round(lat, 6) + 0.0 AS lat, round(lon, 6) + 0.0 AS lon, landuse FROM deduped",
)
def dedupe_sites(spark, sf):
    return round_all(
        cleaning.dedupe_sites(site_xy(spark, sf), "site_id", ["landuse"], "ingest_order")
    )


def order_dates(spark, sf):
    """Order dates as text, some of them unreadable."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("site_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority")).otherwise(day).alias("day"),
    )


FIRST_DATES = """first_dates AS (
  SELECT o_custkey AS site_id, CAST(min(o_orderdate) AS DATE) AS observation_date FROM orders
  WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' GROUP BY o_custkey)"""


@query(
    "A02_first_date",
    f"WITH {FIRST_DATES} SELECT site_id, strftime(observation_date, '%Y-%m-%d') AS observation_date FROM first_dates",
)
def first_date(spark, sf):
    return round_all(cleaning.first_date(order_dates(spark, sf), "site_id", "day"))


AWARDS = """CASE event_id % 6 WHEN 0 THEN '  ' WHEN 1 THEN NULL
  WHEN 2 THEN CASE WHEN event_type = 'error' THEN 'unknown' END
  ELSE CAST({epoch} AS {text}) END"""


DAY_EPOCH = "CAST(epoch(date_trunc('day', ts)) AS BIGINT)"


@query(
    "A03_award_dates",
    f"""WITH a AS (SELECT event_type AS project, {AWARDS.format(epoch=DAY_EPOCH, text='VARCHAR')} AS award
          FROM events)
        SELECT project, round(min(coalesce(try_cast(award AS DOUBLE), 0.0::DOUBLE)), 6) + 0.0 AS award_start_date
        FROM a WHERE award IS NOT NULL AND trim(award) <> '' GROUP BY project""",
)
def award_dates(spark, sf):
    epoch = "datediff(ts, DATE'1970-01-01') * 86400L"
    rows = table(spark, sf, "events").selectExpr(
        "event_type AS project", AWARDS.format(epoch=epoch, text="STRING") + " AS award_start_date"
    )
    return round_all(cleaning.award_dates(rows))


@query(
    "J01_join_many_to_one",
    f"""WITH {S.HORIZONS}, {DEDUPED}, {FIRST_DATES}
        SELECT h.l_orderkey, h.l_linenumber, h.l_partkey, round(d.lat, 6) + 0.0 AS lat, d.landuse,
               strftime(f.observation_date, '%Y-%m-%d') AS observation_date
        FROM horizons h LEFT JOIN deduped d ON h.site_id = d.site_id
        LEFT JOIN first_dates f ON h.site_id = f.site_id""",
)
def join_many_to_one(spark, sf):
    rows = S.horizons(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "site_id")
    sites = cleaning.dedupe_sites(site_xy(spark, sf), "site_id", ["landuse"], "ingest_order")
    dates = cleaning.first_date(order_dates(spark, sf), "site_id", "day")
    joined = cleaning.join_m1(cleaning.join_m1(rows, sites, ["site_id"]), dates, ["site_id"])
    return round_all(joined.drop("site_id", "lon"))


def lab_tables(spark, sf):
    """Parts as laboratory rows, suppliers as pedons, nations as plots, regions as projects."""
    lab = table(spark, sf, "part").selectExpr(
        "p_partkey AS cooplabmst_id", "concat('s', p_partkey) AS dsp_sample_id",
        "p_partkey % 130 AS dsp_pedon_id",
        "CASE WHEN p_partkey % 130 % 9 = 1 THEN concat('S2018KS', p_partkey) ELSE p_brand END AS dsp_pedon",
        "p_size AS layer_no", "p_type AS kssl_labsampnum",
        "CASE WHEN p_partkey % 13 = 0 THEN 'n/a' ELSE cast(p_size / 10 AS string) END AS soc_pct",
        "CASE WHEN p_partkey % 3 = 0 THEN '1.25' END AS bulk_density",
    )
    pedon = table(spark, sf, "supplier").select(
        F.concat(F.lit("p"), "s_suppkey").alias("pedon_id"), F.col("s_suppkey").alias("dsp_pedon_id"),
        F.col("s_nationkey").alias("dsp_plot_id"), F.lit("1").alias("pedon_num"),
        F.col("s_name").alias("userpedonid"),
        F.when(F.col("s_suppkey") % 3 == 0, "2018-06-05").when(F.col("s_suppkey") % 3 == 1, "1528156800")
        .otherwise(" ").alias("date_sampled"),
        S.lon_of(F.col("s_suppkey")).alias("pedon_x"), S.lat_of(F.col("s_suppkey")).alias("pedon_y"),
    )
    layer = table(spark, sf, "part").where("p_size > 5").selectExpr(
        "concat('l', p_partkey) AS laydesg_id", "concat('s', p_partkey) AS dsp_sample_id",
        "p_type AS hzdesg", "'0' AS hrzdep_t", "'10' AS hrzdep_b",
    )
    plot = table(spark, sf, "nation").where("n_nationkey <> 3").selectExpr(
        "n_nationkey AS dsp_plot_id",
        "CASE n_regionkey WHEN 0 THEN 'OSU' WHEN 1 THEN 'KansasState' ELSE 'NCState' END AS project",
        "'2017' AS date",
    )
    award = table(spark, sf, "region").selectExpr(
        "CASE r_regionkey WHEN 0 THEN 'OregonState' WHEN 1 THEN 'KansasState' WHEN 2 THEN 'NCState' "
        "ELSE 'other' END AS project",
        "CASE r_regionkey WHEN 2 THEN '  ' ELSE cast(1400000000 + 86400 * r_regionkey AS string) END AS award_start_date",
    )
    return {
        "cooplabmst": lab, "pedon": pedon, "layerdesignation": layer, "plotoverview": plot,
        "sourceproject": award,
    }


LAB = f"""lab AS (
  SELECT p_partkey AS cooplabmst_id, p_partkey % 130 AS dsp_pedon_id,
         CASE WHEN p_partkey % 130 % 9 = 1 THEN 'S2018KS' || p_partkey ELSE p_brand END AS dsp_pedon,
         CASE WHEN p_partkey % 13 <> 0 THEN p_size / 10 END AS soc_pct,
         CASE WHEN p_partkey % 3 = 0 THEN 1.25::DOUBLE END AS bulk_density FROM part),
pedon AS (
  SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 3 <> 2 THEN DATE '2018-06-05' END AS sampled,
         {S.lat_sql('s_suppkey')} AS lat, {S.lon_sql('s_suppkey')} AS lon FROM supplier),
plot AS (
  SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'OSU' WHEN 1 THEN 'KansasState' ELSE 'NCState' END AS project
  FROM nation WHERE n_nationkey <> 3),
award AS (
  SELECT CASE r_regionkey WHEN 0 THEN 'OregonState' WHEN 1 THEN 'KansasState' ELSE 'other' END AS project,
         min(DATE '2014-05-13' + r_regionkey) AS day
  FROM region WHERE r_regionkey <> 2 GROUP BY 1),
joined AS (
  SELECT l.*, p.lat, p.lon, p.sampled, o.project,
         CASE WHEN pt.p_size > 5 THEN pt.p_type END AS hzdesg,
         CASE WHEN starts_with(dsp_pedon, 'S2018KS') THEN 'KansasState'
              WHEN starts_with(dsp_pedon, 'S2019MN') THEN 'UnivOfMinnesota'
              WHEN lat > 45 AND lon < -110 THEN 'WashingtonState'
              WHEN lon BETWEEN -82 AND -75 AND lat BETWEEN 33 AND 37 THEN 'NCState'
              WHEN lon < -100 AND lat < 37 THEN 'TexasA&MPt-1'
              WHEN o.project = 'OSU' THEN 'OregonState' ELSE o.project END AS proxy_project
  FROM lab l JOIN part pt ON pt.p_partkey = l.cooplabmst_id
  LEFT JOIN pedon p ON l.dsp_pedon_id = p.s_suppkey LEFT JOIN plot o ON p.s_nationkey = o.n_nationkey),
dated AS (
  SELECT j.*, coalesce(j.sampled, a.day) AS observation_date,
         CASE WHEN j.sampled IS NOT NULL THEN 'Date_Sampled' WHEN a.day IS NOT NULL
              THEN 'award_start_date_proxy' ELSE 'missing' END AS observation_date_source
  FROM joined j LEFT JOIN award a ON j.proxy_project = a.project)"""


@query(
    "J02_J04_assemble_lab",
    f"""WITH {LAB} SELECT cooplabmst_id, round(lat, 6) + 0.0 AS lat, hzdesg, project, proxy_project,
        round(soc_pct, 6) + 0.0 AS soc_pct, strftime(observation_date, '%Y-%m-%d') AS observation_date,
        observation_date_source FROM dated""",
)
def assemble_lab(spark, sf):
    joined = observations.join_relational(lab_tables(spark, sf))
    return round_all(
        joined.select(
            "cooplabmst_id", "lat", "hzdesg", "project", "proxy_project", "soc_pct",
            "observation_date", "observation_date_source",
        )
    )


@query(
    "LB_clean_relational",
    f"""WITH {LAB} SELECT cooplabmst_id, round(lat, 6) + 0.0 AS lat, round(lon, 6) + 0.0 AS lon,
        round(soc_pct, 6) + 0.0 AS soc_pct_mass, round(bulk_density, 6) + 0.0 AS measured_bulk_density_g_cm3,
        strftime(observation_date, '%Y-%m-%d') AS observation_date FROM dated
        WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0)
          AND soc_pct >= 0 AND observation_date IS NOT NULL""",
)
def clean_relational(spark, sf):
    cleaned = observations.clean_relational(observations.join_relational(lab_tables(spark, sf)))
    return round_all(
        cleaned.select(
            "cooplabmst_id", "lat", "lon", "soc_pct_mass", "measured_bulk_density_g_cm3",
            "observation_date",
        )
    )


EXPORTED = """exported AS (SELECT * FROM dated
  WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0)
    AND soc_pct >= 0 AND observation_date IS NOT NULL)"""


@query(
    "LB_relational_qc",
    f"""WITH {LAB}, {EXPORTED}, counts AS (
          SELECT count(DISTINCT cooplabmst_id) AS source_lab_rows, count(*) AS joined_rows, count(soc_pct) AS rows_with_soc,
                 count(bulk_density) AS rows_with_measured_bulk_density, count(hzdesg) AS rows_with_horizon_designation,
                 count(sampled) AS rows_with_explicit_sampling_date,
                 count(*) FILTER (observation_date_source = 'award_start_date_proxy') AS rows_using_award_start_proxy,
                 count(*) FILTER (observation_date_source = 'missing') AS rows_missing_all_date_sources,
                 (SELECT count(*) FROM exported) AS export_rows,
                 (SELECT count(DISTINCT dsp_pedon_id) FROM exported) AS export_unique_pedons,
                 (SELECT count(bulk_density) FROM exported) AS export_rows_with_measured_bulk_density FROM dated)
        UNPIVOT counts ON COLUMNS(*) INTO NAME name VALUE n""",
)
def relational_qc(spark, sf):
    joined = observations.join_relational(lab_tables(spark, sf))
    return observations.relational_qc(joined, observations.clean_relational(joined))


@query(
    "J03_row_counts",
    """SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_ids FROM orders
       LEFT JOIN customer ON o_custkey = c_custkey""",
)
def row_counts(spark, sf):
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"),
        "o_custkey", "left",
    )
    return cleaning.row_counts(cleaning.assert_one_row_per(joined, "o_orderkey"), "o_orderkey")


# --- the campaign source, end to end ---------------------------------------------------

def campaign(spark, sf):
    h = S.horizons(spark, sf)
    raw = h.select(
        F.col("l_orderkey").cast("string").alias("samp"), F.col("l_linenumber").cast("string").alias("sample_id"),
        F.col("top_cm").cast("string").alias("top"), F.col("bottom_cm").cast("string").alias("bot"),
        F.lit("A").alias("hzn_desgn"), F.col("site_id").cast("string").alias("rcasiteid"),
        *[F.lit("1").alias(c) for c in ("pedon_no", "upedonid", "upedon", "lab_sample_no", "user_site_id")],
        F.col("l_partkey").cast("string").alias("smp_id"), F.col("l_suppkey").cast("string").alias("natural_key"),
        F.lit("1").alias("lay_id"),
        F.when(F.col("l_linenumber") == 7, "trace").otherwise(F.col("c_tot").cast("string")).alias("c_tot_ncs"),
        F.col("caco3").cast("string").alias("caco3"), F.col("bd").cast("string").alias("measure_bd"),
    )
    xy = site_xy(spark, sf).select(
        F.col("site_id").cast("string").alias("raca_site"), F.col("lat").cast("string").alias("lat"),
        F.col("lon").cast("string").alias("lon"), F.lit("r").alias("region"), "landuse",
        F.lit("g").alias("grp"), "ingest_order",
    )
    dates = order_dates(spark, sf).select(
        F.col("site_id").cast("string").alias("rcasiteid"), F.col("day").alias("observation_date")
    )
    return raw, xy, dates


WINDOW = ("1995-05-01", "1995-12-31")
CAMPAIGN = f"""{S.HORIZONS}, {DEDUPED}, {FIRST_DATES}, carbon AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, site_id, top_cm, bottom_cm, bd,
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN caco3 > 0 THEN CASE WHEN c_tot - 0.12::DOUBLE * caco3 < 0 THEN 0.0::DOUBLE
                                       ELSE c_tot - 0.12::DOUBLE * caco3 END
              ELSE c_tot END AS soc_pct_mass FROM horizons),
campaign AS (
  SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, c.site_id, d.lat, d.lon, top_cm,
         bottom_cm, f.observation_date, soc_pct_mass, bd
  FROM carbon c JOIN deduped d ON c.site_id = d.site_id JOIN first_dates f ON c.site_id = f.site_id
  WHERE d.lat BETWEEN -90 AND 90 AND d.lon BETWEEN -180 AND 180 AND NOT (d.lat = 0 AND d.lon = 0)
    AND soc_pct_mass >= 0 AND f.observation_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}')"""


def cleaned_campaign(spark, sf):
    return observations.clean_campaign(observations.join_campaign(*campaign(spark, sf)), WINDOW)


@query(
    "LA_clean_campaign",
    f"""WITH {CAMPAIGN} SELECT CAST(l_orderkey AS VARCHAR) AS samp, CAST(l_linenumber AS VARCHAR) AS sample_id,
        CAST(l_partkey AS VARCHAR) AS smp_id, round(lat, 6) + 0.0 AS lat, round(lon, 6) + 0.0 AS lon,
        round(top_cm, 6) + 0.0 AS top_cm, strftime(observation_date, '%Y-%m-%d') AS observation_date,
        'RaCA_sample_date' AS observation_date_source,
        round(soc_pct_mass, 6) + 0.0 AS soc_pct_mass, round(bd, 6) + 0.0 AS measured_bulk_density_g_cm3
        FROM campaign""",
)
def clean_campaign(spark, sf):
    return round_all(
        cleaned_campaign(spark, sf).select(
            "samp", "sample_id", "smp_id", "lat", "lon", "top_cm", "observation_date",
            "observation_date_source", "soc_pct_mass", "measured_bulk_density_g_cm3",
        )
    )


def _named(counts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, CAST(({sql}) AS BIGINT) AS n" for name, sql in counts.items())


@query(
    "LA_campaign_qc",
    f"WITH {CAMPAIGN} " + _named({
        "source_horizon_rows": "SELECT count(*) FROM horizons",
        "source_unique_sites": "SELECT count(DISTINCT site_id) FROM horizons",
        "coordinate_rows": "SELECT count(*) FROM site_xy",
        "duplicate_coordinate_keys_resolved":
            "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM site_xy GROUP BY site_id HAVING count(*) > 1)",
        "zero_zero_coordinate_sites_rejected": "SELECT count(*) FROM deduped WHERE lat = 0 AND lon = 0",
        "rows_with_lab_carbon": "SELECT count(c_tot) FROM horizons WHERE l_linenumber <> 7",
        "rows_with_observation_date": "SELECT count(f.observation_date) FROM horizons JOIN first_dates f USING (site_id)",
        "rows_with_measured_bulk_density": "SELECT count(bd) FROM horizons",
        "export_rows": "SELECT count(*) FROM campaign", "export_unique_sites": "SELECT count(DISTINCT site_id) FROM campaign",
        "export_rows_with_measured_bulk_density": "SELECT count(bd) FROM campaign",
    }),
)
def campaign_qc(spark, sf):
    raw, xy, dates = campaign(spark, sf)
    joined = observations.join_campaign(raw, xy, dates)
    return observations.campaign_qc(raw, xy, joined, observations.clean_campaign(joined, WINDOW))


POINT_IDS = f"""{CAMPAIGN}, places AS (SELECT DISTINCT observation_date, lat, lon FROM campaign),
ids AS (SELECT 'camp_' || lpad(CAST(row_number() OVER (ORDER BY observation_date, lat, lon) AS VARCHAR), 6, '0')
  AS point_id, * FROM places)"""


@query(
    "W01_L02_point_ids",
    f"""WITH {POINT_IDS} SELECT CAST(l_orderkey AS VARCHAR) AS samp, CAST(l_partkey AS VARCHAR) AS smp_id,
        point_id FROM campaign c JOIN ids i ON c.lat = i.lat AND c.lon = i.lon AND c.observation_date = i.observation_date""",
)
def point_ids(spark, sf):
    dated, _ = observations.with_points(cleaned_campaign(spark, sf), "camp")
    return dated.select("samp", "smp_id", "point_id")


@query(
    "A04_U01_batch_manifest",
    f"""WITH {POINT_IDS}, {S.POINTS}
        SELECT 'camp' AS dataset, strftime(observation_date, '%Y-%m-%d') AS covariate_cutoff_date,
               count(*) AS n_points FROM ids GROUP BY ALL
        UNION ALL SELECT 'customers', strftime(cutoff, '%Y-%m-%d'), count(*) FROM points GROUP BY ALL""",
)
def batch_manifest(spark, sf):
    _, points = observations.with_points(cleaned_campaign(spark, sf), "camp")
    other = S.points(spark, sf).withColumnRenamed("cutoff", "covariate_cutoff_date")
    return round_all(stack.batch_manifest({"camp": points, "customers": other}))


# --- profiles --------------------------------------------------------------------------

def _profile_sql(columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_missing, "
        f"count(*) - count({c}) AS missing, count(DISTINCT {c}) AS distinct_values FROM horizons"
        for c, t in columns.items()
    )


PROFILED = {"l_partkey": "bigint", "site_id": "bigint", "c_tot": "double", "caco3": "double",
            "bd": "double", "observation_date": "date"}


@query("A05_L01_profile", f"WITH {S.HORIZONS} {_profile_sql(PROFILED)}")
def profile(spark, sf):
    return cleaning.sort_by_missing(cleaning.profile(S.horizons(spark, sf), list(PROFILED)))


DESCRIBED = ["c_tot", "caco3", "bd"]


@query(
    "A06_describe",
    f"WITH {S.HORIZONS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) + 0.0 AS mean,
        round(stddev_samp({c}), 6) + 0.0 AS std, round(min({c}), 6) + 0.0 AS min,
        round(max({c}), 6) + 0.0 AS max, """
        + ", ".join(f"round(quantile_cont({c}, {p}), 6) + 0.0 AS p{round(p * 100):02d}"
                    for p in (0.01, 0.05, 0.5, 0.95, 0.99))
        + " FROM horizons"
        for c in DESCRIBED
    ),
)
def describe(spark, sf):
    return round_all(cleaning.describe(S.horizons(spark, sf), DESCRIBED))


@query(
    "A07_qc_counts",
    f"""WITH {S.HORIZONS}, {SITE_XY}
        SELECT 'source_rows' AS name, count(*) AS n FROM horizons
        UNION ALL SELECT 'source_sites', count(DISTINCT site_id) FROM horizons
        UNION ALL SELECT 'rows_with_bulk_density', count(bd) FROM horizons
        UNION ALL SELECT 'zero_zero_rows', count(*) FROM horizons WHERE lat = 0 AND lon = 0
        UNION ALL SELECT 'duplicate_key_rows', CAST(sum(n) AS BIGINT) FROM
          (SELECT count(*) AS n FROM site_xy GROUP BY site_id HAVING count(*) > 1)""",
)
def qc_counts(spark, sf):
    counts = cleaning.named_counts(
        S.horizons(spark, sf),
        {
            "source_rows": F.count("*"), "source_sites": F.count_distinct("site_id"),
            "rows_with_bulk_density": F.count("bd"),
            "zero_zero_rows": F.count_if((F.col("lat") == 0) & (F.col("lon") == 0)),
        },
    )
    return counts.unionByName(cleaning.duplicate_key_rows(site_xy(spark, sf), "site_id"))


@query(
    "A08_validation_report",
    f"""WITH {CAMPAIGN} SELECT 'campaign' AS dataset, count(*) AS n_rows,
        count(DISTINCT l_orderkey) AS unique_primary_ids, count(DISTINCT site_id) AS unique_sites,
        100.0::DOUBLE AS soc_complete_pct,
        round(100.0::DOUBLE * count(bd) / count(*), 6) + 0.0 AS bulk_density_complete_pct FROM campaign""",
)
def validation_report(spark, sf):
    report = cleaning.validate(cleaned_campaign(spark, sf), "campaign", "samp", "rcasiteid")
    return round_all(report.drop(*cleaning.RULES, "missing_id"))


@query(
    "P17_feature_report",
    f"""WITH {S.HORIZONS} SELECT 'caco3' AS feature,
        round(avg(CASE WHEN caco3 IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS missing_share FROM horizons
        UNION ALL SELECT 'bd', round(avg(CASE WHEN bd IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 FROM horizons
        UNION ALL SELECT 'c_tot', round(avg(CASE WHEN c_tot = 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 FROM horizons""",
)
def feature_report(spark, sf):
    df = S.horizons(spark, sf).withColumn(
        "c_tot", F.when(F.col("c_tot") == 5, -9999.0).otherwise(F.col("c_tot"))
    )
    return round_all(cleaning.feature_report(df, ["caco3", "bd", "c_tot"]))


@query(
    "L03_head",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem "
    "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20",
)
def head(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return rank.first_rows(table(spark, sf, "lineitem").select(*keys), keys, 20)


@query(
    "L04_first_by",
    """SELECT l_suppkey, arg_min(l_orderkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS l_orderkey,
       strftime(min(l_shipdate), '%Y-%m-%d') AS day FROM lineitem GROUP BY l_suppkey""",
)
def first_by(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"
    )
    first = cleaning.first_by(rows, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"])
    return first.select(
        "l_suppkey", "l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")
    )


@query(
    "J10_pending",
    """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus FROM orders
       EXCEPT SELECT strftime(l_shipdate, '%Y-%m'), l_linestatus FROM lineitem""",
)
def pending(spark, sf):
    wanted = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus"
    ).distinct()
    done = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_linestatus").alias("o_orderstatus")
    )
    return stack.pending(wanted, done, ["month", "o_orderstatus"])


# --- ranks -----------------------------------------------------------------------------

@query(
    "W02_group_folds",
    f"""WITH {S.HORIZONS}, sizes AS (SELECT site_id, count(*) AS n FROM horizons GROUP BY site_id),
        dealt AS (SELECT site_id, n, (row_number() OVER (ORDER BY n DESC, site_id) - 1) % 10 AS turn FROM sizes)
        SELECT site_id, n, CAST(CASE WHEN turn < 5 THEN turn + 1 ELSE 10 - turn END AS INTEGER) AS fold FROM dealt""",
)
def group_folds(spark, sf):
    folded = rank.group_folds(S.horizons(spark, sf), "site_id")
    return folded.groupBy("site_id", "fold").agg(F.count("*").alias("n"))


RANK_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "observed"]


@query(
    "W03_systematic_sample",
    f"""WITH {S.PAIRS}, r AS (
          SELECT *, row_number() OVER (ORDER BY predicted NULLS FIRST, {', '.join(RANK_KEYS)}) - 1 AS i,
                 greatest(1, count(*) OVER () // 600) AS step FROM pairs)
        SELECT l_orderkey, l_linenumber, l_partkey, round(predicted, 6) + 0.0 AS predicted FROM r WHERE i % step = 0""",
)
def systematic_sample(spark, sf):
    sample = rank.systematic_sample(S.pairs(spark, sf), "predicted", RANK_KEYS)
    return round_all(sample.select("l_orderkey", "l_linenumber", "l_partkey", "predicted"))

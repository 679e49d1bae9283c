"""Raw sources to clean observation tables, unique points and extraction batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.clean import (
    carbonate_correct, coalesce_with_source, date_between, first_rule, mixed_date,
    non_negative, to_number, valid_coord,
)
from loamline.operators.cleaning import (
    assemble_lab, assert_one_row_per, award_dates, dedupe_sites, duplicate_key_rows, first_date, lookup,
    named_counts,
)
from loamline.operators.rank import assign_point_ids
from loamline.schema import require_columns

# The campaign's sampling dates, and the project names of the relational source.
CAMPAIGN = ("2010-05-01", "2012-01-31")
RENAMED_PROJECTS = {"OSU": "OregonState"}

CAMPAIGN_COLUMNS = (
    "samp sample_id top bot hzn_desgn rcasiteid pedon_no upedonid upedon lab_sample_no "
    "user_site_id smp_id natural_key lay_id c_tot_ncs caco3 measure_bd"
).split()


def join_campaign(horizons: DataFrame, site_xy: DataFrame, site_dates: DataFrame) -> DataFrame:
    """Horizons with one coordinate and the earliest date of their site, and the carbon
    content with carbonate taken out."""
    require_columns(horizons, CAMPAIGN_COLUMNS, "horizons")
    horizons = horizons.withColumns(
        {c: to_number(F.col(c)) for c in ("c_tot_ncs", "caco3", "measure_bd", "top", "bot")}
    )
    sites = dedupe_sites(
        site_xy.withColumns({c: to_number(F.col(c)) for c in ("lat", "lon")}),
        "raca_site", ["region", "landuse", "grp"], "ingest_order",
    ).withColumnRenamed("raca_site", "rcasiteid")
    dates = first_date(site_dates, "rcasiteid", "observation_date")
    # Both right sides are grouped by the key, so they cannot repeat it.
    joined = horizons.join(sites, "rcasiteid", "left").join(dates, "rcasiteid", "left")
    day, label = coalesce_with_source([(F.col("observation_date"), "RaCA_sample_date")], None)
    return joined.withColumns(
        {
            "observation_date": day,
            "observation_date_source": label,
            "soc_pct_mass": carbonate_correct(F.col("c_tot_ncs"), F.col("caco3")),
            "measured_bulk_density_g_cm3": F.col("measure_bd"),
        }
    )


def clean_campaign(joined: DataFrame, window: tuple[str, str] = CAMPAIGN) -> DataFrame:
    """Valid place, carbon and campaign date; exported columns; exact duplicates dropped."""
    kept = joined.where(
        valid_coord(F.col("lat"), F.col("lon"))
        & non_negative(F.col("soc_pct_mass"))
        & date_between(F.col("observation_date"), *window)
    )
    return kept.select(
        "lat", "lon", "rcasiteid", "samp", "sample_id", "pedon_no", "upedonid", "upedon",
        "lab_sample_no", "user_site_id", "smp_id", "natural_key", "lay_id", "hzn_desgn",
        F.col("top").alias("top_cm"), F.col("bot").alias("bottom_cm"),
        "observation_date", "observation_date_source", "soc_pct_mass",
        "measured_bulk_density_g_cm3",
    ).distinct()


def proxy_project(pedon: Column, lat: Column, lon: Column, project: Column) -> Column:
    """Project whose award date stands in for a missing sampling date.

    Fixed values: pedon prefixes and coordinate boxes of the five early campaigns.
    """
    rules = [
        (pedon.startswith("S2018KS"), "KansasState"),
        (pedon.startswith("S2019MN"), "UnivOfMinnesota"),
        ((lat > 45) & (lon < -110), "WashingtonState"),
        (lon.between(-82, -75) & lat.between(33, 37), "NCState"),
        ((lon < -100) & (lat < 37), "TexasA&MPt-1"),
    ]
    renamed = first_rule([(project == k, v) for k, v in RENAMED_PROJECTS.items()], project)
    return first_rule(rules, renamed)


def join_relational(tables: dict[str, DataFrame]) -> DataFrame:
    """Laboratory rows with place, layer and an observation date: the sampling date, or else
    the earliest award date of the project."""
    lab = assemble_lab(
        tables["cooplabmst"], tables["pedon"], tables["layerdesignation"],
        tables["plotoverview"], tables["sourceproject"],
    )
    assert_one_row_per(lab, "cooplabmst_id")
    lab = lab.withColumn(
        "proxy_project",
        proxy_project(F.col("dsp_pedon"), F.col("lat"), F.col("lon"), F.col("project")),
    )
    awards = award_dates(tables["sourceproject"]).select(
        F.col("project").alias("proxy_project"), F.col("award_start_date").alias("award_resolved")
    )
    lab = lookup(lab, awards, ["proxy_project"])
    day, label = coalesce_with_source(
        [
            (mixed_date(F.col("date_sampled")), "Date_Sampled"),
            (mixed_date(F.col("award_resolved")), "award_start_date_proxy"),
        ],
        "missing",
    )
    return lab.withColumns({"observation_date": day, "observation_date_source": label}).withColumns(
        {c: to_number(F.col(c)) for c in ("lat", "lon", "soc_pct", "bulk_density", "hrzdep_t", "hrzdep_b")}
    )


def clean_relational(joined: DataFrame) -> DataFrame:
    kept = joined.where(
        valid_coord(F.col("lat"), F.col("lon"))
        & non_negative(F.col("soc_pct"))
        & F.col("observation_date").isNotNull()
    )
    return kept.select(
        "lat", "lon", "cooplabmst_id", "dsp_sample_id", "dsp_pedon_id", "dsp_pedon", "layer_no",
        "kssl_labsampnum", "pedon_id", "dsp_plot_id", "pedon_num", "userpedonid", "laydesg_id",
        "hzdesg", F.col("hrzdep_t").alias("top_cm"), F.col("hrzdep_b").alias("bottom_cm"),
        "observation_date", "observation_date_source", "proxy_project",
        F.col("soc_pct").alias("soc_pct_mass"),
        F.col("bulk_density").alias("measured_bulk_density_g_cm3"),
    ).distinct()


def campaign_qc(horizons: DataFrame, site_xy: DataFrame, joined: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Counters of the campaign's flow, as rows (name, n): sources, joins and export.

    Each table is read once; the places are the same as in the join, one a site.
    """
    numeric = site_xy.withColumns({c: to_number(F.col(c)) for c in ("lat", "lon")})
    sites = dedupe_sites(numeric, "raca_site", [], "ingest_order")
    zero = (F.col("lat") == 0) & (F.col("lon") == 0)
    parts = [
        named_counts(horizons, {
            "source_horizon_rows": F.count("*"), "source_unique_sites": F.count_distinct("rcasiteid"),
        }),
        named_counts(site_xy, {"coordinate_rows": F.count("*")}),
        duplicate_key_rows(site_xy, "raca_site", "duplicate_coordinate_keys_resolved"),
        named_counts(sites, {"zero_zero_coordinate_sites_rejected": F.count_if(zero)}),
        named_counts(joined, {
            "rows_with_lab_carbon": F.count("c_tot_ncs"), "rows_with_observation_date": F.count("observation_date"),
            "rows_with_measured_bulk_density": F.count("measured_bulk_density_g_cm3"),
        }),
        _export_counts(cleaned, "export_unique_sites", "rcasiteid"),
    ]
    return reduce(DataFrame.unionByName, parts)


def relational_qc(joined: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Counters of the relational source's flow, as rows (name, n)."""
    source = F.col("observation_date_source")
    counts = named_counts(joined, {
        "source_lab_rows": F.count_distinct("cooplabmst_id"), "joined_rows": F.count("*"),
        "rows_with_soc": F.count("soc_pct"), "rows_with_measured_bulk_density": F.count("bulk_density"),
        "rows_with_horizon_designation": F.count("hzdesg"),
        "rows_with_explicit_sampling_date": F.count(mixed_date(F.col("date_sampled"))),
        "rows_using_award_start_proxy": F.count_if(source == "award_start_date_proxy"),
        "rows_missing_all_date_sources": F.count_if(source == "missing"),
    })
    return counts.unionByName(_export_counts(cleaned, "export_unique_pedons", "dsp_pedon_id"))


def _export_counts(cleaned: DataFrame, name: str, key: str) -> DataFrame:
    return named_counts(cleaned, {
        "export_rows": F.count("*"), name: F.count_distinct(key),
        "export_rows_with_measured_bulk_density": F.count("measured_bulk_density_g_cm3"),
    })


def with_points(observations: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Observations with their point id, and the table of unique points.

    A point is a place and a cutoff date; the cutoff is the observation date, so no
    covariate window reaches past it. Only the distinct places are checkpointed, for their
    ranks; the observations stay a plan, of which the points read three columns.
    """
    dated = observations.withColumn("covariate_cutoff_date", F.col("observation_date"))
    points = assign_point_ids(dated, prefix)
    # The points are distinct places and dates, so they cannot repeat the key.
    return dated.join(points, ["lat", "lon", "covariate_cutoff_date"], "left"), points



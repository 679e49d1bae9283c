"""Table contracts (DDL schemas), column checks and per-target model settings."""

from __future__ import annotations

import re
from dataclasses import dataclass
from collections.abc import Iterable

from pyspark.sql import DataFrame

OBSERVATIONS = (
    "obs_id STRING, source STRING, site_id STRING, lat DOUBLE, lon DOUBLE, top_cm DOUBLE, "
    "bottom_cm DOUBLE, horizon STRING, observation_date DATE, observation_date_source STRING, "
    "soc_pct_mass DOUBLE, measured_bulk_density_g_cm3 DOUBLE, point_id STRING, "
    "covariate_cutoff_date DATE"
)
POINTS = (
    "point_id STRING, lat DOUBLE, lon DOUBLE, covariate_cutoff_date DATE"
)
ZONES = (
    "zone_id BIGINT, ord INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
)

NODATA = -9999.0
UNKNOWN_CODE = -999
DEPTHS_CM = (5.0, 15.0, 30.0, 60.0, 100.0)


class ContractError(ValueError):
    """A table does not carry what an operator needs."""


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ContractError(f"{what}: missing columns {missing}")
    return df


def require_unique(df: DataFrame, key: str, what: str = "table") -> DataFrame:
    """Joins by a key that repeats would multiply rows."""
    if not df.groupBy(key).count().where("count > 1").isEmpty():
        raise ContractError(f"{what}: {key} repeats")
    return df


def require_safe_names(df: DataFrame) -> DataFrame:
    """Export names carry neither blanks nor periods."""
    bad = [c for c in df.columns if re.search(r"[ .]", c)]
    if bad:
        raise ContractError(f"unsafe column names {bad}")
    return df


# Model inputs of the three targets.
SOC_FEATURES = (
    "z_mid ASPECT EL HAND TWI SOIL_TEXTURE clay_pct lithology_class LRR_group LULC LU_scraped "
    "NLCD_name AI EVI_mean SF VPD_kPa VPD_mean_10y VPD_max_10y VPD_gs_mean_10y "
    "ppt_annual_mean_10y ET_sum EVI_a1 EVI_a2 EVI_b2 EVI_beta0 NDVI_b1 NDVI_beta0 NDWI_b1 "
    "NDWI_beta0 T2M_b1 VPD_a1_10y VPD_b1_10y VPD_beta0_10y ppt_b1_10y ET_a1 ET_beta0"
).split()
BULK_DENSITY_FEATURES = (
    "z_mid EL SL HAND TWI SOIL_TEXTURE clay_pct sand_pct lithology_class AEZ_GROUPID MLRA_ID "
    "LRR_group LU_scraped NLCD_name AI MAT_mean Tmin_spring_min SRAD_1y_mean_MJ NDVI_mean "
    "NDWI_mean SF VPD_kPa VPD_mean_10y VPD_max_10y VPD_gs_mean_10y ppt_sum ppt_cv_10y ET_sum "
    "EVI_b1 EVI_a2 EVI_b2 EVI_beta0 NDVI_b1 NDVI_beta0 NDWI_a1 NDWI_b1 NDWI_beta0 T2M_a1 T2M_b1 "
    "T2M_beta0 T2M_trend VPD_a1_10y VPD_b1_10y VPD_tcoef_10y ppt_a1_10y ppt_b1_10y "
    "ppt_beta0_10y ppt_tcoef_10y ET_a1 ET_b1 ET_a2 ET_b2 ET_beta0 ET_trend"
).split()
SOC_DENSITY_FEATURES = (
    "z_mid EL HAND TWI SOIL_TEXTURE clay_pct sand_pct lithology_class AEZ_GROUPID MLRA_ID "
    "LRR_group LULC LU_scraped NLCD_name AI MAT_mean Tmin_spring_min SRAD_1y_mean_MJ EVI_mean "
    "NDVI_mean NDWI_mean SF VPD_kPa VPD_mean_10y VPD_max_10y VPD_gs_mean_10y ppt_sum ppt_cv_10y "
    "ET_sum EVI_a1 EVI_b1 EVI_a2 EVI_b2 EVI_beta0 NDVI_a1 NDVI_b1 NDVI_beta0 NDVI_trend NDWI_a1 "
    "NDWI_b1 NDWI_beta0 NDWI_trend T2M_a1 T2M_b1 T2M_beta0 T2M_trend VPD_a1_10y VPD_b1_10y "
    "VPD_tcoef_10y ppt_a1_10y ppt_b1_10y ppt_beta0_10y ppt_tcoef_10y ET_a1 ET_b1 ET_a2 ET_b2 "
    "ET_beta0 ET_trend"
).split()
CATEGORICAL = ["LRR_group", "LU_scraped", "NLCD_name"]
# Bands that may stand in for a feature, in order of preference.
BAND_ALIASES = {"EL": ["EL", "EL_MERIT"], "SF": ["SF", "SF_median"]}


@dataclass(frozen=True)
class Target:
    """Settings of one modelled quantity; the scale floor is used in training and in serving."""

    name: str
    column: str
    units: str
    scale_floor: float
    minimum: float | None = None
    below: float | None = None
    external_max: float | None = None
    valid_flag: str | None = None
    external_multiplier: bool = False
    #: Model inputs, and boosting rounds of the point model.
    features: tuple[str, ...] = ()
    rounds: int = 500


TARGETS = {
    "soc_pct": Target("soc_pct", "SOC_pct", "%", 0.01, minimum=0.0, below=12.5, features=tuple(SOC_FEATURES)),
    "bulk_density": Target(
        "bulk_density", "Measure_BD", "g cm-3", 1e-4, external_max=2.0,
        valid_flag="BD_valid_basic", external_multiplier=True, features=tuple(BULK_DENSITY_FEATURES), rounds=550,
    ),
    "soc_density": Target(
        "soc_density", "SOC_density", "g cm-3", 1e-4, valid_flag="SOC_density_valid",
        features=tuple(SOC_DENSITY_FEATURES),
    ),
}


def resolve_bands(available: Iterable[str], required: Iterable[str]) -> dict[str, str]:
    """Feature -> band name, honouring aliases; features made at scoring time are skipped."""
    have = set(available)
    resolved = {}
    for feature in required:
        if feature in ("z_mid", "point_prediction"):
            continue
        options = BAND_ALIASES.get(feature, [feature])
        found = [band for band in options if band in have]
        if not found:
            raise ContractError(f"feature {feature!r} has none of the bands {options}")
        resolved[feature] = found[0]
    return resolved

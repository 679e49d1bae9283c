import datetime as dt

import pytest
from pyspark.sql import functions as F

from loamline.functions import clean, intervals, physical, spectral
from loamline.operators import cleaning, encode, stack
from loamline.plans.observations import clean_campaign, join_campaign, with_points
from loamline.schema import ContractError, require_columns, require_safe_names, resolve_bands


def column(spark, values, dtype, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_numbers_from_text(spark):
    got = column(spark, ["1.5", " 2 ", "-3e2", "1d", "nan", "", "x", None, ".5", "5."], "STRING", clean.to_number)
    assert got == [1.5, 2.0, -300.0, None, None, None, None, None, 0.5, 5.0]


def test_mixed_dates(spark):
    values = ["2018-06-05", "1528156800", " 2018-06-05 ", "", "soon", None, "1e30", "1528156800.0"]
    day = dt.date(2018, 6, 5)
    assert column(spark, values, "STRING", clean.mixed_date) == [day, day, day, None, None, None, None, day]


def test_coordinates(spark):
    rows = [(90.0, 180.0), (0.0, 0.0), (0.0, 5.0), (90.1, 0.0), (None, 1.0), (-90.0, -180.0)]
    df = spark.createDataFrame(rows, "lat DOUBLE, lon DOUBLE")
    got = [r[0] for r in df.select(clean.valid_coord(F.col("lat"), F.col("lon"))).collect()]
    assert got == [True, False, True, False, False, True]


def test_carbonate(spark):
    rows = [(2.0, 5.0), (0.5, 10.0), (2.0, 0.0), (2.0, None), (None, 5.0), (-1.0, None)]
    df = spark.createDataFrame(rows, "c DOUBLE, k DOUBLE")
    got = [r[0] for r in df.select(clean.carbonate_correct(F.col("c"), F.col("k"))).collect()]
    assert got == [pytest.approx(1.4), 0.0, 2.0, 2.0, None, 0.0]


def test_depth_labels(spark):
    got = column(spark, [29.9, 30.0, None, -0.5], "DOUBLE", clean.depth_group)
    assert got == [clean.SHALLOW, clean.DEEP, clean.DEEP, clean.SHALLOW]
    assert column(spark, [29.9, 30.0, None, -0.5], "DOUBLE", clean.depth_bin) == [2, 3, None, -1]


def test_ids(spark):
    assert column(spark, ["12A3", "A", "", None], "STRING", clean.numeric_id) == [123, -999, -999, -999]
    assert column(spark, [1, 1234567], "BIGINT", lambda c: clean.pad_id("p", c)) == ["p_000001", "p_1234567"]


def test_null_passes_through_floors(spark):
    assert column(spark, [None, -1.0], "DOUBLE", lambda c: clean.at_least(c, 0.0)) == [None, 0.0]
    assert column(spark, [None, -9.0], "DOUBLE", lambda c: intervals.floor_scale(c, 0.01)) == [None, 0.01]


def test_formulas(spark):
    assert column(spark, [0.0], "DOUBLE", physical.svp_kpa) == [pytest.approx(0.6108)]
    assert column(spark, [-1.0], "DOUBLE", lambda c: physical.wetness_index(c, F.lit(0.1))) == [None]
    assert column(spark, [0.0, 1.0], "DOUBLE", lambda c: spectral.norm_diff(c, F.lit(0.0))) == [None, 1.0]
    bits = column(spark, [64, 8, 2, 16, 32, 1], "INT", lambda c: spectral.bits_clear(c, spectral.PIXEL_QA_BITS))
    assert bits == [True, False, False, False, False, True]


def test_soil_interval_ends(spark):
    flag = lambda ndvi, nbr2: spectral.is_soil(
        F.lit(True), F.lit(ndvi), F.lit(nbr2), F.lit(True), F.lit(True)
    )
    row = spark.range(1).select(
        flag(-0.10, 0.10), flag(0.25, -0.10), flag(0.26, 0.0), flag(0.0, 0.0)
    ).first()
    assert list(row) == [True, False, False, True]


def test_codes(spark):
    assert column(spark, [0.5, 1.5, 2.5, 9.0, None], "DOUBLE", lambda c: encode.decode_codes(c, encode.LAND_USE)) == [
        None, "F", "F", None, None,
    ]
    assert column(spark, [81, 42, 71, 11, None], "INT", encode.land_use_group) == [1, 2, 3, 4, None]


def test_join_refuses_repeated_keys(spark):
    left = spark.createDataFrame([(1,)], "k INT")
    right = spark.createDataFrame([(1, 1), (1, 2)], "k INT, v INT")
    with pytest.raises(ContractError):
        cleaning.join_m1(left, right, ["k"])


def test_contracts(spark):
    df = spark.createDataFrame([(1,)], "k INT")
    with pytest.raises(ContractError):
        require_columns(df, ["missing"])
    with pytest.raises(ContractError):
        require_safe_names(df.toDF("a.b"))
    assert resolve_bands(["EL_MERIT", "SF"], ["EL", "SF", "z_mid"]) == {"EL": "EL_MERIT", "SF": "SF"}
    with pytest.raises(ContractError):
        resolve_bands(["EL"], ["HAND"])


def test_validation_names_broken_rules(spark):
    df = spark.createDataFrame(
        [("a", "s", 1.0, 1.0, -1.0, None, dt.date(2011, 1, 1))],
        "id STRING, site STRING, lat DOUBLE, lon DOUBLE, soc_pct_mass DOUBLE, "
        "measured_bulk_density_g_cm3 DOUBLE, observation_date DATE",
    )
    with pytest.raises(ContractError, match="negative_soc"):
        cleaning.validate(df, "t", "id", "site")


def test_campaign_edges(spark):
    """Duplicate sites, duplicate rows, bad text, carbonate, dates outside the campaign."""
    columns = "samp rcasiteid c_tot_ncs caco3 measure_bd".split()
    raw = [
        ("1", "A", "2.0", "5", "1.1"), ("1", "A", "2.0", "5", "1.1"), ("2", "A", "trace", None, None),
        ("3", "B", "1.0", None, "x"), ("4", "C", "1.0", "0", "1.0"), ("5", None, "1.0", None, None),
        ("6", "D", "0.1", "50", None),
    ]
    rest = "sample_id top bot hzn_desgn pedon_no upedonid upedon lab_sample_no user_site_id smp_id natural_key lay_id".split()
    horizons = spark.createDataFrame(raw, ", ".join(f"{c} STRING" for c in columns)).withColumns(
        {c: F.lit("1") for c in rest}
    )
    xy = spark.createDataFrame(
        [("A", "40", "-100", None, 1), ("A", "40.000002", "-100", "r2", 2), ("B", "0", "0", "r", 3),
         ("C", "40", "-100", "r", 4), ("D", "41", "-101", "r", 5)],
        "raca_site STRING, lat STRING, lon STRING, region STRING, ingest_order INT",
    ).withColumns({"landuse": F.lit("x"), "grp": F.lit("g")})
    dates = spark.createDataFrame(
        [("A", "2011-05-02"), ("A", "2010-06-01"), ("A", "bad"), ("B", "2011-01-01"),
         ("C", "2012-02-01"), ("D", "2012-01-31")],
        "rcasiteid STRING, observation_date STRING",
    )
    cleaned = clean_campaign(join_campaign(horizons, xy, dates))
    got = {r["samp"]: r for r in cleaned.collect()}
    assert set(got) == {"1", "6"} and cleaned.count() == 2
    assert got["1"]["soc_pct_mass"] == pytest.approx(1.4)
    assert got["1"]["lat"] == pytest.approx(40.000001)
    assert got["1"]["observation_date"] == dt.date(2010, 6, 1)
    assert got["6"]["soc_pct_mass"] == 0.0
    dated, points = with_points(cleaned, "camp")
    assert sorted(r["point_id"] for r in points.collect()) == ["camp_000001", "camp_000002"]
    assert {r["samp"]: r["point_id"] for r in dated.collect()} == {"1": "camp_000001", "6": "camp_000002"}


def test_imputation_and_one_hot(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b"), (9.0, "a")], "x DOUBLE, k STRING")
    new = spark.createDataFrame([(None, None), (2.0, "z")], "x DOUBLE, k STRING")
    filled = encode.impute_median(train, new, ["x"]).collect()
    assert [(r["x"], r["x_missing"]) for r in filled] == [(3.0, 1.0), (2.0, 0.0)]
    assert [r["k"] for r in encode.impute_mode(train, new, ["k"]).collect()] == ["a", "z"]
    hot = encode.one_hot(train, encode.impute_mode(train, new, ["k"]), "k").collect()
    assert [(r["k_1"], r["k_2"]) for r in hot] == [(1.0, 0.0), (0.0, 0.0)]


def test_categories_skip_blanks(spark):
    df = spark.createDataFrame([("b",), ("",), (None,), ("a",), ("b",)], "g STRING")
    table = encode.categories(df, "g")
    assert {r["value"]: r["code"] for r in table.collect()} == {"a": 1, "b": 2}
    coded = encode.encode_categories(df.unionAll(spark.createDataFrame([("q",)], "g STRING")), "g", table, "n")
    assert sorted(r["n"] for r in coded.collect()) == [-999, -999, -999, 1, 2, 2]


def test_pending_and_nodata(spark):
    wanted = spark.createDataFrame([("t", 5.0), ("t", 15.0)], "tile STRING, depth_cm DOUBLE")
    done = spark.createDataFrame([("t", 5.0), ("t", 5.0)], "tile STRING, depth_cm DOUBLE")
    assert [r["depth_cm"] for r in stack.pending(wanted, done, ["tile", "depth_cm"]).collect()] == [15.0]
    df = spark.createDataFrame([(1.0, None), (float("nan"), 2.0)], "a DOUBLE, b DOUBLE")
    assert [r["valid"] for r in stack.valid_mask(stack.fill_nodata(df, ["b"]), ["a", "b"]).collect()] == [False, False]

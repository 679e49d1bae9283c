import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.operators import encode, features, model
from loamline.plans import maps, modelling
from loamline.schema import NODATA, TARGETS, ContractError
from loamline.sources import sinks, snapshots, tables
from loamline.streaming.tiles import score_batch, score_new_tiles, tile_stream

FEATURES = ["z_mid", "clay_pct", "EL", "LU_scraped"]
SMALL = model.Boosting(rounds=3, max_depth=2, learning_rate=0.4)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    data = []
    for i in range(600):
        clay = float(rng.uniform(5, 60))
        kind = "CFRX"[i % 4]
        soc = max(0.0, 0.08 * clay + (2 if kind == "F" else 0) + float(rng.normal(0, 0.3)))
        data.append(
            (f"o{i}", f"s{i % 40}", 40.0, -100.0, str(10 * (i % 5)), str(10 * (i % 5) + 10),
             None if i % 50 == 0 else clay, float(i), None if i % 30 == 0 else kind, soc, soc / 5 + 0.5, i % 7 != 0)
        )
    return spark.createDataFrame(
        data,
        "obs_id STRING, site_id STRING, lat DOUBLE, lon DOUBLE, top_cm STRING, bottom_cm STRING, clay_pct DOUBLE, "
        "EL DOUBLE, LU_scraped STRING, SOC_pct DOUBLE, Measure_BD DOUBLE, BD_valid_basic BOOLEAN",
    ).cache()


@pytest.fixture(scope="module")
def runs(rows):
    train, external = rows.where("site_id < 's3'"), rows.where("site_id >= 's3'")
    return {
        name: model.train_target(train, external, FEATURES, TARGETS[name], SMALL, SMALL)
        for name in ("soc_pct", "bulk_density")
    }


def test_contract_and_filters(rows):
    odd = rows.withColumn("SOC_pct", F.when(F.col("obs_id") == "o1", 13.0).otherwise(F.col("SOC_pct")))
    train, external = model.prepare_tables(odd, odd, FEATURES, TARGETS["soc_pct"])
    assert train.count() == 599 and external.count() == 600
    assert train.select("z_mid").first()[0] in (5.0, 15.0, 25.0, 35.0, 45.0)
    bd, ext = model.prepare_tables(rows, rows, FEATURES, TARGETS["bulk_density"])
    assert bd.count() == rows.where("BD_valid_basic").count()
    assert ext.where("Measure_BD > 2").count() == 0
    with pytest.raises(ContractError):
        model.prepare_tables(rows, rows, [*FEATURES, "HAND"], TARGETS["soc_pct"])


def test_every_row_is_scored_once_out_of_fold(runs):
    oof = runs["soc_pct"]["oof"]
    n = oof.count()
    assert n == oof.select("obs_id").distinct().count() and oof.where("predicted IS NULL").count() == 0
    assert oof.groupBy("site_id").agg(F.count_distinct("fold").alias("k")).where("k > 1").count() == 0
    assert oof.where("NOT (lower_90 <= predicted AND predicted <= upper_90)").count() == 0
    assert oof.where(f"scale < {TARGETS['soc_pct'].scale_floor}").count() == 0


def test_calibration_covers_the_training_scores(runs):
    run = runs["soc_pct"]
    covered = run["oof"].where("observed BETWEEN lower_90 AND upper_90").count()
    manifest = run["manifest"].first()
    assert covered >= np.floor(0.9 * manifest["training_rows"])
    assert manifest["training_sites"] == run["oof"].select("site_id").distinct().count()
    assert {m["dataset"] for m in manifest["metrics"]} == {
        "grouped OOF rows", "grouped OOF pixel x depth", "external rows", "external pixel x depth",
    }
    ratio = runs["bulk_density"]["manifest"].first()["calibration"]
    assert ratio["mapping_ratio"] == pytest.approx(ratio["mapping_multiplier"] / ratio["calibration_multiplier"])


def test_the_model_learns(runs):
    found = {r["dataset"]: r["r2"] for r in runs["soc_pct"]["metrics"].collect()}
    assert found["grouped OOF rows"] > 0.4


def test_feature_vectors(rows, spark):
    train = rows.withColumn("z_mid", F.lit(5.0))
    fitted = model.fit(train, FEATURES, "SOC_pct", SMALL)
    median = float(np.median([r[0] for r in rows.select("clay_pct").where("clay_pct IS NOT NULL").collect()]))
    new = spark.createDataFrame(
        [("a", 5.0, None, 1.0, "Q"), ("b", 5.0, 10.0, 1.0, None), ("c", 5.0, float("nan"), 1.0, "F")],
        "obs_id STRING, z_mid DOUBLE, clay_pct DOUBLE, EL DOUBLE, LU_scraped STRING",
    )
    got = {r["obs_id"]: r["features"] for r in model.feature_matrix(fitted, new, "obs_id").collect()}
    mode = min(
        (-r["count"], r["LU_scraped"])
        for r in rows.where("LU_scraped IS NOT NULL").groupBy("LU_scraped").count().collect()
    )[1]
    assert got["a"][:4] == [5.0, median, 1.0, 1.0] and sum(got["a"][4:]) == 0
    assert got["b"][4:8] == [1.0 if k == mode else 0.0 for k in "CFRX"]
    assert got["c"] == [5.0, median, 1.0, 1.0, 0.0, 1.0, 0.0, 0.0]


def test_folds_share_their_passes(spark, rows):
    """Fitting a model for every fold takes the jobs that one model takes."""
    folded = model.with_folds(rows.withColumn("z_mid", F.lit(5.0)))
    sc, jobs = spark.sparkContext, {}
    for name, holdouts in (("one", [None]), ("six", [1, 2, 3, 4, 5, None])):
        sc.setJobGroup(name, name)
        fitted = model.fit_folds(folded, FEATURES, "SOC_pct", SMALL, holdouts)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(name))
        assert [m.inputs.holdout for m in fitted] == holdouts
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["six"] <= jobs["one"] + 4
    # What a fold holds is not known to its model.
    data = folded.select("fold", "EL", "clay_pct").toPandas()
    for m in fitted[:5]:
        seen = data[data["fold"] != m.inputs.holdout]
        assert m.medians["EL"] == seen["EL"].median() and m.medians["clay_pct"] == seen["clay_pct"].median()


def test_trees_are_those_of_mllib(spark):
    """Without draws of rows and features the scores are those of MLlib's own training."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor

    rng = np.random.default_rng(4)
    data = [
        (f"o{i}", float(rng.integers(0, 40)), None if i % 9 == 0 else float(rng.integers(0, 30)), "ABC"[i % 3], float(rng.gamma(2)))
        for i in range(500)
    ]
    df = spark.createDataFrame(data, "obs_id STRING, a DOUBLE, b DOUBLE, LU_scraped STRING, y DOUBLE").cache()
    params = model.Boosting(rounds=12, max_depth=3, learning_rate=0.3, min_leaf=4, subsample=1.0, colsample=1.0)
    fitted = model.fit(df, ["a", "b", "LU_scraped"], "y", params)
    vectors = model.feature_matrix(fitted, df, "obs_id").join(df, "obs_id").withColumn("__label", F.log1p("y"))
    own = GBTRegressor(
        featuresCol="v", labelCol="__label", maxDepth=3, maxIter=12, stepSize=0.3, minInstancesPerNode=4, maxBins=64, seed=1,
    ).fit(vectors.withColumn("v", array_to_vector("features")))
    want = {r["obs_id"]: r["prediction"] for r in own.transform(vectors.withColumn("v", array_to_vector("features"))).collect()}
    got = {r["obs_id"]: r["p"] for r in fitted.transform(df, "p", ["obs_id"]).collect()}
    assert max(abs(want[k] - got[k]) for k in want) < 1e-9 and len(got) == 500
    through = fitted.pipeline.transform(fitted.prepare(df)).select("obs_id", "prediction").collect()
    assert max(abs(r["prediction"] - got[r["obs_id"]]) for r in through) < 1e-12


def test_predictions_must_align(rows):
    short = rows.limit(10).select("obs_id", F.lit(1.0).alias("predicted"), F.lit(1.0).alias("observed"))
    with pytest.raises(ValueError):
        model.join_predictions(rows, short)


@pytest.fixture(scope="module")
def tiles(spark):
    data = [
        (f"t{i % 2}", i, 0, float(10 + i), None if i == 3 else float(i), float(i % 4 + 1)) for i in range(12)
    ]
    data.append(("t1", 99, 0, -9999.0, 1.0, 1.0))
    data.append(("t1", 98, 0, float("nan"), 1.0, 1.0))
    return spark.createDataFrame(
        data, "tile STRING, row INT, col INT, clay_pct FLOAT, EL_MERIT FLOAT, LU_scraped FLOAT"
    )


@pytest.fixture(scope="module")
def bundles(runs):
    return [runs["soc_pct"]["bundle"], runs["bulk_density"]["bundle"]]


def test_scoring_marks_invalid_pixels(tiles, bundles):
    scored = maps.score_tiles(tiles, bundles, (5.0, 30.0))
    assert scored.count() == 28
    bad = scored.where("row IN (3, 98, 99)")
    assert bad.count() == 6
    assert all(r[b] == NODATA for r in bad.collect() for b in sinks.MAP_BANDS)
    good = scored.where("valid_data_mask = 1")
    assert good.count() == 22
    assert good.where("soc_pct_lower_90 > soc_pct_prediction OR soc_pct_prediction > soc_pct_upper_90").count() == 0
    assert good.where("abs(bulk_density_upper_90 - bulk_density_lower_90 - bulk_density_interval_width) > 1e-5").count() == 0


def test_models_score_in_many_tasks(spark, tiles, bundles):
    """Inputs of one row group are dealt over the tasks before the models, not scored by one."""
    plan = maps.score_tiles(tiles.coalesce(1), bundles, (5.0, 30.0))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [tile" in plan
    assert maps.score_tiles(tiles.coalesce(1), bundles, (5.0, 30.0)).count() == 2 * tiles.count()


def test_training_has_few_partitions(spark, rows, monkeypatch):
    """Passes over small training tables are not spent on as many tasks as a shuffle has."""
    cores = spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(4 * cores + 1))
        assert model.with_folds(rows).rdd.getNumPartitions() == cores
        monkeypatch.setattr(model, "TASK_ROWS", 20)
        assert model.with_folds(rows).rdd.getNumPartitions() == max(cores, 30)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bundle_round_trip(spark, tiles, bundles, tmp_path):
    model.save_bundle(bundles[0], str(tmp_path / "bundle"), spark)
    loaded = model.load_bundle(spark, str(tmp_path / "bundle"))
    assert (loaded.target, loaded.features, loaded.multiplier) == (
        bundles[0].target, bundles[0].features, bundles[0].multiplier
    )
    own, again = (maps.score_tiles(tiles, [b]) for b in (bundles[0], loaded))
    assert own.exceptAll(again).isEmpty() and again.exceptAll(own).isEmpty()


def test_repeated_observation_ids_are_refused(rows):
    with pytest.raises(ContractError, match="obs_id repeats"):
        model.train_target(rows.union(rows.limit(1)), rows, FEATURES, TARGETS["soc_pct"], SMALL, SMALL)


def test_missing_band_fails_early(tiles, bundles):
    with pytest.raises(ContractError):
        maps.score_tiles(tiles.drop("EL_MERIT"), bundles)


def test_second_run_writes_nothing(spark, tiles, bundles, tmp_path):
    out = str(tmp_path / "maps")
    first = maps.run_pending(tiles.where("tile = 't0'"), bundles, out, (5.0,))
    assert [(r["tile"], r["n_pixels"], r["n_valid"]) for r in first.collect()] == [("t0", 6, 6)]
    second = maps.run_pending(tiles, bundles, out, (5.0, 15.0))
    done = sorted((r["tile"], r["depth_cm"]) for r in second.collect())
    assert done == [("t0", 15.0), ("t1", 5.0), ("t1", 15.0)]
    assert maps.run_pending(tiles, bundles, out, (5.0, 15.0)) is None
    assert published(spark, out).count() == 28
    assert published(spark, out, 1).count() == 6


def test_tile_in_two_parts(spark, tiles, bundles, tmp_path):
    out = str(tmp_path / "maps")
    named = tiles.withColumn("tile", F.when(F.col("tile") == "t0", "003").otherwise("004"))
    part = named.where("row < 6")
    first = maps.run_pending(part, bundles, out, (5.0,)).collect()
    assert sorted((r["tile"], r["n_pixels"]) for r in first) == [("003", 3), ("004", 3)]
    assert maps.run_pending(part, bundles, out, (5.0,)) is None
    # The other pixels of the same tiles, as many as before in one of them.
    second = maps.run_pending(named.where("row >= 6"), bundles, out, (5.0,)).collect()
    assert sorted((r["tile"], r["n_pixels"]) for r in second) == [("003", 6), ("004", 8)]
    assert maps.run_pending(named, bundles, out, (5.0,)) is None
    assert published(spark, out).select("row", "col").distinct().count() == 14
    again = maps.run_pending(named, bundles, out, (5.0,), overwrite=True).collect()
    assert sorted((r["tile"], r["n_pixels"]) for r in again) == [("003", 6), ("004", 8)]


def test_many_categories(spark):
    df = spark.range(20000).selectExpr("concat('c', lpad(id, 5, '0')) AS v")
    table = encode.categories(df, "v")
    got = encode.encode_categories(df, "v", table, "code")
    assert got.where("code <> cast(substr(v, 2) AS int) + 1").count() == 0 and got.count() == 20000


def test_stream_scores_each_tile_once(spark, tiles, bundles, tmp_path):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    tiles.where("tile = 't0'").write.parquet(source)
    stream = tile_stream(spark, source, tiles.schema)
    score_new_tiles(stream, bundles, out, state, (5.0,)).awaitTermination()
    assert published(spark, out).count() == 6
    tiles.where("tile = 't1'").write.mode("append").parquet(source)
    score_new_tiles(stream, bundles, out, state, (5.0,)).awaitTermination()
    assert published(spark, out).count() == 14
    # With the state lost, the files come again; the ledger knows them.
    score_new_tiles(stream, bundles, out, str(tmp_path / "new"), (5.0,)).awaitTermination()
    assert published(spark, out).count() == 14 and snapshots.latest(spark, out) == 2
    assert sorted(r["n"] for r in snapshots.sources(spark, out).groupBy("batch").agg(F.sum("n").alias("n")).collect()) == [6, 8]


def test_killed_between_write_and_commit(spark, tiles, bundles, tmp_path, monkeypatch):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    tiles.write.parquet(source)
    stream = tile_stream(spark, source, tiles.schema)
    commit = snapshots._commit

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(snapshots, "_commit", killed)
    with pytest.raises(Exception, match="killed"):
        score_new_tiles(stream, bundles, out, state, (5.0, 15.0)).awaitTermination()
    # All files lie there, none of them is seen.
    assert spark.read.parquet(f"{out}/data").count() == 28 and published(spark, out).count() == 0
    monkeypatch.setattr(snapshots, "_commit", commit)
    score_new_tiles(stream, bundles, out, state, (5.0, 15.0)).awaitTermination()
    assert published(spark, out).count() == 28

    # A batch that is replayed after its commit reads no pixel of the maps.
    def no_scan(*_):
        raise AssertionError("scan of the maps")

    monkeypatch.setattr(maps, "read_snapshot", no_scan)
    batch = spark.read.schema(tiles.schema).parquet(source).withColumn("source_file", F.col("_metadata.file_path"))
    name = snapshots.commits(spark, out).first()["batch"]
    assert score_batch(batch, name, bundles, out, (5.0, 15.0)) is False
    assert score_batch(batch, "another name", bundles, out, (5.0, 15.0)) is False


def test_reader_sees_none_or_all_of_a_publication(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "maps")
    schema = "tile STRING, row INT, col INT, v DOUBLE, depth_cm DOUBLE"
    pixels = spark.createDataFrame([("003", i, 0, float(i), d) for i in range(10) for d in (5.0, 15.0)], schema)
    read = lambda version=None: snapshots.read_snapshot(spark, path, pixels.schema, version)
    assert read().count() == 0 and snapshots.latest(spark, path) == 0
    seen = []
    commit = snapshots._commit
    monkeypatch.setattr(snapshots, "_commit", lambda *a: seen.append(read().count()) or commit(*a))
    snapshots.publish(pixels.where("row < 4"), path)
    snapshots.publish(pixels.where("row >= 4"), path)
    snapshots.publish(pixels.where("depth_cm = 5").withColumn("v", F.lit(-1.0)), path, replace=True)
    snapshots.publish(pixels.limit(0), path)
    assert seen == [0, 8, 20, 20]
    assert [read(v).count() for v in range(5)] == [0, 8, 20, 20, 20]
    assert [read(v).where("v = -1").count() for v in range(5)] == [0, 0, 0, 10, 10]
    assert read().select("tile").distinct().collect()[0][0] == "003"
    found = {r["depth_cm"]: (r["n"], r["mark"]) for r in snapshots.published_pairs(spark, path).collect()}
    want = {r["depth_cm"]: (r["n"], r["mark"]) for r in snapshots.pixel_sums(pixels, ["depth_cm"]).collect()}
    assert found == want


def test_digests_find_what_differs(spark):
    schema = "tile STRING, row INT, col INT, depth_cm DOUBLE, v FLOAT, w DOUBLE"
    rows = [(f"t{k}", i, 0, d, float(k + i), None if i == 2 else 1.5 * i) for k in range(30) for i in range(4) for d in (5.0, 15.0)]
    rows += [("x", 0, 0, 5.0, float("nan"), float("inf")), (None, 0, 0, 5.0, 1.0, 1.0)]
    one = spark.createDataFrame(rows, schema)
    tree = snapshots.merkle(one, ["v", "w"])
    tops = lambda t: [r["digest"] for r in t.where("level = 'map'").collect()]
    assert tops(tree) == tops(snapshots.merkle(spark.createDataFrame(rows[::-1], schema), ["v", "w"]))
    assert {r["level"]: r["n"] for r in tree.groupBy("level").agg(F.sum("n_pixels").alias("n")).collect()} == dict.fromkeys(
        ("tile", "branch", "depth", "map"), len(rows)
    )
    twice = snapshots.merkle(spark.createDataFrame([*rows, rows[0], rows[0]], schema), ["v", "w"])
    changed = snapshots.merkle(spark.createDataFrame([*rows[:-5], ("t29", 1, 0, 15.0, -1.0, 1.5), *rows[-4:]], schema), ["v", "w"])
    for other, want in ((twice, ("t0", rows[0][3])), (changed, (rows[-5][0], rows[-5][3]))):
        assert tops(other) != tops(tree)
        assert ("t0" if other is twice else "t29", want[1]) in {(r["tile"], r["depth_cm"]) for r in snapshots.differing_tiles(tree, other).collect()}
    assert snapshots.differing_tiles(tree, tree).count() == 0 and tops(snapshots.merkle(one.limit(0), ["v", "w"])) == []


def published(spark, path, version=None):
    return snapshots.read_snapshot(spark, path, "tile STRING, row INT, col INT, depth_cm DOUBLE", version)


def test_batches_without_rows(spark, tiles, bundles, tmp_path):
    batch = tiles.limit(0).withColumn("source_file", F.lit("f"))
    assert score_batch(batch, "b#0", bundles, str(tmp_path / "out")) is False


def test_tables_round_trip(spark, tmp_path):
    import datetime as dt

    df = spark.createDataFrame([("a", dt.date(2011, 5, 1), 1.5)], "id STRING, observation_date DATE, v DOUBLE")
    path = str(tmp_path / "csv")
    sinks.write_table(df, path)
    back = tables.read_table(spark, path, ["id", "observation_date"], "id STRING, observation_date STRING, v DOUBLE", "csv")
    assert back.collect()[0].asDict() == {"id": "a", "observation_date": "2011-05-01"}
    with pytest.raises(ContractError):
        tables.read_table(spark, path, ["nope"], "id STRING", "csv")
    with pytest.raises(ContractError):
        sinks.write_table(df.withColumnRenamed("v", "v x"), path)


def test_manifest_file(spark, tmp_path):
    path = tmp_path / "tiles.txt"
    path.write_text("b.tif\n\n  # note\n\t a.tif \nB.tif\n#x\n")
    assert [r["entry"] for r in tables.read_manifest(spark, str(path)).collect()] == ["B.tif", "a.tif", "b.tif"]


def test_series_scan_prunes(spark, tmp_path):
    path = str(tmp_path / "series")
    spark.sql(
        "SELECT cast(id % 3 AS bigint) AS cell_id, timestamp_ntz'2009-07-01' + make_interval(0, 0, 0, cast(id AS int) * 30) AS ts, "
        "id AS v, id AS other FROM range(30)"
    ).withColumn("year", F.year("ts")).write.partitionBy("year").parquet(path)
    cells = spark.createDataFrame([(1,)], "cell_id BIGINT")
    got = tables.scan_series(spark.read.parquet(path), "2010-01-01", "2010-12-31", ["v"], cells)
    assert got.columns == ["cell_id", "ts", "v"] and got.where("cell_id <> 1 OR year(ts) <> 2010").count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_decoding_uses_the_kept_lookup(spark):
    table = encode.categories(spark.createDataFrame([("N",), ("M",)], "v STRING"), "v")
    df = spark.createDataFrame(
        [(1.0, 81.0, -9999.0), (2.0, 12.0, float("nan")), (7.0, 42.0, 3.0), (-999.0, -9999.0, None)],
        "LRR_group DOUBLE, NLCD_name DOUBLE, EL_MERIT DOUBLE",
    )
    names = ["LRR_group", "NLCD_name", "EL"]
    got = [tuple(r) for r in features.resolved(df, features.contract(names), (), table).collect()]
    assert sorted(got, key=str) == sorted(
        [("M", "Pasture/Hay", None), ("N", None, None), (None, "Evergreen Forest", 3.0), (None, None, None)], key=str
    )
    # What holds names already keeps them; the table of the contract comes back as it was.
    again = features.resolved(features.resolved(df, features.contract(names), (), table), features.contract(names), (), None)
    assert sorted((tuple(r) for r in again.collect()), key=str) == sorted(got, key=str)
    made = features.contract(TARGETS["soc_density"].features)
    assert features.load_contract(features.contract_table(spark, made)) == made and len(made) == 59
    with pytest.raises(ContractError):
        features.resolved(df, features.contract(["HAND"]))


def test_modelling_table(spark):
    observations = spark.createDataFrame(
        [("a", "s", 40.0, -100.0, 0, 10, "p1", "2", 1.5), ("b", "s", 40.0, -100.0, 10, 30, "p1", "x", 1.0),
         ("c", "t", 41.0, -101.0, 0, 20, "p2", "1", 0.0), ("d", None, 41.0, -101.0, 0, 20, "p9", "1", 1.2)],
        "obs_id STRING, site_id STRING, lat DOUBLE, lon DOUBLE, top_cm INT, bottom_cm INT, point_id STRING, "
        "soc_pct_mass STRING, measured_bulk_density_g_cm3 DOUBLE",
    )
    target = TARGETS["soc_density"]
    bands = {"EL": "EL_MERIT", "SF": "SF_median"}
    names = [bands.get(f, f) for f in target.features if f != "z_mid"]
    values = {"EL_MERIT": -9999.0, "LU_scraped": 2.0, "NLCD_name": 41.0, "LRR_group": 1.0}
    rows = [(p, *[values.get(n, float(k + i)) for i, n in enumerate(names)]) for k, p in enumerate(("p1", "p2"))]
    covariates = spark.createDataFrame(rows, ["point_id", *names])
    lookup = spark.createDataFrame([("M", 1)], "value STRING, code INT")
    table = modelling.modelling_table(observations, covariates, target, lookup)
    got = {r["obs_id"]: r for r in table.collect()}
    assert set(table.columns) >= {*target.features, "SOC_density", "SOC_density_valid"} and len(got) == 4
    assert (got["a"]["SOC_density"], got["a"]["z_mid"], got["a"]["EL"]) == (pytest.approx(0.03), 5.0, None)
    assert (got["b"]["SOC_density"], got["b"]["SOC_density_valid"], got["c"]["SOC_density_valid"]) == (None, False, False)
    assert [got["a"][c] for c in ("LU_scraped", "NLCD_name", "LRR_group")] == ["F", "Deciduous Forest", "M"]
    assert got["d"]["HAND"] is None and got["d"]["LRR_group"] is None
    train, external = model.prepare_tables(table, table, target.features, target)
    assert [r["obs_id"] for r in train.collect()] == ["a"] and external.count() == 2
    with pytest.raises(ContractError, match="point_id repeats"):
        modelling.modelling_table(observations, covariates.union(covariates), target, lookup)

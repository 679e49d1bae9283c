"""Imputation, one-hot columns, prepared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, round_all
from loamline.operators import encode, model
from loamline.schema import TARGETS

TRAIN, EXTERNAL = "l_returnflag <> 'R'", "l_returnflag = 'R'"


def train_and_all(spark, sf):
    """What an imputer learns from, and the whole table it is applied to."""
    rows = S.horizons(spark, sf)
    return rows.where(TRAIN), rows


@query(
    "A27_impute_median",
    f"""WITH {S.HORIZONS}, m AS (SELECT median(caco3) AS caco3, median(bd) AS bd FROM horizons WHERE {TRAIN})
        SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce(h.caco3, m.caco3), 6) + 0.0 AS caco3,
               round(coalesce(h.bd, m.bd), 6) + 0.0 AS bd, round(top_cm, 6) + 0.0 AS top_cm,
               CASE WHEN h.caco3 IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS caco3_missing,
               CASE WHEN h.bd IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS bd_missing
        FROM horizons h, m""",
)
def impute_median(spark, sf):
    train, rest = train_and_all(spark, sf)
    filled = encode.impute_median(train, rest, ["caco3", "bd", "top_cm"])
    return round_all(
        filled.select(
            "l_orderkey", "l_linenumber", "l_partkey", "caco3", "bd", "top_cm", "caco3_missing", "bd_missing"
        )
    )


KIND = "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 'k' || (l_partkey % 7) END"


@query(
    "A28_impute_mode",
    f"""WITH {S.HORIZONS}, k AS (SELECT *, {KIND} AS kind FROM horizons),
        m AS (SELECT kind AS top FROM k WHERE {TRAIN} AND kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)
        SELECT l_orderkey, l_linenumber, l_partkey, coalesce(kind, top) AS kind FROM k, m""",
)
def impute_mode(spark, sf):
    train, rest = (df.withColumn("kind", F.expr(KIND)) for df in train_and_all(spark, sf))
    filled = encode.impute_mode(train, rest, ["kind"])
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", "kind")


@query(
    "A29_one_hot",
    f"""WITH {S.HORIZONS}, k AS (SELECT *, CASE WHEN {EXTERNAL} AND l_partkey % 11 = 0 THEN 'new' ELSE 'k' || (l_partkey % 4) END AS kind
          FROM horizons) SELECT l_orderkey, l_linenumber, l_partkey, """
    + ", ".join(f"CASE WHEN kind = 'k{i}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS kind_{i + 1}" for i in range(4))
    + " FROM k",
)
def one_hot(spark, sf):
    kind = f"CASE WHEN {EXTERNAL} AND l_partkey % 11 = 0 THEN 'new' ELSE 'k' || (l_partkey % 4) END"
    train, rest = (df.withColumn("kind", F.expr(kind)) for df in train_and_all(spark, sf))
    coded = encode.one_hot(train, rest, "kind")
    return coded.select("l_orderkey", "l_linenumber", "l_partkey", *[f"kind_{i}" for i in range(1, 5)])


@query(
    "A29_one_hot_vector",
    f"""WITH {S.HORIZONS}, levels AS (
          SELECT kind, row_number() OVER (ORDER BY kind) - 1 AS place, count(*) OVER () AS size
          FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS kind FROM horizons WHERE {TRAIN}))
        SELECT l_orderkey, l_linenumber, l_partkey, CAST((SELECT max(size) FROM levels) AS INTEGER) AS size,
               CAST(place AS INTEGER) AS place, CASE WHEN place IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS total
        FROM horizons LEFT JOIN levels ON kind = CAST(l_partkey AS VARCHAR)""",
)
def one_hot_vector(spark, sf):
    """As many levels as there are parts, as a sparse vector."""
    train, rest = (df.withColumn("kind", F.col("l_partkey").cast("string")) for df in train_and_all(spark, sf))
    coded = encode.one_hot_vector(train, rest, "kind", "hot")
    return coded.select(
        "l_orderkey", "l_linenumber", "l_partkey", "hot.size", F.get("hot.indices", F.lit(0)).alias("place"),
        F.aggregate("hot.values", F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query(
    "M01_prepare_tables",
    f"""WITH {S.HORIZONS} SELECT 'train' AS part, l_orderkey || '-' || l_linenumber AS obs_id,
        round((top_cm + bottom_cm) / 2, 6) + 0.0 AS z_mid, round(c_tot, 6) + 0.0 AS "SOC_pct" FROM horizons
        WHERE {TRAIN} AND c_tot >= 0 AND c_tot < 12.5 AND site_id IS NOT NULL
        UNION ALL SELECT 'external', l_orderkey || '-' || l_linenumber, round((top_cm + bottom_cm) / 2, 6) + 0.0,
        round(c_tot, 6) + 0.0 FROM horizons WHERE {EXTERNAL} AND c_tot >= 0 AND lat BETWEEN -90 AND 90""",
)
def prepare_tables(spark, sf):
    def named(df):
        return df.withColumns(
            {
                "obs_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
                "SOC_pct": F.col("c_tot").cast("string"), "top_cm": F.col("top_cm").cast("string"),
            }
        )

    rows = named(S.horizons(spark, sf))
    train, external = rows.where(TRAIN), rows.where(EXTERNAL)
    train, external = model.prepare_tables(
        train, external, ["caco3", "bd", "z_mid"], TARGETS["soc_pct"]
    )
    both = train.withColumn("part", F.lit("train")).unionByName(external.withColumn("part", F.lit("external")))
    return round_all(both.select("part", "obs_id", "z_mid", "SOC_pct"))


@query(
    "J11_join_predictions",
    f"""WITH {S.PAIRS}, o AS (SELECT l_orderkey || '-' || l_linenumber AS obs_id, max(observed) AS observed,
          max(predicted) AS predicted, max(z_mid) AS z_mid FROM pairs GROUP BY ALL)
        SELECT obs_id, round(z_mid, 6) + 0.0 AS z_mid, round(predicted, 6) + 0.0 AS point_prediction FROM o""",
)
def join_predictions(spark, sf):
    unique = S.pairs(spark, sf).groupBy(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("obs_id")
    ).agg(*[F.max(c).alias(c) for c in ("observed", "predicted", "z_mid")])
    joined = model.join_predictions(
        unique.select("obs_id", "z_mid"), unique.select("obs_id", "observed", "predicted")
    )
    return round_all(joined)

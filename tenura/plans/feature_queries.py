"""Queries that fit and apply imputation and encoding."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenura.operators import features
from tenura.plans.registry import query, rounded
from tenura.sources.views import view, with_views

V = with_views("encodable")
CATS, NUMS, MULTI = ("priority", "sex", "site"), ("amount", "weight"), "tags"


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM encodable WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)"


def _median(c: str) -> str:
    return f"(SELECT MEDIAN({c}) FROM encodable)"


@query("impute_mode", V + f"""
    SELECT id, COALESCE(priority, {_mode('priority')}) AS priority, COALESCE(site, {_mode('site')}) AS site
    FROM encodable""")
def impute_mode(spark, folder):
    return features.impute_mode(view(spark, folder, "encodable"), ["priority", "site"]).select("id", "priority", "site")


@query("impute_median", V + f"""
    SELECT id, ROUND(COALESCE(amount, {_median('amount')}), 6) AS amount,
           ROUND(COALESCE(CAST(weight AS DOUBLE), {_median('weight')}), 6) AS weight FROM encodable""")
def impute_median(spark, folder):
    return rounded(
        features.impute_median(view(spark, folder, "encodable"), NUMS).select("id", "amount", "weight")
    )


# Levels per column: all if at most 30, else the 29 most frequent and one shared level.
_FILLED = V + ", filled AS (SELECT id, " + ", ".join(f"COALESCE({c}, {_mode(c)}) AS {c}" for c in CATS) + f""",
        COALESCE(amount, {_median('amount')}) AS amount, COALESCE(CAST(weight AS DOUBLE), {_median('weight')}) AS weight,
        COALESCE(tags, '') AS tags FROM encodable),
    cells AS (""" + " UNION ALL ".join(f"SELECT id, '{c}' AS col, {c} AS v FROM filled" for c in CATS) + """),
    counted AS (SELECT col, v, COUNT(*) AS n FROM cells GROUP BY 1, 2),
    placed AS (SELECT col, v, ROW_NUMBER() OVER (PARTITION BY col ORDER BY n DESC, v) AS pos,
                      ROW_NUMBER() OVER (PARTITION BY col ORDER BY v) AS abc,
                      COUNT(*) OVER (PARTITION BY col) AS size FROM counted),
    cats AS (SELECT c.id, CASE WHEN p.size > 30 AND p.pos > 29 THEN 'cats__' || c.col || '_infrequent'
                               ELSE 'cats__' || c.col || '_' || c.v END AS feature, 1.0::DOUBLE AS value
             FROM cells c JOIN placed p ON c.col = p.col AND c.v = p.v WHERE NOT (p.size = 2 AND p.abc = 1)),
    words AS (SELECT DISTINCT id, TRIM(UNNEST(STRING_SPLIT(tags, ','))) AS t FROM filled),
    vocab AS (SELECT t FROM words WHERE t <> '' GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 30),
    multi AS (SELECT id, 'multiuse__' || t AS feature, 1.0::DOUBLE AS value FROM words WHERE t IN (SELECT t FROM vocab)),
    nums AS (SELECT id, 'num__amount' AS feature, amount AS value FROM filled WHERE amount <> 0
             UNION ALL SELECT id, 'num__weight', weight FROM filled WHERE weight <> 0)"""


def _long(df, names: list[str], vector: str = "features"):
    """Vector as one row per non-zero entry."""
    cells = df.select("id", F.posexplode(vector_to_array(vector)).alias("at", "value")).where(F.col("value") != 0)
    named = F.element_at(F.array(*map(F.lit, names)), F.col("at") + 1)
    return rounded(cells.select("id", named.alias("feature"), "value"))


@query("one_hot", _FILLED + " SELECT id, feature, value FROM cats")
def one_hot(spark, folder):
    df = view(spark, folder, "encodable")
    model = features.make_encoder(CATS, ()).fit(df)
    return _long(model.transform(df), model.feature_names())


@query("multi_hot", _FILLED + " SELECT id, feature, value FROM multi")
def multi_hot(spark, folder):
    df = view(spark, folder, "encodable")
    model = features.make_encoder((), (), MULTI).fit(df)
    return _long(model.transform(df), model.feature_names())


_ALL = """ SELECT id, feature, ROUND(value, 6) AS value
    FROM (SELECT * FROM cats UNION ALL SELECT * FROM multi UNION ALL SELECT * FROM nums)"""


@query("encode_features", _FILLED + _ALL)
def encode_features(spark, folder):
    df = view(spark, folder, "encodable")
    model = features.make_encoder(CATS, NUMS, MULTI).fit(df)
    return _long(model.transform(df), model.feature_names())


@query("encode_features_dense", _FILLED + _ALL)
def encode_features_dense(spark, folder):
    df = view(spark, folder, "encodable")
    dense, _ = features.make_encoder_pair(CATS, NUMS, MULTI)
    model = dense.fit(df)
    return _long(model.transform(df), model.feature_names())


@query("feature_names", _FILLED + """,
    names AS (SELECT DISTINCT CASE col WHEN 'priority' THEN 1 WHEN 'sex' THEN 2 ELSE 3 END AS grp,
                     CASE WHEN size > 30 AND pos > 29 THEN 1 ELSE 0 END AS last,
                     CASE WHEN size > 30 AND pos > 29 THEN 'infrequent' ELSE v END AS sortv,
                     'cats__' || col || '_' || CASE WHEN size > 30 AND pos > 29 THEN 'infrequent' ELSE v END AS name
              FROM placed WHERE NOT (size = 2 AND abc = 1)
              UNION ALL SELECT 4, 0, t, 'multiuse__' || t FROM vocab
              UNION ALL SELECT 5, 0, 'a', 'num__amount' UNION ALL SELECT 5, 0, 'b', 'num__weight')
    SELECT ROW_NUMBER() OVER (ORDER BY grp, last, sortv) - 1 AS position, name,
           name NOT LIKE 'num%' AS is_categorical FROM names""")
def feature_names(spark, folder):
    model = features.make_encoder(CATS, NUMS, MULTI).fit(view(spark, folder, "encodable"))
    rows = list(zip(range(1000), model.feature_names(), model.categorical_mask()))
    return spark.createDataFrame(rows, "position long, name string, is_categorical boolean")

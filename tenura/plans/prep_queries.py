"""Queries that join, shape and profile the HR extracts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tenura.operators import correlation, prep, profile
from tenura.plans.registry import query, rounded
from tenura.session import fresh_path
from tenura.sources import files
from tenura.sources.views import view, with_views

CENTRAL = with_views("central")
TYPES = {
    "id_employee": "bigint", "departement": "string", "revenu": "double", "site": "int",
    "eval_number": "string", "nb_evals": "bigint", "note_moyenne": "double", "nb_reponses": "bigint",
    "satisfaction": "double", "a_quitte_l_entreprise": "string",
}
EXTRACT_SCHEMAS = {
    "sirh": "id_employee long, departement string, revenu double, site int",
    "evals": "eval_number string, nb_evals long, note_moyenne double",
    "survey": "code_sondage long, nb_reponses long, satisfaction double",
}
JOINED = with_views("sirh", "evals", "survey") + """
    SELECT s.id_employee, s.departement, s.revenu, s.site, e.eval_number, e.nb_evals, e.note_moyenne,
           v.nb_reponses, v.satisfaction
    FROM sirh s
    LEFT JOIN evals e ON s.id_employee = CAST(REGEXP_EXTRACT(e.eval_number, '([0-9]+)', 1) AS BIGINT)
    LEFT JOIN survey v ON v.code_sondage = s.id_employee"""


@query("build_central", JOINED)
def build_central(spark, folder):
    return prep.build_central(*[view(spark, folder, v) for v in ("sirh", "evals", "survey")])


@query("src_csv_roundtrip", JOINED)
def src_csv_roundtrip(spark, folder):
    paths = {}
    for name in EXTRACT_SCHEMAS:
        paths[name] = fresh_path(spark, f"csv-{name}")
        view(spark, folder, name).write.option("header", True).csv(paths[name])
    raw = files.load_raw_sources(spark, paths["sirh"], paths["evals"], paths["survey"], EXTRACT_SCHEMAS)
    return prep.build_central(raw["sirh"], raw["evals"], raw["survey"])


@query("standardize_columns", """
    SELECT c_custkey AS customer_key, c_mktsegment AS market_segment, c_acctbal AS "account__balance"
    FROM customer""")
def standardize_columns(spark, folder):
    messy = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias(" Customer Key "), F.col("c_mktsegment").alias("MARKET Segment"),
        F.col("c_acctbal").alias("Account  Balance"),
    )
    return prep.standardize_columns(messy)


@query("target_map", CENTRAL + """
    SELECT id_employee, CASE a_quitte_l_entreprise WHEN 'Oui' THEN 1 WHEN 'Non' THEN 0 END AS label FROM central""")
def target_map(spark, folder):
    return prep.map_target(view(spark, folder, "central")).select("id_employee", "label")


_NUMERIC = ("bigint", "double", "int")


@query("split_feature_types", CENTRAL + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{'numeric' if t in _NUMERIC else 'categorical'}' AS kind, "
    f"COUNT({c}) AS n_known FROM central" for c, t in TYPES.items() if c != "a_quitte_l_entreprise"))
def split_feature_types(spark, folder):
    central = view(spark, folder, "central")
    numeric, other = prep.split_feature_types(central, prep.TARGET)
    known = central.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.lit("numeric" if c in numeric else "categorical").alias("kind"),
                         F.count(c).alias("n_known"))
                for c in numeric + other
            ]
        ).alias("rows")
    )
    return known.select(F.inline("rows"))


@query("select_uncorrelated", CENTRAL + """
    SELECT departement, revenu, site, nb_evals, satisfaction FROM central""")
def select_uncorrelated(spark, folder):
    path = fresh_path(spark, "drop-list")
    files.write_drop_list(spark, ["note_moyenne", "nb_reponses", "niveau_hierarchique_poste"], path)
    dropped = files.read_drop_list(spark, path)
    return prep.select_uncorrelated(
        view(spark, folder, "central"), dropped, ["id_employee", "eval_number", prep.TARGET]
    )


@query("head_sample", CENTRAL + "SELECT * FROM central ORDER BY id_employee LIMIT 100")
def head_sample(spark, folder):
    return prep.head_sample(view(spark, folder, "central"), ["id_employee"])


@query("class_balance", CENTRAL + """
    SELECT COUNT(*) FILTER (a_quitte_l_entreprise = 'Non') AS class_0_stayed,
           COUNT(*) FILTER (a_quitte_l_entreprise = 'Oui') AS class_1_left,
           ROUND(COUNT(*) FILTER (a_quitte_l_entreprise = 'Oui') / COUNT(a_quitte_l_entreprise), 6) AS attrition_rate
    FROM central""")
def class_balance(spark, folder):
    return rounded(prep.class_balance(prep.map_target(view(spark, folder, "central"))))


_CELLS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, '{t}' AS dtype, CAST({c} AS VARCHAR) AS v, COUNT(*) AS cnt FROM central GROUP BY 3"
    for c, t in TYPES.items()
)
_PROFILE = CENTRAL + f""", cells AS ({_CELLS}),
    tops AS (SELECT col, v, cnt, ROW_NUMBER() OVER (
                 PARTITION BY col ORDER BY cnt DESC, v IS NULL DESC, v) AS pos FROM cells),
    stats AS (SELECT col, dtype, COUNT(*) AS nunique,
                 CAST(COALESCE(SUM(cnt) FILTER (v IS NULL), 0) AS BIGINT) AS n_missing,
                 CAST(SUM(cnt) AS BIGINT) AS total FROM cells GROUP BY 1, 2),
    profile AS (SELECT s.col AS "column", s.dtype, s.nunique, s.n_missing,
                 ROUND(s.n_missing / s.total, 6) AS pct_missing, t.v AS top_value,
                 ROUND(t.cnt / s.total, 6) AS top_ratio
          FROM stats s JOIN tops t ON s.col = t.col AND t.pos = 1)"""


@query("profile_columns", _PROFILE + " SELECT * FROM profile")
def profile_columns(spark, folder):
    return rounded(profile.profile_columns(view(spark, folder, "central")))


@query("profile_flags", _PROFILE + """
    SELECT 'constant' AS flag, "column" FROM profile WHERE nunique <= 1
    UNION ALL SELECT 'quasi_constant', "column" FROM profile WHERE top_ratio >= 0.9 AND nunique > 1
    UNION ALL SELECT 'high_missing', "column" FROM profile WHERE pct_missing >= 0.8
    UNION ALL SELECT 'moderate_missing', "column" FROM profile WHERE pct_missing >= 0.4 AND pct_missing < 0.8""")
def profile_flags(spark, folder):
    return profile.profile_flags(profile.profile_columns(view(spark, folder, "central")), quasi_constant=0.9)


_FREQ = """
    , counts AS (SELECT v AS value, COUNT(*) AS frequency FROM vals GROUP BY 1)
    SELECT value, frequency, ROUND(100.0 * frequency / (SELECT SUM(frequency) FROM counts), 6) AS percentage,
           (SELECT COUNT(*) FROM counts) AS n_unique FROM counts"""


@query("value_freq", CENTRAL + """
    , vals AS (SELECT CAST(nb_evals AS VARCHAR) AS v FROM central WHERE nb_evals IS NOT NULL)""" + _FREQ)
def value_freq(spark, folder):
    return rounded(profile.value_frequencies(view(spark, folder, "central"), "nb_evals"))


@query("value_freq_split", with_views("skills") + """
    , parts AS (SELECT TRIM(UNNEST(STRING_SPLIT(tags, ','))) AS v FROM skills WHERE tags IS NOT NULL)
    , vals AS (SELECT v FROM parts WHERE v <> '')""" + _FREQ)
def value_freq_split(spark, folder):
    return rounded(profile.value_frequencies(view(spark, folder, "skills"), "tags", split=True))


@query("rate_by_category", CENTRAL + """
    SELECT departement, COUNT(a_quitte_l_entreprise) AS n,
           ROUND(COUNT(*) FILTER (a_quitte_l_entreprise = 'Oui') / COUNT(*), 6) AS taux_depart
    FROM central WHERE departement IS NOT NULL GROUP BY 1""")
def rate_by_category(spark, folder):
    return rounded(profile.rate_by_category(view(spark, folder, "central"), "departement"))


NUMBERS = ("quantity", "price", "discount", "tax", "line", "net")
_N = with_views("numeric")
_PAIRS = " UNION ALL ".join(
    f"SELECT {i} AS pos, '{a}' AS col_i, '{b}' AS col_j, ABS(CORR({a}, {b})) AS abs_corr FROM numeric"
    for i, (a, b) in enumerate(combinations(NUMBERS, 2))
)
_MATRIX = _N + f", pairs AS ({_PAIRS})"


@query("corr_pairs", _MATRIX + " SELECT col_i, col_j, ROUND(abs_corr, 6) AS abs_corr FROM pairs")
def corr_pairs(spark, folder):
    return rounded(correlation.correlation_pairs(view(spark, folder, "numeric"), NUMBERS))


_CENTRAL_NUMBERS = ("revenu", "site", "nb_evals", "note_moyenne", "nb_reponses", "satisfaction")


@query("corr_pairs_nulls", CENTRAL + " UNION ALL ".join(
    f"SELECT '{a}' AS col_i, '{b}' AS col_j, ROUND(ABS(CORR({a}, {b})), 6) AS abs_corr FROM central"
    for a, b in combinations(_CENTRAL_NUMBERS, 2)))
def corr_pairs_nulls(spark, folder):
    return rounded(correlation.correlation_pairs(view(spark, folder, "central"), _CENTRAL_NUMBERS))


_MEANS = _MATRIX + """,
    ends AS (SELECT col_i AS c, abs_corr FROM pairs UNION ALL SELECT col_j, abs_corr FROM pairs
             UNION ALL SELECT DISTINCT col_i, 0.0 FROM pairs UNION ALL SELECT 'net', 0.0),
    means AS (SELECT c AS "column", AVG(abs_corr) AS mean_abs FROM ends GROUP BY 1)"""


@query("corr_mean_abs", _MEANS + ' SELECT "column", ROUND(mean_abs, 6) AS mean_abs FROM means')
def corr_mean_abs(spark, folder):
    pairs = correlation.correlation_pairs(view(spark, folder, "numeric"), NUMBERS)
    return rounded(correlation.mean_abs_correlation(pairs, NUMBERS))


@query("corr_drop_list", _MEANS.replace("WITH ", "WITH RECURSIVE ", 1) + """,
    strong AS (SELECT p.col_i, p.col_j, ROW_NUMBER() OVER (ORDER BY p.abs_corr DESC, p.col_i, p.col_j) AS step,
                      CASE WHEN a.mean_abs >= b.mean_abs THEN p.col_i ELSE p.col_j END AS loser
               FROM pairs p JOIN means a ON p.col_i = a."column" JOIN means b ON p.col_j = b."column"
               WHERE p.abs_corr >= 0.85),
    walk AS (SELECT CAST(0 AS BIGINT) AS step, CAST([] AS VARCHAR[]) AS gone
             UNION ALL
             SELECT s.step, CASE WHEN LIST_CONTAINS(w.gone, s.col_i) OR LIST_CONTAINS(w.gone, s.col_j) THEN w.gone
                                 ELSE LIST_APPEND(w.gone, s.loser) END
             FROM walk w JOIN strong s ON s.step = w.step + 1)
    SELECT UNNEST(gone) AS "column" FROM walk WHERE step = (SELECT MAX(step) FROM walk)""")
def corr_drop_list(spark, folder):
    dropped, _ = correlation.suggest_correlated(view(spark, folder, "numeric"), NUMBERS, threshold=0.85)
    return spark.createDataFrame([(c,) for c in dropped], "column string")


def _rank_sql(c: str) -> str:
    return f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}"


_RANKED = ("quantity", "price", "discount", "line")


@query("corr_spearman", _N + f", ranks AS (SELECT {', '.join(map(_rank_sql, _RANKED))} FROM numeric) "
       + " UNION ALL ".join(
           f"SELECT '{a}' AS col_i, '{b}' AS col_j, ROUND(ABS(CORR(r_{a}, r_{b})), 6) AS abs_corr FROM ranks"
           for a, b in combinations(_RANKED, 2)))
def corr_spearman(spark, folder):
    return rounded(correlation.correlation_pairs(view(spark, folder, "numeric"), _RANKED, "spearman"))


_TAU = ("quantity", "discount", "tax", "line")


def _tau_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS col_i, '{b}' AS col_j, ROUND(ABS(
        SUM(p.w * q.w * SIGN(p.x - q.x) * SIGN(p.y - q.y)) FILTER (p.x <> q.x AND p.y <> q.y)
        / SQRT(SUM(p.w * q.w) FILTER (p.x <> q.x)) / SQRT(SUM(p.w * q.w) FILTER (p.y <> q.y))), 6) AS abs_corr
        FROM (SELECT {a} AS x, {b} AS y, CAST(COUNT(*) AS DOUBLE) AS w FROM numeric GROUP BY 1, 2) p,
             (SELECT {a} AS x, {b} AS y, CAST(COUNT(*) AS DOUBLE) AS w FROM numeric GROUP BY 1, 2) q"""


@query("corr_kendall", _N + " UNION ALL ".join(_tau_sql(a, b) for a, b in combinations(_TAU, 2)))
def corr_kendall(spark, folder):
    return rounded(correlation.correlation_pairs(view(spark, folder, "numeric"), _TAU, "kendall"))

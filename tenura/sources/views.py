"""HR-shaped views over the given tables.

There are no HR extracts, so the operators run on views of the sales, event, text and vector
tables.  Each view is one SELECT in plain SQL that Spark and the checking engine both accept;
``{name}`` stands for a table or an earlier view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    # Three HR extracts; their columns are the given ones under HR names.  Means are taken over
    # whole cents, so that they do not depend on the order of addition.
    "sirh": """
        SELECT c_custkey AS id_employee, c_mktsegment AS departement,
               c_acctbal AS revenu, c_nationkey AS site
        FROM {customer}""",
    "evals": """
        SELECT 'E_' || CAST(o_custkey AS STRING) AS eval_number,
               COUNT(*) AS nb_evals,
               CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100 AS note_moyenne
        FROM {orders} WHERE o_orderdate >= CAST('2001-01-01' AS TIMESTAMP)
        GROUP BY o_custkey""",
    "survey": """
        SELECT user_id AS code_sondage, COUNT(*) AS nb_reponses,
               
               CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100 AS satisfaction
        FROM {events} GROUP BY user_id""",
    "central": """
        SELECT s.id_employee, s.departement, s.revenu, s.site,
               e.eval_number, e.nb_evals, e.note_moyenne, v.nb_reponses, v.satisfaction,
               CASE WHEN e.eval_number IS NULL THEN NULL
                    WHEN s.revenu < 0 THEN 'Oui' ELSE 'Non' END AS a_quitte_l_entreprise
        FROM {sirh} s
        LEFT JOIN {evals} e ON 'E_' || CAST(s.id_employee AS STRING) = e.eval_number
        LEFT JOIN {survey} v ON s.id_employee = v.code_sondage""",
    # Audit log: one request per order, one prediction per order line.
    "requests": """
        SELECT o.o_orderkey AS id, o.o_orderdate AS created_at, o.o_orderpriority AS endpoint,
               CASE o.o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 422 ELSE 500 END AS http_status,
               CAST(FLOOR(o.o_totalprice / 1000) AS INT) AS response_time_ms,
               '{{"departement":"' || c.c_mktsegment || '"}}' AS request_data
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    "predictions": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' ||
               CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id,
               l_orderkey AS request_id, l_shipdate AS created_at,
               CAST(l_partkey AS STRING) AS employee_id, l_discount * 10 AS attrition_prob,
               CASE WHEN l_discount * 10 * 100 < 40 THEN 'LOW'
                    WHEN l_discount * 10 * 100 < 60 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
               l_returnflag AS model_version
        FROM {lineitem}""",
    # Labels with scores: small (texts with a quality label) and large (order lines).
    "scored": """
        SELECT d.doc_id AS id, l.quality AS y,
               CAST(d.n_chars AS DOUBLE) / (d.n_chars + 1000) AS score
        FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
    "big_scored": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' ||
               CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' ||
               CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING) AS id,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
               l_extendedprice / (l_extendedprice + 50000) AS score,
               l_quantity / 50 AS gate, l_discount * 10 AS pos_score, l_tax * 10 AS neg_score
        FROM {lineitem}""",
    "emb": """
        SELECT vec_id AS id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, embedding AS x
        FROM {embeddings}""",
    "numeric": """
        SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount,
               l_tax AS tax, CAST(l_linenumber AS DOUBLE) AS line,
               l_extendedprice * (1 - l_discount) AS net
        FROM {lineitem}""",
    # Employee records as text, as a lenient reader of request payloads delivers them.
    # Values run out of range, are missing, fractional or words now and then.
    "employees_raw": """
        SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL
                    ELSE 'EMP_' || CAST(c_custkey AS STRING) END AS employee_id,
               c_custkey,
               CASE WHEN c_custkey % 89 = 0 THEN 'many'
                    WHEN c_custkey % 83 = 0 THEN NULL
                    WHEN c_custkey % 79 = 0 THEN '35.5'
                    WHEN c_custkey % 73 = 0 THEN '35.0'
                    ELSE CAST(16 + (c_custkey * 7) % 56 AS STRING) END AS age,
               CAST(c_acctbal + 900 AS STRING) AS revenu_mensuel,
               CAST((c_custkey * 3) % 12 AS STRING) AS nombre_experiences_precedentes,
               CAST(30 + c_custkey % 20 AS STRING) AS nombre_heures_travailless,
               CAST((c_custkey * 5) % 15 AS STRING) AS annees_dans_le_poste_actuel,
               CAST(1 + c_custkey % 5 AS STRING) AS satisfaction_employee_environnement,
               CASE WHEN c_custkey % 101 = 7 THEN NULL
                    ELSE CAST(1 + (c_custkey * 2) % 5 AS STRING) END AS note_evaluation_precedente,
               CAST(1 + (c_custkey * 3) % 5 AS STRING) AS satisfaction_employee_nature_travail,
               CAST(1 + (c_custkey * 7) % 5 AS STRING) AS satisfaction_employee_equipe,
               CAST(1 + (c_custkey * 11) % 5 AS STRING) AS satisfaction_employee_equilibre_pro_perso,
               CAST(1 + (c_custkey * 13) % 4 AS STRING) AS note_evaluation_actuelle,
               CAST(c_custkey % 4 AS STRING) AS nombre_participation_pee,
               CAST(c_custkey % 7 AS STRING) AS nb_formations_suivies,
               CAST(c_custkey % 3 - CASE WHEN c_custkey % 61 = 0 THEN 5 ELSE 0 END AS STRING)
                   AS nombre_employee_sous_responsabilite,
               CAST((c_custkey * 17) % 30 AS STRING) AS distance_domicile_travail,
               CAST(1 + (c_custkey * 19) % 5 AS STRING) AS niveau_education,
               CAST((c_custkey * 23) % 16 AS STRING) AS annees_depuis_la_derniere_promotion,
               CAST((c_custkey * 29) % 18 AS STRING) AS annes_sous_responsable_actuel,
               CASE c_custkey % 7 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Homme'
                    WHEN 3 THEN 'Femme' WHEN 4 THEN 'M' WHEN 5 THEN 'F'
                    ELSE CASE WHEN c_custkey % 5 = 0 THEN 'Unknown' ELSE 'Male' END END AS genre,
               CASE c_custkey % 6 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' WHEN 2 THEN 'Divorced'
                    WHEN 3 THEN 'Célibataire' WHEN 4 THEN 'Marié' ELSE 'Divorcé' END AS statut_marital,
               c_mktsegment AS departement,
               'Poste ' || CAST(c_nationkey AS STRING) AS poste,
               CASE c_nationkey % 3 WHEN 0 THEN 'Chemistry' WHEN 1 THEN 'Génie & Matériaux'
                    ELSE 'Droit de l''entreprise' END AS domaine_etude,
               CASE WHEN c_custkey % 71 = 0 THEN 'Maybe' WHEN c_custkey % 3 = 0 THEN 'Yes'
                    ELSE 'No' END AS heure_supplementaires
        FROM {customer}""",
    # Comma lists per customer for the multi-valued column operators.
    "skills": """
        SELECT o_orderkey AS id, o_custkey AS employee,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL
                    ELSE ' ' || o_orderpriority || ', ' || o_orderstatus || ' ,, P' ||
                         CAST(o_custkey % 40 AS STRING) END AS tags
        FROM {orders}""",
    # Text, list and number columns with gaps for the encoders.
    "encodable": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS priority,
               CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL
                    ELSE 'S' || CAST(o_custkey % 45 AS STRING) END AS site,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL
                    ELSE ' ' || o_orderpriority || ', ' || o_orderstatus || ' ,, P' ||
                         CAST(o_custkey % 40 AS STRING) END AS tags,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS amount,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 100 END AS weight
        FROM {orders}""",
    # Employee records with a target that follows overtime, satisfaction and seniority.
    "attrition": """
        SELECT *, CASE WHEN (c_custkey * 7919) % 1000 <
                       40 + CASE WHEN heure_supplementaires = 'Yes' THEN 250 ELSE 0 END
                       + CASE WHEN satisfaction_employee_environnement = '1' THEN 200 ELSE 0 END
                       + CASE WHEN annees_dans_le_poste_actuel IN ('0', '5') THEN 200 ELSE 0 END
                       THEN 'Oui' ELSE 'Non' END AS a_quitte_l_entreprise
        FROM {employees_raw}""",
}

_NAME = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def _closure(name: str) -> list[str]:
    """The view and the views below it, lowest first."""
    order: list[str] = []
    for used in _NAME.findall(VIEWS[name]):
        if used in VIEWS:
            order += [v for v in _closure(used) if v not in order]
    return order + [name]


def with_views(*names: str) -> str:
    """``WITH`` prefix that defines the named views over tables known by their bare names."""
    ordered: list[str] = []
    for name in names:
        ordered += [v for v in _closure(name) if v not in ordered]
    bodies = ", ".join(f"{v} AS ({_fill(VIEWS[v], {})})" for v in ordered)
    return f"WITH {bodies} "


def _fill(text: str, places: dict[str, str]) -> str:
    body = _NAME.sub(lambda m: places.get(m.group(1), m.group(1)), text)
    return body.replace("{{", "{").replace("}}", "}")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The view as a DataFrame over the parquet files of ``folder``."""
    places = {t: f"parquet.`{folder}/{t}.parquet`" for t in TABLES}
    ordered = _closure(name)
    ctes = ", ".join(f"{v} AS ({_fill(VIEWS[v], places)})" for v in ordered)
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}")

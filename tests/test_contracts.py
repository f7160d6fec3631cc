"""The record contract: limits, vocabularies, types, batch sizes and output ranges."""

import pytest
from pyspark.sql import functions as F

from tenura.functions.risk import decision_columns
from tenura.operators import prep, quality
from tenura.sources import files

GOOD = {
    "employee_id": "staff-17", "age": "44", "revenu_mensuel": "3871.25", "nombre_experiences_precedentes": "6",
    "nombre_heures_travailless": "36", "annees_dans_le_poste_actuel": "9", "satisfaction_employee_environnement": "2",
    "note_evaluation_precedente": "4", "satisfaction_employee_nature_travail": "5", "satisfaction_employee_equipe": "1",
    "satisfaction_employee_equilibre_pro_perso": "2", "note_evaluation_actuelle": "1", "nombre_participation_pee": "0",
    "nb_formations_suivies": "7", "nombre_employee_sous_responsabilite": "4", "distance_domicile_travail": "23",
    "niveau_education": "5", "annees_depuis_la_derniere_promotion": "8", "annes_sous_responsable_actuel": "3",
    "genre": "F", "statut_marital": "Divorced", "departement": "Warehouse", "poste": "Shift planner",
    "domaine_etude": "Logistics", "heure_supplementaires": "Yes",
}
CASES = [
    ({}, []),
    ({"age": None}, ["age:required"]),
    ({"age": "17"}, ["age:range"]), ({"age": "18"}, []), ({"age": "70"}, []), ({"age": "71"}, ["age:range"]),
    ({"age": "many"}, ["age:whole_number"]), ({"age": "28.4"}, ["age:whole_number"]), ({"age": "28.0"}, []),
    ({"revenu_mensuel": "-12.5"}, ["revenu_mensuel:range"]), ({"revenu_mensuel": "0"}, ["revenu_mensuel:range"]),
    ({"revenu_mensuel": "0.01"}, []), ({"revenu_mensuel": "much"}, ["revenu_mensuel:number"]),
    ({"satisfaction_employee_equipe": "0"}, ["satisfaction_employee_equipe:range"]),
    ({"satisfaction_employee_equipe": "6"}, ["satisfaction_employee_equipe:range"]),
    ({"note_evaluation_actuelle": "5"}, ["note_evaluation_actuelle:range"]),
    ({"nombre_experiences_precedentes": "-1"}, ["nombre_experiences_precedentes:range"]),
    ({"nombre_heures_travailless": "168"}, []), ({"nombre_heures_travailless": "169"}, ["nombre_heures_travailless:range"]),
    ({"distance_domicile_travail": "100000"}, []),
    ({"heure_supplementaires": "Yes"}, []), ({"heure_supplementaires": "Maybe"}, ["heure_supplementaires:enum"]),
    ({"genre": "Homme", "statut_marital": "Marié"}, []), ({"genre": "Unknown"}, ["genre:enum"]),
    ({"genre": "male"}, ["genre:enum"]), ({"statut_marital": "Célibataire"}, []),
    ({"poste": "Maître d'hôtel", "departement": "Achats & Ventes", "domaine_etude": "Génie civil – à Orléans"}, []),
    ({"employee_id": None}, ["employee_id:required"]),
    ({"age": "12", "genre": None, "niveau_education": "x"},
     ["genre:required", "niveau_education:whole_number", "age:range"]),
]


def test_cases(spark):
    rows = [(i, *{**GOOD, **change}.values()) for i, (change, _) in enumerate(CASES)]
    schema = "i int, " + ", ".join(f"{n} string" for n in GOOD)
    checked = quality.validate(spark.createDataFrame(rows, schema))
    shown = F.transform("errors", lambda e: F.concat_ws(":", e["field"], e["rule"]))
    found = {r["i"]: (r["is_valid"], r["e"]) for r in checked.select("i", "is_valid", shown.alias("e")).collect()}
    for i, (change, want) in enumerate(CASES):
        assert found[i] == (not want, want), change


def test_extremes_are_valid(spark):
    low = {f: str(lo) for f, (lo, _) in quality.INTEGER_FIELDS.items()}
    high = {f: str(hi if hi is not None else 10**6) for f, (_, hi) in quality.INTEGER_FIELDS.items()}
    schema = ", ".join(f"{n} string" for n in GOOD)
    df = spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in (low, high)], schema)
    valid, quarantine = quality.split_valid(df)
    assert valid.count() == 2 and quarantine.count() == 0
    assert dict(valid.dtypes)["age"] == "int" and dict(valid.dtypes)["revenu_mensuel"] == "double"


def test_a_filter_after_validation_stays_small(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], ", ".join(f"{n} string" for n in GOOD))
    valid, _ = quality.split_valid(df)
    wide = valid.select("*", *[(F.col(f) + 1).alias(f"_{f}") for f in quality.INTEGER_FIELDS])
    assert wide.where(F.col("_age") > 3).count() == 1


def test_canonical_spelling(spark):
    df = spark.createDataFrame([("Homme", "Marié"), ("Female", "Single"), ("x", None)], "genre string, statut_marital string")
    assert [tuple(r) for r in quality.canonicalise(df).collect()] == [("Male", "Married"), ("Female", "Single"), ("x", None)]


def test_text_fields_must_be_text(spark):
    df = spark.createDataFrame([('{"genre": 123, "poste": "a"}',), ('{"genre": "M"}',)], "line string")
    assert [r[0] for r in df.select(quality.text_fields_are_text(F.col("line"))).collect()] == [["genre"], []]


@pytest.mark.parametrize("size, valid", [(1, True), (2, True), (100, True), (101, False)])
def test_batch_size(spark, size, valid):
    df = spark.range(size).withColumn("batch", F.lit("b"))
    assert quality.batch_size_check(df, "batch").first()["is_valid"] is valid


def test_output_contract(spark):
    df = spark.createDataFrame([(150.0, "HIGH"), (50.0, "critical"), (50.0, "LOW")], "probability_leave double, risk_level string")
    got = {(r["field"], r["n"]) for r in quality.broken_rule_counts(df, quality.output_rules()).collect()}
    assert got == {("probability_leave", 1), ("risk_level", 1)}


@pytest.mark.parametrize(
    "prob, leave, risk",
    [(0.0, False, "LOW"), (0.3999, False, "LOW"), (0.4, False, "MEDIUM"), (0.5, True, "MEDIUM"), (0.5999, True, "MEDIUM"),
     (0.6, True, "HIGH"), (1.0, True, "HIGH"), (0.399999, False, "LOW")],
)
def test_risk_levels(spark, prob, leave, risk):
    got = spark.range(1).select(*[c.alias(n) for n, c in decision_columns(F.lit(prob)).items()]).first()
    assert (got["will_leave"], got["risk_level"]) == (leave, risk)
    assert got["probability_leave"] + got["probability_stay"] == pytest.approx(100)


def test_central_join_details(spark):
    sirh = spark.createDataFrame([(1, "a"), (2, "b")], "id_employee long, note string")
    evals = spark.createDataFrame([("E_1", "x"), ("E_1", "y")], "eval_number string, note string")
    survey = spark.createDataFrame([(2, 5)], "code_sondage long, s int")
    got = prep.build_central(sirh, evals, survey)
    assert set(got.columns) == {"id_employee", "note_x", "eval_number", "note_y", "s"}
    assert got.count() == 3
    bad = spark.createDataFrame([("none", "x")], "eval_number string, note string")
    with pytest.raises(Exception):
        prep.build_central(sirh, bad, survey).collect()
    assert prep.build_central(sirh, bad, survey, strict_keys=False).count() == 2


def test_missing_columns_are_named(spark):
    with pytest.raises(prep.MissingColumns, match="age"):
        prep.require_columns(spark.range(1), ["age"])


def test_files(spark, tmp_path):
    assert files.read_drop_list(spark, f"{tmp_path}/absent.json") == []
    (tmp_path / "drop.json").write_text('["a",\n "b"]')
    assert files.read_drop_list(spark, f"{tmp_path}/drop.json") == ["a", "b"]
    with pytest.raises(Exception):
        files.load_raw_sources(spark, "/absent/a", "/absent/b", "/absent/c")
    (tmp_path / "x.csv").write_text("a,b\n1,NaN\n2,3.5\n")
    assert [r["b"] for r in files.read_csv(spark, f"{tmp_path}/x.csv", "a int, b double").collect()] == [None, 3.5]

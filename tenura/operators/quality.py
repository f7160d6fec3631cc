"""Contract rules for employee records, predictions and the audit tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.risk import RISK_LEVELS

# The record contract.  Whole-number fields with their inclusive limits.
INTEGER_FIELDS: dict[str, tuple[int | None, int | None]] = {
    "age": (18, 70),
    "nombre_experiences_precedentes": (0, 50),
    "nombre_heures_travailless": (0, 168),
    "annees_dans_le_poste_actuel": (0, 50),
    "satisfaction_employee_environnement": (1, 5),
    "note_evaluation_precedente": (1, 4),
    "satisfaction_employee_nature_travail": (1, 5),
    "satisfaction_employee_equipe": (1, 5),
    "satisfaction_employee_equilibre_pro_perso": (1, 5),
    "note_evaluation_actuelle": (1, 4),
    "nombre_participation_pee": (0, None),
    "nb_formations_suivies": (0, 20),
    "nombre_employee_sous_responsabilite": (0, None),
    "distance_domicile_travail": (0, None),
    "niveau_education": (1, 5),
    "annees_depuis_la_derniere_promotion": (0, 50),
    "annes_sous_responsable_actuel": (0, 50),
}
POSITIVE_FIELDS = ("revenu_mensuel",)
ENUM_FIELDS: dict[str, tuple[str, ...]] = {
    "genre": ("Male", "Female", "M", "F", "Homme", "Femme"),
    "statut_marital": ("Single", "Married", "Divorced", "Célibataire", "Marié", "Divorcé"),
    "heure_supplementaires": ("Yes", "No"),
}
FREE_TEXT_FIELDS = ("departement", "poste", "domaine_etude")
# Model order of the 24 fields.
NUMERIC_FEATURES = ("age", "revenu_mensuel", *[f for f in INTEGER_FIELDS if f != "age"])
CATEGORICAL_FEATURES = ("genre", "statut_marital", *FREE_TEXT_FIELDS, "heure_supplementaires")
FEATURES = (*CATEGORICAL_FEATURES, *NUMERIC_FEATURES)
BATCH_LIMITS = (1, 100)

# Optional: one spelling for each meaning of the synonyms.
CANONICAL = {
    "genre": {"M": "Male", "Homme": "Male", "F": "Female", "Femme": "Female"},
    "statut_marital": {"Célibataire": "Single", "Marié": "Married", "Divorcé": "Divorced"},
}


@dataclass(frozen=True)
class Rule:
    """A named condition that a good row fulfils; an unknown outcome counts as broken."""

    field: str
    name: str
    holds: Column


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Array of ``(field, rule, value)`` for the rules a row breaks."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.coalesce(r.holds, F.lit(False)),
                    F.struct(
                        F.lit(r.field).alias("field"),
                        F.lit(r.name).alias("rule"),
                        F.col(r.field).cast("string").alias("value"),
                    ),
                )
                for r in rules
            ]
        )
    )


def as_number(text: Column) -> Column:
    """Number given as number or numeric text, else null."""
    return text.try_cast("double")


def as_whole(text: Column) -> Column:
    """Whole number, also from ``35.0``; words and fractions give null."""
    number = as_number(text)
    return F.when(number == F.floor(number), number).try_cast("int")


def type_rules() -> list[Rule]:
    whole = [
        Rule(f, "whole_number", F.col(f).isNull() | as_whole(F.col(f)).isNotNull()) for f in INTEGER_FIELDS
    ]
    number = [Rule(f, "number", F.col(f).isNull() | as_number(F.col(f)).isNotNull()) for f in POSITIVE_FIELDS]
    return whole + number


def record_rules(with_id: bool = True) -> list[Rule]:
    """Presence, type, range and vocabulary rules for records read as text.

    A missing value breaks only the presence rule and a wrong type only the type rule.
    """
    rules: list[Rule] = []
    names = (["employee_id"] if with_id else []) + list(FEATURES)
    rules += [Rule(f, "required", F.col(f).isNotNull()) for f in names]
    rules += type_rules()
    for field, (low, high) in INTEGER_FIELDS.items():
        value = as_whole(F.col(field))
        fits = F.lit(True)
        if low is not None:
            fits = fits & (value >= low)
        if high is not None:
            fits = fits & (value <= high)
        rules.append(Rule(field, "range", value.isNull() | fits))
    for field in POSITIVE_FIELDS:
        value = as_number(F.col(field))
        rules.append(Rule(field, "range", value.isNull() | (value > 0)))
    for field, allowed in ENUM_FIELDS.items():
        rules.append(Rule(field, "enum", F.col(field).isNull() | F.col(field).isin(*allowed)))
    return rules


def payload_rules() -> list[Rule]:
    """Rules of exploded batch payloads: those of records, text sent as text, and a request that holds employees."""
    present = Rule("employee_id", "employees_required", F.col("position").isNotNull())
    text = [
        Rule(f, "text", ~F.coalesce(F.array_contains("not_text", f), F.lit(False))) for f in CATEGORICAL_FEATURES
    ]
    return [present, *record_rules(), *text]


def validate(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``errors`` and ``is_valid``; no row is dropped.

    The errors come out of a one-element generator: they are computed once per row, and a filter
    on them stays a short condition instead of the whole rule list, which the optimizer would
    otherwise carry through every later projection.
    """
    broken = broken_rules(record_rules() if rules is None else rules)
    checked = df.select("*", F.inline(F.array(F.struct(broken.alias("errors")))))
    return checked.withColumn("is_valid", F.size("errors") == 0)


def typed(df: DataFrame) -> DataFrame:
    """Valid text records with their real types."""
    casts = {f: as_whole(F.col(f)) for f in INTEGER_FIELDS}
    casts |= {f: as_number(F.col(f)) for f in POSITIVE_FIELDS}
    return df.withColumns({f: c for f, c in casts.items() if f in df.columns})


def split_valid(df: DataFrame, rules: Sequence[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(valid typed rows, quarantine with errors)``."""
    checked = validate(df, rules)
    return typed(checked.where("is_valid")).drop("errors", "is_valid"), checked.where(~F.col("is_valid"))


def canonicalise(df: DataFrame, spellings: dict[str, dict[str, str]] = CANONICAL) -> DataFrame:
    """Replace synonyms by one spelling (off unless called)."""
    for field, same in spellings.items():
        pairs = [F.lit(x) for kv in same.items() for x in kv]
        df = df.withColumn(field, F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(field)), F.col(field)))
    return df


def text_fields_are_text(line: Column) -> Column:
    """Text fields of a raw JSON line that hold something other than text.

    Readers with a text schema hide the difference between 17 and "17"; this looks at the line.
    """
    parsed = F.try_parse_json(line)
    found = [
        F.when(
            F.schema_of_variant(F.variant_get(parsed, f"$.{f}", "variant")).isin("STRING", "VOID")
            | F.variant_get(parsed, f"$.{f}", "variant").isNull(),
            F.lit(None),
        ).otherwise(F.lit(f))
        for f in CATEGORICAL_FEATURES
    ]
    return F.array_compact(F.array(*found))


def batch_size_check(df: DataFrame, batch: str, limits: tuple[int, int] = BATCH_LIMITS) -> DataFrame:
    """Size of every batch and whether it keeps the contract (a report; scoring has no limit)."""
    sizes = df.groupBy(batch).agg(F.count("*").alias("batch_size"))
    return sizes.withColumn("is_valid", F.col("batch_size").between(*limits))


def prediction_rules() -> list[Rule]:
    """CHECK, NOT NULL and length rules of the prediction table."""
    length = lambda f, n: Rule(f, f"max_length_{n}", F.col(f).isNull() | (F.length(f) <= n))
    return [
        *[Rule(f, "required", F.col(f).isNotNull()) for f in ("id", "request_id", "created_at", "prediction_date")],
        Rule("attrition_prob", "between_0_and_1", F.col("attrition_prob").between(0, 1)),
        Rule("risk_level", "enum", F.col("risk_level").isin(*RISK_LEVELS)),
        length("employee_id", 50),
        length("risk_level", 10),
        Rule("model_version", "required", F.col("model_version").isNotNull()),
        length("model_version", 50),
    ]


def request_rules() -> list[Rule]:
    length = lambda f, n: Rule(f, f"max_length_{n}", F.col(f).isNull() | (F.length(f) <= n))
    return [
        *[Rule(f, "required", F.col(f).isNotNull()) for f in ("id", "created_at", "endpoint")],
        length("endpoint", 100),
        Rule("request_data", "required", F.col("request_data").isNotNull()),
        length("client_ip", 45),
        Rule("http_status", "required", F.col("http_status").isNotNull()),
    ]


def output_rules() -> list[Rule]:
    """Rules of scoring output: percents in range, known risk level."""
    return [
        Rule("probability_leave", "between_0_and_100", F.col("probability_leave").between(0, 100)),
        Rule("risk_level", "enum", F.col("risk_level").isin(*RISK_LEVELS)),
    ]


def broken_rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking each rule, all rules in one pass."""
    hits = [
        F.struct(F.lit(r.field).alias("field"), F.lit(r.name).alias("rule"),
                 F.count_if(~F.coalesce(r.holds, F.lit(False))).alias("n"))
        for r in rules
    ]
    return df.agg(F.array(*hits).alias("hits")).select(F.inline("hits"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def orphans(children: DataFrame, parents: DataFrame, foreign: str = "request_id", key: str = "id") -> DataFrame:
    """Rows whose parent is missing; a row without a parent id is no orphan."""
    known = parents.select(F.col(key).alias(foreign))
    return children.where(F.col(foreign).isNotNull()).join(known, foreign, "left_anti")

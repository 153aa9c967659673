"""Reference dimension of states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATE_SCHEMA = "state_code string, state_name string, macro_region string"

# The 27 federative units with their official macro-region.
STATES = (
    ("AC", "Acre", "North"),
    ("AL", "Alagoas", "Northeast"),
    ("AM", "Amazonas", "North"),
    ("AP", "Amapá", "North"),
    ("BA", "Bahia", "Northeast"),
    ("CE", "Ceará", "Northeast"),
    ("DF", "Distrito Federal", "Center-West"),
    ("ES", "Espírito Santo", "Southeast"),
    ("GO", "Goiás", "Center-West"),
    ("MA", "Maranhão", "Northeast"),
    ("MG", "Minas Gerais", "Southeast"),
    ("MS", "Mato Grosso do Sul", "Center-West"),
    ("MT", "Mato Grosso", "Center-West"),
    ("PA", "Pará", "North"),
    ("PB", "Paraíba", "Northeast"),
    ("PE", "Pernambuco", "Northeast"),
    ("PI", "Piauí", "Northeast"),
    ("PR", "Paraná", "South"),
    ("RJ", "Rio de Janeiro", "Southeast"),
    ("RN", "Rio Grande do Norte", "Northeast"),
    ("RO", "Rondônia", "North"),
    ("RR", "Roraima", "North"),
    ("RS", "Rio Grande do Sul", "South"),
    ("SC", "Santa Catarina", "South"),
    ("SE", "Sergipe", "Northeast"),
    ("SP", "São Paulo", "Southeast"),
    ("TO", "Tocantins", "North"),
)

STATE_CODES = tuple(code for code, _, _ in STATES)


def state_reference(spark: SparkSession) -> DataFrame:
    """One row per state: code, name and macro-region."""
    return spark.createDataFrame(STATES, STATE_SCHEMA)

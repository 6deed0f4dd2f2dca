"""The student-performance study: its column contract, star, bands and factors, and the full run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import types as T

from bandscope.operators.cohort import factor_gap, factor_scorecard
from bandscope.operators.mart import build_mart
from bandscope.operators.star import split_star
from bandscope.sources.layers import (
    land_bronze,
    publish,
    publish_view,
    read_layer,
    write_layer,
)
from bandscope.spec import BandSpec, Dimension, StarSpec, mean, rate

# The source file's columns, the published table and column names, grades, band
# labels and thresholds of the study.
SOURCE = T.StructType(
    [
        T.StructField("Student_ID", T.StringType()),
        T.StructField("First_Name", T.StringType()),
        T.StructField("Last_Name", T.StringType()),
        T.StructField("Email", T.StringType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Department", T.StringType()),
        T.StructField("Attendance (%)", T.DoubleType()),
        T.StructField("Midterm_Score", T.DoubleType()),
        T.StructField("Final_Score", T.DoubleType()),
        T.StructField("Projects_Score", T.DoubleType()),
        T.StructField("Total_Score", T.DoubleType()),
        T.StructField("Grade", T.StringType()),
        T.StructField("Study_Hours_per_Week", T.DoubleType()),
        T.StructField("Extracurricular_Activities", T.StringType()),
        T.StructField("Internet_Access_at_Home", T.StringType()),
        T.StructField("Parent_Education_Level", T.StringType()),
        T.StructField("Family_Income_Level", T.StringType()),
        T.StructField("Stress_Level (1-10)", T.IntegerType()),
        T.StructField("Sleep_Hours_per_Night", T.DoubleType()),
    ]
)
RENAMES = {"Stress_Level (1-10)": "Stress_Level", "Attendance (%)": "Attendance"}
PERSONAL = ["First_Name", "Last_Name", "Email"]
PROFILE = ["Gender", "Age", "Parent_Education_Level", "Family_Income_Level"]
HABITS = [
    "Study_Hours_per_Week",
    "Extracurricular_Activities",
    "Internet_Access_at_Home",
    "Stress_Level",
    "Sleep_Hours_per_Night",
]
GRADES = ("A", "B", "C", "D", "F")
BANDS = BandSpec({"Alto": ("A", "B"), "Medio": (), "Baixo": ("F",)}, default="Medio")
STAR = StarSpec(
    key="Student_ID",
    key_alias="ID_Aluno",
    entity={c: c for c in PERSONAL + PROFILE},
    behaviour={c: c for c in HABITS},
    category="Department",
    category_alias="Nome_Disciplina",
    category_id="ID_Disciplina",
    fact={
        "Attendance": "Presenca",
        "Midterm_Score": "Nota_Midterm",
        "Final_Score": "Nota_Final",
        "Projects_Score": "Nota_Projetos",
        "Total_Score": "Nota_Total",
        "Grade": "Conceito",
    },
)
TABLES = {
    "entity": "alunos",
    "category": "disciplinas",
    "behaviour": "habitos",
    "fact": "fato_desempenho",
}
MART, MART_VIEW, BAND = "alunos_unificados", "alunos_com_desempenho", "Desempenho"
MART_TYPES = {
    "Presenca": "double",
    "Nota_Midterm": "double",
    "Nota_Final": "double",
    "Nota_Projetos": "double",
    "Nota_Total": "double",
    "Age": "int",
    "Study_Hours_per_Week": "double",
    "Stress_Level": "int",
    "Sleep_Hours_per_Night": "double",
}
FACTORS = [
    mean("study_hours", "Study_Hours_per_Week"),
    mean("sleep_hours", "Sleep_Hours_per_Night"),
    rate("high_stress", "Stress_Level >= 7"),
    rate("low_parent_education", "Parent_Education_Level IN ('High School', 'None')"),
    rate("low_income", "Family_Income_Level = 'Low'"),
    rate("has_activities", "Extracurricular_Activities = 'Yes'"),
    rate("no_internet", "Internet_Access_at_Home = 'No'"),
]


def students_mart(star: dict[str, DataFrame], allow_fan_out: bool = False) -> DataFrame:
    """The wide table. Names and e-mail stay in the entity dimension."""
    key = STAR.key_alias
    return build_mart(
        star["fact"],
        [
            Dimension("alunos", star["entity"], key, key, PROFILE),
            Dimension("habitos", star["behaviour"], key, key, HABITS),
        ],
        BANDS,
        grade="Conceito",
        casts=MART_TYPES,
        allow_fan_out=allow_fan_out,
        band_col=BAND,
    )


@dataclass(frozen=True)
class StudyResult:
    mart: DataFrame
    scorecard: DataFrame
    gap: DataFrame


def run_study(
    spark: SparkSession,
    source: str,
    bronze: str,
    silver: str,
    database: str = "default",
    fmt: str = "parquet",
    buckets: int = 0,
) -> StudyResult:
    """CSV to bronze to silver to published tables, mart, view, scorecard and gap.

    With ``buckets`` the published entity, behaviour and fact tables are bucketed on the entity
    key, and the mart's joins read them without shuffling.
    """
    landed = land_bronze(spark, source, bronze, SOURCE, renames=RENAMES)
    write_layer(split_star(landed, STAR), silver)
    star = {}
    for name, df in read_layer(spark, silver, list(TABLES)).items():
        keyed = buckets and STAR.key_alias in df.columns
        star[name] = publish(
            df,
            f"{database}.{TABLES[name]}",
            fmt,
            bucket_by=STAR.key_alias if keyed else None,
            buckets=buckets,
        )
    publish(students_mart(star), f"{database}.{MART}", fmt)
    mart = publish_view(spark, f"{database}.{MART_VIEW}", f"{database}.{MART}")
    scorecard = factor_scorecard(mart, FACTORS, BANDS, BAND)
    return StudyResult(mart, scorecard, factor_gap(scorecard, "Baixo", "Alto", BAND))

"""The student study from a CSV to its published tables, on rows small enough to check by hand."""

import pytest

from bandscope.operators import profile
from bandscope.operators.cohort import cohort_rate, measure_by_band
from bandscope.operators.distribution import box_stats, histogram
from bandscope.operators.mart import entity_measure_pairs
from bandscope.plans import students

HEADER = ",".join(f'"{n}"' if "(" in n else n for n in students.SOURCE.names) + ",Ignored"


def line(i, grade, stress="5", sleep="7.0", edu="Bachelor", income="High", extra="No", net="Yes",
         age="20", department="CS", study="10.0"):
    return ",".join(
        [f"{i:03d}", f"First{i}", f"Last{i}", f"e{i}@x.org", "Female", age, department,
         "90.5", "50", "60.25", "70", "80", grade, study, extra, net, edu, income, stress, sleep, "z"]
    )


LINES = [
    line(1, "A", stress="7", edu="None", department="Engineering"),
    line(2, "A", stress="3"),
    line(3, "B", stress="", edu="", department="Business"),
    line(4, "B", stress="9", income="Low", extra="Yes"),
    line(5, "C", sleep="", age="abc"),
    line(6, "D", net="No", age="22.0"),
    line(7, "", department="Mathematics"),
    line(8, "F", sleep="5.0", edu="High School", net="No", study="4.5"),
]


@pytest.fixture(scope="module", params=[0, 4], ids=["plain", "bucketed"])
def study(spark, tmp_path_factory, request):
    home = tmp_path_factory.mktemp("study")
    (home / "in.csv").write_text("\n".join([HEADER, *LINES]) + "\n", encoding="utf-8")
    return students.run_study(
        spark, str(home / "in.csv"), str(home / "bronze"), str(home / "silver"), buckets=request.param
    )


def test_mart(spark, study):
    assert study.mart.columns == [
        "ID_Aluno", "Nome_Disciplina", "Presenca", "Nota_Midterm", "Nota_Final", "Nota_Projetos",
        "Nota_Total", "Conceito", "ID_Disciplina", "Gender", "Age", "Parent_Education_Level",
        "Family_Income_Level", "Study_Hours_per_Week", "Extracurricular_Activities",
        "Internet_Access_at_Home", "Stress_Level", "Sleep_Hours_per_Night", "Desempenho",
    ]
    rows = {r.ID_Aluno: r for r in study.mart.collect()}
    assert sorted(rows) == [f"{i:03d}" for i in range(1, 9)]
    assert [rows[k].Desempenho for k in sorted(rows)] == ["Alto"] * 4 + ["Medio"] * 3 + ["Baixo"]
    assert (rows["005"].Age, rows["006"].Age, rows["003"].Stress_Level) == (None, 22, None)
    ids = {r.Nome_Disciplina: r.ID_Disciplina for r in rows.values()}
    assert ids == {"Business": "1", "CS": "2", "Engineering": "3", "Mathematics": "4"}


def test_scorecard_and_gap(study):
    card = {(r.Desempenho, r.factor): (r.matching, r.total, r.value) for r in study.scorecard.collect()}
    assert card["Alto", "high_stress"] == (2, 4, 50.0)
    assert card["Alto", "low_parent_education"] == (1, 4, 25.0)
    assert card["Alto", "low_income"] == (1, 4, 25.0)
    assert card["Alto", "has_activities"] == (1, 4, 25.0)
    assert card["Baixo", "no_internet"] == (1, 1, 100.0)
    assert card["Medio", "no_internet"] == (1, 3, 33.33)
    assert card["Baixo", "study_hours"] == (None, 1, 4.5)
    order = [r.Desempenho for r in study.scorecard.collect() if r.factor == "sleep_hours"]
    assert order == ["Alto", "Medio", "Baixo"]
    gap = {r.factor: r.gap for r in study.gap.collect()}
    assert (gap["sleep_hours"], gap["no_internet"], gap["high_stress"]) == (-2.0, 100.0, -50.0)


def test_every_factor_alone_gives_the_scorecard_line(study):
    card = {(r.Desempenho, r.factor): r.value for r in study.scorecard.collect()}
    for factor in students.FACTORS:
        if factor.kind == "rate":
            alone = cohort_rate(study.mart, factor.name, factor.expr, students.BANDS, students.BAND)
            for r in alone.collect():
                assert card[r[students.BAND], factor.name] == r[f"pct_{factor.name}"]


def test_exploration_of_the_published_tables(spark, study):
    tables = {name: spark.table(f"default.{name}") for name in students.TABLES.values()}
    counts = [tuple(r) for r in profile.table_counts(tables).collect()]
    assert counts == [("alunos", 8), ("fato_desempenho", 8), ("habitos", 8), ("disciplinas", 4)]
    nulls = profile.null_profile(tables["alunos"], ["ID_Aluno", "First_Name"], "alunos").first()
    assert tuple(nulls) == ("alunos", 8, 0, 0)
    cells = {r.table_name: (r.cells, r.null_cells) for r in profile.cell_profile(tables).collect()}
    assert cells == {
        "alunos": (64, 2),  # one unreadable age, one absent education
        "disciplinas": (8, 0),
        "fato_desempenho": (72, 1),  # its id and its name of the category are both kept
        "habitos": (48, 2),
    }
    assert profile.numeric_summary(tables["alunos"], ["Age"]).first().maximum == 22
    ages = {r.Age: r.total for r in profile.value_counts(tables["alunos"], "Age").collect()}
    assert ages == {None: 1, 20: 6, 22: 1}
    gender = profile.grouped_summary(tables["alunos"], "Gender", ["Age"], ["Age"]).first()
    assert (gender.total, gender.avg_Age, gender.min_Age, gender.max_Age) == (8, 20.29, 20, 22)
    grades = profile.share_of_total(tables["fato_desempenho"], "Conceito", students.GRADES).collect()
    assert [(r.Conceito, r.total) for r in grades] == [
        ("A", 2), ("B", 2), ("C", 1), ("D", 1), ("F", 1), (None, 1),
    ]
    pairs = entity_measure_pairs(
        tables["alunos"], tables["fato_desempenho"], "ID_Aluno", "Age", "Nota_Final"
    )
    assert pairs.count() == 7
    bins = histogram(pairs, ["Age", "Nota_Final"]).collect()
    assert sum(r.n for r in bins if r.column_name == "Age") == 7
    sleep = measure_by_band(study.mart, "Sleep_Hours_per_Night", students.BAND)
    assert {r[students.BAND]: r.n for r in box_stats(sleep, students.BAND, "Sleep_Hours_per_Night").collect()} == {
        "Alto": 4, "Medio": 2, "Baixo": 1,
    }
    names = set(study.mart.columns)
    assert not names & set(students.PERSONAL)

"""Names: cases built from the rules, each label written in several ways."""

import itertools

import pytest
from pyspark.sql import functions as F

from markfield.config import Taxonomy
from markfield.functions import names as N
from markfield.sources.annotations import name_facts

TAXONOMY = Taxonomy()


def label_cases():
    """Name, label, subtype and problem for every class, letter and way of writing."""
    frames = ("{}", "plate 3 {}", "{}_old", "x-{}-7", "12{}34")
    for name, frame in itertools.product(TAXONOMY.classes, frames):
        letters = TAXONOMY.subtypes[name]
        for letter in "abcdefg":
            known = letter in letters
            problem = None if known else "invalid_subtype" if letters else "unexpected_subtype"
            for text in (f"{name}({letter})", f"{name.lower()} ( {letter.upper()} )"):
                yield frame.format(text), name, letter, problem
        yield frame.format(name), name, None, "missing_subtype" if letters else None
        yield frame.format(f"z{name}"), None, None, "unknown_label"
        for other in TAXONOMY.classes:
            if other != name:
                yield frame.format(f"{name} {other}"), None, None, "multiple_class_names"
    yield "", None, None, "unknown_label"
    yield "TSD(a), later TSD(c)", "TSD", "c", None


def test_labels(spark):
    cases = list(label_cases())
    rows = spark.createDataFrame(cases, "name string, label string, subtype string, problem string")
    alone = rows.select("*", N.parse_label(F.col("name")).alias("p")).collect()
    in_files = name_facts(spark.createDataFrame([(f"5 Area/q/{name}.roi",) for name, *_ in cases if name], "relpath string")).collect()
    by_path = {row.relpath: row for row in in_files}
    for row in alone:
        want = (row.label, row.subtype, row.problem)
        assert (row.p.label, row.p.subtype, row.p.problem) == want, row.name
        if row.name:
            found = by_path[f"5 Area/q/{row.name}.roi"]
            assert (found.label, found.subtype, found.label_problem) == want, row.name


def test_dot_in_a_stem(spark):
    rows = spark.createDataFrame([("5 Area/q/v0.9 TSD(c).roi",)], "relpath string")
    assert name_facts(rows).head().fine_label == "TSD_c"
    assert name_facts(rows, legacy_double_stem=True).head().label_problem == "unknown_label"


@pytest.mark.parametrize("area", ["5", "14", None])
@pytest.mark.parametrize(("number", "more"), [("2", ""), ("6", "-1"), ("9", "_4")])
def test_hints_name_the_area_and_the_raster(spark, area, number, more):
    """Digits after the area's own number are the hint; without an area all digits are."""
    name = f"After an_{area or 8}_{number}{more}_TED(a)"
    row = spark.createDataFrame([(name, area)], "t string, a string").select(N.image_hint(F.col("t"), F.col("a")).alias("h")).head()
    whole = f"{number}{more}".replace("-", "_")
    assert row.h == (whole if area else f"8_{whole}")


def test_hint_agrees_with_a_raster_name(spark):
    cases = [("4", "after 4", True), ("4", "after 4_9", True), ("4_9", "after 4_9", True), ("5", "after 4_9", False), ("4", "after", False),
             (None, "after 4", None)]
    rows = spark.createDataFrame([case[:2] for case in cases], "h string, s string")
    got = [row.m for row in rows.select(N.hint_matches(F.col("h"), F.col("s")).alias("m")).collect()]
    assert got == [case[2] for case in cases]


def test_folders_give_area_stage_and_directory(spark):
    cases = {
        "set/21 area/Before it/ROISET/q_after.roi": ("21", "after", "set/21 area/Before it", True),
        "6 Area/after/q.roi": ("6", "after", "6 Area/after", False), "q.roi": (None, None, "", False),
        "6area/before and after/q.roi": ("6", None, "6area/before and after", False)}
    rows = spark.createDataFrame([(path,) for path in cases], "p string").select(
        "p", N.area_of(F.col("p")).alias("a"), N.file_stage(F.col("p")).alias("s"), N.image_directory(F.col("p")).alias("d"),
        N.in_set_folder(F.col("p")).alias("i")).collect()
    assert {row.p: (row.a, row.s, row.d, row.i) for row in rows} == cases


def test_taxonomy_of_ones_own(spark):
    own = Taxonomy({"RED": ("x", "y"), "BLUE": ()})
    rows = spark.createDataFrame([("1 Area/red(Y).roi",), ("1 Area/BLUE.roi",), ("1 Area/TSD(a).roi",)], "relpath string")
    assert [(row.fine_label, row.label_problem) for row in name_facts(rows, own).collect()] == [
        ("RED_y", None), ("BLUE", None), (None, "unknown_label")]
    assert own.fine_labels == ("RED_x", "RED_y", "BLUE")

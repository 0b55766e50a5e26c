"""Facts carried by file and folder names, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from markfield.config import Taxonomy

DIGITS = r"(\d+)"


def label_pattern(taxonomy: Taxonomy) -> str:
    """Class token not touching ASCII letters, optionally followed by ``(x)``."""
    names = "|".join(taxonomy.classes)
    return rf"(?i)(?<![A-Za-z])({names})(?![A-Za-z])\s*(?:\(\s*([A-Za-z])\s*\))?"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_path(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def stem(name: Column) -> Column:
    """Name without its last suffix; a leading dot does not start a suffix."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]+)$", 1))


def in_set_folder(path: Column) -> Column:
    """The immediate parent folder is the annotation export folder (any case)."""
    return F.lower(file_name(parent_path(path))) == "roiset"


def label_tokens(text: Column, taxonomy: Taxonomy) -> tuple[Column, Column]:
    """Every class token (upper case) and the letter in parentheses after it, blank if none."""
    pattern = F.lit(label_pattern(taxonomy))
    tokens = F.split(F.upper(F.array_join(F.regexp_extract_all(text, pattern, F.lit(1)), "|")), r"\|")
    return tokens, F.regexp_extract_all(text, pattern, F.lit(2))


def label_and_subtype(tokens: Column, letters: Column) -> tuple[Column, Column]:
    """The last token and its letter when all tokens name one class."""
    one_class = (F.size(letters) > 0) & (F.size(F.array_distinct(tokens)) == 1)
    letter = F.nullif(F.lower(F.try_element_at(letters, F.lit(-1))), F.lit(""))
    return F.when(one_class, F.try_element_at(tokens, F.lit(-1))), F.when(one_class, letter)


def label_problem(letters: Column, label: Column, subtype: Column, taxonomy: Taxonomy) -> Column:
    """Why a name gives no usable label, null when it does."""
    without = [name for name, subs in taxonomy.subtypes.items() if not subs]
    usable = F.concat_ws("_", label, subtype).isin(*taxonomy.fine_labels)
    return (
        F.when(F.size(letters) == 0, "unknown_label")
        .when(label.isNull(), "multiple_class_names")
        .when(label.isin(*without) & subtype.isNotNull(), "unexpected_subtype")
        .when(~label.isin(*without) & subtype.isNull(), "missing_subtype")
        .when(~usable, "invalid_subtype")
    )


def parse_label(text: Column, taxonomy: Taxonomy | None = None) -> Column:
    """``struct(label, subtype, problem)``; ``problem`` is null for a usable label.

    On wide tables prefer the three steps above as separate columns, as ``name_facts``
    does, so that the name is matched once per row.
    """
    taxonomy = taxonomy or Taxonomy()
    tokens, letters = label_tokens(text, taxonomy)
    label, subtype = label_and_subtype(tokens, letters)
    problem = label_problem(letters, label, subtype, taxonomy)
    return F.struct(label.alias("label"), subtype.alias("subtype"), problem.alias("problem"))


def fine_label(label: Column, subtype: Column) -> Column:
    return F.when(label.isNotNull(), F.concat_ws("_", label, subtype))


def stage_of(text: Column) -> Column:
    """``before`` or ``after`` when exactly one of the words occurs, else null."""
    lowered = F.lower(text)
    before = lowered.rlike(r"(?<![a-z])before(?![a-z])")
    after = lowered.rlike(r"(?<![a-z])after(?![a-z])")
    return F.when(before & ~after, "before").when(after & ~before, "after")


def file_stage(relpath: Column) -> Column:
    """Stage from the file stem, falling back to the folders above it."""
    return F.coalesce(stage_of(F.trim(stem(file_name(relpath)))), stage_of(parent_path(relpath)))


def area_of(relpath: Column) -> Column:
    """Digits of the first path part that reads ``<n> Area``."""
    rule = r"(?i)^(\d+)\s*Area$"
    parts = F.filter(F.transform(F.split(relpath, "/"), lambda part: F.trim(part)), lambda part: part.rlike(rule))
    return F.regexp_extract(F.get(parts, F.lit(0)), rule, 1)


def image_hint(text: Column, area: Column, taxonomy: Taxonomy | None = None) -> Column:
    """Digit runs before the first label token, without a leading area number."""
    prefix = F.get(F.split(text, label_pattern(taxonomy or Taxonomy()), 2), F.lit(0))
    prefix = F.when(area.isNotNull(), F.regexp_replace(prefix, r"(?i)area\s*\d+", "")).otherwise(prefix)
    runs = F.regexp_extract_all(prefix, F.lit(DIGITS), F.lit(1))
    drop = area.isNotNull() & (F.size(runs) > 1) & (F.get(runs, F.lit(0)) == area)
    kept = F.when(drop, F.slice(runs, F.lit(2), F.greatest(F.size(runs), F.lit(1)))).otherwise(runs)
    return F.nullif(F.array_join(kept, "_"), F.lit(""))


def image_digits(text: Column) -> Column:
    return F.nullif(F.array_join(F.regexp_extract_all(text, F.lit(DIGITS), F.lit(1)), "_"), F.lit(""))


def hint_matches(hint: Column, image_stem: Column) -> Column:
    """Null without a hint, false when the image name has no digits, else a match test."""
    digits = image_digits(image_stem)
    return F.when(
        hint.isNotNull(),
        F.coalesce((hint == digits) | (hint == F.substring_index(digits, "_", 1)), F.lit(False)),
    )


def hint_warnings(matches: Column) -> Column:
    note = F.array(F.lit("image_number_in_roi_name_differs_from_tiff_name"))
    return F.when(matches == F.lit(False), note).otherwise(F.array().cast("array<string>"))


def image_directory(relpath: Column) -> Column:
    """Folder that should hold the raster: the parent, or one up from the export folder."""
    parent = parent_path(relpath)
    return F.when(in_set_folder(relpath), parent_path(parent)).otherwise(parent)


def is_magnified(directory: Column) -> Column:
    return file_name(directory).rlike(r"(?i)x\s*100")

"""Problems of samples and patches, all found by one scan of each."""

import hashlib
import re

from markfield.config import Taxonomy
from markfield.operators import findings as V

LABELS = Taxonomy({"ant": (), "bee": ("a",)})
SCHEMA = "patch_id string, path string, sha256 string, fine_label string, area string, split string, _copies int"


def tables(spark, samples, patches):
    rows = [(p, f"f/{p}", hashlib.sha256(b).hexdigest(), label, area, split, 7) for p, b, label, area, split in samples]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(patches, "patch_id string, pixels binary, split string")


def problems(spark, samples, patches, most=9):
    judged = V.judged_samples(*tables(spark, samples, patches), 1, LABELS, ["path", "area"])
    found = V.first_problems(V.sample_problems(judged).unionByName(V.area_problems(judged)), most)
    return judged, sorted(tuple(row) for row in found.collect())


def test_every_kind_of_damage_is_named(spark):
    samples = [("a", b"abc", "ant", "1", "train"), ("b", b"bcd", "bee_a", "1", "train"), ("c", b"cde", "ant", "2", "val"),
               ("d", b"def", None, "2", "test"), ("e", b"efg", "bee", None, None), ("f", b"fgh", "ant", "3", None),
               ("g", b"ghi", "ant", "3", "val"), ("g", b"ghi", "ant", "3", "train"), (None, b"x", "ant", "4", "val")]
    patches = [("a", b"abc", "s"), ("b", b"bc", "s"), ("c", b"xyz", "s"), ("d", b"def", "s"), ("d", b"def", "s"),
               ("f", b"fgh", "s"), ("g", b"ghi", "s"), ("nobody", b"123", "s"), (None, b"x", "s")]
    judged, found = problems(spark, samples, patches)
    assert found == [
        ("labels", 1, 2, "unknown label null"), ("labels", 2, 2, "unknown label bee"),
        ("patches", 1, 5, "bad patch f/None"), ("patches", 2, 5, "bad patch f/b"), ("patches", 3, 5, "bad patch f/c"),
        ("patches", 4, 5, "bad patch f/d"), ("patches", 5, 5, "bad patch f/e"),
        ("splits", 1, 2, "2 (test, val)"), ("splits", 2, 2, "3 (, val of 3)")]
    assert V.digest_text(judged, "number")[1] == len(samples)
    assert problems(spark, samples, patches, 1)[1] == [row for row in found if row[1] == 1]


def test_digest_ignores_order_and_sees_a_value(spark):
    samples = [(str(n), b"abc", "ant", str(n % 3), "val") for n in range(50)]
    one, _ = tables(spark, samples, [])
    other, _ = tables(spark, samples[::-1], [])
    changed, _ = tables(spark, samples[:-1] + [("49", b"abc", "ant", "9", "val")], [])
    digests = [V.digest_text(rows, V.row_digest(["path", "area"])) for rows in (one, other.repartition(5), changed, one.filter("false"))]
    assert digests[0] == digests[1] != digests[2] and digests[3] == ("0-0", 0)


def test_empty_tables(spark):
    assert problems(spark, [], [])[1] == []
    assert problems(spark, [("a", b"abc", "ant", "1", "val")], [])[1] == [("patches", 1, 1, "bad patch f/a")]


def test_one_scan_of_each_table(spark, tmp_path):
    samples, patches = tables(spark, [("a", b"abc", "ant", "1", "val")], [("a", b"abc", "s")])
    samples.write.parquet(str(tmp_path / "samples"))
    patches.write.parquet(str(tmp_path / "patches"))
    judged = V.judged_samples(spark.read.parquet(str(tmp_path / "samples")), spark.read.parquet(str(tmp_path / "patches")), 1, LABELS, ["path"])
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("Relation", plan)) == 2
    assert "split" in plan and judged.collect()[0].patch_good

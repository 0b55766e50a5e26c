"""Commits that die in any step leave the older version or none, and a retry succeeds."""

import pytest

from markfield.plans import versions as V


class Died(BaseException):
    pass


def writer(spark, number, dies_after=None):
    """Three tables of one version; dies after some of them."""
    def write(folder):
        for step in range(3):
            if step == dies_after:
                raise Died
            spark.range(5).selectExpr("id", f"{number} AS version").write.parquet(f"{folder}/t{step}")
        return number
    return write


def seen(spark, root):
    folder = V.current(spark, root)
    if folder is None:
        return None
    found = {tuple(r) for step in range(3) for r in spark.read.parquet(f"{folder}/t{step}").select("id", "version").collect()}
    assert len(found) == 5
    return {version for _, version in found}.pop()


@pytest.mark.parametrize("older", [None, 1])
def test_death_in_every_step(spark, tmp_path, monkeypatch, older):
    root = str(tmp_path / "set")
    if older:
        assert V.commit_version(spark, root, writer(spark, older)) == older
    for dies_after in range(3):
        with pytest.raises(Died):
            V.commit_version(spark, root, writer(spark, 7, dies_after))
        assert seen(spark, root) == older
    point = V._point

    def dies_before(*args):
        raise Died

    def cut_off(spark_, root_, stage):
        point(spark_, root_, stage)
        newest = tmp_path / "set" / "pointers" / V._pointers(spark, root)[0]
        newest.write_bytes(newest.read_bytes()[:40])
        (newest.parent / f".{newest.name}.crc").unlink(missing_ok=True)
        raise Died

    for stand_in in (dies_before, cut_off):
        monkeypatch.setattr(V, "_point", stand_in)
        with pytest.raises(Died):
            V.commit_version(spark, root, writer(spark, 8))
        assert seen(spark, root) == older
    monkeypatch.setattr(V, "_point", point)
    assert V.commit_version(spark, root, writer(spark, 9)) == 9 and seen(spark, root) == 9
    assert not V.recover(spark, root)  # a stage of today may still be written
    gone = V.recover(spark, root, abandoned=-60, keep=1)
    assert len(gone) == 2 + bool(older) and seen(spark, root) == 9


def test_two_builders_take_different_numbers(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    V.commit_version(spark, root, writer(spark, 1))
    real, stale = V._pointers, [["000000000000"]]
    monkeypatch.setattr(V, "_pointers", lambda *args: stale.pop() if stale else real(*args))
    V.commit_version(spark, root, writer(spark, 2))
    assert len(real(spark, root)) == 2 and seen(spark, root) == 2


def test_empty_version_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing was written"):
        V.commit_version(spark, str(tmp_path / "set"), lambda folder: None)
    assert V.current(spark, str(tmp_path / "set")) is None

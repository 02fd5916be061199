import gzip

import pytest

from tierflow import storage


def staged_now(spark):
    return set(storage.names_in(spark, storage._staging_home(spark)))


def test_stage_result_keeps_the_result_only(spark):
    before = staged_now(spark)

    def make():
        inner = storage.stage_result(spark, lambda: storage.stage(spark.range(5), "deep"), "inner")
        return storage.stage(inner.filter("id > 1"), "part")

    found = storage.stage_result(spark, make, "whole")
    assert sorted(r.id for r in found.collect()) == [2, 3, 4]
    assert [name.rsplit("-", 1)[0] for name in staged_now(spark) - before] == ["whole"]


def test_stage_result_leaves_nothing_after_a_failure(spark):
    before = staged_now(spark)

    def make():
        return storage.stage(spark.range(5), "part").selectExpr("raise_error('broken')")

    with pytest.raises(Exception, match="broken"):
        storage.stage_result(spark, make, "whole")
    left = staged_now(spark) - before
    assert not [name for name in left if not name.startswith("whole")]
    later = storage.stage(spark.range(1), "later")
    assert later.count() == 1 and any(name.startswith("later") for name in staged_now(spark))


def test_first_line_of_a_packed_file(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt", encoding="utf-8") as file:
        file.write("\nnämn,b\n1,2\n")
    (tmp_path / "b.csv").write_text("c,d\n")
    assert storage.first_line(spark, str(tmp_path / "a.csv.gz")) == "nämn,b"
    assert storage.first_line(spark, str(tmp_path / "b.csv")) == "c,d"

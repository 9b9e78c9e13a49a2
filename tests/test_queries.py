import pytest

import __spark_entry__ as entry
from compare import connect, differences
from hotrank.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_ranking_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    assert differences(spark, duck, sf, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "creation_id", "score", "window_end", "rank"]
    assert df.count() > 0


def test_ranking_queries_outlive_a_missing_module(monkeypatch):
    import sys

    import __spark_entry__

    for name in [x for x in sys.modules if x.startswith("hotrank.llm") or x == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    # None stands for a module that cannot be imported.
    monkeypatch.setitem(sys.modules, "zstandard", None)
    assert set(__spark_entry__.queries()) == set(__spark_entry__.QUERIES)
    assert set(__spark_entry__.oracle_sql()) == set(__spark_entry__.ORACLES)


def test_slices_are_written_by_all_tasks_and_handed_over_whole(spark, tmp_path):
    from hotrank.catalog.queries import _Slices

    rows = spark.range(0, 400, 1, 4).selectExpr("id", "cast(id % 2 as int) as part")
    slices = _Slices(spark, str(tmp_path / "s"), {"t": rows})
    for part in range(3):  # nobody has a row in the last
        slices.hand_over(part)
        files = list((tmp_path / "s" / "in" / "t" / str(part)).glob("*.parquet"))
        assert len(files) == (4 if part < 2 else 0)
        read = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/s/in/t")
        assert read.columns == ["id"] and read.count() == min(400, 200 * (part + 1))

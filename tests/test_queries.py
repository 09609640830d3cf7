"""Each registered query against its SQL twin, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from labelspark.plans.registry import ORACLES, QUERIES
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# The library's own; those of the corpus operators have tests of their own.
OWN = {name: build for name, build in QUERIES.items() if not build.__module__.startswith("labelspark.llm") and name != "pipeline"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(OWN) <= set(ORACLES) == set(entry.oracle_sql()) and set(entry.queries()) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["range_select", "time_range", "seconds_time", "millis_time", "stored_label_names", "counter_irate"])
def test_any_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "labels_s"]
    assert entry.entry(spark).count() > 0


def test_the_entry_works_without_what_the_corpus_operators_import():
    import subprocess
    import sys
    from pathlib import Path

    program = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, cwd=Path(entry.__file__).parent)
    assert done.returncode == 0 and int(done.stdout) == len(OWN), done.stderr

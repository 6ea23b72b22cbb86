"""Every registered query gives the rows of its SQL twin."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from playtide import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == []


def test_bursts_are_found(duck):
    """The twin of the rapid-fire rule at its own limits compares rows, not nothing with nothing."""
    assert len(duck.sql(ORACLES["rapid_fire_bursts"]).fetchall()) > 0


def test_optional_packages_may_be_absent():
    """Without a package that only the operators over documents need, all other queries are still there."""
    code = (
        "import sys; sys.modules.update(sentencepiece=None, xxhash=None, tokenizers=None); import __spark_entry__ as e; "
        "from playtide import catalog; assert set(catalog.queries()) <= set(e.queries()); assert set(catalog.oracles()) <= set(e.oracle_sql())")
    subprocess.run([sys.executable, "-c", code], cwd=Path(entry_point.__file__).parent, check=True)

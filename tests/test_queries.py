"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from compare import differences, duck

import __spark_entry__ as entry_points
from eventflow.plans.catalog import QUERIES
from eventflow.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_same_names():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) == set(ORACLES)


def test_import_needs_no_session():
    root = Path(entry_points.__file__).parent
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=root, capture_output=True)
    assert done.returncode == 0, done.stderr.decode()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert differences(entry_points.queries()[name](spark, SF), con, entry_points.oracle_sql()[name]) == []

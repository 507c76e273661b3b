"""Every registered query against its SQL form, on the smallest tables."""

import os

import pytest

from idtrail.queries import QUERIES, SQL
from tests.oracle import DATA, compare, database

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return database(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert name in SQL
    compare(spark, db, name, QUERIES[name], SQL[name], FOLDER)

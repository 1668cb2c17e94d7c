"""Every named query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import oracle
from promptmill.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES and QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert oracle.compare(spark, con, FOLDER, name, QUERIES[name], ORACLE[name]) is None

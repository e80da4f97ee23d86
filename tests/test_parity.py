"""Every registered query gives the rows of its SQL twin, also with every key treated as hot."""

import pytest

from compare import compare, duck
from vocabweave.operators import keyed
from vocabweave.plans.all_queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, connection, name):
    assert compare(spark, connection, name, FOLDER) == ""


NUMBERED = ["cui_lists", "equivalence_classes", "triples_values", "triples_node_values", "pipe_agg", "edges_to_rels", "coderels_build"]


@pytest.mark.parametrize("name", NUMBERED)
def test_same_rows_when_all_keys_are_hot(spark, connection, monkeypatch, name):
    monkeypatch.setattr(keyed, "MIN_HOT_ROWS", 2)
    monkeypatch.setattr(keyed, "SHARES", 10**9)
    assert name in ORACLES
    assert compare(spark, connection, name, FOLDER) == ""

"""Queries of the training-data operators against their SQL over the driver's smallest tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from comparing import SF_DIR, both  # noqa: E402

from glosswerk.llm import queries as Q  # noqa: E402


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_is_its_sql(spark, name):
    ours, theirs = both(spark, Q.QUERIES[name], Q.ORACLE_SQL[name])
    assert ours == theirs


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 11))

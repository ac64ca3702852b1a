"""Every data and preparation query gives the same rows as its SQL text, at the smallest scale.

Models are fitted on small matrices in test_models.py; tests/check.py compares their queries as well.
"""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from orderlore.plans import registry

FOLDER = "/root/testdata/sf0.001"
TEXTS = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_text_has_a_query():
    assert set(TEXTS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted({**registry.DATA_QUERIES, **registry.PREP_QUERIES}))
def test_same_rows(spark, db, name):
    assert differences(entry.queries()[name](spark, FOLDER), db, TEXTS[name]) == []


def test_flagship(spark):
    assert len(entry.entry(spark).columns) == 35

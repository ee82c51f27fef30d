"""Every registered query against its check SQL, over whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from check import compare, open_tables
from dumpflow.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_agrees(spark, tables, name):
    outcome, _ = compare(spark, tables, name, FOLDER)
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["page_hash", "day", "access_code", "views"]
    assert frame.limit(1).count() == 1


def test_every_query_has_a_check():
    assert set(catalogue.QUERIES) == set(catalogue.CHECKS)

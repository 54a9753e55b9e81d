import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import compare  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from limnospark.bindings import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ("hydraulic_audit", "section_enrichment", "consolidate_runs", "corr_window_match", "stage_metrics", "export_pivot_median", "registry_log", "dis_points")


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_agrees_with_sql(spark, name):
    note = compare.difference(queries()[name](spark, FOLDER), compare.connect(FOLDER), oracle_sql()[name])
    assert note == ""  # an empty pair is a failure too

"""What plans must look like at scale: narrow scans, pushed filters, few shuffles, no Python."""

import re

import pytest

from tests.oracle import DATA
from voxelyard.plans import catalogue

SF = f"{DATA}/sf0.001"


def plan(spark, name):
    df = catalogue.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_sweep_scans_one_column_and_pushes_the_background_filter(spark):
    text = plan(spark, "volume_sweep")
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint>", text)
    assert re.search(r"PushedFilters: \[[^\]]*Not\(EqualTo\(l_suppkey,0\)\)", text)
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1


def test_compartments_are_one_aggregate(spark):
    text = plan(spark, "compartment_merge")
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["volume_sweep", "index_scan_bbox", "joint_counts", "cable_length", "diameter_stats", "frustum_volume_area", "summarize_by", "log_histogram", "failure_streak", "properties_wide", "run_lengths", "attach_points", "nearest_by_grid", "block_merge_upsert", "local_density"])
def test_built_in_expressions_only(spark, name):
    text = plan(spark, name)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", text)


def test_sorts_of_whole_tables_are_rare(spark):
    """No window without a partition over more than a few hundred rows."""
    for name in ("percent_rank_bands", "nearest_rank_quantiles", "failure_streak", "status_pivot"):
        text = plan(spark, name)
        for window in re.findall(r"Window \[[^\n]*", text):
            assert "windowspecdefinition(part" in window or "_w" in window or re.search(r"\], \[[a-z_]+#\d+", window), window

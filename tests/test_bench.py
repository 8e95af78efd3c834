import bench
import pytest

NAMES = [
    "radius_500m_pairs", "radius_500m_pairs_left", "journey_positions", "whole_run", "radius_500m_scores", "corridor_box_totals",
    "corridor_buffer_totals", "corridor_buffer_totals_lattice", "corridor_journeys", "station_volumes", "stage_journeys",
    "stage_accidents", "temporal_hourly", "blackspot_mart", "corridor_mart", "temporal_mart",
]


@pytest.fixture(scope="module")
def entries(spark):
    return bench.entries(spark, "/root/testdata/sf0.001")


def test_every_entry_is_named_here(entries):
    assert sorted(entries) == sorted(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_entry_runs(entries, name):
    assert bench.seconds_of(entries[name]) > 0

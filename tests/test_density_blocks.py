"""Blocks of the density topics: results across their borders, and tables that grow with the points only."""

import numpy as np
import pytest

from papervein.operators import density
from tests.test_density import plain, topics_of


@pytest.mark.parametrize("widths, shape", [((64,), (400, 3)), ((3,), (400, 3)), ((1,), (400, 2))])
def test_groups_across_blocks(spark, monkeypatch, widths, shape):
    """Chains of points through many blocks, full cells that are cut short, and points by themselves."""
    monkeypatch.setattr(density, "WIDTHS", widths)
    rng = np.random.default_rng(shape[1])
    steps = np.cumsum(rng.normal(scale=0.05, size=shape), axis=0)
    points = np.round(np.concatenate([steps, rng.uniform(-3, 3, (100, shape[1])), rng.normal(scale=0.02, size=(120, shape[1]))]), 3)
    assert topics_of(spark, points, 0.2, 5, 4) == plain(points, 0.2, 5, 4)


def test_no_table_of_points_by_cells(spark, monkeypatch):
    """Every point has a fifth of all cells in reach; no written table has a row for each."""
    sizes, cut = [], density.cut_lineage

    def counted(df):
        table = cut(df)
        sizes.append(table.count())
        return table

    monkeypatch.setattr(density, "cut_lineage", counted)
    points = np.round(np.random.default_rng(3).uniform(-1, 1, (800, 5)), 4)
    assert topics_of(spark, points, 1.0, 40, 4) == plain(points, 1.0, 40, 4)
    assert max(sizes) <= 10 * len(points)

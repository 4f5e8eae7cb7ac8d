"""The registered forecast fits the configured model."""

from tidemark.config import Settings
from tidemark.plans.queries import GBT_SETTINGS


def test_the_registered_fit_has_the_configured_trees():
    default = Settings()
    assert (GBT_SETTINGS.trees, GBT_SETTINGS.depth) == (default.trees, default.depth) == (600, 8)

"""Imports every query module so that the registry is complete."""

from vecstack.plans import (q_arrays, q_features, q_flows, q_image, q_linear, q_neighbors,  # noqa: F401
                            q_sources, q_trees)
from vecstack.plans.registry import ORACLES, QUERIES  # noqa: F401

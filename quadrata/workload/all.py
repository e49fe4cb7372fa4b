"""Imports every query module; the registry is complete afterwards."""

from quadrata.workload import aggregates, learning, panels, quality, scalars, scans  # noqa: F401
from quadrata.workload.base import REGISTRY, TABLES  # noqa: F401

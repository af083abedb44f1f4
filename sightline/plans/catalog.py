"""Imports every module that registers queries."""

from . import bank, calibration, composites, detections, matching, scalars  # noqa: F401

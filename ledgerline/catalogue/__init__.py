"""Queries over the testdata, one or more for each operator, each with its SQL twin."""

from __future__ import annotations

from . import aggregates, quality, reporting, scalars  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401

"""Imports every module that registers queries."""

from checks import builders, expressions, quality_reports, relations, reporting, storage  # noqa: F401

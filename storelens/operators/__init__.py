"""Joins, reshaping, aggregation, paging and data-quality reports."""

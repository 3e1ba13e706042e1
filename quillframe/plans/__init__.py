"""Queries over the given tables, each with the SQL that checks it where SQL can say it."""

from quillframe.plans import (  # noqa: F401  (importing registers the queries)
    choosing,
    cleaning,
    ensembles,
    evaluating,
    explaining,
    modelling,
    monitoring,
    ordering,
    profiling,
    splitting,
    storing,
    texts,
)
from quillframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Runs that put the operators together, and the registered queries."""

from foliosift.plans import curation_queries, evaluation_queries, item_queries, text_queries  # noqa: F401
from foliosift.plans.registry import CHECKS, QUERIES


def flagship(spark, folder):
    return QUERIES["agg3_count_reasons_full_list"](spark, folder)

"""Loads every query module and exposes the registry."""

from __future__ import annotations

import importlib

from claimlens.plans.registry import ORACLES, QUERIES

_MODULES = (
    "claimlens.plans.quality_queries",
    "claimlens.plans.profile_queries",
    "claimlens.plans.prep_queries",
    "claimlens.plans.model_queries",
    "claimlens.plans.stream_queries",
    "claimlens.plans.job_queries",
)


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def all_queries():
    _load()
    return QUERIES


def all_oracles():
    _load()
    return ORACLES


def flagship(spark, sf_dir):
    _load()
    return QUERIES["a5_quality"](spark, sf_dir)

"""Every registered query by name."""

from shoploom.catalog import consumers, declared_tests, kpis, models, operators  # noqa: F401
from shoploom.catalog.reads import columns_of
from shoploom.catalog.registry import CHECKS, PLANS, runner


def queries():
    return {name: runner(plan, columns_of(name)) for name, plan in PLANS.items()}


def oracle_sql():
    return dict(CHECKS)

"""Commerce analytics on Spark: staging, customer funnel, marts and weekly reports."""

from shoploom.session import configure

__all__ = ["configure"]

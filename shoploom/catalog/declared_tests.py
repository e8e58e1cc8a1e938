"""L16: the declared column tests, one query per result."""

from __future__ import annotations

from shoploom.catalog.registry import register
from shoploom.plans.declared_tests import TESTS, run_tests

_CTE = {
    "orders": "k01", "lines": "k02", "customers": "k03", "events": "k04", "social_ads": "k05", "search_ads": "k06", "email_campaigns": "k07",
    "email_flows": "k08", "shipments": "k09", "classified": "k10", "lifetime": "k11", "households": "k12", "funnel": "k13", "sessions": "k14",
    "enriched_lines": "k15", "dim_customers": "k16", "fct_orders": "k17", "fct_order_lines": "k18", "sample_conversions": "k19",
    "daily_performance": "k20", "weekly_product_sales": "k21", "monthly_cohorts": "k22", "unit_economics": "k23", "demand_features": "k24",
    "ad_performance": "k25", "email_performance": "k26", "web_funnel": "k27", "fct_shipments": "k28", "channel_mix": "k29", "net_sales": "k30",
    "product_performance": "k31", "sku_performance": "k32", "sample_orders": "k33", "sample_sku_ranking": "k34", "launch_sampling": "k35",
}


def _statement(result: str) -> str:
    declared, cte = TESTS[result], _CTE[result]
    rows = []
    for c in declared["not_null"].split():
        rows.append((f"not_null {c}", f"SELECT count(*) FROM {cte} WHERE {c} IS NULL"))
    for c, values in declared.get("accepted", {}).items():
        listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
        rows.append((f"accepted_values {c}", f"SELECT count(*) FROM {cte} WHERE {c} NOT IN ({listed})"))
    for key in declared.get("unique", []):
        known = " AND ".join(f"{c} IS NOT NULL" for c in key.split(","))
        rows.append((f"unique {key}", f"SELECT count(*) - count(DISTINCT ({key})) FROM {cte} WHERE {known}"))
    for column, parent, field in declared.get("parents", []):
        rows.append((f"relationship {column}", f"SELECT count(*) FROM {cte} WHERE {column} NOT IN (SELECT {field} FROM {_CTE[parent]})"))
    return "\nUNION ALL\n".join(f"SELECT '{result}' AS result, '{n}' AS test, ({q}) AS violations" for n, q in rows)


for _result in TESTS:
    register(
        f"l16_declared_tests_{_result}",
        lambda t, result=_result: run_tests(
            result, getattr(t, result), {p: getattr(t, p) for _, p, _ in TESTS[result].get("parents", [])}
        ),
        _statement(_result),
    )

"""All registered queries and SQL twins, merged from the family modules."""

from __future__ import annotations

from panora.plans import (q_aggregate, q_clean, q_design, q_estimate, q_gaps, q_joins, q_nulls, q_profile, q_reshape,
                          q_sources, q_window)

QUERIES: dict = {}
SQL: dict = {}

for _mod in (q_design, q_clean, q_sources, q_joins, q_aggregate, q_window, q_reshape, q_profile, q_estimate,
             q_nulls, q_gaps):
    QUERIES.update(_mod.QUERIES)
    SQL.update(_mod.SQL)

"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from tidemark.plans import counting, decoding, dwelling, scalars, storing, streams, visitors
from tidemark.plans.base import Plan

ALL: dict[str, Plan] = {
    plan.name: plan
    for module in (decoding, counting, visitors, dwelling, scalars, storing, streams)
    for plan in module.PLANS
}

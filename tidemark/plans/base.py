"""What a named query is, and the SQL views the checks share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Plan:
    """A query, the inventory entries it covers and, where there is one, its check."""

    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


# The traffic view in the checking engine's SQL.
TRAFFIC = """
traffic as (
  select event_id, cast(floor(epoch(ts)) as bigint) as req_time,
         cast(user_id as varchar) as visit_id,
         cast(1 + user_id % 2 as integer) as plat, cast(1 + user_id % 5 as integer) as agent_type,
         event_type as website, '10.0.0.' || cast(user_id % 100 as varchar) as ip,
         case when cast(json_extract_string(props, '$.k') as integer) % 3 = 0 then ''
              else 'ch' || cast(cast(json_extract_string(props, '$.k') as integer) % 3 as varchar) end as channel,
         cast(json_extract_string(props, '$.k') as integer) as k,
         strftime(ts, '%Y-%m-%d') as req_date, hour(ts) as req_hour
  from events)
"""

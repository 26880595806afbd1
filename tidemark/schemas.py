"""Declared schemas; nothing in this package infers one."""

from __future__ import annotations

TRAFFIC = (
    "event_id BIGINT, req_time BIGINT, visit_id STRING, plat INT, agent_type INT, "
    "website STRING, ip STRING, channel STRING, k INT"
)

# Fact table of page requests. agent_type: 1 PC, 2 WAP, 3 public account, 4 iOS,
# 5 Android; req_status: 1 success, 2 failure.
DETAILS_TRAFFIC = (
    "id STRING, req_time TIMESTAMP, req_date DATE, req_hour INT, plat TINYINT, "
    "agent_type TINYINT, website STRING, url STRING, host STRING, ref_url STRING, "
    "ip STRING, visit_id STRING, loading_time BIGINT, req_status TINYINT, extra STRING, "
    "market_source STRING, market_medium STRING, market_campaign STRING, "
    "market_content STRING, market_term STRING, add_date DATE, add_time TIMESTAMP, "
    "update_time TIMESTAMP"
)

# Hourly summary table; all times are epoch seconds.
STAT_TRAFFIC = (
    "id STRING, plat INT, agent_type INT, website STRING, pv_count INT, uv_count INT, "
    "ip_count INT, stat_date INT, stat_hour INT, stat_time INT, update_time INT, "
    "add_time INT"
)

DELIVERY_RESULT = "payload STRING, attempts INT, ok BOOLEAN, reply STRING"

"""All registered queries and the SQL each is compared with."""

from __future__ import annotations

from tickhouse.catalogue import (
    delivery,
    delivery_sql,
    incremental,
    incremental_sql,
    jobs,
    jobs_sql,
    market,
    market_sql,
)


def queries() -> dict:
    return {**market.QUERIES, **delivery.QUERIES, **jobs.QUERIES, **incremental.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**market_sql.ORACLES, **delivery_sql.ORACLES, **jobs_sql.ORACLES,
            **incremental_sql.ORACLES}

"""External sinks.

JDBC: the connection (URL, table, user, driver, ...) always comes from the
caller; no credential lives in this code.  A failing export is logged and
reported, not raised, so one unreachable database does not stop the other
marts (the caller decides what to do with the report).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def jdbc_write(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "append", num_partitions: int | None = None) -> str | None:
    """Write ``df`` to a JDBC table; returns ``None`` on success, else the error text.

    ``num_partitions`` caps concurrent connections (each partition opens one).
    Default mode is ``append``: re-running appends again, so callers that
    reload a whole mart should pass ``mode="overwrite"``.
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    try:
        out.write.mode(mode).jdbc(url=url, table=table, properties=dict(properties or {}))
        return None
    except Exception as exc:  # noqa: BLE001 - reported to the caller
        log.error("JDBC export of %s failed: %s", table, exc)
        return f"{type(exc).__name__}: {exc}"

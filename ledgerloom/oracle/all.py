"""All SQL checks by key."""

from __future__ import annotations

from . import across, clickstream, delivery, loyalty, segments, subscriptions, weekly

SQL: dict[str, str] = {
    **loyalty.SQL, **delivery.SQL, **subscriptions.SQL,
    **weekly.SQL, **clickstream.SQL, **segments.SQL,
    **across.SQL,
}

"""The right to erasure: a user's rows are counted, removed from every store, looked for again, and the outcome is audited."""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER_ID = re.compile(r"[A-Za-z0-9_-]{1,128}")


def checked_id(user_id: str) -> str:
    user_id = (user_id or "").strip()
    if not USER_ID.fullmatch(user_id):
        raise ValueError("a user id is 1 to 128 letters, digits, _ or -")
    return user_id


def without_user(rows: DataFrame, user_id: str) -> DataFrame:
    """All other rows; those of no user stay."""
    return rows.where(~F.col("user_id").eqNullSafe(F.lit(checked_id(user_id))))


def preview(rows: DataFrame, user_id: str) -> DataFrame:
    """What an erasure would do: rows that go and rows that stay."""
    own = F.col("user_id").eqNullSafe(F.lit(checked_id(user_id)))
    return rows.agg(F.count_if(own).alias("rows_deleted"), F.count_if(~own).alias("rows_kept"))


def erase(user_id: str, stores: dict[str, tuple[Callable[[], DataFrame], Callable[[DataFrame], None]]], regulation: str = "GDPR", handler: str = "tributary") -> dict:
    """Rewrites each store (name -> reader, writer) without the user. Always returns an audit record, also if a store fails.

    A store is `ok` only if its rewrite succeeded and none of the user's rows are found afterwards. Erasing again is harmless.
    """
    user_id, asked = checked_id(user_id), datetime.datetime.now(datetime.UTC)
    audit = {"schema_version": "1.0", "request_id": str(uuid.uuid4()), "user_id": user_id, "requested_at": asked.isoformat(), "regulation": regulation, "handler": handler, "systems_erased": {}}
    own = F.col("user_id") == user_id
    for name, (read, write) in stores.items():
        n = -1
        try:
            n = read().where(own).count()
            if n:
                write(without_user(read(), user_id))
            left = read().where(own).count()
            entry = {"rows_deleted": n - left, "status": "ok" if left == 0 else "incomplete", "details": f"{left} rows left"}
        except Exception as e:
            entry = {"rows_deleted": n, "status": "failed", "details": str(e)[:500]}
        audit["systems_erased"][name] = entry
    audit["completed_at"] = datetime.datetime.now(datetime.UTC).isoformat()
    audit["status"] = "ok" if all(x["status"] == "ok" for x in audit["systems_erased"].values()) else "failed"
    return audit

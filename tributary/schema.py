"""The event record, its domains, and the rules by which its schema may change."""

from __future__ import annotations

from pyspark.sql import types as T

#: The nine event types.
EVENT_TYPES = ("VIEW", "ADD_TO_CART", "REMOVE_CART", "WISHLIST", "ORDER_CREATED", "ORDER_CANCELLED", "PAYMENT_SUCCESS", "PAYMENT_FAILED", "REFUND")
#: Devices after normalisation.
DEVICES = ("web", "android", "ios", "other")

EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("payment_mode", T.StringType()),
])
REQUIRED = ("event_id", "session_id", "event_type", "device", "ip", "event_time")

_WIDER = {("int", "bigint"), ("int", "double"), ("bigint", "double"), ("float", "double"), ("int", "float")}


def check_evolution(old: T.StructType, new: T.StructType, required: tuple[str, ...] = REQUIRED) -> list[str]:
    """What forbids reading data of either schema with the other; empty if the change is allowed.

    Allowed: nullable fields are added, numbers widened. Rejected: fields dropped or renamed, required fields added, other types.
    """
    before, after = {f.name: f for f in old}, {f.name: f for f in new}
    faults = [f"field dropped: {name}" for name in before if name not in after]
    for name, field in after.items():
        if name not in before:
            if not field.nullable or name in required:
                faults.append(f"required field added: {name}")
        else:
            a, b = before[name].dataType.simpleString(), field.dataType.simpleString()
            if a != b and (a, b) not in _WIDER:
                faults.append(f"type changed: {name} {a} -> {b}")
    return faults

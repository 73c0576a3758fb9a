"""Payload -> JSON text (the publisher side of the contract)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from ..schemas import PAYLOAD_SCHEMA

# Nulls are written out (a missing key would read as a contract violation)
# and times keep microseconds, as the device sends them.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Columns renamed on the way into the tables, named back for the payload.
PAYLOAD_RENAMES = {"timestamp": "event_timestamp"}


def payload_json(schema: StructType = PAYLOAD_SCHEMA, renames: dict[str, str] | None = None) -> Column:
    """``to_json(struct(<payload fields>))`` with the options above.

    Reads the payload fields from the current row, accepting a stored name
    (``event_timestamp``) for a payload name (``timestamp``).
    """
    renames = PAYLOAD_RENAMES if renames is None else renames
    fields = []
    for f in schema:
        src = F.col(renames.get(f.name, f.name))
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            src = src.cast("timestamp_ntz")
        fields.append(src.alias(f.name))
    return F.to_json(F.struct(*fields), JSON_OPTIONS)

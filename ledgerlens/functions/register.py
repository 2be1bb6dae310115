"""Publish the text functions to SQL as temporary functions.

They are SQL functions, inlined by the optimizer: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlens.functions import redaction, scrubbing
from ledgerlens.functions.mac import hmac_sha256


def register(spark: SparkSession, mac_key: bytes = b"", salt: str = "ledgerlens") -> list[str]:
    """Create the functions in the current session and return their names."""
    bodies = {
        "redact_sql": redaction.redact("x"),
        "fingerprint_sql": redaction.fingerprint("x", salt),
        "scrub_text": scrubbing.scrub("x"),
        "mask_credentials": scrubbing.mask_credentials("x"),
    }
    if mac_key:
        bodies["record_mac"] = hmac_sha256("x", mac_key)
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS STRING RETURN {body}")
    # built on redact_sql, so its input is bound once instead of being repeated in the text
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION clip_preview(r STRING) RETURNS STRING "
        f"RETURN {redaction.preview('r')}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION preview_sql(x STRING) RETURNS STRING "
        f"RETURN clip_preview(redact_sql({redaction.trimmed('x')}))"
    )
    return [*bodies, "clip_preview", "preview_sql"]

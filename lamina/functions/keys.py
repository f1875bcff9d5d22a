"""Surrogate keys that hide the business identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published keys are compared across systems, so text form and digest are given.
KEY_SEPARATOR = "||"
VERSION_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
DIGEST_BITS = 256


def version_key(business_id: Column, valid_from: Column) -> Column:
    """Digest naming one effective-dated version of a client."""
    stamp = F.date_format(valid_from, VERSION_STAMP)
    return F.sha2(F.concat_ws(KEY_SEPARATOR, business_id, stamp), DIGEST_BITS)


def campaign_key(campaign_id: Column) -> Column:
    return F.sha2(campaign_id, DIGEST_BITS)

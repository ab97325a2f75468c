"""Keyed signatures of bodies as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of SHA-256's block, and what a header begins with.
BLOCK, SCHEME = 64, "sha256="


def hmac_sha256(body: Column, secret: bytes) -> Column:
    """The HMAC of a binary body, in hex: two nested digests, each led by the key's block under its mask."""
    key = (hashlib.sha256(secret).digest() if len(secret) > BLOCK else secret).ljust(BLOCK, b"\0")
    inner, outer = (F.lit(bytes(b ^ mask for b in key)) for mask in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, body), 256))), 256)


def is_signed(header: Column, body: Column, secret: bytes) -> Column:
    """Whether a webhook's header is the signature of its body. Both sides are digested again, so how much of a wrong header is right doesn't show."""
    again = lambda c: F.sha2(F.concat(F.lit(secret), c.cast("binary")), 256)
    return F.coalesce(again(header) == again(F.concat(F.lit(SCHEME), hmac_sha256(body, secret))), F.lit(False))

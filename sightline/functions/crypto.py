"""Vectors as Fernet tokens, by built-in functions: AES-128-CBC, and HMAC-SHA256 out of SHA-256.

The key is part of the plan as a literal; keep plans and event logs as secret as the key.
"""

from __future__ import annotations

import base64

from pyspark.sql import Column
from pyspark.sql import functions as F

VERSION = b"\x80"  # fixed value: the token format's first byte


def _keys(key: str) -> tuple[bytes, bytes]:
    """(signing, encryption) halves of a URL-safe base64 key of 32 bytes."""
    raw = base64.urlsafe_b64decode(key)
    if len(raw) != 32:
        raise ValueError("a key has 32 bytes")
    return raw[:16], raw[16:]


def _binary(data: bytes) -> Column:
    return F.lit(bytearray(data))


def hmac_sha256(key: bytes, data: Column) -> Column:
    """HMAC-SHA256 of binary ``data`` for a key of up to 64 bytes."""
    block = key.ljust(64, b"\0")
    inner, outer = (_binary(bytes(x ^ pad for x in block)) for pad in (0x36, 0x5C))
    return F.unhex(F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, data), 256))), 256))


def encrypt(data: Column, key: str, at: Column, iv: Column) -> Column:
    """The token (a string) of binary ``data``. at: seconds since 1970. iv: 16 bytes, never the same
    for two tokens. Null in, null out."""
    signing, secret = _keys(key)
    time = F.unhex(F.lpad(F.hex(at.cast("long")), 16, "0"))
    body = F.concat(_binary(VERSION), time, F.aes_encrypt(data, _binary(secret), F.lit("CBC"), F.lit("PKCS"), iv))  # the iv is put first
    return F.translate(F.base64(F.concat(body, hmac_sha256(signing, body))), "+/\r\n", "-_")  # without line breaks


def decrypt(token: Column, key: str) -> Column:
    """The data of a token; null for null and for a token that is not of this key or was changed."""
    signing, secret = _keys(key)
    shaped = F.coalesce(token.rlike("^[A-Za-z0-9_-]+={0,2}$") & (F.length(token) % 4 == 0), F.lit(False))
    raw = F.unbase64(F.translate(F.when(shaped, token), "-_", "+/"))
    n = F.octet_length(raw)
    body, mac = F.substring(raw, F.lit(1), n - 32), F.substring(raw, n - 31, F.lit(32))
    good = (n >= 73) & ((n - 57) % 16 == 0) & (F.substring(raw, 1, 1) == _binary(VERSION)) & (hmac_sha256(signing, body) == mac)
    return F.when(good, F.try_aes_decrypt(F.substring(raw, F.lit(10), n - 41), _binary(secret), F.lit("CBC"), F.lit("PKCS")))


def issued_at(token: Column) -> Column:
    """When a token was made, in seconds since 1970; it is not checked here."""
    return F.conv(F.hex(F.substring(F.unbase64(F.translate(token, "-_", "+/")), 2, 8)), 16, 10).cast("long")

"""Authenticated encryption of single fields, from Spark's built-in functions only."""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: "secret" in its name makes Spark redact the setting wherever settings are shown.
KEY_CONF = "recollect.protect.secret"
DETERMINISTIC = "deterministic"
RANDOM = "random"
_BLOCK = 64  # block size of SHA-256 in bytes


def key_from_conf(spark: SparkSession) -> bytes:
    """The 32-byte key, given as hex in the session's configuration."""
    value = spark.conf.get(KEY_CONF, None)
    if not value:
        raise ValueError(f"set {KEY_CONF} to a 32-byte key in hex")
    key = bytes.fromhex(value)
    if len(key) != 32:
        raise ValueError(f"{KEY_CONF} must hold 32 bytes, got {len(key)}")
    return key


def _derived(key: bytes, purpose: str) -> bytes:
    """A key of its own for each purpose, so that no key serves two algorithms."""
    return hmac.new(key, purpose.encode(), hashlib.sha256).digest()


def _binary(c: Column) -> Column:
    return F.unhex(c)


def hmac_sha256(key: bytes, message: Column) -> Column:
    """HMAC (RFC 2104) as two nested digests; the padded keys are literals."""
    padded = key.ljust(_BLOCK, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in padded))
    outer = F.lit(bytearray(b ^ 0x5C for b in padded))
    digest = _binary(F.sha2(F.concat(inner, message.cast("binary")), 256))
    return _binary(F.sha2(F.concat(outer, digest), 256))


def encrypt(value: Column, key: bytes, algorithm: str, aad: Column) -> Column:
    """AES-GCM. Deterministic mode derives the nonce from the value, so equal values
    under one ``aad`` give equal ciphertext; random mode takes a fresh nonce per row."""
    if algorithm == DETERMINISTIC:
        message = F.concat(aad.cast("binary"), F.lit(bytearray(1)), value.cast("binary"))
        nonce = F.substring(hmac_sha256(_derived(key, "nonce"), message), 1, 12)
    elif algorithm == RANDOM:
        nonce = F.lit("")
    else:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    return F.aes_encrypt(
        value, F.lit(bytearray(_derived(key, "encrypt"))), F.lit("GCM"), F.lit("DEFAULT"), nonce.cast("binary"), aad
    )


def decrypt(ciphertext: Column, key: bytes, aad: Column) -> Column:
    """Plaintext, or null when key or ``aad`` do not match."""
    plain = F.try_aes_decrypt(
        ciphertext, F.lit(bytearray(_derived(key, "encrypt"))), F.lit("GCM"), F.lit("DEFAULT"), aad
    )
    return plain.cast("string")


# ---- key rings: a key's number stands in front of what it has encrypted --------

#: Bytes of a key's number.
_NUMBER = 4


def key_ring(master: bytes, numbers: Sequence[int]) -> dict[int, bytes]:
    """Keys by number, each derived from one secret."""
    return {n: _derived(master, f"field key {n}") for n in numbers}


def _numbered(number: int) -> bytearray:
    return bytearray(number.to_bytes(_NUMBER, "big"))


def _bound(number: int, aad: Column) -> Column:
    """The path with the key's number, so that neither can be exchanged."""
    return F.concat(F.lit(_numbered(number)), aad.cast("binary"))


def encrypt_under(value: Column, ring: Mapping[int, bytes], number: int, algorithm: str, aad: Column) -> Column:
    """The number of a key of the ring, then the value encrypted by that key."""
    if number not in ring:
        raise ValueError(f"no key {number} in the ring")
    return F.concat(F.lit(_numbered(number)), encrypt(value, ring[number], algorithm, _bound(number, aad)))


def key_number(ciphertext: Column) -> Column:
    """Which key a value is encrypted under."""
    return F.conv(F.hex(F.substring(ciphertext, 1, _NUMBER)), 16, 10).cast("int")


def decrypt_by_ring(ciphertext: Column, ring: Mapping[int, bytes], aad: Column) -> Column:
    """Plaintext, by the key that the value names; null where the ring has no such key or key
    and path do not match."""
    plain, body = F.lit(None).cast("string"), F.substring(ciphertext, _NUMBER + 1, 1 << 30)
    for number, key in ring.items():
        plain = F.when(key_number(ciphertext) == number, decrypt(body, key, _bound(number, aad))).otherwise(plain)
    return plain

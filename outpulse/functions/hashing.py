"""Stable keys and hash-based uniforms, so that exploration replays exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outpulse.functions.numeric import col

HASH_SPAN = float(1 << 60)


def hash_int(*parts) -> Column:
    """Non-negative 60-bit integer taken from the md5 of the joined parts."""
    text = F.concat_ws(":", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_uniform(*parts) -> Column:
    """Uniform in [0, 1)."""
    return hash_int(*parts).cast("double") / F.lit(HASH_SPAN)


def jitter(low: int, high: int, *parts) -> Column:
    """Deterministic integer in [low, high]."""
    return (F.lit(low) + F.pmod(hash_int(*parts), F.lit(high - low + 1))).cast("long")


def beta_mean_jitter(alpha, beta, *parts) -> Column:
    """Posterior mean plus a hash-sized nudge (not a Beta draw)."""
    a, b = col(alpha).cast("double"), col(beta).cast("double")
    return F.try_divide(a, a + b) + F.lit(0.01) * hash_uniform(*parts)


def stable_hash(text) -> Column:
    return F.sha2(F.coalesce(col(text), F.lit("")), 256)


def base64_sha256(text) -> Column:
    return F.base64(F.unhex(F.sha2(col(text), 256)))


def report_row_key(message_id, source_file, sent_text, body) -> Column:
    """The id when there is one, else a digest of where and what the row is."""
    present = F.when(F.trim(col(message_id)) != "", F.trim(col(message_id)))
    digest = F.sha2(
        F.concat_ws(
            "|",
            *[F.coalesce(col(c).cast("string"), F.lit("")) for c in (source_file, sent_text, body)],
        ),
        256,
    )
    return F.coalesce(present, digest)

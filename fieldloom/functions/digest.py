"""md5 digests read as numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK_BITS = 32
_CHUNKS = 4
_CHUNK_DIGITS = _CHUNK_BITS // 4
MAX_BUCKETS = 2**31


def check_buckets(buckets: int) -> None:
    if not 0 < buckets < MAX_BUCKETS:
        raise ValueError(f"bucket number must lie in 1..{MAX_BUCKETS - 1}")


def digest_bucket(digest: Column, buckets: int) -> Column:
    """A 128-bit hex digest modulo ``buckets``.

    The digest overflows every numeric type, so its 32-bit chunks are folded in
    from the left. Where ``buckets`` divides 2**32 the higher chunks vanish.
    """
    check_buckets(buckets)
    base = 1 << _CHUNK_BITS
    first = _CHUNKS - 1 if base % buckets == 0 else 0
    rest = F.lit(0).cast("bigint")
    for i in range(first, _CHUNKS):
        digits = F.substring(digest, i * _CHUNK_DIGITS + 1, _CHUNK_DIGITS)
        chunk = F.conv(digits, 16, 10).cast("bigint")
        rest = chunk % buckets if i == first else (rest * base + chunk) % buckets
    return rest


def md5_bucket(text: Column, buckets: int) -> Column:
    """The md5 digest of ``text`` as an integer modulo ``buckets``."""
    return digest_bucket(F.md5(text), buckets)

"""Number columns derived from an amount."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_log(column: str | Column) -> Column:
    """Natural logarithm; null for zero and below."""
    return F.ln(column)


def thousandths(column: Column) -> Column:
    """Decimal part of an amount in thousandths, cut off rather than rounded."""
    return ((column - column.cast("bigint")) * 1000).cast("int")


# A Mersenne prime. The fifth power is one-to-one modulo it, and products of two
# remainders fit in 64 bits.
HASH_PRIME = 2 ** 31 - 1


def hash_number(key: str | Column, seed: int) -> Column:
    """A repeatable pseudo-random number in [0, 2**31 - 1) for a whole-number key and a seed.

    Plain arithmetic, so it stays in generated code and any SQL engine can repeat it. For
    a text key pass ``xxhash64`` of it.
    """
    key, p = (F.col(key) if isinstance(key, str) else key).cast("bigint"), F.lit(HASH_PRIME)
    low, high = F.pmod(key, p), F.pmod(F.floor(key / p).cast("bigint"), p)
    mixed = (low * 48271 + high * 69621 + (seed * 16807 + 11) % HASH_PRIME) % p
    square = mixed * mixed % p
    return square * square % p * mixed % p

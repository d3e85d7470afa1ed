"""Surrogate keys for the conformed dimensions.

A dimension id is a function of the member's name, so the fact load computes the
id of a known member without joining billions of rows to the dimension.

* ``surrogate_key`` is the contract's 32-bit id: ``hash(name || " Product")``
  (Spark's Murmur3, seed 42) widened to long and shifted by ``Int.MaxValue``.
  Two of some 77,000 names are likely to share one.
* ``wide_key`` puts two such hashes together to 63 bits: the id of a warehouse
  by default.

How many bits a warehouse uses is a property stored with it.  Names whose ids
collide all the same are settled when they are new: the later ones get a salted
id, noted in the warehouse's table of key exceptions, which the fact load joins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffix appended before hashing (the same for products and
# retailers) and the offset that keeps ids non-negative.
KEY_SUFFIX = " Product"
KEY_OFFSET = 2147483647

WIDE_BITS, NARROW_BITS = 63, 32


def _col(name: Column | str) -> Column:
    return F.col(name) if isinstance(name, str) else name


def _salted(name: Column | str, salt: int) -> Column:
    return F.concat(_col(name), F.lit(KEY_SUFFIX + (f"#{salt}" if salt else "")))


def surrogate_key(name: Column | str, salt: int = 0) -> Column:
    """32-bit id of a dimension member from its name (null name -> id of null)."""
    return F.hash(_salted(name, salt)).cast("long") + F.lit(KEY_OFFSET)


def wide_key(name: Column | str, bits: int = WIDE_BITS, salt: int = 0) -> Column:
    """Non-negative id of ``bits`` bits (63 at most) from two hashes of the name."""
    text = _salted(name, salt)
    high = F.hash(text).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    # a mark before the text: after it, texts that share the first hash could share the second
    low = F.hash(F.concat(F.lit("*"), text)).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
    key = F.shiftleft(high, 31).bitwiseOR(low)
    return key if bits >= WIDE_BITS else key.bitwiseAND(F.lit((1 << bits) - 1))


def key_of(name: Column | str, bits: int = WIDE_BITS, salt: int = 0) -> Column:
    """Id of a member in a warehouse of ``bits``-bit ids (32: the contract's ids)."""
    return surrogate_key(name, salt) if bits == NARROW_BITS else wide_key(name, bits, salt)


def member_key(name: Column | str, bits: int = WIDE_BITS) -> Column:
    """Id of a *known* member: null when the name is null.

    This is what a left lookup by name into the dimension returns for a member
    without a key exception.
    """
    return F.when(_col(name).isNotNull(), key_of(name, bits))

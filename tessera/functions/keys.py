"""Seeded, engine-independent hash keys for sampling, splits and folds.

A small integer mixer (two Lehmer steps with xor-shifts, modulus 2^31-1) on
a 64-bit integer id. Integer-exact, so any SQL engine can reproduce it, and
no intermediate exceeds 2^47 (safe under ANSI overflow checks).
For string ids, ``xxhash64`` is folded into the same range first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the mixer.
MODULUS = 2147483647
MULT_1 = 48271
MULT_2 = 69621
SHIFT_1 = 15
SHIFT_2 = 13


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_key(id_col, seed: int = 42) -> Column:
    """Integer in [0, 2^31) that orders rows pseudo-randomly for a seed."""
    c = _c(id_col)
    base = F.pmod(c.cast("long"), F.lit(MODULUS))
    h = F.pmod(base + F.lit(seed % MODULUS), F.lit(MODULUS))
    h = F.pmod(h * F.lit(MULT_1), F.lit(MODULUS))
    h = h.bitwiseXOR(F.shiftright(h, SHIFT_1))
    h = F.pmod(h * F.lit(MULT_2), F.lit(MODULUS))
    return h.bitwiseXOR(F.shiftright(h, SHIFT_2))


def seeded_key_any(id_col, seed: int = 42) -> Column:
    """Like :func:`seeded_key` for ids of any type (strings via xxhash64)."""
    return seeded_key(F.xxhash64(_c(id_col)), seed)


def seeded_unit(id_col, seed: int = 42) -> Column:
    """Pseudo-random double in [0, 1) from :func:`seeded_key`."""
    return seeded_key(id_col, seed).cast("double") / F.lit(2147483648.0)


def seeded_key_sql(id_sql: str, seed: int = 42) -> str:
    """The same mixer as a DuckDB expression (for oracles)."""
    m = MODULUS
    h = f"((({id_sql}) % {m} + {m}) % {m} + {seed % m}) % {m}"
    h = f"(({h}) * {MULT_1}) % {m}"
    h = f"xor(({h}), ({h}) >> {SHIFT_1})"
    h = f"(({h}) * {MULT_2}) % {m}"
    return f"xor(({h}), ({h}) >> {SHIFT_2})"

"""Counter-based random numbers as plain integer column arithmetic.

A uniform is a pure function of (key state, draw id): results do not depend
on partitioning, task retries or executor loss (unlike ``rand(seed)``), and
the same integer arithmetic runs bit-identically in DuckDB, so simulated
predictions have an exact SQL oracle. All arithmetic stays below 2**63, so
ANSI overflow checks never fire.

Design: an md5 of the key and the seed gives four 28-bit words. They set, per
key, two steps and, per stream, two start values, so that stream ``t`` is

    mix((a_t + (d + 1) * step_a) mod P + (b_t + (d + 1) * step_b) mod Q)

over the draws ``d``: the sum of two arithmetic progressions modulo two primes
has a period of about 2**62, and the 112 bits of state keep the streams of
different keys (and of one key) apart. ``mix`` is three rounds of a
multiply-add modulo the Mersenne prime P followed by an xor-shift. Normals come
from Box-Muller pairs. (One md5 per draw, the plain alternative, costs several
times as much per uniform in both engines.)

Mixing rounds are applied as staged projections: each intermediate becomes a
column, so Catalyst keeps one copy of every subexpression (it does not
collapse projections that would duplicate non-trivial expressions).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameters of the generator (own design; shared with the SQL oracle).
MOD = 2147483647                      # 2**31 - 1, prime
MOD_B = 2147483629                    # 2**31 - 19, prime
TWO_POW_31 = 2147483648.0
KEY_MULT = 1103515245
STREAM_MULT = 1013904223
# (multiplier, increment, xor-shift) per round
ROUNDS = [(48271, 12345, 15), (69621, 67891, 13), (16807, 24680, 16), (39373, 13579, 11)]
DRAW_ROUNDS = ROUNDS[:3]              # of a draw; states are mixed by all four
TWO_PI = 2.0 * math.pi


def key_word(key_hex: Column, word: int) -> Column:
    """28-bit integer from the ``word``-th 7 hex digits of an md5 string."""
    return F.conv(F.substring(key_hex, 1 + 7 * word, 7), 16, 10).cast("long")


def stream_seed(key_int: Column, stream: int) -> Column:
    """Unmixed start value of one stream of one key."""
    return ((key_int * F.lit(KEY_MULT)) % F.lit(MOD) + F.lit(((stream + 1) * STREAM_MULT) % MOD)) % F.lit(MOD)


def _xorshift(c: Column, shift: int) -> Column:
    return c.bitwiseXOR(F.shiftright(c, shift))


def with_mixed(df: DataFrame, names: list[str], rounds: list[tuple[int, int, int]] = ROUNDS) -> DataFrame:
    """Apply the mixing rounds in place to the integer columns ``names``.

    One projection per round: the xor-shift of the previous round is fused
    with this round's multiply-add (an attribute referenced twice is cheap),
    which keeps generated code small.
    """
    prev_shift = None
    for mult, inc, shift in rounds:
        def step(n, mult=mult, inc=inc, prev_shift=prev_shift):
            x = F.col(n) if prev_shift is None else _xorshift(F.col(n), prev_shift)
            return (x * F.lit(mult) + F.lit(inc)) % F.lit(MOD)
        df = df.withColumns({n: step(n) for n in names})
        prev_shift = shift
    return df.withColumns({n: _xorshift(F.col(n), prev_shift) for n in names})


def to_uniform(c: Column | str) -> Column:
    """Map a mixed integer in [0, 2**31) to a uniform in (0, 1)."""
    col = F.col(c) if isinstance(c, str) else c
    return (col.cast("double") + F.lit(0.5)) / F.lit(TWO_POW_31)


def with_box_muller(df: DataFrame, u1: str, u2: str, z1: str, z2: str, tmp: str) -> DataFrame:
    """Two independent N(0, 1) columns from two uniform columns."""
    df = df.withColumn(tmp, F.sqrt(F.lit(-2.0) * F.log(F.col(u1))))
    return df.withColumns(
        {
            z1: F.col(tmp) * F.cos(F.lit(TWO_PI) * F.col(u2)),
            z2: F.col(tmp) * F.sin(F.lit(TWO_PI) * F.col(u2)),
        }
    ).drop(tmp)


def step_of(mixed: Column, modulus: int) -> Column:
    """A step in [1, modulus) from a mixed state."""
    return mixed % F.lit(modulus - 1) + F.lit(1)


def with_draw_state(df: DataFrame, draw_id: str, step_a: str, step_b: str, starts: list[tuple[str, str]], names: list[str]) -> DataFrame:
    """Unmixed states ``names`` of a draw, one per (a, b) pair of start columns.
    Sums stay below 2**32, products below 2**51."""
    d = F.col(draw_id) + F.lit(1)
    keep = [c for c in df.columns]
    df = df.select(*keep, ((d * F.col(step_a)) % F.lit(MOD)).alias("_oa"), ((d * F.col(step_b)) % F.lit(MOD_B)).alias("_ob"))
    drop = {x for pair in starts for x in pair} | {step_a, step_b}
    return df.select(
        *[c for c in keep if c not in drop],
        *[((F.col(a) + F.col("_oa")) % F.lit(MOD) + (F.col(b) + F.col("_ob")) % F.lit(MOD_B)).alias(n) for (a, b), n in zip(starts, names)],
    )

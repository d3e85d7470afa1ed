"""DuckDB SQL expression equal to Spark's ``hash(string)``.

Used only to write the DuckDB oracle queries that check surrogate ids
independently of Spark.  Spark hashes the UTF-8 bytes of a string with
Murmur3 x86_32 (seed 42): whole little-endian 4-byte words first, then every
remaining byte on its own (sign-extended, as a Java byte), each mixed like a
word; then the length and the usual finalizer.  All arithmetic is mod 2^32,
products are done in HUGEINT, and ``list_transform([x], lambda v: ...)[1]``
serves as a let-binding.
"""

from __future__ import annotations

# Murmur3 x86_32 constants and Spark's default seed.
_C1 = 0xCC9E2D51
_C2 = 0x1B873593
_N = 0xE6546B64
_F1 = 0x85EBCA6B
_F2 = 0xC2B2AE35
_SEED = 42
_M = 4294967296  # 2^32


def _mul(a: str, c: int) -> str:
    return f"CAST((CAST({a} AS HUGEINT) * {c}) % {_M} AS BIGINT)"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) | (({x}) >> {32 - r})) & {_M - 1}"


def _mix_k(k: str) -> str:
    return _mul(f"({_rotl(_mul(k, _C1), 15)})", _C2)


def spark_hash_sql(expr: str) -> str:
    """DuckDB expression: Spark ``hash(expr)`` for a VARCHAR ``expr`` (INTEGER, null -> 42)."""
    byte = "CAST(('0x' || substr(hx, 2 * i + 1, 2)) AS BIGINT)"
    word = (
        f"(CAST(('0x' || substr(hx, 8 * w + 1, 2)) AS BIGINT)"
        f" | (CAST(('0x' || substr(hx, 8 * w + 3, 2)) AS BIGINT) << 8)"
        f" | (CAST(('0x' || substr(hx, 8 * w + 5, 2)) AS BIGINT) << 16)"
        f" | (CAST(('0x' || substr(hx, 8 * w + 7, 2)) AS BIGINT) << 24))"
    )
    signed_byte = f"(CASE WHEN {byte} >= 128 THEN {byte} + {_M - 256} ELSE {byte} END)"
    ks = (
        f"list_concat([{_SEED}],"
        f" list_transform(range(n // 4), lambda w: {_mix_k(word)}),"
        f" list_transform(range(n - n % 4, n), lambda i: {_mix_k(signed_byte)}))"
    )
    step = f"({_mul(f'({_rotl(f'xor(acc, k)', 13)})', 5)} + {_N}) % {_M}"
    h = f"list_reduce({ks}, lambda acc, k: {step})"
    fmix = (
        "list_transform([xor(h, n)], lambda a:"
        f" list_transform([{_mul('xor(a, a >> 16)', _F1)}], lambda b:"
        f" list_transform([{_mul('xor(b, b >> 13)', _F2)}], lambda c:"
        " xor(c, c >> 16))[1])[1])[1]"
    )
    body = (
        f"list_transform([hex(encode({expr}))], lambda hx:"
        f" list_transform([length(hx) // 2], lambda n:"
        f" list_transform([{h}], lambda h: {fmix})[1])[1])[1]"
    )
    return (
        f"(CASE WHEN ({expr}) IS NULL THEN {_SEED} ELSE"
        f" CAST(list_transform([{body}], lambda u: CASE WHEN u >= 2147483648 THEN u - {_M} ELSE u END)[1] AS INTEGER) END)"
    )


def surrogate_key_sql(name_expr: str) -> str:
    """DuckDB twin of ``functions.keys.surrogate_key`` (narrow ids)."""
    return f"(CAST({spark_hash_sql(f'({name_expr}) || {chr(39)} Product{chr(39)}')} AS BIGINT) + 2147483647)"


def wide_key_sql(name_expr: str) -> str:
    """DuckDB twin of ``functions.keys.wide_key`` (63 bits)."""
    salted = f"({name_expr}) || ' Product'"
    high = f"((CAST({spark_hash_sql(salted)} AS BIGINT) + {_M}) % {_M})"
    low = f"((CAST({spark_hash_sql(chr(39) + '*' + chr(39) + ' || ' + salted)} AS BIGINT) + {_M}) % {_M // 2})"
    return f"({high} * {_M // 2} + {low})"

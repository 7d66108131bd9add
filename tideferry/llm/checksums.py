"""Checksums as DuckDB SQL, which has none of its own."""

from __future__ import annotations

# The reflected polynomial of CRC-32, and its start and end value.
POLYNOMIAL = 0xEDB88320
ONES = 0xFFFFFFFF


def sql_crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string, bit by bit."""
    bits = f"flatten(list_transform(range(1, len({text}) + 1), lambda i: list_transform(range(0, 8), lambda b: (ord(({text})[i]) >> b) & 1)))"
    step = f"lambda a, b: xor(a >> 1, {POLYNOMIAL} * (xor(a, b) & 1))"
    return f"xor(list_reduce(list_concat([{ONES}::BIGINT], {bits}::BIGINT[]), {step}), {ONES})"

"""SQL for checksums that DuckDB lacks."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """DuckDB expression: the CRC-32 of the UTF-8 bytes of ``text``, an expression whose code points are below U+0800."""
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)"
    bytes_ = f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))"
    shifted = "list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda crc, byte: {shifted}), 4294967295)"

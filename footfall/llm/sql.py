"""Pieces of DuckDB SQL that several queries' SQL shares."""

from __future__ import annotations

# crc_table.t: the 256 remainders of CRC-32, from the rule that makes them
CRC_TABLE = """
crc_rule(byte, v, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc_rule WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(v ORDER BY byte) AS t FROM crc_rule WHERE k = 8)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; crc_table must be in FROM."""
    return f"""xor(4294967295, list_reduce(
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda pair: ('0x' || pair)::BIGINT),
        lambda state, byte: xor(state >> 8, t[(xor(state, byte) & 255) + 1]), 4294967295::BIGINT))"""


def field(column: str) -> str:
    """One field of a record: `-` for null, else byte count, colon, value."""
    value = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode({value})) || ':' || {value} END"


def ascii_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

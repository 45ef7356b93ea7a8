"""CRC-32 in DuckDB SQL, which has none, for the SQL twins."""

#: A common table with the 256 entries of the reflected polynomial 0xEDB88320 as the list ``tab``.
TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(
  list_prepend(i, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
  ELSE a >> 1 END)) AS tab)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text; ``tab`` of ``TABLE`` must be in scope."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform({pairs}, "
            "lambda h: ('0x' || h)::BIGINT)), "
            "lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])))")

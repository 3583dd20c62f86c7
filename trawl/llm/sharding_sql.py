"""DuckDB SQL of the sharding query: draws, checksums and slots written out."""

from __future__ import annotations

from trawl.llm.sharding import DIGITS, OVERHEAD, Tree, levels_of

# The checksum's table by its rule: eight halvings of each byte by the polynomial.
CHECKSUM_TABLE = """
checksum_table AS (
    SELECT list(list_reduce([i] || range(8), lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
)
"""


def checksum(hexed: str) -> str:
    """crc32 of the bytes whose hexadecimal digits are ``hexed``."""
    byte = "CAST('0x' || x AS BIGINT)"
    octets = f"list_transform(regexp_extract_all({hexed}, '..'), lambda x: {byte})"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda c, b: {step}), 4294967295)"


def placed(tree: Tree, name: str, out: str) -> str:
    """A chain of tables that ends in ``name`` (key, out)."""
    parts, before, parent = [], "keys", "''"
    for i, level in enumerate(levels_of(tree)):
        rows = ", ".join(f"('{p}', '{n}', {s}, {w}::DOUBLE)" for p, kids in level.items() for n, s, w in kids)
        draw = f"CAST('0x' || substr(md5(c.name || ':' || k.key), 1, {DIGITS}) AS BIGINT)"
        parts.append(f"{name}_kids{i}(parent, name, shard, weight) AS (VALUES {rows})")
        parts.append(
            f"{name}{i} AS (SELECT k.key, arg_min(c.name, d) AS at, arg_min(c.shard, d) AS {out} FROM "
            f"(SELECT k.key, {parent if i == 0 else 'k.at'} AS at FROM {before} k) k JOIN {name}_kids{i} c ON c.parent = k.at, "
            f"LATERAL (SELECT -ln(({draw} + 0.5) / {float(16**DIGITS)}) / c.weight AS d) GROUP BY k.key)"
        )
        before = f"{name}{i}"
    parts.append(f"{name} AS (SELECT key, {out} FROM {before})")
    return ",\n".join(parts)


def sharding_sql(tree: Tree, larger: Tree) -> str:
    return f"""
WITH {CHECKSUM_TABLE},
docs AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, encode(coalesce(text, '')) AS bytes FROM documents),
keys AS (SELECT DISTINCT key FROM docs),
{placed(tree, "now", "shard")},
{placed(larger, "later", "grown_shard")},
sized AS (
    SELECT doc_id, key, CAST(octet_length(bytes) + {OVERHEAD} AS BIGINT) AS size, CAST({checksum("hex(bytes)")} AS BIGINT) AS text_crc32
    FROM docs, checksum_table
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM sized JOIN now USING (key) JOIN later USING (key)
"""

"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

#: Levels that the SQL unrolls: sources of up to 16^5 rows, up to 16^3 sources.
_LEVELS, _OVER = 5, 3

#: Reflected polynomial of crc32 (fixed value).
_POLYNOMIAL = 0xEDB88320

# crc32 of a short text of ASCII characters, bit by bit
_CRC32 = f"""xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({{0}}, ''),
        lambda c: ascii(c)::BIGINT), lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, {_POLYNOMIAL}) ELSE x >> 1 END)), 4294967295)"""


def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    parts = " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields)
    return f"sha256({parts})"


def _tree(name: str, key: str, levels: int) -> str:
    """``{name}0`` holds key, pos and node; adds each level's runs and the next nodes."""
    out = []
    for k in range(levels):
        out.append(f"""
    {name}_run{k} AS (SELECT {key}, pos // 16 AS run, string_agg(node, '' ORDER BY pos) AS members,
        any_value(size) AS size
        FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS size FROM {name}{k}) GROUP BY {key}, pos // 16),
    {name}{k + 1} AS (SELECT {key}, run AS pos,
        CASE WHEN size > 1 THEN sha256(members) ELSE members END AS node FROM {name}_run{k})""")
    return ",".join(out)


def _merkle() -> str:
    joins, flanks = [], []
    for name, key, position, levels in (
        ("t", "source", "leaves.pos", _LEVELS), ("u", "one", "top.pos", _OVER),
    ):
        for k in range(levels):
            alias, at = f"{name}_r{k}", f"({position} // {16**k})"
            same = "leaves.source IS NOT DISTINCT FROM {}.source" if name == "t" else "{}.one = 1"
            joins.append(f"JOIN {name}_run{k} {alias} ON {same.format(alias)} AND {alias}.run = {at} // 16")
            left = f"substr({alias}.members, 1, 64 * ({at} % 16))"
            right = f"substr({alias}.members, 64 * ({at} % 16) + 65)"
            flanks.append((f"{alias}.size > 1", left, right))
    siblings = ", ".join(
        f"CASE WHEN {some} THEN {{'l': {left}, 'r': {right}}} END" for some, left, right in flanks
    )
    return f"""
    WITH leaves AS (SELECT doc_id, source, leaf, tampered,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM (SELECT doc_id, source, {_leaf("text")} AS leaf,
            CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 5 = 0 THEN
            {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
            FROM documents)),
    t0 AS (SELECT source, pos, leaf AS node FROM leaves),{_tree("t", "source", _LEVELS)},
    top AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos
        FROM t{_LEVELS}),
    u0 AS (SELECT 1 AS one, pos, subroot AS node FROM top),{_tree("u", "one", _OVER)},
    placed AS (SELECT doc_id, leaf, subroot, u{_OVER}.node AS root, coalesce(tampered, leaf) AS start,
        list_filter([{siblings}], lambda s: s IS NOT NULL) AS path
        FROM leaves JOIN top ON leaves.source IS NOT DISTINCT FROM top.source CROSS JOIN u{_OVER}
        {" ".join(joins)}),
    folded AS (SELECT doc_id, leaf, subroot, root,
        sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
        list_reduce([start] || list_transform(path, lambda s: s.l || '*' || s.r),
            lambda a, s: sha256(replace(s, '*', a))) AS folded_root FROM placed)
    SELECT *, folded_root = root AS verified FROM folded
"""


ORACLE_SQL: dict[str, str] = {"op12_merkle": _merkle()}

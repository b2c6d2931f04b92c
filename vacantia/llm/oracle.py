"""SQL that the training-data queries must agree with, where SQL can state them."""

from __future__ import annotations

#: Levels of the trees the SQL builds: enough for 16**5 rows of a source and 16**3 sources.
_SOURCE_LEVELS, _TOP_LEVELS = 5, 3


def _spelled(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    fields = [_spelled(c) for c in ("doc_id", "source", "lang", "n_chars")] + [_spelled(text)]
    return f"sha256({' || '.join(fields)})"


def _tree(name: str, levels: int) -> list[str]:
    """Level by level the nodes of every tree; a tree that is down to one node goes on as that node."""
    parts = []
    for k in range(1, levels + 1):
        parts.append(
            f"""{name}{k} AS MATERIALIZED (SELECT tree, pos // 16 AS pos, list(node ORDER BY pos) AS kids, max(n) AS below,
              CASE WHEN max(n) = 1 THEN max(node) ELSE sha256(array_to_string(list(node ORDER BY pos), '')) END AS node,
              (max(n) + 15) // 16 AS n FROM {name}{k - 1} GROUP BY tree, pos // 16)"""
        )
    return parts


def _climb(name: str, start: str, levels: int) -> list[str]:
    """A leaf's siblings and its folded digest, level by level."""
    parts = []
    for k in range(1, levels + 1):
        before = start if k == 1 else f"{name}_up{k - 1}"
        parts.append(
            f"""{name}_up{k} AS (SELECT u.* REPLACE (
              CASE WHEN below = 1 THEN folded ELSE sha256(array_to_string(kids[:pos % 16], '') || folded
                || array_to_string(kids[pos % 16 + 2:], '')) END AS folded,
              CASE WHEN below = 1 THEN proof ELSE proof || array_to_string(kids[:pos % 16], '')
                || array_to_string(kids[pos % 16 + 2:], '') END AS proof, u.pos // 16 AS pos)
              FROM {before} u JOIN (SELECT tree AS t, pos AS a, kids, below FROM {name}{k}) ON t = tree AND a = u.pos // 16)"""
        )
    return parts


MANIFEST = "WITH " + ",\n  ".join(
    [
        f"""leaves AS MATERIALIZED (SELECT doc_id, source, {_leaf('text')} AS leaf,
          CASE WHEN crc32_of(CAST(doc_id AS VARCHAR)) % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered
          FROM documents)""",
        """ranked AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
          row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)""",
        "low0 AS (SELECT tree, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM ranked)",
        *_tree("low", _SOURCE_LEVELS),
        f"""high0 AS (SELECT 0 AS tree, tree - 1 AS pos, node, count(*) OVER () AS n FROM low{_SOURCE_LEVELS})""",
        *_tree("high", _TOP_LEVELS),
        "begin AS (SELECT doc_id, leaf, coalesce(altered, leaf) AS folded, '' AS proof, tree, pos FROM ranked)",
        *_climb("low", "begin", _SOURCE_LEVELS),
        f"""middle AS (SELECT doc_id, leaf, folded, proof, 0 AS tree, u.tree - 1 AS pos, node AS subroot
          FROM low_up{_SOURCE_LEVELS} u JOIN (SELECT tree AS t, node FROM low{_SOURCE_LEVELS}) ON t = u.tree)""",
        *_climb("high", "middle", _TOP_LEVELS),
    ]
) + f"""
  SELECT doc_id, leaf, subroot, (SELECT max(node) FROM high{_TOP_LEVELS}) AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = (SELECT max(node) FROM high{_TOP_LEVELS}) AS verified FROM high_up{_TOP_LEVELS}"""

#: DuckDB has no crc32: bit by bit over the bytes of a short text of digits.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({x}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END))"""
MANIFEST = MANIFEST.replace("crc32_of(CAST(doc_id AS VARCHAR))", "xor(" + _CRC.format(x="CAST(doc_id AS VARCHAR)") + ", 4294967295)")

WARC = """WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
  fives AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT)) AS v FROM hashed)
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (v[i // 4 + 1] >> (5 * (3 - i % 4))) & 31 + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to
  FROM fives""".replace("& 31 + 1, 1", "& 31) + 1, 1").replace("(v[i", "((v[i")


def _vectors(rounds: int) -> str:
    parts = [
        """kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS v
          FROM kept, range(16) t(p))""",
        "firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64)",
        "book0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN firsts USING (vec_id))",
    ]
    for k in range(rounds + 1):
        parts.append(
            f"""near{k} AS MATERIALIZED (SELECT vec_id, a.p, min({{'d': list_sum(list_transform(range(1, len(a.v) + 1),
              lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))), 'e': e}}) AS m FROM parts a JOIN book{k} b ON a.p = b.p GROUP BY 1, 2)"""
        )
        if k < rounds:
            parts.append(
                f"""mean{k} AS (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS v FROM (SELECT a.p, m.e AS e, i,
                  CAST(sum(a.v[i]) AS BIGINT) AS s, count(*) AS c FROM near{k} n JOIN parts a USING (vec_id, p), range(1, len(a.v) + 1) r(i)
                  GROUP BY ALL) GROUP BY p, e)"""
            )
            parts.append(
                f"""book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b
                  LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)"""
            )
    return "WITH " + ",\n  ".join(parts) + f"""
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
      FROM (SELECT vec_id, string_agg(printf('%02x', CAST(m.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
        FROM near{rounds} GROUP BY vec_id) JOIN kept USING (vec_id)"""


VECTORS = _vectors(2)

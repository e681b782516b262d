"""DuckDB SQL of the operators that it can express."""

from __future__ import annotations

#: Vectors without nulls and non-finite components, as doubles.
_USABLE = """SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, width: int = 64, scale: int = 4096) -> str:
    """Rounds are unrolled: one table of nearest entries and one of codebooks each."""
    size = width // parts
    cell = f"""p AS MATERIALIZED (SELECT vec_id, label, unnest(range({width})) AS d, unnest(list_transform(e, lambda x: floor({scale} * x)::BIGINT)) AS v FROM u),
c AS MATERIALIZED (SELECT vec_id, label, d // {size} AS part, d % {size} AS pos, v FROM p),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, v FROM c JOIN
  (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM u) USING (vec_id) WHERE r <= {entries})"""
    steps = [f"WITH u AS MATERIALIZED ({_USABLE})", cell]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, label, part, entry, apart FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY apart, entry) AS r FROM (
    SELECT vec_id, label, part, entry, sum((c.v - b{i}.v) * (c.v - b{i}.v))::BIGINT AS apart FROM c JOIN b{i} USING (part, pos)
    GROUP BY vec_id, label, part, entry)) WHERE r = 1)""")
        if i < rounds:
            steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m.v, b{i}.v) AS v FROM b{i} LEFT JOIN (
  SELECT part, entry, pos, ((sum(v)::BIGINT - ((sum(v)::BIGINT % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v
  FROM c JOIN a{i} USING (vec_id, part) GROUP BY part, entry, pos) m USING (part, entry, pos))""")
    return ",\n".join([steps[0] + ",\n" + steps[1], *steps[2:]]) + f""",
e AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label),
s AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e, s"""


HARD_NEGATIVES = f"""WITH u AS ({_USABLE}),
q AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
  list_transform(e, lambda x: floor(256 * x)::BIGINT) AS v FROM u WHERE label IS NOT NULL AND vec_id IS NOT NULL),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
  list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM q a, q b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY rank <= 3"""


def _draw(name: str, weight: float) -> str:
    return f"-ln((('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), '/{name}')), 1, 13))::BIGINT + 0.5::DOUBLE) / {16 ** 13}::DOUBLE) / {weight}::DOUBLE"


def _descend(nodes: list[tuple[str, float, str]]) -> str:
    """SQL of the value of the node with the smallest draw."""
    if len(nodes) == 1:
        return nodes[0][2]
    draws = [_draw(name, weight) for name, weight, _ in nodes]
    least = f"least({', '.join(draws)})"
    return "CASE " + " ".join(f"WHEN {d} = {least} THEN {value}" for d, (_, _, value) in zip(draws, nodes, strict=True)) + " END"


def _shard(tree: list[list[list[float]]]) -> str:
    number, regions = 0, []
    for r, region in enumerate(tree):
        racks = []
        for k, rack in enumerate(region):
            leaves = [(f"{r}/{k}/{s}", w, str(number + s)) for s, w in enumerate(rack)]
            number += len(rack)
            racks.append((f"{r}/{k}", sum(rack), _descend(leaves)))
        regions.append((str(r), sum(w for _, w, _ in racks), _descend(racks)))
    return f"({_descend(regions)})::INTEGER"


def hash_tree(tree: list[list[list[float]]]) -> str:
    """CRC-32 is a fold over bytes with the table of the reflected polynomial."""
    entry = "xor(c >> 1, 3988292384 * (c & 1))"
    folded = "n::BIGINT"
    for _ in range(8):
        folded = f"list_transform([{folded}], lambda c: {entry})[1]"
    return f"""WITH t AS MATERIALIZED (SELECT list_transform(range(256), lambda n: {folded}) AS crc),
d AS MATERIALIZED (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM documents),
r AS (SELECT doc_id, size, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS text_crc32,
  {_shard(tree)} AS shard, {_shard([*tree, [[1.0]]])} AS grown_shard FROM d, t)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, size, text_crc32) - 1 AS slot, grown_shard FROM r"""

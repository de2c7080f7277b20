"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from ledgerflow.llm import mixing


def _apportion(source: str, group: str, item: str, votes: str, seats: str, out: str) -> str:
    """Sainte-Lague by listing the quotients between two safe bounds."""
    return f"""
    SELECT a.*, lo + coalesce(won, 0) AS {out} FROM (
      SELECT *, CASE WHEN {seats} > 0 THEN floor(q * greatest({seats} - half, 0) / {seats} + 0.5)::BIGINT ELSE 0 END AS lo
      FROM (SELECT *, CASE WHEN {seats} > 0 AND sum({votes}) OVER g > 0
                           THEN {votes} * {seats}::DOUBLE / (sum({votes}) OVER g)::DOUBLE ELSE 0.0 END AS q,
                   (count(*) OVER g) / 2 AS half
            FROM {source} WINDOW g AS (PARTITION BY {group}))) a
    LEFT JOIN (
      SELECT {group} AS g_, {item} AS i_, count(*) AS won FROM (
        SELECT {group}, {item}, room, row_number() OVER (PARTITION BY {group} ORDER BY q / (k + 0.5) DESC, {item}, k) AS r
        FROM (SELECT *, unnest(range(lo, hi)) AS k FROM (
          SELECT *, ({seats} - sum(lo) OVER (PARTITION BY {group}))::BIGINT AS room FROM (
            SELECT *, floor(q * greatest({seats} - half, 0) / {seats} + 0.5)::BIGINT AS lo,
                   floor(q * ({seats} + half) / {seats} + 0.5)::BIGINT AS hi
            FROM (SELECT *, CASE WHEN sum({votes}) OVER g > 0
                                 THEN {votes} * {seats}::DOUBLE / (sum({votes}) OVER g)::DOUBLE ELSE 0.0 END AS q,
                         (count(*) OVER g) / 2 AS half
                  FROM {source} WINDOW g AS (PARTITION BY {group}))
            WHERE {seats} > 0))))
      WHERE r <= room GROUP BY 1, 2) b ON a.{group} = b.g_ AND a.{item} = b.i_"""


MIXING = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS line
  FROM documents),
rows_ AS (SELECT *, ('0x' || substr(line, 1, 8))::BIGINT % {mixing.SHARDS} AS shard FROM d),
cells0 AS (SELECT source, shard, sum(size)::BIGINT AS shard_size FROM rows_ GROUP BY ALL),
s0 AS (SELECT source, sum(shard_size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
       FROM cells0 GROUP BY source),
s1 AS (SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][(place - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
              source_size * {mixing.LIMIT} AS stop, (sum(source_size) OVER ())::BIGINT AS total FROM s0),
s2 AS (SELECT *, (total - coalesce(sum(stop) OVER (ORDER BY stop / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                 / sum(weight) OVER (ORDER BY stop / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit FROM s1),
s3 AS (SELECT *, CASE WHEN stop / weight <= unit THEN stop::DOUBLE
                      ELSE weight * (SELECT arg_min(unit, stop / weight) FROM s2 WHERE stop / weight > unit) END AS target,
              (total // {mixing.BLOCK_WORDS})::BIGINT AS corpus_blocks, 1 AS one FROM s2),
s4 AS ({_apportion('s3', 'one', 'place', 'target', 'corpus_blocks', 'source_blocks')}),
c1 AS (SELECT c.shard, c.shard_size, s.place, s.source, s.source_size, s.target, s.source_blocks
       FROM cells0 c JOIN s4 s ON c.source IS NOT DISTINCT FROM s.source),
c2 AS ({_apportion('c1', 'place', 'shard', 'shard_size', 'source_blocks', 'blocks')}),
placed AS (
  SELECT r.doc_id, r.size, c.source_size, c.target, c.shard_size, least(c.blocks * {mixing.BLOCK_WORDS}, c.shard_size * {mixing.LIMIT}) AS quota,
         coalesce(sum(r.size) OVER (PARTITION BY r.source, r.shard ORDER BY r.line, r.doc_id, r.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows_ r JOIN c2 c ON r.source IS NOT DISTINCT FROM c.source AND r.shard = c.shard)
SELECT doc_id, size, source_size, target,
       (size * coalesce(quota // nullif(shard_size, 0), 0)
        + greatest(0, least(size, quota - coalesce(quota // nullif(shard_size, 0), 0) * shard_size - before)))::BIGINT AS taken
FROM placed
"""

_FILTERS = "ABCDE"
_BIT = "(1 << (ascii({}) - 65))"

FILTER_AUDIT = f"""
WITH flags AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY 1),
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
first AS (SELECT body, min(doc_id) AS first FROM t GROUP BY body),
d AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CAST(len(words) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INTEGER)
        + 4 * CAST(100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 5 * length(body) AS INTEGER)
        + 8 * CAST(regexp_matches(body, '[#$%&*|]') AS INTEGER) + 16 * coalesce(CAST(doc_id > first AS INTEGER), 0) AS mask
      FROM t JOIN first USING (body) LEFT JOIN flags USING (doc_id)),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, mask),
letter AS (SELECT unnest(string_split('{_FILTERS}', '')) AS l),
orders AS (SELECT a.l || b.l || c.l || e.l || f.l AS o FROM letter a, letter b, letter c, letter e, letter f
           WHERE len(list_distinct([a.l, b.l, c.l, e.l, f.l])) = 5),
slots AS (SELECT o, CAST(s AS INTEGER) AS step, {_BIT.format("substr(o, s, 1)")} AS bit,
                 list_sum([{_BIT.format("x")} FOR x IN string_split(substr(o, 1, s - 1), '') IF x <> '']) AS seen
          FROM orders, range(1, 6) r(s)),
found AS (
  SELECT part, o, step, bit,
    sum(CASE WHEN mask & (coalesce(seen, 0)::BIGINT | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & coalesce(seen, 0)::BIGINT = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & coalesce(seen, 0)::BIGINT > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & coalesce(seen, 0)::BIGINT = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & coalesce(seen, 0)::BIGINT = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, slots GROUP BY part, o, step, bit)
SELECT part, o AS filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found
"""

ORACLE: dict[str, str] = {"op5_mixing": MIXING, "op13_filter_audit": FILTER_AUDIT}

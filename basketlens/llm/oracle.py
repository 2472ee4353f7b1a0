"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: WITH items: ``crc_table`` (one row: the table of the checksum), from its polynomial.
CRC_TABLE = """
bytes_of AS (SELECT range AS i FROM range(256)),
crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda a, x: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS crcs
  FROM bytes_of)"""


def crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; ``crcs`` of crc_table must be in scope."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = "lambda a, v: xor(a >> 8, crcs[(xor(a, v) & 255) + 1])"
    return f"xor(list_reduce({data}, {step}, 4294967295), 4294967295)"


IMPORTANCE_SQL = f"""
WITH {CRC_TABLE},
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS n, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
cut AS (
  SELECT side, n, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM texts),
runs AS (
  SELECT side, n, unnest(list_concat(words, list_transform(range(1, len(words)),
    lambda i: words[i] || ' ' || words[i + 1]))) AS feature
  FROM cut),
counted AS (SELECT side, n, feature, count(*) AS times FROM runs GROUP BY ALL),
dealt AS (
  SELECT feature, {crc32('feature')} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM counted), crc_table),
sums AS (
  SELECT bucket, sum(times) FILTER (side = 'd') AS s, sum(times) FILTER (side = 'b') AS t
  FROM counted JOIN dealt USING (feature) GROUP BY bucket),
filled AS (
  SELECT bucket, coalesce(s, 0)::DOUBLE AS s, coalesce(t, 0)::DOUBLE AS t,
         (sum(s) OVER ())::DOUBLE AS all_s, coalesce(sum(t) OVER (), 0)::DOUBLE AS all_t FROM sums),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM filled),
weighed AS (
  SELECT n, sum(times)::BIGINT AS n_features, floor(sum(times * gain)::DOUBLE / sum(times))::BIGINT AS weight
  FROM counted JOIN dealt USING (feature) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY n),
scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
           + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
  FROM cut LEFT JOIN weighed USING (n) WHERE side = 'd'),
numbered AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, n_features) END AS place,
         floor(count(*) FILTER (n_words >= 20) OVER () * 25 / 100) AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM numbered
"""

TRIE_SQL = f"""
WITH {CRC_TABLE},
placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(coalesce(role, '')), encode(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS turns FROM placed GROUP BY conv_id),
headed AS (SELECT conv_id, turns, {crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM own, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(o.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM headed c LEFT JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(turns) AS length, d AS depth, turns[1:d] AS path,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(turns[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, path),
childless AS (
  SELECT n.* FROM nodes n LEFT JOIN (SELECT DISTINCT depth - 1 AS depth, path[1:depth - 1] AS path FROM nodes WHERE depth > 0) c
    ON c.depth = n.depth AND c.path = n.path WHERE c.path IS NULL),
kids AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
ancestry AS (
  SELECT p.depth, p.path, n.depth AS below, (n.n_convs - 1) * n.words AS saving,
         EXISTS (SELECT 1 FROM childless l WHERE l.depth = n.depth AND l.conv_id = n.conv_id) AS leaf
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
sums AS (SELECT depth, path, count(*) FILTER (leaf) AS n_leaves, sum(saving)::BIGINT AS saved_tokens FROM ancestry GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves, s.saved_tokens,
       n.ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.path = n.path
LEFT JOIN kids k ON k.depth = n.depth AND k.path = n.path
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.path = n.path[1:n.depth - 1]
"""


def _kd_level(i: int) -> str:
    """One level of the tree: from points{i} to points{i + 1}."""
    dims = range(4)
    widths = [f"(max(d{d}) - min(d{d})) / greatest((SELECT max(d{d}) - min(d{d}) FROM points0), 1e-300)" for d in dims]
    pick = "CASE " + " ".join(f"WHEN w{d} = greatest(w0, w1, w2, w3) THEN {d}" for d in dims) + " END"
    along = "CASE dim " + " ".join(f"WHEN {d} THEN d{d}" for d in dims) + " END"
    return f"""
nodes{i} AS (
  SELECT node, leaves, sum(w)::BIGINT AS total, {", ".join(f"{w} AS w{d}" for d, w in enumerate(widths))}
  FROM points{i} WHERE leaves > 1 GROUP BY node, leaves),
keyed{i} AS (
  SELECT p.*, {along} AS k, total * (p.leaves // 2) / p.leaves::DOUBLE AS need
  FROM points{i} p JOIN (SELECT node, total, {pick} AS dim FROM nodes{i}) n USING (node)),
summed{i} AS (
  SELECT *, sum(w) OVER o AS reached, row_number() OVER o AS place, lead(part) OVER o IS NULL AS last
  FROM keyed{i} WINDOW o AS (PARTITION BY node ORDER BY k, t0, t1, part)),
grouped{i} AS (
  SELECT *, min(place) OVER g AS g_first, max(place) OVER g AS g_last,
         min(reached - w) OVER g AS g_start, max(reached) OVER g AS g_end
  FROM summed{i} WINDOW g AS (PARTITION BY node, digest)),
cuts{i} AS (
  SELECT node, CASE
    WHEN g_last > g_first AND least(abs(g_start - need), abs(g_end - need)) <= (SELECT 0.02::DOUBLE * total / 8 FROM totals)
      THEN CASE WHEN abs(g_end - need) < abs(g_start - need) THEN g_last ELSE g_first - 1 END
    ELSE CASE WHEN abs(reached - need) < abs(reached - w - need) THEN place ELSE place - 1 END END AS left_points
  FROM grouped{i} WHERE reached - w <= need AND (reached > need OR last)),
points{i + 1} AS (
  SELECT s.digest, s.part, s.w, s.d0, s.d1, s.d2, s.d3, s.t0, s.t1,
         CASE WHEN place <= left_points THEN node ELSE node + leaves // 2 END AS node,
         CASE WHEN place <= left_points THEN leaves // 2 ELSE leaves - leaves // 2 END AS leaves
  FROM summed{i} s JOIN cuts{i} USING (node))"""


KD_SHARDS_SQL = f"""
WITH {CRC_TABLE},
sized AS (
  SELECT doc_id, md5(coalesce(text, '')) AS digest, strlen(coalesce(text, '')) + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS own,
         coalesce(('0x' || rpad(substr(hex(encode(source)), 1, 12), 12, '0'))::BIGINT::DOUBLE + 1, 0) AS d0,
         coalesce(('0x' || rpad(substr(hex(encode(lang)), 1, 12), 12, '0'))::BIGINT::DOUBLE + 1, 0) AS d1,
         coalesce(doc_id::DOUBLE, -9223372036854775808) AS d2
  FROM documents, crc_table),
totals AS (SELECT sum(size)::BIGINT AS total, greatest(1.0::DOUBLE, 0.01::DOUBLE * sum(size)::BIGINT / 8) AS heaviest FROM sized),
weights AS (SELECT digest, sum(size)::BIGINT AS w, min(d0) AS d0, min(d1) AS d1, min(d2) AS d2, min(size)::DOUBLE AS d3 FROM sized GROUP BY digest),
parted AS (
  SELECT s.doc_id, s.digest, s.size, s.text_crc32,
         CASE WHEN w > heaviest THEN own % ceil(w / heaviest)::BIGINT ELSE 0 END AS part
  FROM sized s JOIN weights USING (digest), totals),
points0 AS (
  SELECT p.digest, part, sum(size)::BIGINT AS w, any_value(d0) AS d0, any_value(d1) AS d1, any_value(d2) AS d2, any_value(d3) AS d3,
         ('0x' || substr(p.digest, 1, 13))::BIGINT AS t0, ('0x' || substr(p.digest, 14, 13))::BIGINT AS t1, 0 AS node, 8 AS leaves
  FROM parted p JOIN weights USING (digest) GROUP BY p.digest, part),
{",".join(_kd_level(i) for i in range(3))}
SELECT doc_id, size, text_crc32, 'bytes' AS law, node::INTEGER AS shard,
       row_number() OVER (PARTITION BY node ORDER BY
         md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR), CAST(text_crc32 AS VARCHAR)))) - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM parted JOIN points3 USING (digest, part)
"""


#: The mix in closed form: words of a source are taken in md5 order, whole passes first, then its start; slots by the
#: bits of their number, reversed.
MIXING_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS digest
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::DOUBLE AS weight,
         (3 * source_size)::DOUBLE AS cap, (SELECT sum(size) FROM sized)::DOUBLE AS total FROM sources),
filled AS (
  SELECT *, (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW o AS (ORDER BY cap / weight, source IS NULL, encode(source))),
leveled AS (
  SELECT source, source_size, CASE WHEN cap < level * weight THEN cap ELSE weight * (
    SELECT arg_min(level, cap / weight) FROM filled WHERE NOT cap < level * weight) END AS target FROM filled),
ordered AS (
  SELECT s.*, l.source_size, l.target, floor(l.target)::BIGINT AS words,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY digest, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM sized s JOIN leveled l ON s.source IS NOT DISTINCT FROM l.source),
scheduled AS (
  SELECT *, coalesce(lag(hi) OVER (ORDER BY source IS NULL, encode(source)), 0) AS lo FROM (
    SELECT source, source_size, floor(target)::BIGINT AS words, ceil(source_size / 256)::BIGINT AS blocks,
           CASE WHEN lead(target) OVER o IS NULL THEN 1.0
                ELSE (sum(target) OVER o / (SELECT sum(target) FROM leveled WHERE target > 0)) END::DOUBLE AS hi
    FROM leveled WHERE target > 0 WINDOW o AS (ORDER BY source IS NULL, encode(source)))),
points AS (
  SELECT i AS slot, ('0b' || reverse(lpad(bin(i), 52, '0')))::BIGINT::DOUBLE / 4503599627370496 AS point
  FROM range((SELECT ceil(sum(size) / 256)::BIGINT FROM sized)) AS r(i)),
ranked AS (
  SELECT slot, source, source_size, words, blocks, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
  FROM points JOIN scheduled ON point >= lo AND point < hi),
dealt AS (
  SELECT slot, source, rank % blocks AS block,
         CASE WHEN rank // blocks < words // source_size THEN 256 ELSE least(256, words % source_size - rank % blocks * 256) END AS n
  FROM ranked WHERE rank < words // source_size * blocks + ceil(words % source_size / 256)),
picked AS (
  SELECT source, block, min(slot) FILTER (n = 256) AS whole_slot, min(slot) FILTER (n < 256) AS part_slot,
         coalesce(sum(n) FILTER (n < 256), 0) AS part
  FROM dealt GROUP BY source, block),
reached AS (
  SELECT o.source, o.doc_id, o.size, o.pos,
         min(CASE WHEN greatest(o.pos, p.block * 256) < p.block * 256 + part THEN least(whole_slot, part_slot) ELSE whole_slot END) AS first_slot
  FROM ordered o JOIN picked p ON o.source IS NOT DISTINCT FROM p.source AND o.size > 0
   AND p.block BETWEEN o.pos // 256 AND (o.pos + o.size - 1) // 256
  GROUP BY o.source, o.doc_id, o.size, o.pos)
SELECT o.doc_id, o.size, o.source_size, o.target,
       CASE WHEN o.size = 0 THEN 0 ELSE (words // source_size) * o.size
            + greatest(least(o.pos + o.size, words % source_size) - o.pos, 0) END::BIGINT AS taken,
       first_slot
FROM ordered o LEFT JOIN reached r
  ON o.size > 0 AND r.source IS NOT DISTINCT FROM o.source AND r.doc_id IS NOT DISTINCT FROM o.doc_id AND r.size = o.size AND r.pos = o.pos
"""

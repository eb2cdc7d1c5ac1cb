"""DuckDB texts of the queries of this subpackage that SQL can express."""

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# The control strings of the chat template, as a pattern.
CONTROLS = r"<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"

CHAT = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *,
        length(text) + length(text) - length(replace(text, '\', ''))
            + len(regexp_extract_all(text, '{CONTROLS}')) AS text_chars,
        length(role) + length(role) - length(replace(replace(role, '\', ''), chr(10), ''))
            + len(regexp_extract_all(role, '{CONTROLS}')) AS role_chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(text_chars + role_chars + length('<|im_start|>') + length('<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

MIXING = """
WITH RECURSIVE docs AS (
    SELECT doc_id, source, coalesce(source, '') AS name, text,
        md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM documents
), sources AS (
    SELECT name, count(*) AS n,
        CASE name WHEN 'src0' THEN 4 WHEN 'src1' THEN 3 WHEN 'src2' THEN 2 ELSE 1 END AS share
    FROM docs GROUP BY name
), whole AS (
    SELECT list(name ORDER BY name) AS names, list(share ORDER BY name) AS shares, sum(share)::BIGINT AS period
    FROM sources
), schedule(slot, done, pick) AS (
    SELECT -1::BIGINT, [0::BIGINT for x in shares], NULL::BIGINT FROM whole
    UNION ALL
    SELECT slot + 1, [done[i] + CASE WHEN i = pick THEN 1 ELSE 0 END for i in range(1, len(shares) + 1)], pick
    FROM (
        SELECT slot, done, shares, list_min([
            {'due': ((done[i] + 1) * period + shares[i] - 1) // shares[i], 'i': i}
            for i in range(1, len(shares) + 1) if done[i] * period // shares[i] <= slot + 1
        ]).i AS pick
        FROM schedule, whole WHERE slot + 1 < period
    )
), turns AS (
    SELECT names[pick] AS name, slot AS spot, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS turn
    FROM schedule, whole WHERE slot >= 0
), lasting AS (
    SELECT min((n // 8) * period // share) AS runs_out FROM sources, whole
), numbered AS (
    SELECT doc_id, source, name,
        row_number() OVER (PARTITION BY name ORDER BY key, text) - 1 AS index
    FROM docs
), placed AS (
    SELECT d.*, index // 8 AS block, share, period, runs_out, spot,
        (index // 8) // share * period + spot AS slot
    FROM numbered d JOIN sources USING (name), whole, lasting, turns t
    WHERE t.name = d.name AND t.turn = (index // 8) % share
)
SELECT doc_id, source, block, CAST(index % 8 AS INTEGER) AS place,
    block * period // share AS release, ((block + 1) * period + share - 1) // share AS deadline,
    slot, slot < runs_out AS on_target
FROM placed
"""

CODES = """
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
    SELECT vec_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS p FROM kept, range(4) AS r(part)
), book0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS c
    FROM points WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
)"""
NEAREST = """, near{n} AS MATERIALIZED (
    SELECT vec_id, part, any_value(p) AS p, arg_min(entry, [list_inner_product(c, c) - 2 * list_inner_product(c, p), entry]) AS entry
    FROM points JOIN book{n} USING (part) GROUP BY vec_id, part
)"""
MEANS = """, means{n} AS (
    SELECT part, entry, list(mean ORDER BY i) AS c FROM (
        SELECT part, entry, i, floor(sum(p[i]) / count(*)) AS mean
        FROM near{n}, range(1, (SELECT max(len(p)) + 1 FROM points)) AS r(i) GROUP BY part, entry, i
    ) GROUP BY part, entry
), book{m} AS MATERIALIZED (
    SELECT part, entry, coalesce(means{n}.c, book{n}.c) AS c FROM book{n} LEFT JOIN means{n} USING (part, entry)
)"""
CODES += "".join(NEAREST.format(n=n) + MEANS.format(n=n, m=n + 1) for n in range(4)) + NEAREST.format(n=4) + """, coded AS (
    SELECT vec_id, string_agg(printf('%02x', n.entry), '' ORDER BY part) AS code,
        CAST(sum(list_inner_product(p, p) - 2 * list_inner_product(p, c) + list_inner_product(c, c)) AS BIGINT) AS error
    FROM near4 n JOIN book4 USING (part, entry) GROUP BY vec_id
), digest AS (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256
    FROM book4
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (vec_id), digest
"""

SHARDING = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(value ORDER BY byte) AS entries FROM (
        SELECT byte, list_reduce(range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), byte) AS value
        FROM range(256) AS r(byte)
    )
), keyed AS (
    SELECT doc_id, text, coalesce(CAST(doc_id AS VARCHAR), '') AS key, hex(encode(coalesce(text, ''))) AS digits
    FROM documents
), sized AS (
    SELECT doc_id, text, key, length(digits) // 2 + 1 AS size,
        xor(list_reduce(
            list_transform(regexp_extract_all(digits, '..'), lambda h: CAST('0x' || h AS BIGINT)),
            lambda c, b: xor(c >> 8, entries[CAST(xor(c, b) & 255 AS BIGINT) + 1]), 4294967295::BIGINT
        ), 4294967295) AS text_crc32
    FROM keyed, crc_table
), draws AS (
    SELECT key, path, -ln((CAST('0x' || substr(md5(key || '/' || path), 1, 13) AS BIGINT) + 0.5) / 4503599627370496::DOUBLE) AS time
    FROM (SELECT DISTINCT key FROM keyed), (
        SELECT 'r.' || r AS path FROM range(5) AS x(r) UNION ALL
        SELECT 'r.' || r || '.' || k FROM range(5) AS x(r), range(2) AS y(k) WHERE r < 4 OR k = 0 UNION ALL
        SELECT 'r.' || r || '.' || k || '.' || s FROM range(5) AS x(r), range(2) AS y(k), range(2) AS z(s) WHERE r < 4 OR k + s = 0
    )
), regions AS (
    SELECT key, arg_min(path, [time / 4, path[3]::INT]) FILTER (path <> 'r.4') AS region,
        arg_min(path, [time / CASE path WHEN 'r.4' THEN 1 ELSE 4 END, path[3]::INT]) AS grown_region
    FROM draws WHERE length(path) = 3 GROUP BY key
), racks AS (
    SELECT d.key, arg_min(d.path, [time, d.path[5]::INT]) AS rack, any_value(grown_region) AS grown_region
    FROM draws d JOIN regions r ON d.key = r.key AND d.path[1:3] = r.region AND length(d.path) = 5 GROUP BY d.key
), shards AS (
    SELECT d.key, arg_min(d.path, [time, d.path[7]::INT]) AS path, any_value(grown_region) AS grown_region
    FROM draws d JOIN racks r ON d.key = r.key AND d.path[1:5] = r.rack AND length(d.path) = 7 GROUP BY d.key
), placed AS (
    SELECT key, 4 * path[3]::INT + 2 * path[5]::INT + path[7]::INT AS shard, grown_region FROM shards
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
    CASE grown_region WHEN 'r.4' THEN 16 ELSE shard END AS grown_shard
FROM sized JOIN placed USING (key)
"""

FILTERS = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), firsts AS (
    SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text
), failing AS (
    SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e
    FROM docs JOIN firsts USING (text)
), said AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id
), sets AS (
    SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
            CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
        count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failing LEFT JOIN said USING (doc_id) GROUP BY ALL
), orders(filter_order) AS (
    SELECT '' UNION ALL
    SELECT filter_order || letter FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter)
    WHERE NOT contains(filter_order, letter)
), steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier
    FROM orders, range(1, 6) AS r(step) WHERE length(filter_order) = 5
), taken AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS hit,
        earlier <> '' AND regexp_matches(fails, '[' || CASE earlier WHEN '' THEN '-' ELSE earlier END || ']') AS gone
    FROM sets, steps
), counted AS (
    SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM taken GROUP BY ALL
)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM counted
"""

TEXTS: dict[str, str] = {
    "op4_topk": TOP_K,
    "op5_chat": CHAT,
    "op7_mixing": MIXING,
    "op11_codes": CODES,
    "op12_sharding": SHARDING,
    "op13_filters": FILTERS,
}

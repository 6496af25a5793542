"""DuckDB SQL of the queries that SQL can express, written from their definitions, not from the operators."""

from marquee.llm.mixing import MixParams, constants

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

OP4 = f"""
WITH l AS (
  SELECT doc_id, pos, lines[pos] AS line,
         {_LOWER.format("trim(lines[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
gone AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, gone.key IS NOT NULL AS dropped FROM l LEFT JOIN gone ON l.key = gone.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first_id,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(sha, (1 + 10 * (i // 8))::INTEGER, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31))::INTEGER, 1)), '')
           AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""

OP6 = f"""
WITH r AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw_host, coalesce(rest, '') AS rest FROM r),
h AS (
  SELECT page_id, {_LOWER.format("raw_host")} AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM u),
rules(rule, r_host, r_path, r_verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(r_verdict, length(rule)) AS verdict
  FROM h JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY page_id),
outcome AS (
  SELECT doc_id AS page_id, count(*) AS n,
         sum(CASE WHEN coalesce(quality = 0, false) OR coalesce(toxic = 1, false) THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
names AS (
  SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM h),
parts AS (
  SELECT *, string_split(name, '.') AS l, regexp_matches(name, '^[0-9.]+$|^\\[') AS address FROM names),
cut AS (
  SELECT *, array_to_string(l[-1:], '.') AS one, array_to_string(l[-2:], '.') AS two, array_to_string(l[-3:], '.') AS three FROM parts),
ends AS (
  SELECT *, regexp_full_match(two, '(ac|co|com|edu|gov|net|org)\\.[a-z][a-z]') AS deep FROM cut),
levels AS (
  SELECT page_id, host,
    CASE WHEN address THEN name WHEN deep THEN three ELSE two END AS domain,
    CASE WHEN address THEN name WHEN deep THEN two ELSE one END AS suffix
  FROM ends),
hosts AS (
  SELECT host, domain, suffix, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad
  FROM levels LEFT JOIN outcome USING (page_id) GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
groups AS (
  SELECT 'h' AS level, n, bad FROM hosts WHERE n > 0 UNION ALL SELECT 'd', n, bad FROM domains WHERE n > 0
  UNION ALL SELECT 's', n, bad FROM suffixes WHERE n > 0),
moments AS (
  SELECT level, sum(bad) / sum(n) AS m, sum(bad * bad / n) - sum(bad) * sum(bad) / sum(n) AS spread,
         count(*) - 1.0::DOUBLE AS g1, sum(n) - sum(n * n) / sum(n) - (count(*) - 1.0::DOUBLE) AS scale
  FROM groups GROUP BY level),
rho AS (SELECT level, CASE WHEN m > 0 AND m < 1 AND scale > 0 THEN (spread / (m * (1 - m)) - g1) / scale ELSE 0 END AS rho FROM moments),
strength AS (SELECT level, least(1000.0, greatest(1.0, CASE WHEN rho <= 0 THEN 1000.0 ELSE 1 / rho - 1 END)) AS s FROM rho),
k AS (SELECT coalesce((SELECT s FROM strength WHERE level = 'h'), 1000.0) AS sh, coalesce((SELECT s FROM strength WHERE level = 'd'), 1000.0) AS sd,
             coalesce((SELECT s FROM strength WHERE level = 's'), 1000.0) AS ss,
             (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM hosts) AS root),
sr AS (SELECT suffix, (ss * root + bad) / (ss + n) AS rate FROM suffixes, k),
dr AS (SELECT d.domain, d.suffix, (sd * sr.rate + d.bad) / (sd + d.n) AS rate FROM domains d JOIN sr USING (suffix), k),
ab AS (SELECT host, sh * dr.rate + bad AS a, sh * (1 - dr.rate) + n - bad AS b FROM hosts JOIN dr USING (domain, suffix), k),
rep AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower FROM ab)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN lower > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM h JOIN rep USING (host) LEFT JOIN fit USING (page_id)
"""

OP7 = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)),
one AS (
  SELECT conv_id, pos, coalesce(role, 'unknown') || chr(1) || coalesce(text, '') || chr(2) AS content,
         '<|im_start|>' || replace(replace(coalesce(role, 'unknown'), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
         || chr(10) || replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
         || '<|im_end|>' || chr(10) AS piece
  FROM t),
upto AS (
  SELECT conv_id, pos, string_agg(content, '') OVER w AS prefix, string_agg(piece, '') OVER w AS rendered,
         max(pos) OVER (PARTITION BY conv_id) AS n_turns
  FROM one WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
inner_prefixes AS (SELECT DISTINCT prefix FROM upto WHERE pos < n_turns)
SELECT min(conv_id) AS conv_id, n_turns::BIGINT AS n_turns, count(*) AS n_copies, any_value(rendered) AS rendered
FROM upto WHERE pos = n_turns AND prefix NOT IN (SELECT prefix FROM inner_prefixes) GROUP BY prefix, n_turns
"""

_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

OP9 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS s FROM b)),
dw AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM d, (SELECT DISTINCT size FROM b) WHERE len(w) >= size)),
hit AS (SELECT doc_id, item_id, s, dw.size FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _mix_hash(v: str, a: int, b: int) -> str:
    p = 2147483647
    x = f"((((({v}) % {p}) + {p}) % {p}) * {a} + {b}) % {p}"
    return f"((((({x}) * 40503) >> 7) % {p}) * {b} + {a}) % {p}"


def _mixing_sql() -> str:
    """The mix in whole: targets, draws, permutations and taken words.

    Bucketed running sums are one plain running sum here; the permutation's
    rounds are chained CTEs. The hash's constants are parameters of the mix.
    """
    p = MixParams()
    rounds, last = [], "p0"
    for r in range(p.rounds):
        ka, kb = constants(p.seed, 2 * r)
        ba, bb = constants(p.seed, 2 * r + 1)
        rounds.append(f"""q{r} AS (SELECT *, ((({_mix_hash('key', ka, kb)}) % n_blocks - x) % n_blocks + n_blocks) % n_blocks AS y FROM {last}),
p{r + 1} AS (SELECT * EXCLUDE (x, y), CASE WHEN ((((greatest(x, y) % 2147483647) * {ba} + {_mix_hash('key', ba, bb)}) % 2147483647) >> 10) & 1 = 1
  THEN y ELSE x END AS x FROM q{r})""")
        last = f"p{r + 1}"
    n, m, k = p.block_words, p.shard_slots, p.max_epochs
    return f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, {k} * source_size AS cap
  FROM (SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source)),
weighed AS (SELECT *, {list(p.weights)}[(rank % {len(p.weights)} + 1)::INTEGER]::BIGINT AS weight FROM ranked),
filled AS (
  SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       * weight AS is_full
  FROM weighed),
targets AS (
  SELECT source, rank, docs, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
    ((sum(source_size) OVER () - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) * weight)::DOUBLE
    / (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target FROM filled),
wants AS (
  SELECT rank, (source_size + {n - 1}) // {n} AS n_blocks, target * ((source_size + {n - 1}) // {n}) / source_size AS want
  FROM targets WHERE source_size > 0),
quotas AS (SELECT *, ceil(round(sum(want) OVER (), 3))::BIGINT AS slots FROM wants),
grid0 AS (SELECT *, unnest(range(0, (slots - 1) // {m} + 1)) AS shard FROM quotas),
grid1 AS (SELECT *, least({m}, slots - shard * {m}) AS in_shard FROM grid0),
grid2 AS (SELECT *, want * in_shard / slots AS expect FROM grid1),
grid3 AS (SELECT *, floor(expect + 1e-9::DOUBLE)::BIGINT AS sure FROM grid2),
grid4 AS (SELECT *, greatest(0, floor((expect - sure) * 1048576))::BIGINT AS ticks FROM grid3),
grid AS (
  SELECT *, (in_shard - sum(sure) OVER (PARTITION BY shard))::BIGINT AS rest, (sum(ticks) OVER (PARTITION BY shard))::BIGINT AS all_ticks,
         coalesce(sum(ticks) OVER (PARTITION BY shard ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS low
  FROM grid4),
spare0 AS (
  SELECT shard, all_ticks, unnest(range(0, rest)) AS draw
  FROM (SELECT DISTINCT shard, rest, all_ticks FROM grid WHERE all_ticks > 0 AND rest > 0)),
spare AS (SELECT shard, ({_mix_hash('shard * 4099 + draw', *constants(p.seed, 901))}) % all_ticks AS u FROM spare0),
drawn AS (
  SELECT g.shard, g.rank, count(*) AS extra FROM spare s JOIN grid g ON g.shard = s.shard AND u >= low AND u < low + ticks
  GROUP BY g.shard, g.rank),
counts AS (
  SELECT g.rank, n_blocks, g.shard, sure + coalesce(extra, 0) AS n FROM grid g LEFT JOIN drawn d ON d.shard = g.shard AND d.rank = g.rank),
firsts AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY rank ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS f FROM counts),
slots AS (SELECT rank, n_blocks, unnest(range(f, f + n)) AS j FROM firsts WHERE n > 0),
p0 AS (SELECT rank, n_blocks, rank * 1009 + (j // n_blocks) * 31 AS key, j % n_blocks AS x FROM slots WHERE j < n_blocks * {k}),
{", ".join(rounds)},
reads AS (SELECT rank, x AS block, count(*) AS times FROM {last} GROUP BY rank, x),
dealt AS (
  SELECT doc_id, rank, size, ({_mix_hash('coalesce(doc_id, 0)', *constants(p.seed, 900))}) % greatest(1, (docs + {p.bucket_rows - 1}) // {p.bucket_rows}) AS bucket
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE size > 0),
placed AS (
  SELECT *, (sum(size) OVER (PARTITION BY rank ORDER BY bucket, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start FROM dealt),
pieces AS (SELECT *, unnest(range(start // {n}, (start + size - 1) // {n} + 1)) AS block FROM placed),
taken AS (
  SELECT p.rank, start, doc_id, size, sum((least(start + size, (p.block + 1) * {n}) - greatest(start, p.block * {n})) * coalesce(times, 0))::BIGINT AS taken
  FROM pieces p LEFT JOIN reads r ON r.rank = p.rank AND r.block = p.block GROUP BY p.rank, start, doc_id, size)
SELECT doc_id, size, source_size, target, taken FROM taken JOIN targets USING (rank)
UNION ALL
SELECT doc_id, size, source_size, target, 0 FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE size = 0
"""


OP3 = _mixing_sql()

OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \\x09]+') AS words FROM pieces),
total AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, array_to_string(words[pos:pos + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(words) >= size)),
f AS (SELECT lang, phrase, size, count(*)::BIGINT AS a FROM g GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE size >= 2 AND a >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, p1.a AS l, p2.a AS r, (2000000::HUGEINT * c.a) // (p1.a::HUGEINT + p2.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f p1 ON p1.lang = c.lang AND p1.phrase = array_to_string(c.words[1:k], ' ')
  JOIN f p2 ON p2.lang = c.lang AND p2.phrase = array_to_string(c.words[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, a, array_to_string(words[pos:pos + part - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - part + 2)) AS pos FROM (SELECT *, unnest(range(2, size)) AS part FROM c))),
longer AS (SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer ON longer.lang = b.lang AND longer.phrase = b.phrase
  WHERE coalesce(100::HUGEINT * longer.a < 80::HUGEINT * b.a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

# crc32 by its definition: reflected polynomial 0xEDB88320, one byte and one bit at a time
_BITS = "list_reduce(list_concat([{0}], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
_CRC = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen({0}) + 1), "
        "lambda j: ascii(substr({0}, j, 1))::BIGINT)), lambda c, b: " + _BITS.format("xor(c, b)") + "), 4294967295)")

OP12 = f"""
WITH turns AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, own, {_CRC.format("conv_id::VARCHAR")} % 4 AS h FROM turns),
c AS (SELECT h.conv_id, list_concat(coalesce(base.own, [])[1:h], h.own[h + 1:]) AS seq
      FROM h LEFT JOIN turns base ON base.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, d AS depth, seq[1:d] AS node, d = len(seq) AS ends FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM c)),
n AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
             CASE WHEN depth = 0 THEN 0 ELSE
               (count(*) - 1) * len(regexp_extract_all(node[depth][2], '[^\\x20\\x09-\\x0D]+')) END AS saved
      FROM m GROUP BY depth, node),
k AS (SELECT p.depth, p.node, count(*) AS n_children FROM n p JOIN n x ON x.depth = p.depth + 1 AND x.node[1:p.depth] = p.node GROUP BY ALL),
a AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, node)),
below AS (
  SELECT depth, node[1:depth] AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT node, n_children, saved, unnest(range(0, depth + 1)) AS depth FROM a) GROUP BY ALL)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, b.n_leaves, b.saved_tokens, a.ends_sha256
FROM a JOIN below b ON b.depth = a.depth AND b.node = a.node
LEFT JOIN n p ON p.depth = a.depth - 1 AND p.node = a.node[1:p.depth]
"""

ORACLES = {"op1_kdtree_topk": OP1, "op3_mixing": OP3, "op4_line_dedup": OP4, "op5_warc": OP5, "op6_url_filter": OP6,
           "op7_chat_format": OP7, "op9_decontamination": OP9,
           "op11_phrases": OP11, "op12_prefix_trie": OP12}

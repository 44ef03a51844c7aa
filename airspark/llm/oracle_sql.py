"""DuckDB SQL for the operators that SQL can express, written from their definitions by brute force."""


def crc32(byte_list: str) -> str:
    """SQL for the CRC-32 of a list of byte values; the table is made by its rule."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        table.append(c)
    step = f"xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({byte_list}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


# Pairs are counted through every shared shingle; components by following links from each document.
JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2),
                                      lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM w
), sets AS MATERIALIZED (
  SELECT min(doc_id) AS d, list_sort(shingles) AS shingles, len(shingles) AS n FROM s
  WHERE len(shingles) > 0 GROUP BY ALL
), e AS MATERIALIZED (SELECT d, n, unnest(shingles) AS x FROM sets
), links AS MATERIALIZED (
  SELECT a.d AS a, b.d AS b FROM e a JOIN e b ON a.x = b.x AND a.d <> b.d AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.d, b.d, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT d AS a, d AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), label AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles,
       CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE l.component_id END AS component_id
FROM s LEFT JOIN sets t ON list_sort(s.shingles) = t.shingles LEFT JOIN label l ON l.a = t.d
"""

TOPK = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, c.row AS other, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.row <> q.row AND len(q.e) = len(c.e)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id, other)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Every combination of frequent tokens is tried, as a bit mask over a page's tokens.
URLS = r"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r AS (
  SELECT p.*, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
      WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule,
    list_sort(list_distinct(list_concat(
      list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'host=' || x),
      list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path=' || regexp_replace(
        translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '#', 'g'))))) AS tokens
  FROM p
), ruled AS (
  SELECT r.*, CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block'
                   WHEN rule IS NOT NULL THEN 'allow' END AS own
  FROM r
), sets AS (SELECT tokens, own, count(*) AS n FROM ruled GROUP BY ALL
), need AS (SELECT ceil(0.01 * sum(n)) AS least FROM sets WHERE own IS NOT NULL
), frequent AS (
  SELECT t FROM (SELECT unnest(tokens) AS t, n FROM sets WHERE own IS NOT NULL)
  GROUP BY t HAVING sum(n) >= (SELECT least FROM need)
), slim AS (
  SELECT list_sort(list_intersect(tokens, coalesce((SELECT list(t) FROM frequent), []))) AS s, tokens, own, n FROM sets
), masks AS (
  SELECT s, tokens, own, n, unnest(range(1, (2 ** len(s))::BIGINT)) AS m FROM slim
), combos AS (
  SELECT list_filter(s, lambda x, i: (m >> (i - 1)) & 1 = 1) AS combo, tokens, own, n FROM masks
), mined AS (
  SELECT combo FROM combos WHERE own IS NOT NULL GROUP BY combo
  HAVING sum(CASE WHEN own = 'block' THEN n ELSE 0 END) >= (SELECT least FROM need)
     AND sum(CASE WHEN own = 'block' THEN n ELSE 0 END) >= 0.9 * sum(n)
), hits AS (SELECT DISTINCT tokens FROM combos WHERE own IS NULL AND combo IN (SELECT combo FROM mined))
SELECT page_id, host, path, rule,
       coalesce(own, CASE WHEN tokens IN (SELECT tokens FROM hits) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

# The cheapest edits by dynamic programming over the rows of all conversations at once: for each state the
# cost (9 digits) and audit as one string, so that the least string is the least (cost, audit).
_AFTER = {"S": "U", "P": "U", "U": "A", "A": "U"}


def _step() -> str:
    """The four states after one more row, then after insertions (one or two: a third never pays)."""
    add = lambda key, cost, edit: f"(printf('%09d', ({key})[1:9]::BIGINT + {cost}) || ({key})[10:] || '{edit}')"
    into = {q: [add(f"k{q}", "3", "D")] for q in "SPUA"}
    for p, after in _AFTER.items():
        free = f"CASE WHEN NOT gone THEN {add(f'k{p}', '2 + late', 'R')} END"
        into[after].append(free)
    for p, role, q in (("S", "s", "P"), ("S", "u", "U"), ("P", "u", "U"), ("U", "a", "A"), ("A", "u", "U")):
        into[q].append(f"CASE WHEN NOT gone AND initial = '{role}' THEN {add(f'k{p}', 'late', 'K')} END")
    least = {q: f"least({', '.join(x)})" if len(x) > 1 else x[0] for q, x in into.items()}
    return ", ".join(f"{least[q]} AS r{q}" for q in "SPUA")


def _inserted(k: str) -> str:
    add = lambda key, edits: f"(printf('%09d', ({key})[1:9]::BIGINT + {2 * len(edits)}) || ({key})[10:] || '{edits}')"
    s, p, u, a = (f"{k}{q}" for q in "SPUA")
    return (f"{s} AS kS, {p} AS kP, least({u}, {add(s, 'I')}, {add(p, 'I')}, {add(a, 'I')}) AS kU, "
            f"least({a}, {add(u, 'I')}, {add(s, 'II')}, {add(p, 'II')}) AS kA")


CONVERSATIONS = rf"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM said, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS pos,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS final
  FROM damaged
), judged AS (
  SELECT conv_id, pos, turn, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS previous,
    final = '' AS blank,
    final <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate, final
  FROM placed
), rows_ AS MATERIALIZED (
  SELECT *, blank OR duplicate AS gone, CASE WHEN NOT blank AND NOT duplicate AND final NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS late
  FROM judged
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, sum(late)::BIGINT AS truncated,
    count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0::BIGINT AS pos, '000000000' AS kS, NULL::VARCHAR AS kP, '000000002I' AS kU, '000000004II' AS kA
  FROM (SELECT DISTINCT conv_id FROM rows_)
  UNION ALL
  SELECT conv_id, pos, {_inserted("r")} FROM (
    SELECT w.conv_id, r.pos, {_step()}
    FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1)
), done AS (
  SELECT conv_id, arg_max(least(kS, kA), pos) AS key FROM walk GROUP BY conv_id
), solved AS (SELECT conv_id, key[1:9]::BIGINT AS cost, key[10:] AS audit FROM done
), edits AS (
  SELECT conv_id, i, audit[i] AS edit, len(replace(audit[1:i], 'I', '')) AS pos, len(replace(audit[1:i], 'D', '')) AS place
  FROM solved, range(1, len(audit) + 1) AS t(i)
), led AS (
  SELECT e.*, r.role, r.text, r.initial FROM edits e
  LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.pos AND e.edit <> 'I' WHERE e.edit <> 'D'
), told AS (
  SELECT *, max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS headed FROM led
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS whole
  FROM told GROUP BY conv_id
)
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
  coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, coalesce(s.cost, 0) AS cost, coalesce(s.audit, '') AS audit,
  sha256(coalesce(t.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""

NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.row, a.vec_id AS anchor_id, c.row AS other, c.vec_id, a.label = c.label AS same,
    list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.row <> c.row AND len(a.e) = len(c.e)
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id, other) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.row, p.other ORDER BY n.score DESC, n.vec_id, n.other)::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.row = p.row AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def _tree(tree: dict, name: str) -> str:
    """The shard of ``key`` by the tree's draws, as nested CASEs."""
    from .shard_tree import DIGITS, weight

    def below(node, path: str) -> str:
        if not isinstance(node, dict):
            return path.rsplit("/", 1)[1]
        draws = {f"{path}/{c}": f"-ln((('0x' || left(md5('{path}/{c}|' || key), {DIGITS}))::BIGINT + 0.5::DOUBLE) / {float(16 ** DIGITS)}::DOUBLE) / {weight(x)}::DOUBLE"
                 for c, x in node.items()}
        if len(draws) == 1:
            return below(next(iter(node.values())), next(iter(draws)))
        least = f"least({', '.join(draws.values())})"
        whens = " ".join(f"WHEN {d} THEN {below(x, p)}" for (p, d), x in zip(draws.items(), node.values()))
        return f"CASE {least} {whens} END"
    return f"({below(tree, '')})::INTEGER AS {name}"


def sharding() -> str:
    from .shard_tree import tree_of
    raw = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"""
WITH d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, coalesce(doc_id::VARCHAR, '') AS key, {crc32(raw)} AS text_crc32
  FROM documents
), s AS (SELECT *, {_tree(tree_of(24), "shard")}, {_tree(tree_of(25), "grown_shard")} FROM d)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM s
"""

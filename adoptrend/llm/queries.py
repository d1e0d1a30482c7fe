"""The registered queries of this package and, where SQL can express them, their SQL.

A query applies its operator to the whole of its table and derives the columns it is compared by.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from adoptrend.llm import (
    chat_format, exact_dedup, mixing, packing, pii, prefix_trie, quality, reversed_search, simhash, token_counts, topk, toxicity, url_filter,
)
from adoptrend.llm.base import table
from adoptrend.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = lambda spark, folder: build(tune(spark), folder)
    return build


@query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.takes(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL["op1_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, source, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS size,
    CASE WHEN length(text) > 0 THEN 0.05::DOUBLE + 0.95::DOUBLE
      * (length(text) - length(regexp_replace(text, '[\p{Ll} ]+', '', 'g'))) / length(text) ELSE 0.05::DOUBLE END AS quality,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM w GROUP BY source
), r AS (
  SELECT *, 2 * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
    sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - 2 * source_size AS given,
    sum(weight) OVER (ORDER BY 2 * source_size / weight DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS open
  FROM s
), l AS (
  SELECT max((budget - given) / open) FILTER ((budget - given) / open <= most / weight) AS level FROM r
), t AS (
  SELECT source, source_size, least(most::DOUBLE, weight * level) AS target FROM r, l
), p AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY w.source ORDER BY -ln(u) / quality, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)
      - size / 2.0::DOUBLE AS middle
  FROM w JOIN t ON w.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + (middle <= target - epochs * source_size)::BIGINT))::BIGINT AS taken
FROM p
"""


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


@query
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, folder, "documents"))


SQL["op3_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


@query
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_of(kind, "base").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed("base"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


@query
def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.self_search(table(spark, folder, "embeddings"), every=50)


SQL["op7_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), e AS (
  SELECT vec_id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM e q JOIN e c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"))


# a pass that makes wildcards
WILDCARDS = """x{i} AS (
  SELECT *, unnest(now) AS seg, generate_subscripts(now, 1) AS i FROM a{i}
), o{i} AS (
  SELECT host, above, count(*) AS branches, sum(n) AS pages
  FROM (SELECT host, now[1 : i - 1] AS above, seg, sum(n) AS n FROM x{i} GROUP BY ALL) GROUP BY ALL
  HAVING count(*) >= 8 AND count(*) > 0.5::DOUBLE * sum(n)
), t{i} AS (
  SELECT x.host, x.segs, list(CASE WHEN o.host IS NULL THEN x.seg ELSE '*' END ORDER BY x.i) AS new
  FROM x{i} x LEFT JOIN o{i} o ON x.host = o.host AND x.now[1 : x.i - 1] = o.above GROUP BY ALL
), a{next} AS (
  SELECT a.* EXCLUDE (now), coalesce(t.new, a.now) AS now FROM a{i} a LEFT JOIN t{i} t ON a.host = t.host AND a.segs = t.segs
), """

SQL["op8_url_filter"] = r"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), r AS (
  SELECT *, CASE
      WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule,
    list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s:
      CASE WHEN regexp_matches(s, '^[0-9a-fA-F-]{8,}$') AND regexp_matches(s, '[0-9]') THEN '#'
        ELSE regexp_replace(s, '[0-9]+', '0', 'g') END) AS segs
  FROM p
), f AS (
  SELECT host, segs, count(*) AS n, count(rule) AS labelled,
    count(*) FILTER (rule IN ('net/', 'example.com/de/')) AS bad
  FROM r GROUP BY host, segs
), a0 AS (
  SELECT *, segs AS now FROM f
), {passes}w AS (
  SELECT * FROM a3
), x AS (
  SELECT host, segs, now, n, labelled, bad, unnest(now) AS seg, generate_subscripts(now, 1) AS i FROM w
), b AS (
  SELECT host, now[1 : i - 1] AS above, seg, sum(labelled) AS labelled, sum(bad) AS bad
  FROM x GROUP BY ALL HAVING sum(labelled) > 0
), o AS (
  SELECT host, above, sum(bad) / sum(labelled) AS share FROM b GROUP BY ALL HAVING count(*) > 1
), m AS (
  SELECT b.host, b.above, b.seg FROM b JOIN o ON b.host = o.host AND b.above = o.above
  WHERE abs(bad - labelled * share) <= 2.0::DOUBLE * sqrt(labelled * share * (1 - share))
), t AS (
  SELECT x.host, x.segs, list(CASE WHEN m.seg IS NULL THEN x.seg ELSE '+' END ORDER BY x.i) AS template
  FROM x LEFT JOIN m ON x.host = m.host AND x.now[1 : x.i - 1] = m.above AND x.seg = m.seg GROUP BY ALL
), v AS (
  SELECT w.*, coalesce(t.template, w.now) AS template FROM w LEFT JOIN t ON w.host = t.host AND w.segs = t.segs
), g AS (
  SELECT host, template, sum(labelled)::DOUBLE AS labelled, sum(bad)::DOUBLE AS bad, string_split(host, '.') AS names FROM v GROUP BY host, template
), c AS (
  SELECT host, template, labelled, bad, len(names) AS d, unnest(nodes) AS node, generate_subscripts(nodes, 1) AS i FROM (
    SELECT *, list_transform(range(len(names)), lambda k: array_to_string(names[len(names) - k :], '.'))
      || list_transform(range(1, len(template)), lambda k: host || '/' || array_to_string(template[1 : k], '/')) AS nodes FROM g)
), k AS (
  SELECT node, sum(share) AS s, count(*)::DOUBLE AS n
  FROM (SELECT node, sum(bad) / sum(labelled) AS share FROM c WHERE labelled > 0 GROUP BY node, coalesce(template[greatest(i - d, 0) + 1], '')) GROUP BY node
), z AS (
  SELECT host, template, list_reduce([{'p': 0.1::DOUBLE, 's': 0::DOUBLE, 'n': 0::DOUBLE}] || list({'p': 0::DOUBLE, 's': k.s, 'n': k.n} ORDER BY i),
    lambda a, b: {'p': (b.s + 2 * a.p) / (b.n + 2), 's': 0::DOUBLE, 'n': 0::DOUBLE}).p AS p
  FROM (SELECT host, template, i, node, k.n AS votes, lead(k.n) OVER (PARTITION BY host, template ORDER BY i) AS next FROM c JOIN k USING (node))
  JOIN k USING (node) WHERE votes IS DISTINCT FROM next GROUP BY host, template
), u AS (
  SELECT v.host, v.segs, (g.bad + 2 * coalesce(z.p, 0.1::DOUBLE)) / (g.labelled + 2) AS purity
  FROM v JOIN g ON v.host = g.host AND v.template = g.template LEFT JOIN z ON v.host = z.host AND v.template = z.template
)
SELECT r.page_id, r.host, r.path, r.rule, CASE
    WHEN r.rule IN ('net/', 'example.com/de/') THEN 'block' WHEN r.rule IS NOT NULL THEN 'allow'
    WHEN u.purity > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM r JOIN u ON r.host = u.host AND r.segs = u.segs
""".replace("{passes}", "".join(WILDCARDS.format(i=i, next=i + 1) for i in range(url_filter.PASSES)))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_reversed_search(spark: SparkSession, folder: str) -> DataFrame:
    return reversed_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op11_reversed_search"] = r"""
WITH i AS (
  SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id
), q AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({terms}) AS term FROM i) GROUP BY ALL
), d AS (
  SELECT row_number() OVER () AS nr, doc_id, {terms} AS terms FROM documents
), c AS (
  SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0
), p AS (
  SELECT nr, doc_id, n, term, count(*) AS tf
  FROM (SELECT nr, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM p, c GROUP BY term, docs
), s AS (
  SELECT item_id, nr, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY ALL HAVING score > 0
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM s QUALIFY rank <= 20
""".replace(
    "{terms}",
    r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')""",
)


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    listed = prefix_trie.rebuilt(prefix_trie.sequences(table(spark, folder, "conversations")))
    return prefix_trie.ends_digest(*prefix_trie.prefix_trie(listed))


SQL["op12_prefix_trie"] = r"""
WITH bytes AS (
  SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS entry
  FROM range(256) b(i)
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM l, (SELECT list(entry ORDER BY i) AS entries FROM bytes)
), r AS (
  SELECT h.conv_id, CASE WHEN l.turns IS NULL THEN h.turns[h + 1 :] ELSE l.turns[1 : h] || h.turns[h + 1 :] END AS turns
  FROM h LEFT JOIN l ON l.conv_id = h.conv_id - h.conv_id % 20
), m AS (
  SELECT conv_id, turns, d, turns[1 : d] AS path FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM r)
), n AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = d), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM m GROUP BY d, path
), k AS (
  SELECT d - 1 AS d, path[1 : d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), v AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.d = k.d AND n.path = k.path
), u AS (
  SELECT a AS d, path[1 : a] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT path, saved, n_children, unnest(range(d + 1)) AS a FROM v) GROUP BY ALL
)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN u ON v.d = u.d AND v.path = u.path LEFT JOIN n p ON p.d = v.d - 1 AND p.path = v.path[1 : v.d - 1]
"""


@query
def op13_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.chat_format(turns.unionByName(more)))


SQL["op13_chat_format"] = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length({text}) AS broken, length({role}) AS named FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(broken + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 5 ELSE 17 + named END))::BIGINT
    AS formatted_chars
FROM e GROUP BY conv_id
"""
for _column in ("text", "role"):
    _broken = f"replace({_column}, '\\', '\\\\')"
    for _control in chat_format.CONTROLS:
        _broken = f"replace({_broken}, '{_control}', '{_control[0]}\\{_control[1:]}')"
    SQL["op13_chat_format"] = SQL["op13_chat_format"].replace("{" + _column + "}", _broken)

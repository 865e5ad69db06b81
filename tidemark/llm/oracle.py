"""SQL for DuckDB with the rows of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.quality import BASE_FAILED, RULES, QualityRules

ORACLE: dict[str, str] = {}

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE["op2_near_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)
), both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (
  SELECT x AS node, x AS seen FROM both_ways
  UNION
  SELECT node, y FROM reach JOIN both_ways ON x = seen
), m AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  coalesce(m.least, d.doc_id) AS component_id, coalesce(m.least, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.node = d.doc_id
"""


def _quality() -> str:
    q = QualityRules()
    names = ("bad", "none", "good")
    start = ", ".join(
        f"{x} AS {kind}_{r}_{vote}"
        for r in RULES
        for kind, rates in (("g", q.good), ("j", q.junk))
        for vote, x in zip(names, rates)
    )
    score = "ln(prior / (1 - prior))" + "".join(
        f" + CASE {r} WHEN 1 THEN ln(g_{r}_good / j_{r}_good) WHEN 0 THEN ln(g_{r}_bad / j_{r}_bad)"
        f" ELSE ln(g_{r}_none / j_{r}_none) END"
        for r in RULES
    )
    good = f"(1 / (1 + exp(-({score}))))"
    rounds = []
    for k in range(q.rounds):
        sums = ", ".join(
            f"sum(CASE {r} WHEN {vote} THEN {of} ELSE 0 END) AS s{kind}_{r}_{vote}"
            for r in RULES
            for kind, of in (("g", "good"), ("j", "n - good"))
            for vote in (0, 1)
        )
        rates = ", ".join(
            f"(s{kind}_{r}_0 + {first[0]}) / ({whole} + 1) AS {kind}_{r}_bad,"
            f" (greatest({whole} - s{kind}_{r}_0 - s{kind}_{r}_1, 0) + {first[1]}) / ({whole} + 1) AS {kind}_{r}_none,"
            f" (s{kind}_{r}_1 + {first[2]}) / ({whole} + 1) AS {kind}_{r}_good"
            for r in RULES
            for kind, whole, first in (("g", "good", q.good), ("j", "(n - good)", q.junk))
        )
        rounds.append(
            f"e{k} AS (SELECT sum(n) AS n, sum(good) AS good, {sums} FROM"
            f" (SELECT patterns.*, n * {good} AS good FROM patterns, p{k})),\n"
            f"p{k + 1} AS MATERIALIZED (SELECT (good + {q.prior}) / (n + 1) AS prior, {rates} FROM e{k})"
        )
    votes = ", ".join(f"{rule} AS {name}" for name, rule in RULES.items())
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, {_WORDS.format(text="coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), g AS (
  SELECT id, p, count(*) OVER (PARTITION BY id, g) AS n FROM (
    SELECT id, unnest(range(1, len(w) - 1)) AS p,
      unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g
    FROM w WHERE len(w) >= 3)
), r AS (
  SELECT id, count(DISTINCT p + k) AS n FROM g, range(3) AS t(k) WHERE g.n > 1 GROUP BY id
), m AS MATERIALIZED (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines,
    length(regexp_replace(t, '[^\\p{{L}}]+', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper,
    len(list_filter(w, lambda x: NOT regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))) AS n_bare_words,
    len(list_filter(w, lambda x: right(x, 1) IN ('.', '!', '?'))) AS n_ends
  FROM w LEFT JOIN r USING (id)
), v AS MATERIALIZED (SELECT *, {votes} FROM m),
patterns AS MATERIALIZED (SELECT {", ".join(RULES)}, count(*)::DOUBLE AS n FROM v WHERE NOT ({BASE_FAILED}) GROUP BY ALL),
p0 AS (SELECT {q.prior} AS prior, {start}),
{",\n".join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {good} >= {q.threshold} AS kept
FROM (SELECT *, {BASE_FAILED} AS base_failed FROM v), p{q.rounds}
"""


ORACLE["op1_quality_rules"] = _quality()

ORACLE["op5_mixing"] = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS.format(text="coalesce(text, '')")})::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source
), r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM s
), w AS (SELECT *, 3 * size AS lim, 1 + (n - 1) % 3 AS weight, sum(size) OVER () AS total FROM r
), c AS (
  SELECT *, coalesce(sum(lim) OVER (ORDER BY lim / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY lim / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM w
), f AS (
  SELECT *, bool_and(lim * rest <= (total - used) * weight) OVER (ORDER BY lim / weight, n) AS full_up FROM c
), t AS (
  SELECT source, size, n, CASE WHEN full_up THEN lim::DOUBLE ELSE
    ((total - sum(lim) FILTER (full_up) OVER ()) * weight)::DOUBLE / sum(weight) FILTER (NOT full_up) OVER () END AS target
  FROM (SELECT * REPLACE (total::BIGINT AS total, lim::BIGINT AS lim) FROM f)
), t2 AS (
  SELECT source, size, n, coalesce(target, (SELECT sum(size) FROM t)::BIGINT * (1 + (n - 1) % 3)
    / (SELECT sum(1 + (n - 1) % 3) FROM t)::DOUBLE) AS target FROM t
), b AS (SELECT ceil(sum(size) / 64)::BIGINT AS n FROM s
), seats AS (
  SELECT source, k, rank FROM (
    SELECT source, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, t2.n) AS rank
    FROM t2, b, range(b.n) AS g(k) WHERE target > 0)
  , b WHERE rank <= b.n
), q AS (
  SELECT t2.source, t2.size AS source_size, t2.target,
    least(64 * (SELECT count(*) FROM seats WHERE seats.source IS NOT DISTINCT FROM t2.source), 3 * t2.size) AS quota
  FROM t2
), l AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS first FROM d
), o AS (
  SELECT l.doc_id, l.source, l.size, q.source_size, q.target, first, CASE WHEN source_size > 0 THEN
    l.size * (quota // source_size) + greatest(0, least(l.size, quota - (quota // source_size) * source_size - first))
    ELSE 0 END AS taken
  FROM l JOIN q ON l.source IS NOT DISTINCT FROM q.source
)
SELECT o.doc_id, o.size, o.source_size, o.target, o.taken::BIGINT AS taken,
  CASE WHEN taken > 0 THEN (rank - 1) // (SELECT greatest(1, ceil(n / 64)::BIGINT) FROM b) ELSE -1 END AS shard
FROM o LEFT JOIN seats ON seats.source IS NOT DISTINCT FROM o.source AND seats.k = (o.first // 64)::BIGINT
"""

ORACLE["op7_substring_dedup"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), g AS (
  SELECT id, doc_id, unnest(range(1, len(w) - 11)) AS p,
    unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS g
  FROM d WHERE len(w) >= 13
), o AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)
), c AS (
  SELECT id, list(DISTINCT p + k) AS gone FROM g JOIN o USING (g), range(13) AS t(k)
  WHERE g.doc_id > o.least GROUP BY id
), k AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
    array_to_string(CASE WHEN gone IS NULL THEN w ELSE
      list_transform(list_sort(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i))), lambda i: w[i]) END, ' ') AS t
  FROM d LEFT JOIN c USING (id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM k
"""


def _crc32(text: str) -> str:
    """The unsigned checksum of an ASCII string, bit by bit."""
    bit = "CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, i: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {byte}), 4294967295::BIGINT)"


def _leaf(text: str) -> str:
    fields = [f"{f}::VARCHAR" for f in ("doc_id", "source", "lang", "n_chars")] + [text]
    framed = [f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields]
    return f"sha256({' || '.join(framed)})"


ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other
  FROM documents
), r AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, leaf, other, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, other) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS n
  FROM d
), nodes AS (
  SELECT tree, 0 AS level, place, leaf AS digest, n FROM r
  UNION ALL
  SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), max((n + 2) // 3)
  FROM nodes WHERE n > 1 GROUP BY tree, level, place // 3
), upper AS (
  SELECT 0 AS level, tree AS place, digest, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), max((n + 2) // 3)
  FROM upper WHERE n > 1 GROUP BY level, place // 3
), steps AS (
  SELECT r.id, 0 AS part, x.level, string_agg(x.digest, '' ORDER BY x.place) FILTER (x.place < r.place // (3 ** x.level)::BIGINT) AS before,
    string_agg(x.digest, '' ORDER BY x.place) FILTER (x.place > r.place // (3 ** x.level)::BIGINT) AS after
  FROM r JOIN nodes x ON x.tree = r.tree AND x.n > 1 AND x.place // 3 = r.place // (3 ** (x.level + 1))::BIGINT GROUP BY ALL
  UNION ALL
  SELECT r.id, 1, x.level, string_agg(x.digest, '' ORDER BY x.place) FILTER (x.place < r.tree // (3 ** x.level)::BIGINT),
    string_agg(x.digest, '' ORDER BY x.place) FILTER (x.place > r.tree // (3 ** x.level)::BIGINT)
  FROM r JOIN upper x ON x.n > 1 AND x.place // 3 = r.tree // (3 ** (x.level + 1))::BIGINT GROUP BY ALL
), paths AS (
  SELECT id, list(coalesce(before, '') || '|' || coalesce(after, '') ORDER BY part, level) AS path FROM steps GROUP BY id
), o AS (
  SELECT r.doc_id, r.leaf, s.digest AS subroot, (SELECT digest FROM upper WHERE n = 1) AS root,
    sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
    list_reduce(list_concat([other], coalesce(path, [])),
      lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
  FROM r JOIN nodes s ON s.tree = r.tree AND s.n = 1 LEFT JOIN paths USING (id)
)
SELECT *, folded_root = root AS verified FROM o
"""

ORACLE["op11_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM t GROUP BY conv_id
), k AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS k FROM c LEFT JOIN c b ON b.conv_id = c.base
), r AS (
  SELECT k.conv_id, place + 1 AS d, role, text FROM k JOIN t ON t.conv_id = k.base AND place < k.k
  UNION ALL
  SELECT k.conv_id, place - h + k + 1, role, text FROM k JOIN t ON t.conv_id = k.conv_id AND place >= h
), s AS (
  SELECT k.conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY d) FILTER (d IS NOT NULL) AS w,
    list(strlen(text) ORDER BY d) AS b
  FROM k LEFT JOIN r USING (conv_id) GROUP BY k.conv_id
), p AS MATERIALIZED (
  SELECT conv_id, d, len(w) AS n, CASE WHEN d = 0 THEN '' ELSE array_to_string(w[1:d], ' ') END AS key,
    CASE WHEN d = 0 THEN NULL WHEN d = 1 THEN '' ELSE array_to_string(w[1:d - 1], ' ') END AS up, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM (SELECT conv_id, coalesce(w, []) AS w, b FROM s))
), nodes AS MATERIALIZED (
  SELECT key, min(conv_id) AS conv_id, min(d) AS d, min(up) AS up, count(*) AS n, (count(*) - 1) * min(bytes) AS saved,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = p.n) AS ends
  FROM p GROUP BY key
), kids AS (SELECT up AS key, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up
), below AS (
  SELECT p.key, sum(x.saved) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM nodes x LEFT JOIN kids USING (key) JOIN p ON p.conv_id = x.conv_id AND p.d <= x.d GROUP BY p.key
)
SELECT x.conv_id, x.d::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM nodes x JOIN below USING (key) LEFT JOIN kids USING (key) LEFT JOIN nodes up ON up.key = x.up
"""

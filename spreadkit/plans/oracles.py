"""DuckDB SQL that computes the same answers as :mod:`spreadkit.plans.queries`.

The SQL is an independent statement of each query's semantics, run by the
checker against the same parquet tables (views ``events``, ``documents``,
``embeddings``, ``lineitem`` ...). Squared distances are written out term
by term, left to right, which is the order the Spark side adds them in, so
argmax decisions agree bit for bit.
"""

from __future__ import annotations

from spreadkit.plans.queries import K, L, LARGE_SAMPLE, MANY_GROUP_PICKS, MANY_PICKS, ODD_PICKS, PICKS, SEED

EMBEDDING_DIM = 64
LINEITEM_DIM = 4

EMBEDDING_POINTS = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
LINEITEM_ID = (
    "CAST(CAST(l_orderkey AS HUGEINT) * 1000000000000000000000 + CAST(l_partkey AS HUGEINT) * 1000000000000 "
    "+ CAST(l_suppkey AS HUGEINT) * 1000 + l_linenumber * 100 + CAST(l_quantity AS HUGEINT) AS DECIMAL(38,0))"
)
LINEITEM_POINTS = (
    f"SELECT {LINEITEM_ID} AS id, "
    "CAST([l_quantity, l_extendedprice, l_discount, l_tax] AS DOUBLE[]) AS v FROM lineitem"
)

TOKENS = (
    "CASE WHEN text = '' THEN [''] "
    "WHEN rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[]) "
    "ELSE string_split(rtrim(text, ' '), ' ') END"
)
# lines end at \\r\\n, \\n or \\r; the last needs no end
LINES = (
    "SELECT unnest(string_split(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), "
    "'\\n\\z', ''), chr(10))) AS text FROM documents WHERE text <> ''"
)
WORDS = f"SELECT unnest({TOKENS}) AS w FROM documents"


def sq(a: str, b: str, dim: int) -> str:
    """Squared distance of two DuckDB lists, one term per coordinate."""
    return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, dim + 1))


def pairs_sql(points: str, dim: int, cmp: str = "<") -> str:
    return (
        f"WITH p AS ({points}) SELECT a.id AS i, b.id AS j, {sq('a.v', 'b.v', dim)} AS d2 "
        f"FROM p a JOIN p b ON a.id {cmp} b.id"
    )


def farthest_first_sql(points: str, dim: int, k: int, group: str = "0") -> str:
    """Recursive farthest-first; returns ``g, step, id, v`` of the chosen rows.

    Each iteration carries every row with its running minimum ``d2``; the
    row chosen at a step has ``c`` set and ``d2 = -1`` from then on.
    """
    return f"""
WITH RECURSIVE pts AS (SELECT {group} AS g, id, v FROM ({points})),
ff(step, g, id, v, d2, c) AS (
  SELECT 0, g, id, v, CAST('Infinity' AS DOUBLE), id = min(id) OVER (PARTITION BY g) FROM pts
  UNION ALL
  SELECT step, g, id, v, nd,
         nd >= 0 AND row_number() OVER (PARTITION BY g ORDER BY nd DESC, id) = 1
  FROM (
    SELECT step + 1 AS step, g, id, v,
           CASE WHEN c OR d2 < 0 THEN CAST(-1 AS DOUBLE)
                ELSE least(d2, {sq('v', 'cv', dim)}) END AS nd
    FROM (SELECT *, max(CASE WHEN c THEN v END) OVER (PARTITION BY g) AS cv FROM ff) s
  ) t
  WHERE step < {k}
)
SELECT g, step, id, v FROM ff WHERE c"""


def greedy_sql(points_with_order: str, dim: int, k: int, n: int | None = None) -> str:
    """Recursive greedy matching over ``id, v, o`` rows: ``pick, id``. With
    ``n`` (the number of rows) at most ``k`` it is all rows in order."""
    if n is not None and k >= n:
        return f"SELECT row_number() OVER (ORDER BY o) - 1 AS pick, id FROM ({points_with_order})"
    odd = f"""
UNION ALL
SELECT {k - 1} AS pick, id FROM (
  SELECT id FROM pts WHERE NOT list_contains((SELECT used FROM gm ORDER BY t DESC LIMIT 1), id) ORDER BY o LIMIT 1
) r""" if k % 2 else ""
    return f"""
WITH RECURSIVE pts AS ({points_with_order}),
e AS (SELECT a.id AS i, b.id AS j, a.o AS oi, b.o AS oj, {sq('a.v', 'b.v', dim)} AS d
      FROM pts a JOIN pts b ON a.o < b.o),
gm(t, used, i, j) AS (
  SELECT 0, [i, j], i, j FROM (SELECT i, j FROM e ORDER BY d DESC, oi, oj LIMIT 1) f
  UNION ALL
  SELECT gm.t + 1, list_concat(gm.used, [e.i, e.j]), e.i, e.j
  FROM gm JOIN e ON NOT list_contains(gm.used, e.i) AND NOT list_contains(gm.used, e.j)
  WHERE gm.t + 1 < {k // 2}
  QUALIFY row_number() OVER (ORDER BY e.d DESC, e.oi, e.oj) = 1
)
SELECT 2 * t AS pick, i AS id FROM gm
UNION ALL
SELECT 2 * t + 1 AS pick, j AS id FROM gm{odd}"""


def diversity_sql(points: str, dim: int, k: int, groups: int) -> str:
    core = farthest_first_sql(points, dim, k, group=f"CAST(id % {groups} AS BIGINT)")
    ordered = f"SELECT id, v, g * {k} + step AS o FROM ({core})"
    return greedy_sql(ordered, dim, k)


def avg_distance_of(picks_sql: str, points: str, dim: int) -> str:
    return f"""
WITH s AS (SELECT p.id, p.v FROM ({points}) p JOIN ({picks_sql}) q ON p.id = q.id)
SELECT round(avg(sqrt({sq('a.v', 'b.v', dim)})), 6) AS avg_distance
FROM s a JOIN s b ON a.id < b.id"""


def _oracles() -> dict[str, str]:
    emb, li = EMBEDDING_POINTS, LINEITEM_POINTS
    class_counts = 'SELECT event_type AS "class", count(*) AS cnt FROM events GROUP BY 1'
    word_counts = f"SELECT w AS word, count(*) AS cnt FROM ({WORDS}) GROUP BY 1"

    def drawn(points: str, k: int) -> str:
        rank = f"substr(md5(concat_ws(':', '{SEED}', CAST(id AS VARCHAR))), 1, 15)"
        return f"SELECT id FROM ({points}) ORDER BY {rank}, id LIMIT {k}"

    sample = drawn(emb, PICKS)
    core = f"SELECT id, v, id AS o FROM ({farthest_first_sql(emb, EMBEDDING_DIM, PICKS, f'id % {L}')})"
    to_center = (
        f"WITH p AS (SELECT id, v, id % {L} AS g FROM ({emb})), "
        "c AS (SELECT g, min(id) AS i, arg_min(v, id) AS cv FROM p GROUP BY g) "
        f"SELECT i, id AS j, {sq('v', 'cv', EMBEDDING_DIM)} AS d2 FROM p JOIN c USING (g) WHERE id <> i"
    )
    ff = farthest_first_sql(emb, EMBEDDING_DIM, PICKS)
    return {
        "read_labelled": 'SELECT event_id AS key, event_type AS "class" FROM events',
        "read_labelled_permissive": (
            "SELECT count(*) FILTER (WHERE event_id % 7 <> 0) AS n_read, "
            "CAST(sum(event_id) FILTER (WHERE event_id % 7 <> 0) AS BIGINT) AS key_sum, "
            "count(*) FILTER (WHERE event_id % 7 = 0) AS n_rejected FROM events"
        ),
        "read_points": (
            f"SELECT {LINEITEM_ID} AS id, l_quantity AS x0, l_extendedprice AS x1, "
            "l_discount AS x2, l_tax AS x3 FROM lineitem"
        ),
        "read_points_file": (
            "SELECT row_number() OVER (ORDER BY l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS id, "
            "l_quantity AS x0, l_extendedprice AS x1, l_discount AS x2, l_tax AS x3 FROM lineitem"
        ),
        "document_lines_file": f"SELECT row_number() OVER (ORDER BY text) - 1 AS line_id, md5(text) AS digest FROM ({LINES})",
        "word_count_file": f"SELECT unnest({TOKENS}) AS word, count(*) AS cnt FROM ({LINES}) GROUP BY 1",
        "class_count_file": class_counts,
        "exact_partition_sizes": (
            f"SELECT CAST(p AS INTEGER) AS partition, n // {K} + CAST(p < n % {K} AS BIGINT) AS size "
            f"FROM (SELECT count(*) AS n FROM events), range({K}) r(p)"
        ),
        "class_count": class_counts,
        "class_count_two_round": class_counts,
        "class_count_sorted": class_counts + ' ORDER BY "class"',
        "most_frequent_class": class_counts + ' ORDER BY cnt DESC, "class" LIMIT 1',
        "most_frequent_returnflag": (
            'SELECT l_returnflag AS "class", count(*) AS cnt FROM lineitem GROUP BY 1 '
            'ORDER BY cnt DESC, "class" LIMIT 1'
        ),
        "max_partition_size": (
            f"SELECT max(c) AS max_partition_size FROM "
            f"(SELECT (event_id % {K} + {K}) % {K} AS b, count(*) AS c FROM events GROUP BY 1)"
        ),
        "max_partition_size_physical": (
            f"SELECT CAST({K} AS BIGINT) AS partitions, count(*) AS n_rows, true AS balanced FROM events"
        ),
        "document_lines": (
            f"SELECT count(*) AS n_lines, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM ({LINES})"
        ),
        "document_count": "SELECT count(*) AS n_docs FROM documents",
        "tokenize": f"SELECT doc_id, CAST(len({TOKENS}) AS BIGINT) AS n_tokens FROM documents",
        "word_count": word_counts,
        "word_count_lines": f"SELECT unnest({TOKENS}) AS word, count(*) AS cnt FROM ({LINES}) GROUP BY 1",
        "word_count_salted": word_counts,
        "word_count_partition": word_counts,
        "distinct_word_count": f"SELECT count(DISTINCT w) AS n_words FROM ({WORDS})",
        "avg_word_length": (
            f"SELECT CAST(sum(length(w)) // count(*) AS BIGINT) AS avg_word_length "
            f"FROM (SELECT DISTINCT w FROM ({WORDS}))"
        ),
        "pairwise_sqdist": f"SELECT i, j, round(d2, 6) AS sqdist FROM ({to_center})",
        "pairwise_distance": f"SELECT i, j, round(sqrt(d2), 6) AS distance FROM ({to_center})",
        "exact_diameter": (
            f"SELECT round(sqrt(max(d2)), 6) AS diameter FROM ({pairs_sql(emb, EMBEDDING_DIM, '<=')})"
        ),
        "exact_diameter_blocked": (
            f"SELECT round(sqrt(max(d2)), 6) AS diameter FROM ({pairs_sql(emb, EMBEDDING_DIM, '<=')})"
        ),
        "exact_diameter_tree": (
            f"SELECT round(sqrt(max(d2)), 6) AS diameter FROM ({pairs_sql(emb, EMBEDDING_DIM, '<=')})"
        ),
        "exact_diameter_pruned": (
            f"SELECT round(sqrt(max(d2)), 6) AS diameter FROM ({pairs_sql(li, LINEITEM_DIM, '<=')})"
        ),
        "avg_pairwise_distance": (
            f"SELECT round(avg(sqrt(d2)), 6) AS avg_distance FROM ({pairs_sql(core, EMBEDDING_DIM)})"
        ),
        "sample_k": sample,
        "sample_k_large": drawn(li, LARGE_SAMPLE),
        "sample_rest": f"SELECT id FROM ({emb}) WHERE id NOT IN ({sample})",
        "sampled_diameter": (
            f"WITH p AS ({emb}), s AS (SELECT p.* FROM p WHERE id IN ({sample})), "
            f"r AS (SELECT p.* FROM p WHERE id NOT IN ({sample})) "
            f"SELECT round(sqrt(max({sq('s.v', 'r.v', EMBEDDING_DIM)})), 6) AS diameter "
            f"FROM s CROSS JOIN r"
        ),
        "farthest_first": f"SELECT step, id FROM ({ff})",
        "farthest_first_k20": f"SELECT step, id FROM ({farthest_first_sql(emb, EMBEDDING_DIM, MANY_PICKS)})",
        "center_diameter": (
            f"WITH c AS ({ff}) SELECT round(sqrt(max({sq('a.v', 'b.v', EMBEDDING_DIM)})), 6) "
            f"AS diameter FROM c a JOIN c b ON a.id <= b.id"
        ),
        "coreset": (
            f"SELECT g, step, id FROM ({farthest_first_sql(emb, EMBEDDING_DIM, PICKS, f'id % {L}')})"
        ),
        "coreset_lineitem": (
            f"SELECT g, step, id FROM ({farthest_first_sql(li, LINEITEM_DIM, PICKS, f'CAST(id % {L} AS BIGINT)')})"
        ),
        "coreset_lineitem_k12": (
            "SELECT g, step, id FROM "
            f"({farthest_first_sql(li, LINEITEM_DIM, MANY_GROUP_PICKS, f'CAST(id % {L} AS BIGINT)')})"
        ),
        "greedy_matching": greedy_sql(core, EMBEDDING_DIM, PICKS),
        "greedy_matching_odd": greedy_sql(core, EMBEDDING_DIM, ODD_PICKS),
        "greedy_matching_all": greedy_sql(core, EMBEDDING_DIM, PICKS * L, PICKS * L),
        "diversity_mapreduce": diversity_sql(emb, EMBEDDING_DIM, PICKS, L),
        "diversity_mapreduce_lineitem": diversity_sql(li, LINEITEM_DIM, PICKS, L),
        "diversity_value": avg_distance_of(
            diversity_sql(emb, EMBEDDING_DIM, PICKS, L), emb, EMBEDDING_DIM
        ),
        "diversity_value_lineitem": avg_distance_of(
            diversity_sql(li, LINEITEM_DIM, PICKS, L), li, LINEITEM_DIM
        ),
    }


ORACLES: dict[str, str] = _oracles()

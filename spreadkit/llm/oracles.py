"""DuckDB SQL for the registered queries that SQL can express on whole tables.

Tokenizer ids, DOM trees, hashed models, edit distances and random vectors have
no SQL form; those queries are tested in ``tests/llm``.
"""

from __future__ import annotations

from spreadkit.llm.collocations import ABSORB_PERCENT, LEAST, MOST_WORDS, PER_MILLE, TOP
from spreadkit.llm.ngram_join import PERCENT
from spreadkit.llm.repetition import MAX_COVERED, MAX_LONGEST, MAX_REPEAT_WORDS, MIN_REPEAT, MIN_WORDS

WORD = r"[^\x20\x09-\x0D]+"


def _leads(words: int) -> str:
    return ", ".join(f"lead(w, {k}) OVER o AS w{k}" for k in range(1, words))


def _repeated(words: int) -> str:
    """Whether the window of so many words from here occurs twice in the text."""
    columns = ", ".join(["w", *[f"w{k}" for k in range(1, words)]])
    return f"w{words - 1} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, {columns}) > 1"


def _covered(flag: str, words: int) -> str:
    return f"bool_or({flag}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {words - 1} PRECEDING AND CURRENT ROW)"


# The longest repeat: equal windows at i < j lie on the diagonal j - i, and a run
# of so many of them in a row is a repeat that is longer by the window less one.
REPETITION = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS ws FROM d),
p AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
g AS (SELECT *, {_leads(MIN_REPEAT)} FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT *, {_repeated(3)} AS r3, {_repeated(MIN_REPEAT)} AS r5 FROM g),
c AS (SELECT *, {_covered('r3', 3)} AS c3, {_covered('r5', MIN_REPEAT)} AS c5 FROM f),
m AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (WHERE c3) AS n_repeat_words,
             count(*) FILTER (WHERE c5) AS covered_words FROM c GROUP BY doc_id),
pairs AS (SELECT a.doc_id, b.i - a.i AS diagonal, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS run
          FROM f a JOIN f b ON a.doc_id = b.doc_id AND a.i < b.i AND a.r5 AND b.r5
          {' '.join(f'AND a.{c} = b.{c}' for c in ['w', *[f'w{k}' for k in range(1, MIN_REPEAT)]])}),
runs AS (SELECT doc_id, count(*) + {MIN_REPEAT - 1} AS n FROM pairs GROUP BY doc_id, diagonal, run),
longest AS (SELECT doc_id, max(n) AS longest_repeat FROM runs GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
        WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
t AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(covered_words, 0) AS BIGINT) AS covered_words,
             CAST(coalesce(longest_repeat, 0) AS BIGINT) AS longest_repeat
      FROM d LEFT JOIN m USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN dup USING (doc_id)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_WORDS} * n_words AS base_failed FROM t)
SELECT *, NOT base_failed AND 100 * covered_words <= {MAX_COVERED} * n_words
          AND 100 * longest_repeat <= {MAX_LONGEST} * n_words AS kept FROM v"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NGRAM_JOIN = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS ws
  FROM documents),
p AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
g AS (SELECT doc_id, w, {_leads(5)} FROM p WHERE n >= 5 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, concat_ws(' ', w, w1, w2, w3, w4) AS s FROM g WHERE w4 IS NOT NULL
      UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM l WHERE len(ws) BETWEEN 1 AND 4),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id
          WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id, size.n"""

COLLOCATIONS = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
s AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
k AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, {MOST_WORDS + 1}) r(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM k
      GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cut AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS j FROM c),
scored AS (SELECT cut.lang, cut.k, cut.phrase, a, j, l.f AS l, r.f AS r, n,
                  CAST(({PER_MILLE}::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
           FROM cut JOIN f l ON l.lang = cut.lang AND l.k = j AND l.phrase = array_to_string(ws[1 : j], ' ')
           JOIN f r ON r.lang = cut.lang AND r.k = cut.k - j AND r.phrase = array_to_string(ws[j + 1 : cut.k], ' ')
           JOIN s ON s.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (SELECT lang, len, array_to_string(ws[b : b + len - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT lang, ws, a, k, len, unnest(range(1, k - len + 2)) AS b FROM c, range(2, {MOST_WORDS}) r(len) WHERE len < k)
           GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inner_ i ON i.lang = best.lang AND i.len = best.k AND i.phrase = best.phrase
         WHERE longer IS NULL OR 100 * longer::HUGEINT < {ABSORB_PERCENT} * a::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {TOP}"""

ORACLES: dict[str, str] = {"op13_collocations": COLLOCATIONS, "op2_ngram_join": NGRAM_JOIN, "op3_repetition": REPETITION}

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from spreadkit.llm import collocations as C
from spreadkit.llm.textarrays import text_bytes

from support import ODD, docs, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    parts = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    return [w for w in (re.findall(r"[^\x20\x09]+", p) for p in parts) if w]


def brute(rows, least, most=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for ws in pieces(text):
            n[lang or "und"] += len(ws)
            for k in range(1, most + 1):
                f[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cand.items():
            cuts = [(1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                100 * b >= 100 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cand.items()
            )
            if not inside:
                rows_.append((lang, " ".join(p), a, own[p[:k]], own[p[k:]], n[lang], score))
        rows_.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows_[:top])]
    return sorted(out)


def frame(spark, rows, clashes=False):
    df = docs(spark, [t for _, t in rows], clashes=clashes)
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id bigint, lang string")
    return df.join(langs, "doc_id")


def corpus(seed, n=80):
    rng = random.Random(seed)
    fixed = ["New York city", "the end of", "a a a a a a a", "one two three four five six", "é ß ü"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.5 else " ".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))))
        rows.append((rng.choice(["en", "en", "fr", None]), rng.choice([" ", ", ", "\n", "  ", "\t"]).join(parts)))
    return rows + [("de", t) for t in ODD] + [("en", None), (None, "")]


@pytest.mark.parametrize("seed,least,shards", [(1, 5, 3), (2, 9, 2), (3, 4, 4), (4, 12, 1)])
def test_equals_brute_force(spark, seed, least, shards):
    rows = corpus(seed)
    got = C.collocations(frame(spark, rows, clashes=seed == 1), least=least, shards=shards).collect()
    assert sorted(map(tuple, got)) == brute(rows, least) != []


def test_first_rows_and_shorter_phrases(spark):
    rows = corpus(6)
    got = C.collocations(frame(spark, rows), least=6, most=3, top=4).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6, most=3, top=4)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """A filter that says yes to nearly everything: nothing is pruned, nothing wrong."""
    rows = corpus(7)
    monkeypatch.setattr(C, "FILTER_BITS", (64, 64))
    assert sorted(map(tuple, C.collocations(frame(spark, rows), least=7).collect())) == brute(rows, 7)


def test_empty(spark):
    none = empty(spark).selectExpr("doc_id", "text", "'en' AS lang")
    assert C.collocations(none).collect() == []
    assert C.collocations(frame(spark, [("en", None), (None, " .\n")]), least=1).collect() == []


def test_words_and_pieces():
    texts = ODD + ["A.b c,d", "x\ty  z\r\nq", ".", "a", "b"]
    data, offsets = text_bytes(pa.array(texts))
    lower = np.frombuffer(bytes(data).lower(), np.uint8)
    starts, ends, joined = C.pieces_words(lower, offsets)
    got, at = [], 0
    for k in np.append(np.flatnonzero(~joined), len(starts)):
        if k < len(starts):
            got.append([lower[a:b].tobytes().decode() for a, b in zip(starts[at : k + 1], ends[at : k + 1])])
            at = k + 1
    assert got == [ws for t in texts for ws in pieces(t)]


def test_scores_are_exact_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits; the quotient does not."""
    a, n, l, r = 10**13 - 7, 10**13 - 1, 10**13 - 5, 10**13 - 6
    wide = [f"cast({x} AS decimal(38, 0))" for x in (a, n, l, r)]
    got = spark.sql(f"SELECT ({C.PER_MILLE} * {wide[0]} * {wide[1]}) div ({wide[2]} * {wide[3]}) AS s").first().s
    assert got == 1000 * a * n // (l * r)

import random

from spreadkit.llm import decontamination, queries
from spreadkit.llm.decontamination import Index, decontaminate, findings, indexes, keep_clean, normalised

from support import ODD, SF, docs, empty


def edits(pattern, text):
    """Fewest edits between the pattern and any substring, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def test_search_equals_edit_distance(spark):
    index = Index([(r.item_id, r.text) for r in benchmark(spark).orderBy("item_id").limit(3).collect()])
    rng, hits = random.Random(3), 0
    for _ in range(60):
        w = rng.randrange(len(index.low))
        body = list(bytes(index.data[index.low[w] : index.low[w] + index.size[w]]).decode("utf8", "ignore"))
        for _ in range(rng.randrange(9)):
            p, kind = rng.randrange(len(body)), rng.randrange(3)
            body[p : p + (kind > 0)] = [rng.choice("abcxyz")] if kind < 2 else []
        text = "lorem ipsum dolor " * rng.randrange(4) + "".join(body) + " sit amet" * rng.randrange(3)
        data, offsets = normalised([text])
        found = {int(v): int(e) for r in index.search(data, offsets) for v, e in zip(r[1], r[4])}
        for v in range(len(index.low)):
            e = edits(bytes(index.data[index.low[v] : index.low[v] + index.size[v]]), bytes(data[:-1]))
            assert (v in found) == (e <= index.budget[v]) and found.get(v, e) == e
            hits += v in found
    assert hits > 30


def test_query_finds_every_verbatim_item(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in benchmark(spark).collect()}
    got = {(r.doc_id, r.item_id): r for r in queries.op7_decontamination(spark, SF).collect()}
    verbatim = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert verbatim and verbatim <= set(got)
    for (d, i), r in got.items():  # nothing else but what edit distance confirms
        assert r.edits <= 6 and 1 <= r.matched <= r.windows
        if (d, i) not in verbatim:
            index = Index([(i, items[i])])
            text = bytes(normalised([texts[d]])[0])
            assert any(edits(bytes(index.data[a : a + n]), text) <= k for a, n, k in zip(index.low, index.size, index.budget))


def test_blocks_of_the_benchmark(spark, monkeypatch):
    want = sorted(queries.op7_decontamination(spark, SF).collect())
    monkeypatch.setattr(decontamination, "INDEX_BYTES", 2000)
    assert len(list(indexes(benchmark(spark)))) > 3
    assert sorted(queries.op7_decontamination(spark, SF).collect()) == want


def test_case_punctuation_repeats_and_bounds(spark):
    item = "The quick brown fox jumps over the lazy dog near the river bank"
    found = lambda texts: {r[0] for rows in findings(Index([(1, item)]), texts) for r in rows}
    loud = "### " + item.upper().replace(" ", "!! ") + " ###"
    # 3 edits are within 5 % of 63 characters, 5 are not; a half is not the whole
    texts = [item, loud, item.replace("fox", "fax"), item.replace("quick brown", "slow red"), item[:30], "x" + item + "y"]
    assert found(texts) == {0, 1, 2, 5}
    assert found(ODD) == set() and found([]) == set()
    assert list(findings(Index([(1, "short"), (2, "")]), [item])) == [] and list(findings(Index([]), [item])) == []
    assert found([item, item, "pad " * 300_000 + item]) == {0, 1, 2}


def test_nulls_clashes_and_empty(spark):
    bench = spark.createDataFrame(
        [(1, "a passage of the benchmark that is long enough"), (None, "another passage without an item id at all"), (3, None), (4, "")],
        "item_id bigint, text string",
    ).selectExpr("*", "1 as doc_id")
    df = docs(spark, ODD + ["so a passage of the benchmark that is long enough", "another passage without an item id at all"], clashes=True)
    got = {(r.doc_id, r.item_id) for r in decontaminate(df, bench).collect()}
    assert got == {(len(ODD), 1), (len(ODD) + 1, None)}
    clean = keep_clean(df, bench)
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == list(range(len(ODD)))
    assert decontaminate(df, bench.where("item_id > 9")).collect() == []
    assert keep_clean(empty(spark), bench).collect() == []


def test_excerpts_of_the_least_length_at_any_alignment(spark):
    item = bytes(normalised([benchmark(spark).orderBy("item_id").first().text])[0][:-1]).decode("ascii")
    index = Index([(1, item)])
    n = decontamination.EXCERPT
    texts = [f"0123 {item[a : a + n]} 4567" for a in range(len(item) - n + 1)]
    assert len(texts) > 100 and {r[0] for rows in findings(index, texts) for r in rows} == set(range(len(texts)))


def test_short_items_are_matched_exactly(spark):
    index = Index([(1, "Tom & Ann"), (2, "x7"), (3, "?")])
    texts = ["so tom, ann came", "tommy ann", "X7", "ax7", "tom", "ann x", "7", None, "tom ann"]
    got = {(r[0], r[1], r[2], r[3]) for rows in findings(index, texts) for r in rows}
    assert got == {(0, 1, 3, 10), (2, 2, 0, 2), (8, 1, 0, 7)}


def test_unicode_punctuation_and_code_points():
    item = "The quick brown fox doesn't jump over the lazy dog - near the river bank; it sleeps (mostly) all day in the sun"
    russian = "съешь же ещё этих мягких французских булок да выпей чаю"
    chinese = "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏"
    index = Index([(1, item), (2, russian), (3, chinese), (4, "你好")])
    found = lambda text: {r[1] for rows in findings(index, [text]) for r in rows}
    assert found(item.replace(" ", "\u00a0").replace("'", "\u2019").replace("-", "\u2014").replace("(", "\uff08")) == {1}
    assert found(russian.replace("ш", "щ").replace("п", "Ж", 1)) == {2}  # two edits of 5 % of 55
    assert found(chinese[:9] + "狗" + chinese[10:]) == {3} and found("我說你好嗎") == {4} and found("你好"[::-1]) == set()
    # folded alike, yet other letters
    assert found("".join(chr(ord(c) + 128) for c in chinese)) == set()


def test_equal_items_are_one_entry_and_all_reported(spark):
    passage = "the quick brown fox of the benchmark jumps over seventeen lazy dogs at noon and sleeps"
    items = spark.createDataFrame([(i, passage) for i in range(300)] + [(300, "another passage that no text of these ever holds, not one")], "item_id bigint, text string")
    texts = ["intro " + (passage + " and so on ") * 20, "a clean text of some length that has nothing of it", passage]
    rows = decontaminate(docs(spark, texts), items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, i) for d in (0, 2) for i in range(300)}
    assert sum(len(index.ids) for index in indexes(items)) == 2


def test_one_text_with_very_many_hits_is_counted_in_parts(monkeypatch):
    base = "a passage of the benchmark that many items share almost word for word, but not quite"
    items = [(i, f"{base} {i} ending") for i in range(400)]
    texts = ["x " + (base + " 7 ending. ") * 15, "nothing here", base + " 399 ending"]
    want = [sorted(r) for r in findings(Index(items), texts)]
    monkeypatch.setattr(decontamination, "_EXPANDED", 500)
    assert [sorted(r) for r in findings(Index(items), texts)] == want and len(want[0]) >= 400

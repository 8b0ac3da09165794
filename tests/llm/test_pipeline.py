"""The pipeline against plain forms of its stages."""

import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from spreadkit.llm.decontamination import Index, findings
from spreadkit.llm.tables import stored

from support import SF, docs
from test_ngram_join import brute as components
from test_repetition import brute as measures


def kept(text):
    n, _, _, _, repeat, cover, longest = measures(text)
    return n >= 50 and 100 * repeat <= 50 * n and 100 * cover <= 40 * n and 100 * longest <= 25 * n


def test_run_equals_plain_stages(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    texts = {r.doc_id: r.text for r in rows if kept(r.text)}
    groups = components(texts)
    texts = {d: t for d, t in texts.items() if groups[d][1] == d}
    index = Index([(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    order = list(texts)
    found = {order[row[0]] for part in findings(index, [texts[d] for d in order]) for row in part}
    texts = {d: re.sub(r'(?i)(token\W+")[0-9a-f]{40}"', r'\1[SECRET]"', t) for d, t in texts.items() if d not in found}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in texts.items()}

    got: dict[int, list] = {}
    for r in sorted(corpus_pipeline.run(spark, sf).collect(), key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == want and found and any("[SECRET]" in t for t in texts.values())


def test_stages_keep_the_columns_of_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs(spark, [None, ""], 10**6).selectExpr("doc_id", "text", "cast(null as string) as lang", "cast(null as string) as source", "cast(null as bigint) as n_chars")
    df = documents.unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stored(stage(spark, df, SF), "stage")
        assert df.dtypes == documents.dtypes
    assert df.where("n_chars <> length(text)").count() == 0


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(m[1]) for q in entry.queries() if (m := re.match(r"op(\d+)_", q)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5

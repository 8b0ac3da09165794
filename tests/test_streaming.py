import os

from spreadkit.operators import counts, words
from spreadkit.sources import parse_labelled
from spreadkit.streaming import read_lines_stream


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _run(spark, df, name, ckpt):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode("complete")
        .option("checkpointLocation", ckpt).start()
    )
    try:
        query.processAllAvailable()
        return {r[0]: r[1] for r in spark.sql(f"SELECT * FROM {name}").collect()}
    finally:
        query.stop()


def test_streaming_class_counts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, "a.txt", ["0 cat", "1 dog", "2 cat", "bad line"])
    _write(src, "b.txt", ["3 bird", "4 cat", "5 dog"])
    got = _run(spark, counts.class_count(parse_labelled(read_lines_stream(spark, str(src), 1), mode="permissive")),
               "class_counts_stream", str(tmp_path / "ck1"))
    assert got == {"bird": 1, "cat": 3, "dog": 2}


def test_streaming_word_counts(spark, tmp_path):
    src = tmp_path / "docs"
    src.mkdir()
    _write(src, "a.txt", ["a bb a", "ccc bb "])
    got = _run(spark, words.word_count(read_lines_stream(spark, str(src)), text="value"),
               "word_counts_stream", str(tmp_path / "ck2"))
    assert got == {"a": 2, "bb": 2, "ccc": 1}

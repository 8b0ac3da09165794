"""Main text of web pages with a site style tree.

The DOMs of a host's pages are merged by branch (the names and classes from the
root down). For every branch of a host the tree holds

* how its presentation varies: the entropy of the sequences of child elements,
* how its content varies: a text that stands there on c of m pages has entropy
  log c / log m, and the branch's content importance is 1 minus the mean of it
  over its texts,

and the branch's importance combines the two. Content that a host repeats on
every page has importance near 0, text of its own on each page near 1. Branches
of low importance are removed from each page, as are elements that say
themselves that they are no main text (menus, forms, adverts and so on). An
``article`` or ``main`` element is evidence for what is in it: other text of the
page then stays only if its own branch has high importance, or if several articles
together hold less text than stands outside them (teasers).

Equal pages of a host are merged as one page, since a copied article says nothing
about the site. A branch needs ``MIN_PAGES`` pages to be judged. A host may repeat
articles, not only its frame: a low branch with long texts of its own
(``LONG_TEXT``) in two or more versions is put back, with short ones beside it that
vary too (headings); one in a single version only on pages that would keep nothing.

Counts of branches are aggregated by (host, branch, feature), partly before the
shuffle, so a host with a third of all pages is spread over all tasks. Pages are
joined only with their host's list of low branches: the lists are counted, and
broadcast if they fit the cap, so that no html moves; else both sides are salted.

Null and empty html give an empty text. Pages without a url share one nameless
host. Repeated page ids are separate pages.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.dom import Block, read
from spreadkit.llm.tables import stored
from spreadkit.runtime import fits_broadcast

MIN_PAGES = 4
LOW_IMPORTANCE = 0.3
HIGH_IMPORTANCE = 0.7
PRESENTATION_SHARE = 0.1
LONG_TEXT = 200
SALTS = 64

_FEATURES = "host string, fingerprint bigint, branches array<bigint>, kinds array<int>, features array<bigint>"


def features(blocks: list[Block], styles: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Distinct (branch, kind, feature) of a page; kind 0 content, 1 presentation,
    2 long content of the branch itself."""
    out = {(key, 0, xxhash.xxh64_intdigest(b.text) >> 1) for b in blocks for key in b.chain}
    out.update((b.chain[-1], 2, xxhash.xxh64_intdigest(b.text) >> 1) for b in blocks if len(b.text) >= LONG_TEXT)
    out.update((key, 1, style) for key, style in styles)
    return sorted(out)


def main_text(
    blocks: list[Block], low: set[int], high: set[int] = frozenset(), copied: set[int] = frozenset(),
    varied: set[int] = frozenset(), single: set[int] = frozenset(),
) -> str:
    """Blocks of the page outside side elements and low branches."""
    own = [b for b in blocks if not b.side]
    parts = {b.main for b in own if b.main}
    back = copied | varied if any(b.chain[-1] in copied for b in own) else frozenset()
    kept = [b for b in own if not low.intersection(b.chain) or b.chain[-1] in back]
    if parts:
        inside = sum(len(b.text) for b in own if b.main)
        outside = sum(len(b.text) for b in kept if not b.main)
        if len(parts) == 1 or outside <= inside:
            kept = [b for b in kept if b.main or b.chain[-1] in high]
    kept = kept or [b for b in own if b.chain[-1] in single] or [b for b in own if b.main] or own
    return "\n".join(b.text for b in kept)


def style_trees(pages: DataFrame) -> DataFrame:
    """``host, branch, pages, importance`` and what tells copied articles, from
    ``host, html``."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, prints, rows = batch.column(0).to_pylist(), [], []
            for page in batch.column(1).to_pylist():
                blocks, styles = read(page or "")
                prints.append(xxhash.xxh64_intdigest("\n".join(b.text for b in blocks)) >> 1)
                rows.append(features(blocks, styles))
            lists = [[[x[k] for x in r] for r in rows] for k in range(3)]
            kinds = [pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(hosts, pa.string()), pa.array(prints, pa.int64())]
            columns += [pa.array(x, pa.list_(t)) for x, t in zip(lists, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "fingerprint", "branches", "kinds", "features"])

    merged = pages.mapInArrow(merge, _FEATURES).dropDuplicates(["host", "fingerprint"])
    one = merged.select("host", F.explode(F.arrays_zip("branches", "kinds", "features")).alias("x"))
    counts = one.groupBy("host", F.col("x.branches").alias("branch"), F.col("x.kinds").alias("kind"), F.col("x.features").alias("feature")).agg(
        F.count("*").alias("c")
    )
    # every page with the branch has exactly one presentation of it at least
    total = counts.groupBy("host", "branch").agg(
        F.sum(F.when(F.col("kind") == 1, F.col("c"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 1, F.col("c") * F.log("c"))).alias("styled"),
        F.sum(F.when(F.col("kind") == 0, F.col("c"))).alias("texts"),
        F.sum(F.when(F.col("kind") == 0, F.col("c") * F.log("c"))).alias("repeated"),
        F.sum(F.when(F.col("kind") == 2, 1).otherwise(0)).alias("long_texts"),
        F.sum(F.when(F.col("kind") == 2, F.col("c")).otherwise(0)).alias("long_seen"),
    )
    log_pages = F.log("pages")
    content = 1 - F.least(F.col("repeated") / F.col("texts") / log_pages, F.lit(1.0))
    presentation = 1 - F.col("styled") / F.col("pages") / log_pages
    importance = (1 - PRESENTATION_SHARE) * content + PRESENTATION_SHARE * presentation
    return total.where(f"pages >= {MIN_PAGES} and texts > 0").select(
        "host", "branch", "pages", importance.alias("importance"), content.alias("content"), "long_texts", "long_seen"
    )


def host_of(url: str):
    """The host in a url, lower case; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``."""
    source = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host_of(url_col).alias("host"),
    )
    is_low, is_long = F.col("importance") < LOW_IMPORTANCE, 2 * F.col("long_seen") >= F.col("pages")
    roles = {
        "low": is_low,
        "high": F.col("importance") >= HIGH_IMPORTANCE,
        "copied": is_low & is_long & (F.col("long_texts") > 1),
        "varied": is_low & ~is_long & (F.col("content") > 0.01),
        "single": is_low & is_long & (F.col("long_texts") == 1),
    }
    low = stored(
        style_trees(source.select("host", "html")).where(roles["low"] | roles["high"])
        .groupBy("host").agg(*[F.collect_list(F.when(x, F.col("branch"))).alias(k) for k, x in roles.items()]),
        "judged-branches",
    )
    size = low.agg(F.coalesce(F.sum(F.octet_length("host") + sum(8 * F.size(k) for k in roles) + 128), F.lit(0))).first()[0]
    if fits_broadcast(pages.sparkSession, 1, size):
        joined = source.join(F.broadcast(low), "host", "left")
    else:
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        salted = source.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(low.withColumn("salt", F.explode(salts)), ["host", "salt"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = zip(*[c.to_pylist() for c in batch.columns[3:]])
            texts = [
                main_text(read(p or "")[0], *[set(x or ()) for x in own]) for p, own in zip(batch.column(2).to_pylist(), lists)
            ]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", *roles).mapInArrow(
        cut, "page_id bigint, url string, text string, n_chars bigint"
    )

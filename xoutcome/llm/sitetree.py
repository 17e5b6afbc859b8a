"""Main text of web pages by site style trees.

The DOMs of a host are merged along the paths of their elements. Per path, over the host's pages:

* presentation: the entropy of the ways in which the path's children follow each other, in parts of ln(pages);
* content: 1 - mean over distinct texts of ln(pages with the text) / ln(pages): 0 if every text is on every page,
  1 if none comes twice;
* the importance of a branch: (1 - g) * presentation + g * the mean content of all leaves below it, weighted by their
  numbers of distinct texts, with g = ``GAMMA`` to the power of the number of ways.

A host with few pages says little, so its values are drawn to those of all hosts merged to one tree, as if that had
``PRIOR_PAGES`` pages. A branch below ``KEEP`` is removed from each page, unless its markup says article or main;
elements whose markup says menu, header, footer, sidebar, notice, advert, form, script or comment always are.

Null and empty pages, and pages without a block that stays, have an empty text. A page without a host belongs to the
host ''. Repeated rows stay repeated. Columns other than the three named are left behind.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.dom import read
from xoutcome.session import stored

GAMMA = 0.9
KEEP = 0.6
PRIOR_PAGES = 20
BROADCAST_HOSTS = 100_000
BROADCAST_BYTES = 64 << 20
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def node_counts(pages: DataFrame) -> DataFrame:
    """(host, path, kind, feature, pages): on how many pages a path has a text, a way of its children, or is at all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host = host_of(url)
                blocks, children = read(html)
                own = {(host, b.path, "text", xxhash.xxh3_64_intdigest(b.text.encode()) - (1 << 63)) for b in blocks}
                for path, names in children.items():
                    way = "/".join(n for k, n in enumerate(names) if not k or n != names[k - 1])
                    own.add((host, path, "way", xxhash.xxh3_64_intdigest(way.encode()) - (1 << 63)))
                own |= {(host, p, "pages", 0) for p in {k[1] for k in own}}
                count.update(own)
            yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in count], t) for i, t in enumerate(
                (pa.string(), pa.string(), pa.string(), pa.int64()))), pa.array(count.values(), pa.int64())],
                names=["host", "path", "kind", "feature", "pages"])
    return pages.select("url", "html").mapInArrow(run, "host string, path string, kind string, feature long, pages long").groupBy(
        "host", "path", "kind", "feature").agg(F.sum("pages").alias("pages"))


def _node_values(counts: DataFrame, *by: str) -> DataFrame:
    """Per path: pages, presentation, number of ways, content, number of distinct texts."""
    n, log = F.col("pages"), F.log("pages")
    text, way = F.col("kind") == "text", F.col("kind") == "way"
    sums = counts.groupBy(*by).agg(
        F.max(F.when(F.col("kind") == "pages", n)).alias("m"),
        F.sum(F.when(text, log)).alias("text_logs"), F.count(F.when(text, 1)).alias("texts"),
        F.sum(F.when(way, n)).alias("way_pages"), F.sum(F.when(way, n * log)).alias("way_logs"), F.count(F.when(way, 1)).alias("ways"))
    log_m = F.log("m")

    def from_many(value: Column) -> Column:
        return F.when(F.col("m") > 1, value).otherwise(1.0)
    return sums.select(
        *by, "m", "texts", "ways",
        F.when(F.col("texts") > 0, from_many(1 - F.col("text_logs") / (F.col("texts") * log_m))).alias("content"),
        F.when(F.col("ways") > 0, from_many((F.log("way_pages") - F.col("way_logs") / F.col("way_pages")) / log_m)).alias("way"))


def branch_importance(counts: DataFrame) -> DataFrame:
    """(host, path, importance) of every path that any page of a host has."""
    own = _node_values(counts, "host", "path")
    merged = _node_values(counts.groupBy("path", "kind", "feature").agg(F.sum("pages").alias("pages")), "path")
    weight = F.col("m") / (F.col("m") + PRIOR_PAGES)

    def drawn(c: str) -> Column:
        return (weight * F.col(c) + (1 - weight) * F.coalesce(F.col(f"all_{c}"), F.col(c))).alias(c)
    nodes = own.join(merged.select("path", F.col("content").alias("all_content"), F.col("way").alias("all_way")), "path").select(
        "host", "path", "texts", "ways", drawn("content"), drawn("way"))
    steps = F.split("path", "/")  # the first is empty
    above = F.transform(F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))), lambda k: F.concat_ws("/", F.slice(steps, 1, k)))
    leaves = nodes.where("texts > 0").select("host", F.explode(above).alias("path"), "texts", "content").groupBy("host", "path").agg(
        (F.sum(F.col("content") * F.col("texts")) / F.sum("texts")).alias("below"))
    g = F.when(F.col("ways") > 0, F.pow(F.lit(GAMMA), F.col("ways"))).otherwise(1.0)
    return leaves.join(nodes.select("host", "path", "ways", "way"), ["host", "path"], "left").select(
        "host", "path", ((1 - g) * F.coalesce("way", F.lit(0.0)) + g * F.col("below")).alias("importance"))


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    pages = df.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                      F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    low = stored(branch_importance(stored(node_counts(pages), "nodes")).where(F.col("importance") < KEEP).groupBy("host").agg(
        F.collect_list("path").alias("low")), "low-branches")
    # Hosts without a low branch need no row. The list goes to all tasks only if it is small.
    n, size = low.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.array_join("low", ","))), F.lit(0))).first()
    few = n <= BROADCAST_HOSTS and size <= BROADCAST_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html, low_paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                bad = set(low_paths or ())
                keep = []
                for b in read(html)[0]:
                    steps = b.path.split("/") if bad and not b.main else ()
                    if not b.noise and not any("/".join(steps[:k]) in bad for k in range(2, len(steps) + 1)):
                        keep.append(b.text)
                out.append(" ".join(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out), pa.array([len(t) for t in out], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    # The host by the same rule as in host_of.
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)).alias("host")
    joined = pages.select("*", host).join(F.broadcast(low) if few else low, "host", "left")
    kind = dict(df.dtypes)[id_col]
    return joined.select("page_id", "url", "html", "low").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")

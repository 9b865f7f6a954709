"""The main text of web pages: site style trees.

The pages of a host are merged: elements with the same tags and classes from the root are one node of the host's style tree.
A node's presentation is important as far as its layout varies (entropy of the ways its children are laid out), its content as
far as its texts are not shared (one less the mean entropy of each text over the host's pages). Both are entropies to the base
of the number of pages. A node of low composite importance is noise; pages lose their text in such branches. Elements that say
themselves that they are no article (menus, forms, adverts, reader comments and the like) are left out before; where a page
marks its article or main part, only that is looked at.

Pages with the same longest block are copies and count as one, so that an article that a host has many times is not noise. A
host of fewer than ``FEWEST`` pages says too little about its nodes and keeps them all.

Nodes are hashes, so the tree is narrow rows, counted before and after the shuffle; a host with a third of all pages has its
nodes spread by their texts. The noise nodes of a host, a short list, come back to its pages by a join.

Defined results: a null or empty html has an empty text, a null url is one host of its own. Repeated rows are copies and count
once in the tree; each gets its text. Broken markup is read as far as it goes. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.page_text import Page, parse
from silverloom.llm.ship import ship
from silverloom.llm.tables import settled

#: Least composite importance of a node that is kept, the weight of its content, and the fewest pages that can tell.
LEAST, CONTENT, FEWEST = 0.3, 0.9, 10
_CONTENT, _LAYOUT = 0, 1


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def article_blocks(page: Page) -> list[tuple[int, str]]:
    """Style path and text of the blocks of the marked article, or of the whole page where none is marked."""
    inside = [(style, text) for style, marked, text in page.blocks if marked]
    return inside or [(style, text) for style, _, text in page.blocks]


def style_nodes(pages: DataFrame) -> DataFrame:
    """host, node, kind, feature, page (a hash for all copies) of every content and layout; ``pages`` has host and html."""
    from xxhash import xxh64_intdigest

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = parse(html)
                blocks = article_blocks(page)
                longest = max((text for _, text in blocks), key=lambda t: (len(t), t), default="")
                name = xxh64_intdigest(longest) >> 1
                rows = {(style, _CONTENT, xxh64_intdigest(text) >> 1) for style, text in blocks}
                rows |= {(style, _LAYOUT, layout) for style, layout in page.styles}
                for style, kind, feature in rows:
                    for column, value in zip(out, (host, style, kind, feature, name), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["host", "node", "kind", "feature", "page"])

    return pages.select("host", "html").mapInArrow(find, "host long, node long, kind int, feature long, page long").distinct()


def importance(nodes: DataFrame) -> DataFrame:
    """host, node, pages (of the host) and composite importance."""
    pages = nodes.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    pages = settled(pages, "hosts")
    shared = nodes.groupBy("host", "node", "kind", "feature").agg(F.count(F.lit(1)).alias("n"))
    entropy = F.log("n") / F.log("pages")  # of a text over the pages that have it
    counted = shared.join(pages, "host").where(F.col("pages") >= FEWEST)
    by_node = counted.groupBy("host", "node").agg(
        F.avg(F.when(F.col("kind") == _CONTENT, 1 - entropy)).alias("content"),
        F.sum(F.when(F.col("kind") == _LAYOUT, F.col("n"))).alias("laid"),
        F.sum(F.when(F.col("kind") == _LAYOUT, F.col("n") * F.log("n"))).alias("weight"),
        F.max("pages").alias("pages"),
    )
    layout = F.coalesce((F.log("laid") - F.col("weight") / F.col("laid")) / F.log("pages"), F.lit(0.0))
    value = (1 - CONTENT) * layout + CONTENT * F.col("content")
    return by_node.where("content is not null").select("host", "node", "pages", value.alias("importance"))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: float = LEAST) -> DataFrame:
    """page_id, url and text of every page."""
    ship(pages.sparkSession)
    hosted = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.xxhash64(host_of(F.col(url))).alias("host"), F.col(html).alias("html")
    )
    nodes = settled(style_nodes(hosted), "style_nodes")
    noise = importance(nodes).where(F.col("importance") < least).groupBy("host").agg(F.collect_list("node").alias("noise"))
    noise = settled(noise, "noise")

    @F.arrow_udf("string")
    def extract(html: pa.Array, noise: pa.Array) -> pa.Array:
        out = []
        for page, low in zip(html.to_pylist(), noise.to_pylist(), strict=True):
            low = set(low or ())
            out.append("\n".join(text for style, text in article_blocks(parse(page)) if style not in low))
        return pa.array(out, pa.string())

    return hosted.join(noise, "host", "left").select("page_id", "url", extract("html", "noise").alias("text"))

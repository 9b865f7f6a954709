"""Near-duplicate vectors: inverted lists, product-quantised residuals, exact cosines.

A sample of at most ``FIT`` vectors is clustered on the driver into coarse centres and, of what is left beside them, into
subspace codes. Every vector is then in the list of its nearest centre, with its codes and the length of what the codes miss.
As a query it probes each list whose centre is hardly farther than its own: in squared distance by ``MARGIN``, or by what a
partner at the limit can cross between the two centres. That is twice its distance by the centres', and ``SPREAD`` / root of the
dimension of it, for few directions lead from one centre to the other; in one or two dimensions the whole, which loses none. In a list its
distances to the coded vectors are sums of table entries; the triangle inequality turns them into a lower bound, so no partner
in a probed list is lost. What may be near enough is compared by exact cosine in double precision. A pair is found where either
of the two probes the list of the other; the tests hold the recall against all pairs, see the README.

Lists are split into blocks of about ``BLOCK`` vectors, which queries pass one after the other: no task holds more than a block
and a batch. Equal vectors are one. Links are counted where they are found; for the components a block reports a spanning
forest and not its pairs, so thousands of near copies make thousands of rows.

Vectors of all lengths are in one index; only those of one length are compared. The index sees each unit vector's first
components, as many as the most common length has (of equals, the larger), with zeros where there are fewer: leaving components
out only brings vectors nearer, so the bounds hold, and the cosine is that of the whole vectors.

Defined results: a vector that is null, empty, zero, or has a null or non-finite component links with nothing, nor does one
without vec_id; such rows have no links and are components
of their own. Repeated rows are vectors of their own that link. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.components import connected_components
from silverloom.llm.ship import ship
from silverloom.llm.tables import settled

LEAST = 0.9
#: Vectors that the codes are fitted on; bounds of the number of lists, which is twice the root of the number of vectors.
FIT, LISTS = 20_000, (1, 4096)
PARTS, CODES = 8, 64
MARGIN, SPREAD = 0.12, 1.5
BLOCK = 1024
#: Queries that are compared with a block at once.
TOGETHER = 256


@dataclass
class Codebook:
    centres: np.ndarray  # lists x dimension
    parts: np.ndarray  # parts x codes x dimension of a part
    edges: np.ndarray  # where the parts begin

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to all centres, and the nearest."""
        d = (x**2).sum(1)[:, None] - 2 * x @ self.centres.T + (self.centres**2).sum(1)
        return d, d.argmin(1)

    def margin(self, apart: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """How much farther a probed centre may be, by its squared distance to the own one and the vectors' length."""
        return np.maximum(MARGIN, 2 * np.sqrt((2 - 2 * LEAST) * np.maximum(apart, 0)) * np.minimum(1, SPREAD / np.sqrt(size)))

    def split(self, rest: np.ndarray) -> Iterator[np.ndarray]:
        for i in range(len(self.edges) - 1):
            yield rest[:, self.edges[i] : self.edges[i + 1]]

    def tables(self, rest: np.ndarray) -> np.ndarray:
        """rows x parts x codes: squared distance of each part to each code."""
        out = []
        for part, codes in zip(self.split(rest), self.parts, strict=True):
            codes = codes[:, : part.shape[1]]
            out.append((part**2).sum(1)[:, None] - 2 * part @ codes.T + (codes**2).sum(1))
        return np.maximum(np.stack(out, axis=1), 0)

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they miss."""
        tables = self.tables(rest)
        return tables.argmin(2).astype(np.uint8), np.sqrt(tables.min(2).sum(1))


def _clusters(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of k-means from spread-out rows; a centre that loses its rows stays."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([
            ((centres**2).sum(1) - 2 * part @ centres.T).argmin(1) for part in np.array_split(x, max(1, len(x) // 4096))
        ])
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def fit(vectors: DataFrame, lists: int, width: int) -> Codebook:
    """A codebook from the first ``width`` components of a sample of the vectors ``x``; ``vectors`` has node and x."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(_heads(batch.column("x"), width).ravel())
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(values, width).cast(pa.list_(pa.float64()))], ["x"])

    count = vectors.count()
    chance = F.pmod(F.xxhash64("node", F.lit("fit")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = vectors.where(chance < min(1.0, FIT / max(count, 1))).orderBy(F.xxhash64("node")).select("x")
    rows = sample.mapInArrow(heads, "x array<double>").toArrow()["x"]
    if not len(rows):
        rows = vectors.limit(1).select("x").mapInArrow(heads, "x array<double>").toArrow()["x"]
    x = rows.combine_chunks().flatten().to_numpy().reshape(-1, width)
    centres = _clusters(x, min(lists, len(x)))
    edges = np.unique(np.linspace(0, x.shape[1], PARTS + 1).astype(int))
    book = Codebook(centres, np.empty(0), edges)
    rest = x - centres[book.place(x)[1]]
    width = int(np.diff(edges).max())
    parts = [np.pad(_clusters(p, min(CODES, len(p))), ((0, 0), (0, width - p.shape[1]))) for p in book.split(rest)]
    return Codebook(centres, np.stack(parts), edges)


def _units(column: pa.Array) -> np.ndarray:
    """Vectors brought to length 1, in double precision; by the largest component first, so that no square is lost."""
    if not len(column):
        return np.empty((0, 0))
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _head(units: np.ndarray, width: int) -> np.ndarray:
    """The first components, with zeros behind where there are fewer."""
    return np.pad(units[:, :width], ((0, 0), (0, max(0, width - units.shape[1]))))


def _heads(column: pa.Array, width: int) -> np.ndarray:
    """The same of a column of vectors, whatever their lengths."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[rows] = _head(_units(column.take(pa.array(rows))), width)
    return out


def _index(vectors: DataFrame, book) -> DataFrame:
    """Adds the list of every vector, the squared distance to its centre, and the lists it probes."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = book.value
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                d, near = b.place(_heads(part.column("x"), b.centres.shape[1]))
                least = d[np.arange(len(near)), near]
                reach = least[:, None] + b.margin(b.place(b.centres[near])[0], part.column("d").to_numpy()[:, None])
                probes = [np.flatnonzero(row <= far).astype(np.int32) for row, far in zip(d, reach, strict=True)]
                columns = [*part.columns, pa.array(near.astype(np.int32)), pa.array(least), pa.array(probes, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "list", "least", "probes"])

    kind = vectors.schema["x"].dataType.simpleString()
    return vectors.select("node", "n", "d", "x").mapInArrow(place, f"node long, n long, d int, x {kind}, list int, least double, probes array<int>")


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest number linked to each of ``size`` numbers by the pairs."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Block:
    """The coded vectors of one block of a list, all of one length."""

    def __init__(self, book: Codebook, at: int, rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows).combine_chunks()
        self.book, self.centre = book, book.centres[at]
        self.node, self.n, self.least = (table[c].to_numpy() for c in ("node", "n", "least"))
        self.x = _units(table["x"].combine_chunks())
        self.head = _head(self.x, len(self.centre))
        self.codes, self.missed = book.encode(self.head - self.centre)

    def search(self, part: pa.RecordBatch, at: int) -> tuple[np.ndarray, ...] | None:
        """(a, b, links): links found for a, and a forest of the links."""
        node, n, home = (part.column(c).to_numpy() for c in ("node", "n", "list"))
        q = _units(part.column("x"))
        tables = self.book.tables(_head(q, len(self.centre)) - self.centre)
        near = np.zeros((len(q), len(self.x)))
        for i in range(tables.shape[1]):
            near += tables[:, i][:, self.codes[:, i]]
        reach = sqrt(2 - 2 * LEAST) + 1e-6 + self.missed
        i, j = np.nonzero((near <= reach**2) & (node[:, None] != self.node))
        cosine = np.einsum("ij,ij->i", q[i], self.x[j])
        i, j = i[cosine >= LEAST], j[cosine >= LEAST]
        if not len(i):
            return None
        other = self.book.centres[home[i]]
        margin = self.book.margin(((other - self.centre) ** 2).sum(1), self.x.shape[1])
        both = ((self.head[j] - other) ** 2).sum(1) <= self.least[j] + margin - 1e-9
        both |= home[i] == at
        asked = np.bincount(i, self.n[j], len(q)).astype(np.int64)
        told = np.bincount(j[~both], n[i[~both]], len(self.x)).astype(np.int64)
        ids, place = np.unique(np.concatenate([node, self.node]), return_inverse=True)
        label = _forest(place[i], place[len(q) + j], len(ids))
        tied = np.flatnonzero(label != np.arange(len(ids)))
        a = np.concatenate([node[asked > 0], self.node[told > 0], ids[tied]])
        b = np.concatenate([np.full((asked > 0).sum() + (told > 0).sum(), -1), ids[label[tied]]])
        links = np.concatenate([asked[asked > 0], told[told > 0], np.zeros(len(tied), np.int64)])
        forest = np.concatenate([np.zeros(len(a) - len(tied), bool), np.ones(len(tied), bool)])
        return a, b, links, forest


def _links(index: DataFrame, book, blocks: DataFrame) -> DataFrame:
    """a, b, links, forest, by the number of blocks of each list and length: counts of links (b is empty), and links (a, b) that span what is linked."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, now, rows, block = book.value, None, [], None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("probe", "d", "block", "asks")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for start, end in zip([0, *change], [*change, batch.num_rows], strict=True):
                at = tuple(int(k[start]) for k in keys)
                if at[:3] != now:
                    now, rows, block = at[:3], [], None
                if not at[3]:
                    rows.append(batch.slice(start, end - start))
                    continue
                if not rows:
                    continue
                block = block or _Block(b, now[0], rows)
                for i in range(start, end, TOGETHER):
                    found = block.search(batch.slice(i, min(TOGETHER, end - i)), now[0])
                    if found is not None:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["a", "b", "links", "forest"])

    columns = ["node", "n", "d", "x", "list", "least"]
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    data = index.select(*columns, F.col("list").alias("probe")).join(blocks, ["probe", "d"])
    data = data.select(*columns, "probe", own.alias("block"), F.lit(0).alias("asks"))
    asks = index.select(*columns, F.explode("probes").alias("probe")).join(blocks, ["probe", "d"])
    every = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    asks = asks.select(*columns, "probe", every.alias("block"), F.lit(1).alias("asks"))
    placed = data.unionByName(asks).repartition("probe", "d", "block")
    ordered = placed.sortWithinPartitions("probe", "d", "block", "asks")
    return ordered.mapInArrow(search, "a long, b long, links long, forest boolean")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links and component_id of every row."""
    spark = vectors.sparkSession
    ship(spark)
    x = F.col("x")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    kind = "array<float>" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast(kind).alias("x"))
    rows = rows.select("vec_id", "x", F.coalesce(sound & F.col("vec_id").isNotNull(), F.lit(False)).alias("sound"))
    rows = rows.withColumns({"e": F.when(F.col("sound"), F.xxhash64("x")), "f": F.when(F.col("sound"), F.xxhash64(F.lit("second"), "x"))})
    common = rows.where("sound").groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if common is None:
        return alone
    classes = rows.where("sound").groupBy("e", "f", F.size("x").alias("d"))
    classes = settled(
        classes.agg(F.min("vec_id").cast("long").alias("node"), F.count(F.lit(1)).alias("n"), F.first("x").alias("x")), "vectors"
    )
    lists = min(LISTS[1], max(LISTS[0], round(2 * sqrt(classes.count()))))
    book = spark.sparkContext.broadcast(fit(classes, lists, common["d"]))
    index = settled(_index(classes, book), "inverted_lists")
    blocks = index.groupBy(F.col("list").alias("probe"), "d").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    found = settled(_links(index, book, settled(blocks, "blocks")), "vector_links")
    counts = found.where("not forest").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("forest").select("a", "b"))
    named = classes.select("e", "f", "node", "n").join(counts, "node", "left").join(groups, "node", "left")
    named = named.select(
        "e", "f", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    joined = rows.select("vec_id", "e", "f").join(named, ["e", "f"], "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )

"""SimHash near-duplicates: pigeonring filtering of candidates, exact Hamming check, connected components.

Fingerprint: over all word shingles of a text, repeats included, a bit is set where more than half of the shingle hashes
have it. Two fingerprints link where at most two bits differ.

Candidates: the 64 bits form a ring of 16 segments. If at most 2 bits differ, some segment starts a chain of which every
first l segments differ in at most l * 2 / 16 bits: none in the first 7 segments, one in the first 15. The first 7 segments
are 28 equal bits, and of the next 8 segments one half, 16 bits, is equal too. So each fingerprint gets 32 keys of 44 bits
(start, half, bits), equal keys are joined, the chain is checked, and last the whole difference. The filter loses no pair:
it is the pigeonring principle, and the tests compare with all pairs. Equal fingerprints are one row before the join, so
copies are not paired, and no key can hold more than the 2**20 fingerprints that its free bits allow.

Defined results: a null, empty or blank text has fingerprint zero and links like any other. A row without doc_id has a
fingerprint and component null, and links nothing. Rows with one doc_id are one document: what any of
its texts is linked to is one component. Ties cannot occur, since the
smallest doc_id names a component.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.components import connected_components
from silverloom.llm.ship import ship
from silverloom.llm.tables import settled

SHINGLE = 3
MOST_BITS = 2
SEED = 42
SEGMENTS = 16
#: Bytes of a text whose words are held at once.
PART = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    start = 0
    while len(data) - start > PART and (blank := _BLANK.search(data, start + PART)):
        yield data[start : blank.start()].split()
        start = blank.start()
    yield data[start:].split()


def fingerprint_of(data: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of the UTF-8 bytes of a text; the letters A-Z are taken as a-z."""
    from xxhash import xxh64_intdigest

    hashed, ones, count, tail = partial(xxh64_intdigest, seed=SEED), np.zeros(64, np.int64), 0, []
    parts = _words(data.lower())
    for words in parts:
        words = tail + words
        if len(words) >= size:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
            values = np.fromiter(map(hashed, shingles), np.uint64, len(words) - size + 1)
            for i in range(0, len(values), 1 << 16):
                bits = np.unpackbits(values[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(0, dtype=np.int64)
            count += len(values)
        tail = words[max(0, len(words) - size + 1) :]
    if not count:
        return hashed(b" ".join(tail)) if tail else 0
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint of each text as a long (the same 64 bits)."""

    @F.arrow_udf("long")
    def prints(column: pa.Array) -> pa.Array:
        found = [fingerprint_of((t.as_py() or "").encode(), size) for t in column]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return prints(text)


def _rotated(bits: str, i: int) -> Column:
    """Segment i first."""
    n = 64 // SEGMENTS * i
    return F.expr(f"shiftleft({bits}, {n}) | shiftrightunsigned({bits}, {64 - n})") if n else F.col(bits)


def _keys(bits: str) -> Column:
    """(start, half) and 44 bits that two fingerprints must share, as one long."""
    keys = []
    for i in range(SEGMENTS):
        turned = _rotated(bits, i)
        first, near, far = (F.shiftrightunsigned(turned, n) for n in (36, 20, 4))
        for half, part in enumerate((near, far)):
            tag = (2 * i + half) << 44
            keys.append(F.shiftleft(first, 16).bitwiseOR(part.bitwiseAND(F.lit(0xFFFF))).bitwiseOR(F.lit(tag)))
    return F.array(*keys)


def linked_fingerprints(nodes: DataFrame, bits: str = "bits", node: str = "node") -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints differ in at most two bits. ``nodes`` has each fingerprint once."""
    keyed = nodes.select(F.col(bits).alias("bits"), F.col(node).alias("node"), F.posexplode(_keys(bits)).alias("at", "key"))
    left = keyed.select("key", F.col("bits").alias("x"), F.col("node").alias("a"), "at")
    right = keyed.select("key", F.col("bits").alias("y"), F.col("node").alias("b"))
    differ = "(x ^ y)"
    turn = "cast(4 * (at div 2) as int)"
    turned = f"(shiftleft({differ}, {turn}) | if(at < 2, 0L, shiftrightunsigned({differ}, 64 - {turn})))"
    chain = f"bit_count(shiftrightunsigned({turned}, 4)) <= 1"
    joined = left.join(right.hint("merge"), "key")  # Spark sizes the 32 keys of a fingerprint as one and would broadcast them
    return joined.where(f"x < y and {chain} and bit_count({differ}) <= {MOST_BITS}").select("a", "b")


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and bits of every row, as a table of its own: texts are read once."""
    ship(docs.sparkSession)
    return settled(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("bits")), "fingerprints")


def _one_document(marked: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of the fingerprints that share a doc_id, each to the least of them."""
    prints = marked.where("doc_id is not null").groupBy("doc_id").agg(F.min("bits").alias("low"), F.max("bits").alias("high"))
    several = marked.join(prints.where("low < high").select("doc_id"), "doc_id").distinct().join(nodes, "bits")
    least = several.groupBy("doc_id").agg(F.min("node").alias("a"))
    return several.join(least, "doc_id").select("a", F.col("node").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, bits and component_id of every row."""
    marked = with_fingerprints(docs, doc_id, text)
    nodes = settled(marked.where("doc_id is not null").groupBy("bits").agg(F.min("doc_id").alias("node")), "nodes")
    groups = connected_components(linked_fingerprints(nodes).unionByName(_one_document(marked, nodes)))
    named = nodes.join(groups, "node", "left").select(
        F.col("bits").alias("b"), F.coalesce("component", "node").alias("component_id")
    )
    joined = marked.join(named, F.col("bits") == F.col("b"), "left")
    return joined.select("doc_id", "bits", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))

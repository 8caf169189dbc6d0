"""SimHash near-dedup with bit-sliced comparison.

Fingerprints within ``radius`` bits agree in at least two of ``radius + 2`` blocks of bits, so distinct fingerprints
are dealt to one bucket per pair of blocks; two that are linked meet in some bucket. Inside a bucket the
fingerprints stand as vertical bit planes, 64 of them per machine word. A fingerprint is compared with a word of 64
others at once: each plane adds one bit to 64 distances held in carry-save counters, and a word is abandoned as soon
as all its distances exceed the radius.

A bucket of any size is cut into chunks, and each pair of chunks is a task of its own, so none is collected whole. A
bucket returns one edge per member to the smallest fingerprint it is connected with there, never all pairs.
Connected components join the buckets' edges. Copies share a fingerprint and are folded before any of this.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import digest, one_of_each, sliced, stored, texts
from tidewell.llm.components import connected_components

SEED = 42
CHUNK = 2048
# Queries compared at once: keeps the working set of a step within a few megabytes.
QUERIES = 8192
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashed = xxhash.xxh64_digest
    digests = b"".join([
        hashed(joined[start:end], SEED)
        for start, end in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())])
    by_byte = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(by_byte[:, place], minlength=256) @ _BYTE_BITS for place in range(8)])
    return int.from_bytes(np.packbits(2 * counts > len(by_byte)).tobytes(), "big", signed=True)


def _fingerprinted(shingle: int):
    def run(batches):
        for batch in sliced(batches):
            values = [fingerprint(text, shingle) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("d1"), batch.column("d2"), pa.array(values, pa.int64())],
                ["doc_id", "d1", "d2", "fingerprint"])
    return run


def _planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes over the values; plane b holds bit b of value i in bit i % 64 of word i // 64."""
    lanes = -(-len(values) // 64) * 64
    bits = np.zeros((lanes, 64), np.uint8)
    bits[:len(values)] = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _add(a, b, c):
    """Carry-save adder: sum and carry of three bits in every lane."""
    mixed = a ^ b
    return mixed ^ c, (a & b) | (mixed & c)


def _exceeds(radius: int, ones, twos, fours, over):
    """Lanes whose three-bit count, or its overflow, is above ``radius`` (at most 7)."""
    above, equal = np.zeros_like(ones), np.full_like(ones, _ONES)
    for counter, bit in ((fours, radius & 4), (twos, radius & 2), (ones, radius & 1)):
        if bit:
            equal &= counter
        else:
            above |= equal & counter
            equal &= ~counter
    return over | above


def _near(planes, values, queries, words, masks, radius):
    """Of each query and word, the lanes of ``masks`` within ``radius``; returns the queries left and their lanes."""
    kept = np.arange(len(queries))
    mine, at = values[queries], words
    ones, twos, fours, over = (np.zeros(len(queries), np.uint64) for _ in range(4))
    for first in range(0, 64, 8):
        d = [planes[bit, at] ^ (np.uint64(0) - ((mine >> np.uint64(bit)) & np.uint64(1)))
             for bit in range(first, first + 8)]
        ones, two_a = _add(ones, d[0], d[1])
        ones, two_b = _add(ones, d[2], d[3])
        twos, four_a = _add(twos, two_a, two_b)
        ones, two_a = _add(ones, d[4], d[5])
        ones, two_b = _add(ones, d[6], d[7])
        twos, four_b = _add(twos, two_a, two_b)
        fours, eights = _add(fours, four_a, four_b)
        over = over | eights
        left = masks & ~_exceeds(radius, ones, twos, fours, over)
        alive = left != 0
        if not alive.all():
            kept, mine, at, masks = kept[alive], mine[alive], at[alive], masks[alive]
            ones, twos, fours, over, left = ones[alive], twos[alive], fours[alive], over[alive], left[alive]
            if not len(kept):
                break
    return queries[kept], at, left


def _join(parents: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the pairs; a parent is never larger than its child."""
    while True:
        roots_a, roots_b = parents[a], parents[b]
        apart = roots_a != roots_b
        if not apart.any():
            return
        a, b, roots_a, roots_b = a[apart], b[apart], roots_a[apart], roots_b[apart]
        np.minimum.at(parents, np.maximum(roots_a, roots_b), np.minimum(roots_a, roots_b))
        while not np.array_equal(parents, shorter := parents[parents]):
            parents[:] = shorter


def roots_within(values: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """For each value the first row it is connected with in its group, by links of at most ``radius`` bits.

    ``values`` are unsigned 64-bit, group after group; ``ends`` is the end of each row's group.
    """
    parents, planes = np.arange(len(values)), _planes(values)
    for start in range(0, len(values), QUERIES):
        queries = np.arange(start, min(start + QUERIES, len(values)))
        queries = queries[ends[queries] > queries + 1]
        words = (queries + 1) >> 6
        while len(queries):
            low = np.maximum(queries + 1 - (words << 6), 0).astype(np.uint64)
            high = np.minimum(ends[queries] - (words << 6), 64).astype(np.uint64)
            masks = (_ONES << low) & (_ONES >> (np.uint64(64) - high))
            found, at, lanes = _near(planes, values, queries, words, masks, radius)
            if len(found):
                row, lane = np.nonzero(np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                _join(parents, found[row], (at[row] << 6) + lane)
            words = words + 1
            more = (words << 6) < ends[queries]
            queries, words = queries[more], words[more]
    return parents


def _linked(radius: int):
    """Edges inside each bucket; rows come sorted by bucket, and the last one of a batch waits for the next."""
    def edges(keys: np.ndarray, values: np.ndarray):
        change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate((change, [len(values)]))
        ends = np.repeat(bounds, np.diff(np.concatenate(([0], bounds))))
        roots = roots_within(values, ends, radius)
        rows = np.flatnonzero(roots != np.arange(len(values)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[rows].view(np.int64)), pa.array(values[roots[rows]].view(np.int64))], ["a", "b"])

    def run(batches):
        keys, values = np.empty((0, 4), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            columns = [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                       for name in ("blocks", "bits", "low", "high", "fingerprint")]
            keys = np.concatenate((keys, np.stack(columns[:4], axis=1)))
            values = np.concatenate((values, columns[4].view(np.uint64)))
            if not len(values):
                continue
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            whole = last[-1] + 1 if len(last) else 0
            if whole:
                yield edges(keys[:whole], values[:whole])
                keys, values = keys[whole:], values[whole:]
        if len(values):
            yield edges(keys, values)
    return run


def _block_masks(radius: int) -> list[int]:
    """Bit masks of every pair of the ``radius + 2`` blocks, as signed longs."""
    bounds = [64 * block // (radius + 2) for block in range(radius + 3)]
    blocks = [(1 << high) - (1 << low) for low, high in zip(bounds, bounds[1:])]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def fingerprint_links(fingerprints: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Edges a, b between distinct fingerprints (column ``fingerprint``) that connect all within ``radius`` bits."""
    if not 0 <= radius <= 7:
        raise ValueError("radius is between 0 and 7 bits")
    dealt = fingerprints.select("fingerprint", F.posexplode(F.array(*[
        F.col("fingerprint").bitwiseAND(F.lit(mask)) for mask in _block_masks(radius)]))).toDF(
            "fingerprint", "blocks", "bits")
    crowds = dealt.groupBy("blocks", "bits").agg(F.count("*").alias("n")).filter("n > 1").select(
        "blocks", "bits", F.ceil(F.col("n") / chunk).alias("chunks"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("chunks"))
    buckets = (
        dealt.join(crowds, ["blocks", "bits"]).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("blocks", "bits", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                "fingerprint")
    )
    keys = ["blocks", "bits", "low", "high"]
    return buckets.repartition(*keys).sortWithinPartitions(*keys, "fingerprint").mapInArrow(
        _linked(radius), "a long, b long")


def near_groups(docs: DataFrame, shingle: int = 4, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """One row per input row: doc_id, d1, d2, fingerprint (long), root (fingerprint) and component_id.

    A fingerprint bit is set if more than half of the text's word shingles have it set in their XXH64; A-Z are
    lower-cased, a text of fewer words is one shingle, and one without words (also null) has fingerprint zero, which
    links like any other. Documents are in one component if a chain of fingerprints at most ``radius`` bits apart
    joins them; component_id is its smallest doc_id (null only if it has no other). d1 and d2 stand for doc_id and
    text, root for the component. Repeated rows each get their row. Other columns are ignored; an empty table gives
    an empty result.
    """
    d1, d2 = digest(F.col("doc_id"), F.col("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = stored(
        docs.select("doc_id", "text", d1.alias("d1"), d2.alias("d2")).mapInArrow(
            _fingerprinted(shingle), f"doc_id {kind}, d1 long, d2 long, fingerprint long"), "simhash")
    distinct = stored(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = connected_components(fingerprint_links(distinct, radius, chunk))
    rooted = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    components = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.select("fingerprint", "root").join(components, "root"), "fingerprint").select(
        "doc_id", "d1", "d2", "fingerprint", "root", "component_id")


def without_near_copies(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with the columns of ``docs``.

    Of rows alike in doc_id and text the one with the least digest over its other columns stays; a null doc_id stays only
    if its component has no other. Texts of any length, empty and null ones are as in ``near_groups``; an empty table
    gives an empty result.
    """
    staying = near_groups(docs, shingle, radius).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "d1", "d2")).alias("best")).select("best.d1", "best.d2")
    d1, d2 = digest(docs["doc_id"], docs["text"])
    whole = F.struct(*[docs[c] for c in docs.columns])
    packed = docs.select(d1.alias("d1"), d2.alias("d2"), whole.alias("row"))
    others = [F.col("row").getField(c) for c in docs.columns if c not in ("doc_id", "text")]
    single = one_of_each(packed, ["d1", "d2"], *others)
    return single.join(staying, ["d1", "d2"], "left_semi").select("row.*")

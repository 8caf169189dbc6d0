"""Exact dedup by Patricia-trie owners.

Texts are dealt out by byte length and content hash. In each task full byte strings go into a compressed radix trie
whose terminal nodes hold the owner of that text: the row that stays, and how many rows share the text. The same trie
first combines within each batch on the map side, so a text that a third of all rows share travels once per batch
and not once per row; there the trie spills by subtree when it holds too much. After the shuffle rows arrive sorted
by (length, hash), so the subtree of a hash is complete when the next hash begins, and is emitted and freed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import sliced, texts

# Distinct text bytes a map-side trie holds before it spills its heaviest subtree.
TRIE_BYTES = 8 << 20


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low + 1 < high:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if a[low:high] != b[low:high] else high


class _Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner = label, {}, None

    def owners(self) -> Iterator:
        waiting = [self]
        while waiting:
            node = waiting.pop()
            if node.owner is not None:
                yield node.owner
            waiting.extend(node.children.values())

    def weight(self) -> int:
        total, waiting = 0, [self]
        while waiting:
            node = waiting.pop()
            total += len(node.label) + 200
            waiting.extend(node.children.values())
        return total


class PatriciaTrie:
    """Byte strings to owners; an owner is [rank, row, copies] and the highest rank stays."""

    def __init__(self):
        self.root, self.held = _Node(b""), 0

    def insert(self, key: bytes, rank, row: int, copies: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                node.children[key[at]] = child
                self.held += len(child.label) + 200
                node, at = child, len(key)
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            common = _shared(label, key[at:at + len(label)])
            middle = _Node(label[:common])
            child.label = label[common:]
            middle.children[child.label[0]] = child
            node.children[label[0]] = middle
            self.held += 200
            node, at = middle, at + common
        if node.owner is None:
            node.owner = [rank, row, copies]
        else:
            node.owner[2] += copies
            if rank > node.owner[0]:
                node.owner[:2] = rank, row

    def spill(self) -> Iterator:
        """Take out the heaviest subtree below the root and yield its owners."""
        if not self.root.children:
            return
        weights = {first: child.weight() for first, child in self.root.children.items()}
        first = max(weights, key=weights.get)
        self.held -= weights[first]
        yield from self.root.children.pop(first).owners()

    def drain(self) -> Iterator:
        yield from self.root.owners()


def _emit(batch: pa.RecordBatch, owners) -> pa.RecordBatch | None:
    """The owners' rows of a batch, with the copies they now stand for."""
    owners = sorted(owners, key=lambda owner: owner[1])
    if not owners:
        return None
    rows = batch.take(pa.array([owner[1] for owner in owners], pa.int64()))
    at = rows.schema.get_field_index("copies")
    return rows.set_column(at, rows.schema.field(at), pa.array([owner[2] for owner in owners], pa.int64()))


def _ranks(batch: pa.RecordBatch, largest: bool) -> list:
    """Rows in order of preference: the wanted end of the ids, null last, then a hash of the row."""
    ids, ties = batch.column("id").to_pylist(), batch.column("tie").to_pylist()
    if largest:
        return [(False, 0, tie) if i is None else (True, i, tie) for i, tie in zip(ids, ties)]
    return [(False, _Down(0), tie) if i is None else (True, _Down(i), tie) for i, tie in zip(ids, ties)]


class _Down:
    """Turns the order of ids of any type around."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __gt__(self, other):
        return self.value < other.value

    def __lt__(self, other):
        return self.value > other.value

    def __eq__(self, other):
        return self.value == other.value


def _combined(largest: bool, limit: int):
    def run(batches):
        for batch in sliced(batches, limit=limit):
            trie = PatriciaTrie()
            for row, (text, rank, copies) in enumerate(
                    zip(texts(batch), _ranks(batch, largest), batch.column("copies").to_pylist())):
                trie.insert(text, rank, row, copies)
                if trie.held > limit and (part := _emit(batch, trie.spill())):
                    yield part
            if part := _emit(batch, trie.drain()):
                yield part
    return run


def _final(largest: bool):
    """Rows come sorted by (length, hash); the last key of a batch waits for the next batch."""
    def run(batches):
        waiting = None
        for batch in sliced(batches):
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            keys = list(zip(batch.column("length").to_pylist(), batch.column("hash").to_pylist()))
            content, ranks, copies = texts(batch), _ranks(batch, largest), batch.column("copies").to_pylist()
            done, trie, before = [], PatriciaTrie(), None
            for row, key in enumerate(keys):
                if key != before:
                    done.extend(trie.drain())
                    trie, before = PatriciaTrie(), key
                trie.insert(content[row], ranks[row], row, copies[row])
            waiting = _emit(batch, trie.drain())
            if part := _emit(batch, done):
                yield part
        if waiting is not None:
            yield waiting
    return run


def exact_owners(docs: DataFrame, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The row that stays of each distinct text, as it was (column ``row``), with ``copies``, the rows of that text.

    ``keep`` names the end of the doc_ids that stays. Null text counts as empty, so nulls and empty texts are one
    group; the row returned keeps its null. A null doc_id stays only if the text has no other; rows that agree in
    text and doc_id are told apart by a hash over all their columns, and one row of them stays. Other columns may
    have any name, since the whole row travels as one struct. An empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    content = F.coalesce(docs["text"], F.lit(""))
    others = [name for name in docs.columns if name != "text"]
    rows = docs.select(
        F.struct(*[docs[name] for name in others]).alias("row"), docs["doc_id"].alias("id"), content.alias("text"),
        docs["text"].isNull().alias("was_null"), F.octet_length(content).alias("length"),
        F.xxhash64(content).alias("hash"), F.xxhash64(*[docs[name] for name in docs.columns]).alias("tie"),
        F.lit(1).cast("long").alias("copies"),
    )
    combined = rows.mapInArrow(_combined(keep == "largest", trie_bytes), rows.schema)
    dealt = combined.repartition("length", "hash").sortWithinPartitions("length", "hash")
    owners = dealt.mapInArrow(_final(keep == "largest"), rows.schema)
    text = F.when(~F.col("was_null"), F.col("text"))
    whole = F.struct(*[(text if name == "text" else F.col("row").getField(name)).alias(name) for name in docs.columns])
    return owners.select(whole.alias("row"), "copies")


def exact_groups(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows that repeat both text and doc_id each get their row; where that doc_id stays, one of them is kept. Ids and
    hashes only are shuffled here; nulls and ties are as in ``exact_owners``.
    """
    content = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    owners = exact_owners(docs, keep).select(
        F.col("row.doc_id").alias("keep_id"), F.col("copies").alias("group_size"),
        F.sha2(F.coalesce(F.col("row.text"), F.lit("")), 256).alias("text_sha256"))
    rows = docs.select("doc_id", content.alias("text_sha256")).groupBy("doc_id", "text_sha256").agg(
        F.count("*").alias("repeats"))
    return (
        rows.join(owners, "text_sha256")
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
        .select("doc_id", "keep_id", "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")
    )


def without_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return exact_owners(docs, keep).select("row.*")

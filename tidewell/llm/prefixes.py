"""Conversation prefix tries: adaptive radix trees over fixed-width turn ids.

A turn is known by 20 bytes: 16 of a digest of its role and text, and 4 (big-endian) of the text's length, which is what
a node needs to know about its last text. A conversation is the bytes of its turns in order, so its prefixes of whole
turns are the trie nodes it belongs to; texts themselves are never shuffled.

Equal sequences are folded to one with a count, its smallest member and the hash of its members, in one streamed pass.
Distinct sequences are dealt out by their shortest prefix that at most ``GROUP`` of them share: the first turn, or,
below a turn that too many begin with, the turns up to where these part. In each task an adaptive radix tree takes whole
groups and yields their nodes. The few nodes above the cuts are summed up from the roots of the groups.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import stored

DIGEST, LENGTH = 16, 4
WIDTH = DIGEST + LENGTH
# Distinct sequences that share a prefix are cut deeper beyond this number; bounds the tree a task holds.
GROUP = 20_000
# A tree takes groups until it holds about this many bytes of sequences.
TREE_BYTES = 4 << 20
EMPTY = hashlib.sha256(b"").hexdigest()


class _Small:
    """Up to 4, then up to 16 children: sorted first bytes beside their nodes."""

    __slots__ = ("bytes", "nodes", "most")

    def __init__(self, most: int = 4):
        self.bytes, self.nodes, self.most = [], [], most

    def get(self, byte: int):
        at = bisect_left(self.bytes, byte)
        return self.nodes[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, node):
        """The layout that holds the node: this one or, when it is full, the next larger one."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.bytes) == self.most:
            grown = _Small(16) if self.most == 4 else _Indexed()
            for old, child in zip(self.bytes, self.nodes):
                grown = grown.put(old, child)
            return grown.put(byte, node)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def children(self) -> list:
        return self.nodes


class _Indexed:
    """Up to 48 children: an index of 256 bytes into their nodes."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(b"\xff" * 256), []

    def get(self, byte: int):
        at = self.index[byte]
        return None if at == 255 else self.nodes[at]

    def put(self, byte: int, node):
        at = self.index[byte]
        if at != 255:
            self.nodes[at] = node
            return self
        if len(self.nodes) == 48:
            grown = _Direct()
            for old in range(256):
                if self.index[old] != 255:
                    grown.put(old, self.nodes[self.index[old]])
            return grown.put(byte, node)
        self.index[byte] = len(self.nodes)
        self.nodes.append(node)
        return self

    def children(self) -> list:
        return self.nodes


class _Direct:
    """Any number of children: a slot per byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def children(self) -> list:
        return [node for node in self.nodes if node is not None]


class _Node:
    """A compressed path: bytes ``start`` to ``end`` of ``key``, a sequence that runs through it; ``cut`` is the depth of
    that sequence's group."""

    __slots__ = ("key", "cut", "start", "end", "below", "value", "sums")

    def __init__(self, key: bytes, cut: int, start: int, end: int):
        self.key, self.cut, self.start, self.end = key, cut, start, end
        self.below, self.value, self.sums = None, None, None

    def attach(self, child: _Node) -> None:
        self.below = (self.below or _Small()).put(child.key[child.start], child)


def _parting(a: bytes, b: bytes, low: int, high: int) -> int:
    """The first place from ``low`` on, below ``high``, where the two differ, else ``high``; by halving."""
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    """An adaptive radix tree; a value is (members, smallest member, hash of the members)."""

    def __init__(self):
        self.root, self.held = _Node(b"", 0, 0, 0), 0

    def insert(self, key: bytes, cut: int, value: tuple) -> None:
        """A key may be inserted once; it may be a prefix of others."""
        self.held += len(key) + 300
        node = self.root
        while True:
            if node.end == len(key):
                node.value = value
                return
            child = node.below.get(key[node.end]) if node.below is not None else None
            if child is None:
                leaf = _Node(key, cut, node.end, len(key))
                leaf.value = value
                node.attach(leaf)
                return
            at = _parting(child.key, key, child.start, min(child.end, len(key)))
            if at < child.end:
                middle = _Node(child.key, child.cut, child.start, at)
                child.start = at
                middle.attach(child)
                node.attach(middle)
                child = middle
            node = child

    def nodes(self) -> Iterator[tuple]:
        """key, cut, depth, members, smallest, smallest of the parent, children, leaves, saved and hash of each node.

        A node stands at each turn-aligned depth of a path; other depths are inside of turns and none. ``key`` is a
        sequence through the node and ``cut`` the depth of its group: less deep nodes lack members of other groups.
        """
        order, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            order.append(node)
            if node.below is not None:
                waiting.extend(node.below.children())
        for node in reversed(order):
            members, low = (node.value[0], node.value[1]) if node.value else (0, None)
            heads = leaves = saved = 0
            for child in node.below.children() if node.below is not None else ():
                more, least, ends, under, spared = child.sums
                members += more
                low = least if low is None or least < low else low
                heads, leaves, saved = heads + ends, leaves + under, saved + spared
            first, last = node.start // WIDTH + 1, node.end // WIDTH
            if first <= last:
                # The path completes turns: one chain of nodes with the same members.
                heads, leaves = 1, leaves or 1
                saved += sum((members - 1) * _length(node.key, depth) for depth in range(first, last + 1))
            node.sums = (members, low, heads, leaves, saved)
        above = [(self.root, None)]
        while above:
            node, parent = above.pop()
            members, low, _, leaves, saved = node.sums
            first, last = node.start // WIDTH + 1, node.end // WIDTH
            below = node.below.children() if node.below is not None else ()
            for depth in range(first, last + 1):
                inner = depth < last
                ended = node.value[2] if not inner and node.value else EMPTY
                heads = 1 if inner else sum(child.sums[2] for child in below)
                yield node.key, node.cut, depth, members, low, parent, heads, leaves, saved, ended
                saved -= (members - 1) * _length(node.key, depth)
                parent = low
            for child in below:
                above.append((child, parent))


def _length(key: bytes, depth: int) -> int:
    return int.from_bytes(key[depth * WIDTH - LENGTH:depth * WIDTH], "big")


FOLDED = "seq binary, n long, low long, ends string"
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, cut binary")


def _fold(batches) -> Iterator[pa.RecordBatch]:
    """One row per sequence from rows sorted by (seq, conv); ids are hashed as they pass and never held."""
    key, count, low, hashed = None, 0, None, None
    for batch in batches:
        done = []
        seqs, ids = batch.column("seq"), batch.column("conv").cast(pa.string()).to_pylist()
        sequences = seqs.to_pylist()
        start = 0
        while start < len(sequences):
            stop = start + 1
            while stop < len(sequences) and sequences[stop] == sequences[start]:
                stop += 1
            if sequences[start] != key:
                if key is not None:
                    done.append((key, count, low, hashed.hexdigest()))
                key, count, low, hashed = sequences[start], 0, int(ids[start]), hashlib.sha256()
            hashed.update(((b"," if count else b"") + ",".join(ids[start:stop]).encode()))
            count += stop - start
            start = stop
        if done:
            yield _batch(done, _FOLDED)
    if key is not None:
        yield _batch([(key, count, low, hashed.hexdigest())], _FOLDED)


_FOLDED = pa.schema([("seq", pa.binary()), ("n", pa.int64()), ("low", pa.int64()), ("ends", pa.string())])
_NODES = pa.schema([(name, pa.int64()) for name in (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [
    ("ends_sha256", pa.string()), ("cut", pa.binary())])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def _trees(limit: int):
    """Nodes of the groups of a partition, sorted by (cut, seq); ``cut`` is filled where a node is a group's root."""
    def emit(tree: RadixTree):
        rows = []
        for key, cut, depth, members, low, parent, heads, leaves, saved, ended in tree.nodes():
            if depth >= cut:
                root = key[:depth * WIDTH] if depth == cut else None
                rows.append((low, depth, None if root else parent, members, heads, leaves, saved, ended, root))
            if len(rows) == 10_000:
                yield _batch(rows, _NODES)
                rows = []
        if rows:
            yield _batch(rows, _NODES)

    def run(batches):
        tree, before = RadixTree(), None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("cut", "seq", "n", "low", "ends")]
            for cut, seq, n, low, ends in zip(*columns):
                if cut != before and tree.held > limit:
                    yield from emit(tree)
                    tree = RadixTree()
                before = cut
                tree.insert(seq, len(cut) // WIDTH, (n, low, ends))
        yield from emit(tree)
    return run


def _prefix(column: str, turns: Column) -> Column:
    return F.substring(F.col(column), F.lit(1), turns * WIDTH)


def rebuilt_conversations(turns: DataFrame, group: int = 5, shares: int = 9) -> DataFrame:
    """conv and seq, the turns of each rebuilt conversation as bytes.

    Conversation c begins with the first h turns of conversation c - c % ``group`` and goes on with its own after its
    first h, h = crc32(c) % ``shares``. Those at most ``group`` conversations lie in one place, so one shuffle of turn
    ids does. Turns are ordered by turn, null first; turns with equal numbers by their ids, repeated ones all count. Null
    role or text is empty. Turns without conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text)
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    known = F.concat(F.substring(F.sha2(content, 256), 1, 2 * DIGEST), F.lpad(F.hex(size), 2 * LENGTH, "0"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), (F.col("conv_id") - F.col("conv_id") % group).cast("long").alias(
            "first"), "turn", known.alias("known"))
    own = rows.repartition("first").groupBy("first", "conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "known"))).alias("turns"))
    own = own.select("first", "conv", F.unhex(F.array_join(
        F.transform("turns", lambda turn: turn["known"]), "")).alias("own"))
    lead = F.first(F.when(F.col("conv") == F.col("first"), F.col("own")), ignorenulls=True).over(
        Window.partitionBy("first"))
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(shares)).cast("int") * WIDTH
    return own.withColumn("lead", lead).withColumn("taken", taken).select("conv", F.expr(
        "concat(substring(coalesce(lead, X''), 1, taken), substring(own, taken + 1))").alias("seq"))


def _dealt(folded: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """The sequences with the prefix that they are dealt out by, and those that end above the cuts."""
    def groups(df: DataFrame) -> DataFrame:
        spread = df.groupBy("cut").agg(F.count("*").alias("n"), F.min("seq").alias("a"), F.max("seq").alias("b"))
        # What all have in common is what the least and the largest have in common.
        length = F.least(F.length("a"), F.length("b")) / WIDTH
        same = F.filter(F.sequence(F.lit(1), length.cast("int")), lambda d: _prefix("a", d) == _prefix("b", d))
        return spread.filter(F.col("n") > most).select("cut", (F.size(same) + 1).alias("until"))

    ended = [folded.filter(F.length("seq") == 0)]
    still = folded.filter(F.length("seq") > 0).withColumn("cut", _prefix("seq", F.lit(1)))
    settled = []
    while True:
        crowded = stored(groups(still), "crowded")
        if crowded.isEmpty():
            settled.append(still)
            break
        marked = still.join(crowded, "cut", "left")
        settled.append(marked.filter(F.col("until").isNull()).drop("until"))
        reach = F.length("seq") >= F.col("until") * WIDTH
        ended.append(marked.filter(F.col("until").isNotNull() & ~reach).select(folded.columns))
        still = stored(marked.filter(reach).withColumn("cut", _prefix("seq", F.col("until"))).drop("until"), "deeper")
    dealt = settled[0]
    for part in settled[1:]:
        dealt = dealt.unionByName(part.select(dealt.columns))
    return dealt, ended


def _above(roots: DataFrame, ended: DataFrame) -> DataFrame:
    """The nodes above the cuts, by ``prefix``, from the groups' roots and the sequences that end there."""
    last = F.length("cut") / WIDTH
    parts = roots.select(
        F.explode(F.sequence(F.lit(0), last.cast("int") - 1)).alias("depth"), "cut", "n_convs", "conv_id", "n_leaves",
        "saved_tokens", F.lit(None).cast("string").alias("ends"))
    own = F.col("depth") == F.length("seq") / WIDTH
    parts = parts.unionByName(ended.withColumn("depth", F.explode(
        F.sequence(F.lit(0), (F.length("seq") / WIDTH).cast("int")))).select(
        "depth", F.col("seq").alias("cut"), F.col("n").alias("n_convs"), F.col("low").alias("conv_id"),
        F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(own, F.col("ends")).alias("ends")))
    nodes = stored(parts.groupBy(_prefix("cut", F.col("depth")).alias("prefix"), "depth").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_below"), F.max("ends").alias("ends")), "above")
    size = F.conv(F.hex(F.expr(f"substring(prefix, -{LENGTH}, {LENGTH})")), 16, 10).cast("long")
    spared = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * size).otherwise(F.lit(0).cast("long"))
    saved = nodes.select(F.explode(F.sequence(F.lit(0), "depth")).alias("d"), "prefix", spared.alias("spared")).groupBy(
        _prefix("prefix", F.col("d")).alias("prefix")).agg(F.sum("spared").alias("spared"))
    tops = nodes.filter(F.col("depth") > 0).select(_prefix("prefix", F.col("depth") - 1).alias("prefix"))
    children = tops.unionByName(roots.select(_prefix("cut", last.cast("int") - 1).alias("prefix"))).groupBy(
        "prefix").agg(F.count("*").alias("n_children"))
    return nodes.join(saved, "prefix").join(children, "prefix", "left").select(
        "prefix", "conv_id", F.col("depth").cast("long").alias("depth"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        # Only a root without turns below it has no leaf under it, and is one.
        F.greatest("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        (F.col("saved_below") + F.col("spared")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_nodes(turns: DataFrame, group: int = 5, shares: int = 9, most: int = GROUP,
                 tree_bytes: int = TREE_BYTES) -> DataFrame:
    """One row per distinct prefix of rebuilt conversations, in the columns of the contract.

    Nulls, ties and repeated rows are as in ``rebuilt_conversations``; conversations left without turns are members of
    the root alone. An empty table has no nodes, not even a root. A text of any length is its 20 bytes; a conversation
    of very many turns is one path, whose turn ids (not texts) pass one task. Other columns are ignored.
    """
    rebuilt = rebuilt_conversations(turns, group, shares)
    sorted_rows = rebuilt.repartition("seq").sortWithinPartitions("seq", "conv")
    folded = stored(sorted_rows.mapInArrow(_fold, FOLDED), "folded")
    dealt, ended = _dealt(folded, most)
    below = stored(dealt.repartition("cut").sortWithinPartitions("cut", "seq").mapInArrow(_trees(tree_bytes), NODES), "nodes")
    early = ended[0]
    for part in ended[1:]:
        early = early.unionByName(part)
    roots = below.filter(F.col("cut").isNotNull())
    above = stored(_above(roots, early), "tops")
    parents = above.select(F.col("prefix").alias("up"), F.col("conv_id").alias("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    def placed(df: DataFrame, at: str, how: str) -> DataFrame:
        up = F.expr(f"substring({at}, 1, length({at}) - {WIDTH})")
        return df.drop("parent_conv_id").withColumn("up", F.when(F.length(at) > 0, up)).join(parents, "up", how).select(
            *[F.col("parent").alias(name) if name == "parent_conv_id" else F.col(name) for name in columns])
    inner = below.filter(F.col("cut").isNull()).select(columns)
    return inner.unionByName(placed(roots, "cut", "inner")).unionByName(placed(above, "prefix", "left"))

"""Substring dedup: word windows that stand in two places are found by suffix automata and removed.

A suffix automaton of every shard of the corpus, broadcast to all documents, would read the whole corpus once per
shard: its work grows with the square of the input. Here documents stream only past the shards they can match. Every
window has an anchor, its least hashed word k-gram, so equal windows have equal anchors; neighbouring windows share
one and form a region. Regions of an anchor seen once cannot repeat, and regions equal as a whole are folded to one
with a weight. What is left, the distinct regions of an anchor, is a reference shard: its suffix automaton counts
the occurrences of each state, and each region streams through it for the matching statistics of its windows.

Documents are packed into slices that ask tables partitioned by anchor and get answers in the order they asked; a
text moves twice, compressed. An anchor with very many distinct regions (a common phrase) is dealt out by whole
windows instead, so no shard grows with the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import sliced, stored, texts
from tidewell.llm.katz import pack, pack_sorted, unpack, unpack_sorted

SLICE = 2 << 20
# Windows whose anchors are found at once; a step copies all k-grams of each.
STEP = 1 << 15
PARTITION = 1 << 18
# Least words of an anchor; longer for long windows, so that a region has 64 windows at most.
ANCHOR = 8
# Anchors with more distinct regions than this, or than this share of all regions if that is more, are dealt out by
# windows. The share bounds the list of such anchors, which is broadcast.
WIDE, WIDE_SHARE = 512, 50_000
ALL = 64  # in place of a window's number: all windows of the region
ONCE, SAME, MIXED = 0, 1, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


class SuffixAutomaton:
    """All substrings of several word sequences; each state knows how often its substrings occur, by weight."""

    def __init__(self):
        self.next, self.link, self.length, self.count = [{}], [-1], [0], [0]

    def _new(self, length: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, state: int, word, target: int) -> int:
        """A copy of ``target`` that ends the substrings of ``state`` extended by ``word``."""
        copy = self._new(self.length[state] + 1, dict(self.next[target]))
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words, weight: int) -> None:
        last = 0
        for word in words:
            target = self.next[last].get(word)
            if target is not None:
                last = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
            else:
                state = self._new(self.length[last] + 1, {})
                while last != -1 and word not in self.next[last]:
                    self.next[last][word] = state
                    last = self.link[last]
                if last != -1:
                    target = self.next[last][word]
                    exact = self.length[target] == self.length[last] + 1
                    self.link[state] = target if exact else self._split(last, word, target)
                last = state
            self.count[last] += weight

    def finish(self) -> None:
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeated(self, words, window: int) -> int:
        """Bit i is set if the window from word i on occurs twice or more."""
        state = matched = found = 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            if matched >= window:
                while self.length[self.link[state]] >= window:
                    state = self.link[state]
                    matched = self.length[state]
                if self.count[state] >= 2:
                    found |= 1 << (place - window + 1)
        return found


def _anchor_words(window: int) -> int:
    return max(min(ANCHOR, window), window - 63)


def _hashes(words: list[bytes]) -> np.ndarray:
    encoded = pa.array(words, pa.large_binary()).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(word) for word in encoded.dictionary.to_pylist()], np.uint64)
    return known[encoded.indices.to_numpy(zero_copy_only=False)] if len(words) else known


def _regions(hashes: np.ndarray, lengths: np.ndarray, window: int):
    """First word, number of windows, anchor and content hash of each region of consecutive windows."""
    size, anchor = len(hashes), _anchor_words(window)
    if size < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    grams = np.zeros(size - anchor + 1, np.uint64)
    for place in range(anchor):
        grams = grams * _MIX + hashes[place:size - anchor + 1 + place]
    grams = (grams ^ (grams >> np.uint64(31))) * _MIX
    grams ^= grams >> np.uint64(29)
    ends = np.repeat(np.cumsum(lengths), lengths)
    places = np.flatnonzero(np.arange(size - window + 1) + window <= ends[:size - window + 1])
    if not len(places):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    choices = sliding_window_view(grams, window - anchor + 1)
    least = np.concatenate([choices[low:low + STEP].argmin(axis=1) for low in range(0, len(choices), STEP)])
    least = (least + np.arange(size - window + 1))[places]
    first = np.flatnonzero(np.concatenate(
        ([True], (least[1:] != least[:-1]) | (places[1:] != places[:-1] + 1))))
    counts = np.diff(np.append(first, len(places)))
    starts, raw = places[first], hashes.tobytes()
    content = np.array([xxhash.xxh3_64_intdigest(raw[8 * start:8 * (start + count + window - 1)])
                        for start, count in zip(starts.tolist(), counts.tolist())], np.uint64)
    return starts, counts, grams[least[first]], content


def _sliced_words(window: int):
    """One row per slice: words, regions, and the distinct (anchor, content) pairs of regions in order."""
    def run(batches):
        for batch in sliced(batches, limit=SLICE):
            split = [text.split() for text in texts(batch)]
            lengths = np.array([len(words) for words in split], np.int64)
            hashes = _hashes([word for words in split for word in words])
            with np.errstate(over="ignore"):
                starts, counts, anchors, content = _regions(hashes, lengths, window)
            order = np.lexsort((content, anchors))
            anchors, content = anchors[order], content[order]
            new = np.ones(len(order), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (content[1:] != content[:-1])
            entry = np.empty(len(order), np.int64)
            entry[order] = np.cumsum(new) - 1
            blob = b"\n".join(b" ".join(words) for words in split)
            yield pa.RecordBatch.from_arrays([
                batch.column("row").slice(0, 1),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(batch.schema.field("doc_id").type)),
                pa.array([len(blob)], pa.int64()), pa.array([pa.compress(blob, codec="zstd", asbytes=True)]),
                pa.array([pack(np.diff(starts, prepend=0))]), pa.array([pack(counts)]), pa.array([pack(entry)]),
                pa.array([pack_sorted(anchors[new])]), pa.array([pack(content[new])]),
                pa.array([pack(np.bincount(entry, minlength=int(new.sum())))]),
                pa.array([int(new.sum())], pa.int64()),
            ], ["slice", "doc_ids", "length", "blob", "starts", "counts", "entries", "anchors", "content", "times", "n"])
    return run


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _wide_here(batches):
    for row in _rows(batches):
        anchors, regions = np.unique(unpack_sorted(row["anchors"]), return_counts=True)
        many = regions > 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors[many].view(np.int64)), pa.array(regions[many], pa.int64())], ["anchor", "regions"])


def _parts(keys: np.ndarray, bits: int):
    """Partitions that sorted keys fall into, with their bounds."""
    if not len(keys):
        return
    parts = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1])))
    yield from zip(parts[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(keys)])


_REGIONS = pa.schema([("part", pa.int64()), ("slice", pa.int64()), ("anchors", pa.binary()), ("content", pa.binary()),
                      ("times", pa.binary())])


def _regions_dealt(wide: np.ndarray, bits: int):
    def run(batches):
        for row in _rows(batches):
            anchors, content, times = unpack_sorted(row["anchors"]), unpack(row["content"]), unpack(row["times"])
            plain = ~np.isin(anchors, wide)
            anchors, content, times = anchors[plain], content[plain], times[plain]
            yield pa.RecordBatch.from_pylist([{
                "part": part, "slice": row["slice"], "anchors": pack_sorted(anchors[low:high]),
                "content": pack(content[low:high]), "times": pack(times[low:high]),
            } for part, low, high in _parts(anchors, bits)], _REGIONS)
    return run


def _judged(table: pa.Table) -> pa.Table:
    """For each (anchor, content) of a slice: whether the anchor occurs once, always in the same region, or in
    several; whether the slice is the pair's first; and how often the pair occurs."""
    table = table.sort_by("slice")
    pieces = [unpack_sorted(data) for data in table.column("anchors").to_pylist()]
    anchors = np.concatenate(pieces)
    content = np.concatenate([unpack(data) for data in table.column("content").to_pylist()])
    times = np.concatenate([unpack(data) for data in table.column("times").to_pylist()]).astype(np.int64)
    order = np.lexsort((np.arange(len(anchors)), content, anchors))
    a, c = anchors[order], content[order]
    new_anchor = np.concatenate(([True], a[1:] != a[:-1]))
    new_pair = new_anchor | np.concatenate(([True], c[1:] != c[:-1]))
    anchor, pair = np.cumsum(new_anchor) - 1, np.cumsum(new_pair) - 1
    occurs = np.bincount(pair, weights=times[order]).astype(np.int64)
    total, distinct = np.bincount(anchor, weights=times[order]), np.bincount(anchor, weights=new_pair)
    state = np.where(total < 2, ONCE, np.where(distinct == 1, SAME, MIXED))[anchor]
    answer = np.empty(len(order), np.int64)
    answer[order] = state + 4 * new_pair + 8 * occurs[pair]
    ends = np.cumsum([len(piece) for piece in pieces])
    return pa.table({"slice": table.column("slice"), "part": table.column("part"),
                     "answer": pa.array([pack(part) for part in np.split(answer, ends[:-1])], pa.binary())})


class _Slice:
    """A slice's row with the answers on its regions; ``state`` is by distinct region, -1 for wide anchors."""

    def __init__(self, row: dict, wide: np.ndarray):
        blob = pa.decompress(row["blob"], decompressed_size=row["length"], codec="zstd", asbytes=True)
        self.documents = blob.split(b"\n")
        self.starts = np.cumsum(unpack(row["starts"]).astype(np.int64))
        self.counts, self.entries = unpack(row["counts"]).astype(np.int64), unpack(row["entries"]).astype(np.int64)
        self.anchors = unpack_sorted(row["anchors"])
        answers = [unpack(part["answer"]) for part in row["answers"] or ()]
        self.state = np.full(len(self.anchors), -1)
        self.first, self.occurs = np.zeros(len(self.anchors), bool), np.zeros(len(self.anchors), np.int64)
        plain = ~np.isin(self.anchors, wide)
        if answers:
            answer = np.concatenate(answers).astype(np.int64)
            self.state[plain], self.first[plain], self.occurs[plain] = answer & 3, answer >> 2 & 1, answer >> 3


_SHARDS = pa.schema([("part", pa.int64()), ("slice", pa.int64()), ("keys", pa.binary()), ("content", pa.binary()),
                     ("entries", pa.binary()), ("windows", pa.binary()), ("weights", pa.binary()),
                     ("length", pa.int64()), ("blob", pa.binary())])


def _shards_dealt(wide: np.ndarray, bits: int, window: int):
    """Ask the shards about regions of mixed anchors, and about each window of wide ones. Only the first slice of a
    region sends its words, with the number of its occurrences."""
    def run(batches):
        for row in _rows(batches):
            piece = _Slice(row, wide)
            content, times = unpack(row["content"]), unpack(row["times"]).astype(np.int64)
            _, mark = np.unique(piece.entries, return_index=True)
            words = [word for document in piece.documents for word in document.split()]
            asked = []  # key, content, entry, window, weight, words
            for entry in np.flatnonzero(piece.state == MIXED).tolist():
                start, count = int(piece.starts[mark[entry]]), int(piece.counts[mark[entry]])
                mine = bool(piece.first[entry])
                asked.append((int(piece.anchors[entry]), int(content[entry]), entry, ALL,
                              int(piece.occurs[entry]) if mine else 0,
                              b" ".join(words[start:start + count + window - 1]) if mine else None))
            for entry in np.flatnonzero(piece.state == -1).tolist():
                start, count = int(piece.starts[mark[entry]]), int(piece.counts[mark[entry]])
                for place in range(count):
                    text = b" ".join(words[start + place:start + place + window])
                    key = xxhash.xxh3_128_intdigest(text)
                    asked.append((key >> 64, key & (2 ** 64 - 1), entry, place, int(times[entry]), text))
            asked.sort(key=lambda item: item[:4])
            keys = np.array([item[0] for item in asked], np.uint64)
            rows = []
            for part, low, high in _parts(keys, bits):
                some = asked[low:high]
                blob = b"\n".join(item[5] for item in some if item[4])
                rows.append({
                    "part": part, "slice": row["slice"], "keys": pack_sorted(keys[low:high]),
                    "content": pack(np.array([item[1] for item in some], np.uint64)),
                    "entries": pack(np.array([item[2] for item in some])),
                    "windows": pack(np.array([item[3] for item in some])),
                    "weights": pack(np.array([item[4] for item in some])), "length": len(blob),
                    "blob": pa.compress(blob, codec="zstd", asbytes=True)})
            yield pa.RecordBatch.from_pylist(rows, _SHARDS)
    return run


def _matched(window: int):
    def run(table: pa.Table) -> pa.Table:
        """Build each shard's automaton and return, for every region asked about, which of its windows repeat."""
        rows = table.sort_by("slice").to_pylist()
        shards: dict[int, dict[int, list]] = {}
        asked = []
        for row in rows:
            keys, content, weights = unpack_sorted(row["keys"]).tolist(), unpack(row["content"]).tolist(), \
                unpack(row["weights"]).tolist()
            blob = pa.decompress(row["blob"], decompressed_size=row["length"], codec="zstd", asbytes=True)
            regions = iter(blob.split(b"\n"))
            asked.append(list(zip(keys, content)))
            for key, which, weight in zip(keys, content, weights):
                if weight:
                    region = next(regions)
                    known = shards.setdefault(key, {}).setdefault(which, [region, 0])
                    known[1] += weight
        verdicts: dict[int, dict[int, int]] = {}
        for key, regions in shards.items():
            automaton = SuffixAutomaton()
            split = {which: region.split(b" ") for which, (region, _) in regions.items()}
            for which, words in split.items():
                automaton.add(words, regions[which][1])
            automaton.finish()
            verdicts[key] = {which: automaton.repeated(words, window) for which, words in split.items()}
        masks = [pack(np.array([verdicts[key][which] for key, which in pairs], np.uint64)) for pairs in asked]
        return pa.table({
            "slice": pa.array([row["slice"] for row in rows], pa.int64()),
            "part": pa.array([row["part"] for row in rows], pa.int64()),
            "entries": pa.array([row["entries"] for row in rows], pa.binary()),
            "windows": pa.array([row["windows"] for row in rows], pa.binary()),
            "masks": pa.array(masks, pa.binary())})
    return run


def _cut(wide: np.ndarray, window: int):
    def run(batches):
        for row in _rows(batches):
            piece = _Slice(row, wide)
            masks = np.where(piece.state == SAME, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
            for part in row["matched"] or ():
                entries, windows = unpack(part["entries"]).astype(np.int64), unpack(part["windows"])
                found = unpack(part["masks"])
                single = windows != ALL
                found[single] = (found[single] & np.uint64(1)) << windows[single]
                np.bitwise_or.at(masks, entries, found)
            lengths = np.array([len(document.split()) for document in piece.documents], np.int64)
            change = np.zeros(int(lengths.sum()) + 1, np.int64)
            for place in range(int(piece.counts.max(initial=0))):
                hit = piece.starts[(piece.counts > place) & (masks[piece.entries] >> np.uint64(place) & np.uint64(1) > 0)] \
                    + place
                np.add.at(change, hit, 1)
                np.add.at(change, hit + window, -1)
            gone = np.cumsum(change[:-1]) > 0
            ends = np.cumsum(lengths)
            kept, removed = [], []
            for document, end in zip(piece.documents, ends.tolist()):
                words = document.split()
                out = gone[end - len(words):end]
                removed.append(int(out.sum()))
                kept.append(b" ".join(words if not removed[-1] else
                                      [word for word, is_out in zip(words, out.tolist()) if not is_out]))
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], doc_kind[0]) if doc_kind else pa.array(row["doc_ids"]),
                pa.array(lengths), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
            ], ["doc_id", "n_words", "n_removed", "kept_text"])
    doc_kind: list[pa.DataType] = []

    def typed(batches):
        for batch in batches:
            doc_kind[:] = [batch.schema.field("doc_ids").type.value_type]
            yield from run([batch])
    return typed


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts anywhere else in the table.

    Words are what stands between ASCII white space. Windows lie inside one document and are judged on the input; the
    other place may be in the same document, overlapping or not. Returns doc_id, n_words (before), n_removed and
    kept_text (kept words joined by one space), one row per input row.

    Null and empty text have no words. A repeated row is another place, so rows repeated with ``window`` words or
    more lose all of them. Texts shorter than the window are kept. Other columns are ignored; an empty table gives an
    empty result.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = stored(
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).mapInArrow(
            _sliced_words(window),
            f"slice long, doc_ids array<{kind}>, length long, blob binary, starts binary, counts binary, "
            "entries binary, anchors binary, content binary, times binary, n long"), "words")
    total = packed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(max(total, 1) / PARTITION)))
    wide_rows = packed.select("anchors").mapInArrow(_wide_here, "anchor long, regions long").groupBy("anchor").agg(
        F.sum("regions").alias("regions")).filter(F.col("regions") > max(WIDE, total // WIDE_SHARE))
    wide = np.sort(np.array([row.anchor for row in wide_rows.select("anchor").collect()], np.int64).view(np.uint64))
    judged = stored(
        packed.select("slice", "anchors", "content", "times").mapInArrow(
            _regions_dealt(wide, bits), "part long, slice long, anchors binary, content binary, times binary")
        .groupBy("part").applyInArrow(_judged, "slice long, part long, answer binary"), "judged")
    answers = judged.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("part", "answer"))).alias("answers"))
    known = packed.select("slice", "length", "blob", "starts", "counts", "entries", "anchors", "content", "times")
    matched = stored(
        known.join(answers, "slice", "left").mapInArrow(
            _shards_dealt(wide, bits, window),
            "part long, slice long, keys binary, content binary, entries binary, windows binary, weights binary, "
            "length long, blob binary")
        .groupBy("part").applyInArrow(
            _matched(window), "slice long, part long, entries binary, windows binary, masks binary"), "matched")
    masks = matched.groupBy("slice").agg(
        F.collect_list(F.struct("entries", "windows", "masks")).alias("matched"))
    return (
        packed.drop("content", "times", "n").join(answers, "slice", "left").join(masks, "slice", "left")
        .mapInArrow(_cut(wide, window), f"doc_id {kind}, n_words long, n_removed long, kept_text string")
    )

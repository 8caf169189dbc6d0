"""SentencePiece encoding and decoding over a relational lattice.

A text is a row of units, cut wherever two neighbouring characters stand side by side in no piece, so no piece crosses a
unit: a word and the comma behind it are two. Substrings of the distinct units, up to the longest piece, are exploded
and equi-joined with the piece table (a vocabulary of fixed size, so it is broadcast); the edges found are grouped by
unit and folded to boundaries with a higher-order aggregate: for a unigram model by Viterbi, the best total score.
The ids of a BPE model are not those of the best path: its encoder merges neighbours, best score first and leftmost
among equals. For such a model the fold makes exactly these merges over the same edges. Characters outside the
vocabulary become their bytes' pieces.

Documents are read in slices. A slice asks for the ids of its distinct units, partition by partition, and gets them
back in the order it asked; its texts move once, as numbers of its units, to meet them. A unit that a third of all
words are is asked for once per slice.
"""

from __future__ import annotations

import heapq
import re
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import sliced, texts
from tidewell.llm.katz import pack, unpack

MARK = "▁"  # how the vocabulary writes a space
# Units up to this length keep their boundaries in the bits of a long; longer ones merge with a heap.
SHORT = 62
# Text of a slice; a task holds each of its words.
SLICE = 6 << 20
# What an unknown character costs below the lowest score on a unigram path.
UNKNOWN_PENALTY = 10.0


# Powers of an odd number, modulo 2 ** 64.
_POWERS = np.array([pow(0x9E3779B97F4A7C15, place, 1 << 64) for place in range(64)], np.uint64)


class Vocabulary(NamedTuple):
    pieces: list[tuple[str, int, float]]  # with plain spaces; those that text can match
    byte_ids: list[int]  # of the 256 byte pieces; empty if there are none
    unknown: int
    kind: str  # "bpe" or "unigram"

    @property
    def longest(self) -> int:
        return max((len(piece) for piece, _, _ in self.pieces), default=1)


def load_vocabulary(path: str, kind: str = "bpe") -> Vocabulary:
    """Read a SentencePiece model of identity normalisation, with a dummy space in front and no other change."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = [], [0] * 256
    some_bytes = False
    for number in range(model.get_piece_size()):
        if model.is_byte(number):
            byte_ids[int(model.id_to_piece(number)[3:5], 16)] = number
            some_bytes = True
        elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
            pieces.append((model.id_to_piece(number).replace(MARK, " "), number, model.get_score(number)))
    if any(re.search("[^ ] ", piece) for piece, _, _ in pieces):
        raise ValueError("pieces with a space inside or behind are not supported")
    return Vocabulary(pieces, byte_ids if some_bytes else [], model.unk_id(), kind)


class Splitter:
    """Cuts texts into units, wherever two neighbouring characters stand side by side in no piece."""

    def __init__(self, vocabulary: Vocabulary):
        # By the last byte of a character and the first of the next, so some pairs too many are kept together.
        joined = np.zeros((256, 256), bool)
        for piece, _, _ in vocabulary.pieces:
            for one, other in zip(piece, piece[1:]):
                joined[one.encode()[-1], other.encode()[0]] = True
        joined[:, 0x80:0xC0] = True  # within a character
        self._apart = ~joined.ravel()

    def parts(self, units: pa.LargeBinaryArray, parts: int) -> np.ndarray:
        """Where each unit is dealt to: by a polynomial over its bytes."""
        blocks = range(0, len(units), 1 << 15)  # some numbers per byte are held
        return np.concatenate([self._parts(units.slice(start, 1 << 15), parts) for start in blocks])

    def _parts(self, units: pa.LargeBinaryArray, parts: int) -> np.ndarray:
        offsets, raw = _buffers(units)
        starts = offsets[:-1] - offsets[0]
        nth = np.arange(len(raw)) - np.repeat(starts, np.diff(offsets))
        sums = np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[nth & 63], starts)
        sums ^= sums >> np.uint64(32)
        return ((sums * _POWERS[1]) >> np.uint64(33)).astype(np.int64) % parts

    def cut(self, content: list[bytes]) -> tuple[np.ndarray, pa.Array]:
        """Number of units of each text, and all units."""
        marked = [b" " + text.replace(MARK.encode(), b" ") if text else b"" for text in content]
        data = b"".join(marked)
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        raw = np.frombuffer(data, np.uint8)
        first = np.ones(len(raw), bool)
        for start in range(1, len(raw), 1 << 18):  # an index of eight bytes is held per byte
            stop = min(start + (1 << 18), len(raw))
            first[start:stop] = self._apart[raw[start - 1:stop - 1].astype(np.int64) << 8 | raw[start:stop]]
        text_starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        first[text_starts] = True
        starts = np.flatnonzero(first)
        lengths = np.zeros(len(content), np.int64)
        lengths[sizes > 0] = np.diff(np.searchsorted(starts, np.append(text_starts, len(raw))))
        return lengths, _strings(np.append(starts, len(raw)), data)


def _strings(offsets: np.ndarray, data: bytes) -> pa.LargeBinaryArray:
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def _buffers(strings: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each string starts and the last one ends, and the bytes from the first start to that end."""
    if not len(strings):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    return offsets, np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]


def _distinct(batch: pa.RecordBatch, splitter: Splitter, parts: int):
    """Units of each text, the number of each unit, the distinct units, their partitions and the order of asking."""
    lengths, found = splitter.cut(texts(batch))
    encoded = found.dictionary_encode()
    units = encoded.dictionary
    part = splitter.parts(units, parts).astype(np.int32) if len(units) else np.zeros(0, np.int32)
    order = pc.sort_indices(pa.table({"part": part, "unit": units}), [
        ("part", "ascending"), ("unit", "ascending")]).to_numpy()
    return lengths, encoded.indices.to_numpy(zero_copy_only=False), units, part, order


def _pack_units(offsets: np.ndarray, data: memoryview, low: int, high: int) -> bytes:
    blob, lengths = data[offsets[low]:offsets[high]], pack(np.diff(offsets[low:high + 1]))
    return len(lengths).to_bytes(8, "little") + lengths + len(blob).to_bytes(8, "little") + pa.compress(
        blob, codec="zstd", asbytes=True)


def _unpack_units(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """The number of units in each row, and all units."""
    lengths, blobs = [], []
    for data in column.to_pylist():
        size = 8 + int.from_bytes(data[:8], "little")
        lengths.append(unpack(data[8:size]).astype(np.int64))
        blobs.append(pa.decompress(data[size + 8:], decompressed_size=int.from_bytes(data[size:size + 8], "little"),
                                   codec="zstd", asbytes=True))
    return np.array([len(some) for some in lengths]), _strings(
        np.concatenate(([0], np.cumsum(np.concatenate(lengths)))), b"".join(blobs))


def _asked(splitter: Splitter, parts: int):
    """A slice's distinct units, partition by partition."""
    def run(batches):
        for batch in sliced(batches, limit=SLICE):
            _, _, units, part, order = _distinct(batch, splitter, parts)
            if len(order):
                sorted_parts, asked = part[order], units.take(pa.array(order))
                offsets = np.frombuffer(asked.buffers()[1], np.int64)[asked.offset:asked.offset + len(asked) + 1]
                data = memoryview(asked.buffers()[2])
                edges = [0, *(np.flatnonzero(np.diff(sorted_parts)) + 1).tolist(), len(order)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(sorted_parts[edges[:-1]]),
                    pa.array([batch.column("row")[0].as_py()] * (len(edges) - 1), pa.int64()),
                    pa.array([_pack_units(offsets, data, low, high)
                              for low, high in zip(edges, edges[1:])]),
                ], ["part", "slice", "units"])
    return run


def _numbered(splitter: Splitter, parts: int):
    """A slice's documents as numbers of its distinct units, frequent ones small, and where those stand in the order
    of asking."""
    def run(batches):
        for batch in sliced(batches, limit=SLICE):
            lengths, numbers, units, _, order = _distinct(batch, splitter, parts)
            frequent = np.argsort(-np.bincount(numbers, minlength=len(units)), kind="stable")
            rank, place = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
            rank[frequent], place[order] = np.arange(len(units)), np.arange(len(units))
            yield pa.RecordBatch.from_arrays([
                batch.column("row").slice(0, 1),
                pa.array([batch.column("kept").to_pylist()], pa.list_(batch.schema.field("kept").type)),
                pa.array([pack(lengths)]), pa.array([pack(rank[numbers])]), pa.array([pack(place[frequent])]),
            ], ["slice", "kept", "lengths", "numbers", "places"])
    return run


def _distinct_units(table: pa.Table) -> pa.Table:
    """The distinct units of all that are asked about in a partition."""
    _, asked = _unpack_units(table.column("units"))
    units = asked.unique()
    units = units.take(pc.sort_indices(units)).cast(pa.large_string()).cast(pa.string())
    return pa.table({"part": pa.repeat(table.column("part")[0], len(units)), "unit": units})


def _edge_rows(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """part, unit, size and edges, the pieces of two characters or more that stand in the unit.

    An edge of a BPE model is one long: its rank among the scores (equal scores share it), start and length, so edges
    sort by score and then from the left. An edge of a unigram model is a struct of score, start and stop.
    """
    longer = [(piece, score) for piece, _, score in vocabulary.pieces if len(piece) > 1]
    ranks = {score: rank for rank, score in enumerate(sorted({score for _, score in longer}, reverse=True))}
    if vocabulary.longest > 127 or len(ranks) >= 1 << 20:
        raise ValueError("pieces are too long or too many")
    table = units.sparkSession.createDataFrame(
        [(piece, score, ranks[score] << 43) for piece, score in longer], "piece string, score double, rank long")
    # Joined by hash alone, as a key of one number is looked up faster, and compared by the text itself behind that.
    table = table.withColumn("hash", F.xxhash64("piece"))
    # Grouped by a number first: the sort of the many groups compares numbers, in nearly the right order, and no text.
    numbered = units.withColumns({"number": F.monotonically_increasing_id(), "size": F.length("unit")})
    starts = numbered.withColumn(
        "start", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    # Of four characters and more only spans as long as some piece that begins with the same four are cut out. A wrong
    # meeting of hashes brings spans that are no piece.
    heads: dict[str, set[int]] = {}
    for piece, _ in longer:
        if len(piece) > 3:
            heads.setdefault(piece[:4], set()).add(len(piece))
    lengths = units.sparkSession.createDataFrame(
        [(head, sorted(found)) for head, found in heads.items()], "head string, lengths array<int>").select(
        F.xxhash64("head").alias("head"), "lengths")
    met = starts.withColumn("at", F.xxhash64(F.expr("substring(unit, start + 1, 4)"))).join(
        F.broadcast(lengths), F.col("at") == F.col("head"), "left")
    # The last start has no longer piece; its one span keeps the unit in the result.
    least = F.least(F.lit(2), F.col("size") - F.col("start"))
    spans = met.withColumn("length", F.explode(F.concat(F.array(least, F.lit(3)), F.coalesce(
        "lengths", F.array().cast("array<int>"))))).withColumn("stop", F.col("start") + F.col("length")).filter(
        F.col("stop") <= F.col("size"))
    cut = spans.withColumn("cut", F.expr("substring(unit, start + 1, stop - start)")).withColumn(
        "cut_hash", F.xxhash64("cut"))
    joined = cut.join(F.broadcast(table), F.col("cut_hash") == F.col("hash"), "left").withColumn(
        "rank", F.when(F.col("cut") == F.col("piece"), F.col("rank")))
    useful = joined.filter(F.col("rank").isNotNull() | (F.col("start") == F.col("size") - 1))
    if vocabulary.kind == "bpe":
        edge = F.col("rank") + F.col("start").cast("long") * 128 + (F.col("stop") - F.col("start"))
    else:
        edge = F.struct("score", "start", "stop")
    grouped = useful.groupBy("number", "part", "unit").agg(
        F.sort_array(F.collect_list(F.when(F.col("rank").isNotNull(), edge))).alias("edges"))
    return grouped.select("part", "unit", "edges", F.length("unit").alias("size"))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once. A column used inside a lambda would be computed again for each
    element, since the optimiser puts its expression in."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _late_pieces(vocabulary: Vocabulary) -> list[str]:
    """Pieces that are put together, last, from a part that does not come before them by score; of these the shortest.

    Between two boundaries merges go as they do in that text alone, whatever stands around it, so each piece has one
    pair of parts it can be made from. Without late pieces in a unit its merges come in the order of their scores.
    """
    scores = {piece: score for piece, _, score in vocabulary.pieces if len(piece) > 1}
    late: list[str] = []
    for piece, score in scores.items():
        parts = list(piece)
        while len(parts) > 2:
            known = [(-scores[pair], place) for place, pair in enumerate(map("".join, zip(parts, parts[1:])))
                     if pair in scores]
            if not known:
                break
            place = min(known)[1]
            parts[place:place + 2] = [parts[place] + parts[place + 1]]
        if len(parts) == 2 and any(part in scores and scores[part] <= score for part in parts):
            late.append(piece)
    return [piece for piece in late if not any(other in piece for other in late if other != piece)]


def _merged(size: Column, edges: Column, late: Column) -> Column:
    """Boundaries left by BPE, as bits: each step makes the first merge of two neighbours there is.

    Where no merge can be first that was passed over before (not ``late``), that is one pass over the sorted edges.
    """
    one = F.lit(1).cast("long")

    # An edge as the bits of its start and its stop; what lies inside follows from these.
    def ends(edge: Column) -> Column:
        length, start = edge.bitwiseAND(F.lit(127)), F.shiftright(edge, 7).bitwiseAND(F.lit(63))
        return F.call_function("shiftleft", _bit(length.cast("int")) + one, start.cast("int"))

    def inside(e: Column) -> Column:
        return e - e.bitwiseAND(-e) * 3

    def meets(bounds: Column, e: Column) -> Column:
        return (bounds.bitwiseAND(e) == e) & (F.bit_count(bounds.bitwiseAND(inside(e))) == 1)

    def fold(masked: Column) -> Column:
        def step(bounds: Column, _) -> Column:
            first = F.get(F.filter(masked, lambda e: meets(bounds, e)), F.lit(0))
            return F.coalesce(bounds.bitwiseAND(F.bitwise_not(inside(first))), bounds)

        steps = F.slice(F.sequence(F.lit(0), size), F.lit(1), F.least(F.size(masked), size - 1))
        single = _bit(size) - 1 + _bit(size)
        return F.when(late, F.aggregate(steps, single, step)).otherwise(F.aggregate(
            masked, single, lambda bounds, e: F.when(
                meets(bounds, e), bounds.bitwiseAND(F.bitwise_not(inside(e)))).otherwise(bounds)))
    return _let(F.transform(edges, ends), fold)


def _best_path(size: Column, edges: Column, singles: dict[str, float], floor: float) -> Column:
    """Boundaries of the path of the best total score, as bits, by Viterbi.

    The fold runs over the ends of prefixes; its state holds of each prefix the best score and the boundaries of the
    path to it. A character is always a step: with its own score, or the floor if it has no piece.
    """
    empty = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("bounds")))
    own = F.create_map(*[F.lit(item) for pair in singles.items() for item in pair]) if singles else None

    def step(best: Column, end: Column) -> Column:
        def option(start: Column, gain: Column) -> Column:
            before = F.get(best, start)
            return F.struct((before["score"] + gain).alias("score"),
                            before["bounds"].bitwiseOR(_bit(end)).alias("bounds"))

        character = F.substring(F.col("unit"), end, F.lit(1))
        alone = F.lit(floor) if own is None else F.coalesce(F.try_element_at(own, character), F.lit(floor))
        longer = F.transform(
            F.filter(edges, lambda e: e["stop"] == end), lambda e: option(e["start"], e["score"]))
        return F.concat(best, F.array(F.array_max(F.concat(longer, F.array(option(end - 1, alone))))))

    return F.get(F.aggregate(F.sequence(F.lit(1), size), empty, step), size)["bounds"]


def _floor(vocabulary: Vocabulary) -> float:
    return min((score for _, _, score in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY


def _long_starts(unit: str, edges: list, vocabulary: Vocabulary, singles: dict[str, float]) -> list[int]:
    """Where the pieces of a unit too long for bits start: the same merges with a heap, or Viterbi over lists."""
    size = len(unit)
    if vocabulary.kind == "bpe":
        ranks = {(edge >> 7 & (1 << 36) - 1, edge & 127): edge >> 43 for edge in edges}
        after, before, alive = list(range(1, size + 1)), list(range(-1, size - 1)), [True] * size
        heap: list[tuple] = []

        def offer(start: int) -> None:
            middle = after[start]
            if middle < size and (rank := ranks.get((start, after[middle] - start))) is not None:
                heapq.heappush(heap, (rank, start, middle, after[middle]))

        for start in range(size):
            offer(start)
        while heap:
            _, start, middle, stop = heapq.heappop(heap)
            if alive[start] and after[start] == middle and alive[middle] and after[middle] == stop:
                alive[middle], after[start] = False, stop
                if stop < size:
                    before[stop] = start
                offer(start)
                if before[start] >= 0:
                    offer(before[start])
        return [start for start in range(size) if alive[start]]
    ending: dict[int, list] = {}
    for edge in edges:
        ending.setdefault(edge["stop"], []).append((edge["start"], edge["score"]))
    best = [(0.0, 0)]
    for end in range(1, size + 1):
        options = [(end - 1, singles.get(unit[end - 1], _floor(vocabulary))), *ending.get(end, ())]
        best.append(max((best[start][0] + score, start) for start, score in options))
    starts, end = [], size
    while end:
        end = best[end][1]
        starts.append(end)
    return starts[::-1]


def cut_units(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """part, unit and bounds of distinct non-empty units: bit i is set where a piece starts or the unit ends.

    Units longer than ``SHORT`` have their edges instead.
    """
    lattice = _edge_rows(units, vocabulary)
    size, edges, long = F.least(F.col("size"), F.lit(SHORT)), F.col("edges"), F.col("size") > SHORT
    singles = {piece: score for piece, _, score in vocabulary.pieces if len(piece) == 1}
    if vocabulary.kind == "bpe":
        late = [F.contains("unit", F.lit(piece)) for piece in _late_pieces(vocabulary)]
        bounds = _merged(size, edges, reduce(lambda a, b: a | b, late, F.lit(False)))
    else:
        bounds = _best_path(size, edges, singles, _floor(vocabulary))
    return lattice.select("part", "unit", F.when(~long, bounds).alias("bounds"), F.when(long, edges).alias("edges"))


def _characters(raw: np.ndarray) -> np.ndarray:
    """Where the characters start and the last one ends."""
    return np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))


def _answered(vocabulary: Vocabulary):
    singles = {piece: score for piece, _, score in vocabulary.pieces if len(piece) == 1}
    known = pa.array([piece.encode() for piece, _, _ in vocabulary.pieces], pa.large_binary())
    numbers = np.array([number for _, number, _ in vocabulary.pieces], np.int32)
    byte_ids = np.array(vocabulary.byte_ids, np.int32)

    def ids_of(cut: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units of a partition one after the other, and where those of each unit end."""
        offsets, raw = _buffers(cut["unit"])
        offsets = offsets - offsets[0]
        characters = _characters(raw)
        base = np.searchsorted(characters, offsets[:-1])
        bounds = cut["bounds"].fill_null(0).to_numpy().astype(np.int64)
        bits = np.unpackbits(bounds.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner, place = np.nonzero(bits)
        starts = [characters[base[owner] + place]]
        for row in np.flatnonzero(cut["edges"].is_valid().to_numpy(zero_copy_only=False)).tolist():
            unit, edges = cut["unit"][row].as_py().decode(), cut["edges"][row].as_py()
            starts.append(characters[base[row] + np.array(_long_starts(unit, edges, vocabulary, singles))])
        # What a unit ends with is where the next one starts.
        starts = np.unique(np.concatenate([*starts, offsets]))
        pieces = _strings(starts, raw.tobytes())
        found = pc.index_in(pieces, value_set=known)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        ids, sizes = numbers[found.fill_null(0).to_numpy()], np.ones(len(pieces), np.int64)
        if not len(byte_ids):
            ids[missing] = vocabulary.unknown
        elif missing.any():
            sizes[missing] = np.diff(starts)[missing]
            ids = np.repeat(ids, sizes)
            ids[np.repeat(missing, sizes)] = byte_ids[raw[np.repeat(missing, np.diff(starts))]]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(starts, offsets)]

    def run(asked: pa.Table, cut: pa.Table) -> pa.Table:
        """The ids of each slice's units of a partition, in the order asked."""
        cut = cut.set_column(
            cut.schema.get_field_index("unit"), "unit", cut.column("unit").cast(pa.large_binary())).combine_chunks()
        cut = {name: cut.column(name).chunk(0) for name in ("unit", "bounds", "edges")}
        flat, ends = ids_of(cut)
        lengths, units = _unpack_units(asked.column("units"))
        wanted = pc.index_in(units, value_set=cut["unit"]).to_numpy()
        rows = []
        for number, part, low, high in zip(*[asked.column(name).to_pylist() for name in ("slice", "part")],
                                           (np.cumsum(lengths) - lengths).tolist(), np.cumsum(lengths).tolist()):
            some = wanted[low:high]
            sizes = np.diff(ends)[some]
            rows.append({"slice": number, "part": part, "sizes": pack(sizes),
                         "ids": pack(_gather(flat, ends[:-1][some], sizes))})
        return pa.Table.from_pylist(rows, _ANSWER)
    return run


_ANSWER = pa.schema([("slice", pa.int64()), ("part", pa.int32()), ("sizes", pa.binary()), ("ids", pa.binary())])


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start:start + size] of each, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    index = np.repeat(starts - (ends - sizes), sizes)
    index += np.arange(total)
    return flat[index]


def _decoded(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    """Pieces joined and bytes put together, a few texts at a time; the dummy space in front is dropped."""
    found = []
    for start in range(0, len(ids), 128):
        some = ids.slice(start, 128)
        sizes = pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False)
        joined = pc.binary_join(pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), table.take(some.flatten())), b"")
        try:
            text = joined.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            text = pa.array([value.decode("utf-8", "replace") for value in joined.to_pylist()], pa.string())
        found.append(pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text))
    return pa.concat_arrays(found) if found else pa.array([], pa.string())


def _assembled(table):
    """The ids of each document of a slice; with a piece table also the text they stand for."""
    def run(batches):
        known = None if table is None else pa.array(table.value, pa.binary())
        for batch in batches:
            kind = batch.schema.field("kept").type.value_type
            for place in range(batch.num_rows):  # a row is a slice, of some megabytes
                row = batch.slice(place, 1).to_pylist()[0]
                lengths, numbers, places = (
                    unpack(row[name]).astype(np.int64) for name in ("lengths", "numbers", "places"))
                answers = row["answers"] or []
                sizes = np.concatenate([unpack(part["sizes"]) for part in answers] or [np.zeros(0)]).astype(np.int64)
                if len(sizes) != len(places):
                    raise RuntimeError("the documents changed between two readings; store them first")
                flat = np.concatenate(
                    [unpack(part["ids"]).astype(np.int32) for part in answers] or [np.zeros(0, np.int32)])
                starts = (np.cumsum(sizes) - sizes)[places]
                per_unit = sizes[places][numbers]
                bounds = np.concatenate(([0], np.cumsum(per_unit)))[np.concatenate(([0], np.cumsum(lengths)))]
                kept, ids = pa.array(row["kept"], kind), pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(_gather(flat, starts[numbers], per_unit), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [kept, ids] if known is None else [kept, ids, _decoded(ids, known)],
                    ["kept", "ids"] if known is None else ["kept", "ids", "decoded"])
                pa.default_memory_pool().release_unused()
    return run


def _piece_table(spark, vocabulary: Vocabulary):
    size = 1 + max([number for _, number, _ in vocabulary.pieces] + vocabulary.byte_ids + [vocabulary.unknown])
    table: list[bytes] = [b""] * size
    for piece, number, _ in vocabulary.pieces:
        table[number] = piece.encode()
    for byte, number in enumerate(vocabulary.byte_ids):
        table[number] = bytes([byte])
    table[vocabulary.unknown] = " ⁇ ".encode()
    return spark.sparkContext.broadcast(table)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, keep: str = "doc_id", decode: bool = False) -> DataFrame:
    """One row per input row: the column ``keep`` and ids, an array of piece ids of the whole text; with ``decode``
    also decoded, see ``decode_documents``.

    Null and empty text have no ids. A literal vocabulary mark in a text is a space. Other columns are ignored, an
    empty table gives an empty result, repeated rows each get their row.

    ``docs`` is read twice and must fall into the same partitions both times, as a table read from files does; if it
    does not the job stops with an error. Store the result of a shuffle first.
    """
    splitter = Splitter(vocabulary)
    # More partitions than usual, as a unit brings dozens of substrings, and parts enough to fill them evenly.
    partitions = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = 8 * partitions
    rows = docs.select(docs[keep].alias("kept"), "text", F.monotonically_increasing_id().alias("row"))
    asked = rows.select("row", "text").mapInArrow(
        _asked(splitter, parts), "part int, slice long, units binary").repartition(partitions, "part")
    units = asked.groupBy("part").applyInArrow(
        _distinct_units, "part int, unit string").repartition(partitions, "part")
    cut = cut_units(units, vocabulary).withColumnRenamed("part", "cut_part")
    answered = asked.groupBy("part").cogroup(cut.groupBy("cut_part")).applyInArrow(
        _answered(vocabulary), "slice long, part int, sizes binary, ids binary")
    answers = answered.groupBy("slice").agg(
        F.sort_array(F.collect_list(F.struct("part", "sizes", "ids"))).alias("answers"))
    kind = docs.schema[keep].dataType.simpleString()
    numbered = rows.mapInArrow(
        _numbered(splitter, parts), f"slice long, kept array<{kind}>, lengths binary, numbers binary, places binary")
    return numbered.join(answers, "slice", "left").mapInArrow(
        _assembled(_piece_table(docs.sparkSession, vocabulary) if decode else None),
        f"kept {kind}, ids array<int>" + ", decoded string" * decode).withColumnRenamed("kept", keep)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add ``decoded``, the text of ``ids``: pieces joined, bytes put together, the dummy space dropped.

    Byte sequences that are no UTF-8 become replacement characters. Ids without text (control pieces) are dropped.
    """
    shared = _piece_table(encoded.sparkSession, vocabulary)

    def run(batches):
        table = pa.array(shared.value, pa.binary())
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _decoded(ids, table)], [*batch.schema.names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{kinds}, decoded string")

"""Language-model scoring: a Katz backoff bigram model with Good-Turing discounts, trained on the table it scores.

A token is scored recursively: a bigram seen in training has its discounted share of its context's count; any other
has the context's backoff weight times the token's own probability, which again is a discounted share, or the mass
left over for tokens never seen. Backoff weights are normalised exactly, over the very bigrams that were seen.

Documents are packed into slices of some megabytes: a dictionary of token hashes and the tokens as places in it.
Counts live in tables partitioned by the leading bits of the hashes: a slice sends each partition its sorted keys,
with one number per distinct key, and gets the totals of the whole corpus back in the same order. Words, bigrams and
contexts go through that step, one after the other. A key sends one entry per slice however often it occurs, and
bigrams are dealt by both words, so neither a hot word nor a hot context gathers anywhere; partitions hold about
``PARTITION`` entries whatever the corpus, so their number grows with it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import sliced, stored

SLICE = 4 << 20
PARTITION = 1 << 20
# Good-Turing discounts apply to counts up to this; larger ones give up a hundredth of a count, so that every context
# leaves some mass to what it was not seen with.
RELIABLE = 5
TRIM = 0.01
# Neither holds a word, since words have no spaces.
END, START = xxhash.xxh64_intdigest(b" "), xxhash.xxh64_intdigest(b"  ")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes; small or slowly growing ones take little room."""
    values = np.ascontiguousarray(values).astype("<u8")
    width = 4 if not len(values) or values.max() < 1 << 32 else 8
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return len(values).to_bytes(7, "little") + bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    size, width = int.from_bytes(data[:7], "little"), data[7]
    planes = pa.decompress(data[8:], decompressed_size=width * size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, size).T.copy().view(f"<u{width}").ravel().astype(np.uint64)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def _sliced_tokens(batches):
    """One row per slice: its documents, dictionary (sorted hashes) and tokens, the end of each text included."""
    for batch in sliced(batches, limit=SLICE):
        parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), "")))
        words = parts.flatten()
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(batch.num_rows), sizes)[real]
        encoded = words.filter(pa.array(real)).dictionary_encode()
        hashes = np.array(
            [xxhash.xxh64_intdigest(word) for word in encoded.dictionary.cast(pa.large_binary()).to_pylist()] + [END],
            np.uint64)
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = np.bincount(owner, minlength=batch.num_rows) + 1
        ends = np.cumsum(lengths) - 1
        tokens = np.empty(int(lengths.sum()), np.int64)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner] = place[encoded.indices.to_numpy(zero_copy_only=False)]
        tokens[ends] = place[-1]
        held = batch.column("held_out").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([
            batch.column("row").slice(0, 1), pa.array([batch.column("doc_id").to_pylist()],
                                                      pa.list_(batch.schema.field("doc_id").type)),
            pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([pack(lengths)]),
            pa.array([pack_sorted(hashes[order])]), pa.array([pack(tokens)]), pa.array([len(tokens)], pa.int64()),
        ], ["slice", "doc_ids", "held", "lengths", "words", "tokens", "n"])


class _Slice:
    """A slice's row, unpacked."""

    def __init__(self, row: dict):
        self.id, self.doc_ids = row["slice"], row["doc_ids"]
        self.held = np.array(row["held"], bool)
        self.lengths = unpack(row["lengths"]).astype(np.int64)
        self.words = unpack_sorted(row["words"])
        self.tokens = unpack(row["tokens"]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.trained = ~self.held[self.owner]
        # Places of contexts; one past the dictionary is the start of a text.
        self.before = np.concatenate(([0], self.tokens[:-1]))
        self.before[np.cumsum(self.lengths) - self.lengths] = len(self.words)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.trained], minlength=len(self.words))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys, the first token place of each, and the key number of each token."""
        contexts = np.append(self.words, np.uint64(START))
        with np.errstate(over="ignore"):
            keys = (contexts[self.before] ^ (contexts[self.before] >> np.uint64(32))) * _MIX + self.words[self.tokens]
            keys = (keys ^ (keys >> np.uint64(31))) * _MIX
        return np.unique(keys ^ (keys >> np.uint64(30)), return_index=True, return_inverse=True)


def _dealt(slice_id: int, keys: np.ndarray, bits: int, values: dict[str, np.ndarray]):
    """A row per partition that the sorted keys fall into: partition, slice, keys and the values beside them."""
    edges = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else \
        np.array([0, len(keys)])
    filled = np.flatnonzero(edges[1:] > edges[:-1])
    columns = {"part": pa.array(filled, pa.int64()), "slice": pa.array([slice_id] * len(filled), pa.int64()),
               "keys": pa.array([pack_sorted(keys[edges[i]:edges[i + 1]]) for i in filled], pa.binary())}
    columns |= {name: pa.array([pack(array[edges[i]:edges[i + 1]]) for i in filled], pa.binary())
                for name, array in values.items()}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _words_dealt(bits: int):
    def run(batches):
        for row in _rows(batches):
            piece = _Slice(row)
            yield _dealt(piece.id, piece.words, bits, {"counts": piece.word_counts()})
    return run


def _bigrams_dealt(bits: int):
    def run(batches):
        for row in _rows(batches):
            piece = _Slice(row)
            keys, _, number = piece.bigrams()
            counts = np.bincount(number[piece.trained], minlength=len(keys))
            yield _dealt(piece.id, keys, bits, {"counts": counts})
    return run


def _totals(table: pa.Table) -> pa.Table:
    """Send each slice the corpus totals of its keys, doubled, plus 1 where the slice is the key's first.

    The first row also carries how many keys have total 1, 2, ... RELIABLE + 1, any total, and the sum of totals.
    """
    table = table.sort_by("slice")
    keys = [unpack_sorted(data) for data in table.column("keys").to_pylist()]
    counts = np.concatenate([unpack(data) for data in table.column("counts").to_pylist()]).astype(np.int64)
    found, first, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    totals = np.bincount(number, weights=counts, minlength=len(found)).astype(np.int64)
    answer = 2 * totals[number]
    answer[first] += 1
    ends = np.cumsum([len(part) for part in keys])
    frequent = [int((totals == r).sum()) for r in range(1, RELIABLE + 2)]
    stats = [*frequent, int((totals > 0).sum()), int(totals.sum())]
    return pa.table({
        "slice": table.column("slice"), "part": table.column("part"),
        "totals": pa.array([pack(part) for part in np.split(answer, ends[:-1])], pa.binary()),
        "stats": pa.array([stats] + [None] * (len(keys) - 1), pa.list_(pa.int64())),
    })


def _summed(dealt: DataFrame, label: str) -> DataFrame:
    return stored(dealt.groupBy("part").applyInArrow(
        _totals, "slice long, part long, totals binary, stats array<bigint>"), label)


def _statistics(totals: DataFrame) -> list[int]:
    row = totals.agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(RELIABLE + 3)]).first()
    return [int(value) for value in row]


def good_turing(frequent: Sequence[int]) -> np.ndarray:
    """The discounted counts of 0, 1, ... RELIABLE, from the numbers of events seen 1, 2, ... RELIABLE + 1 times.

    Where Good-Turing gives no count between zero and the count itself (few or uneven data), a fixed part of a count
    is taken instead.
    """
    n = [0, *frequent]
    common = (RELIABLE + 1) * n[RELIABLE + 1] / n[1] if n[1] else 1.0
    part = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    found = np.zeros(RELIABLE + 1)
    for r in range(1, RELIABLE + 1):
        ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        kept = (ratio - common) / (1 - common) if common < 1 else 0.0
        found[r] = r * kept if 0 < kept < 1 else r - part
    return found


class _Model:
    """The few numbers of the whole corpus that turn counts into probabilities."""

    def __init__(self, words: Sequence[int], bigrams: Sequence[int]):
        self.types, self.size = words[-2], words[-1]
        self.word_discounts, self.bigram_discounts = good_turing(words[:RELIABLE + 1]), good_turing(bigrams[:RELIABLE + 1])
        few = list(words[:RELIABLE])
        mass = sum(n * self.word_discounts[r] for r, n in enumerate(few, 1))
        mass += self.size - sum(n * r for r, n in enumerate(few, 1)) - TRIM * (self.types - sum(few))
        self.unseen = 1 - mass / self.size if self.size else 1.0

    def discounted(self, counts: np.ndarray, discounts: np.ndarray) -> np.ndarray:
        return np.where(counts <= RELIABLE, discounts[np.minimum(counts, RELIABLE)], counts - TRIM)

    def own(self, counts: np.ndarray) -> np.ndarray:
        """Probability of a token from its count alone."""
        return np.where(counts > 0, self.discounted(counts, self.word_discounts) / max(self.size, 1), self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.size + 0.5 * (self.types + 1)))


def _together(parts) -> np.ndarray:
    return np.concatenate([unpack(part["totals"]) for part in parts]).astype(np.int64)


# What a slice knows of its documents, and what it asks of the partitions of contexts.
_ASKED = """part long, slice long, keys binary, own binary, kinds binary, counts binary, unseen_at binary,
            unseen_doc binary, unseen_n binary, doc_ids array<{kind}>, held array<boolean>, n_tokens binary,
            n_known binary, base binary, score binary"""
_DOCUMENTS = ["doc_ids", "held", "n_tokens", "n_known", "base", "score"]


def _asked(model: _Model, bits: int, starts: int, schema: pa.Schema):
    """Score all but the backoff weights; send contexts what the slice adds to them and who needs their weight.

    ``own`` sums the tokens' own probabilities over the bigrams that count as this slice's; ``kinds`` are numbers of
    those bigrams seen 1, 2, ... RELIABLE times and more often. ``starts`` is the number of training documents.
    """
    def run(batches):
        for row in _rows(batches):
            piece = _Slice(row)
            words = _together(row["word_totals"]) >> 1
            answer = _together(row["bigram_totals"])
            _, place, number = piece.bigrams()
            totals, mine = answer >> 1, (answer & 1).astype(bool)
            contexts = np.append(words, starts)  # counts of contexts
            own = model.own(words)
            seen = totals > 0
            ratio = np.log10(np.where(
                seen, model.discounted(totals, model.bigram_discounts) / np.maximum(contexts[piece.before[place]], 1),
                own[piece.tokens[place]]))
            docs = len(piece.lengths)
            base = np.bincount(piece.owner, weights=model.base(words)[piece.tokens], minlength=docs)
            score = np.bincount(piece.owner, weights=ratio[number], minlength=docs)
            known = np.bincount(piece.owner, weights=words[piece.tokens] > 0, minlength=docs).astype(np.int64)

            # Per context: what this slice adds to the sums, and the unseen tokens that wait for its weight.
            size = len(contexts)
            counted = mine & seen
            at = piece.before[place[counted]]
            added = np.bincount(at, weights=own[piece.tokens[place[counted]]], minlength=size)
            kind = np.minimum(totals[counted], RELIABLE + 1) - 1
            kinds = np.bincount(at * (RELIABLE + 1) + kind, minlength=size * (RELIABLE + 1)).reshape(size, -1)
            waiting = ~seen[number] & (contexts[piece.before] > 0)
            pairs, times = np.unique(piece.before[waiting] * docs + piece.owner[waiting], return_counts=True)
            needed = np.zeros(size, bool)
            needed[at] = True
            needed[pairs // max(docs, 1)] = True
            hashes = np.append(piece.words, np.uint64(START))
            order = np.argsort(hashes)
            order = order[needed[order]]
            place_of = np.full(size, -1)
            place_of[order] = np.arange(len(order))
            keys, asked_at = hashes[order], place_of[pairs // max(docs, 1)]
            by_key = np.argsort(asked_at, kind="stable")
            asked_at, asked_doc, asked_n = asked_at[by_key], (pairs % max(docs, 1))[by_key], times[by_key]
            parts = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            edges = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(parts) else []
            rows = []
            for low, high in zip(edges, [*edges[1:], len(parts)]):
                a, b = np.searchsorted(asked_at, [low, high])
                rows.append({
                    "part": int(parts[low]), "slice": piece.id, "keys": pack_sorted(keys[low:high]),
                    "own": added[order[low:high]].tobytes(), "kinds": pack(kinds[order[low:high]].ravel()),
                    "counts": pack(contexts[order[low:high]]), "unseen_at": pack(asked_at[a:b] - low),
                    "unseen_doc": pack(asked_doc[a:b]), "unseen_n": pack(asked_n[a:b])})
            yield pa.RecordBatch.from_pylist(rows, schema)
            yield pa.RecordBatch.from_pylist([{
                "part": piece.id % (1 << bits), "slice": piece.id, "doc_ids": piece.doc_ids, "held": row["held"],
                "n_tokens": pack(piece.lengths), "n_known": pack(known), "base": base.tobytes(),
                "score": score.tobytes()}], schema)
    return run


def _weighted(model: _Model):
    """Backoff weights of a partition's contexts, and the sum of their logs that each document needs."""
    def run(table: pa.Table) -> pa.Table:
        documents = table.filter(pc.is_valid(table.column("score"))).select(["slice", "part", *_DOCUMENTS])
        documents = documents.append_column("who", pa.nulls(len(documents), pa.binary())).append_column(
            "sums", pa.nulls(len(documents), pa.binary()))
        rows = table.filter(pc.is_valid(table.column("keys"))).sort_by("slice").to_pylist()
        if not rows:
            return documents
        keys = [unpack_sorted(row["keys"]) for row in rows]
        _, first, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        own = np.bincount(number, weights=np.concatenate([np.frombuffer(row["own"]) for row in rows]))
        kinds = np.concatenate([unpack(row["kinds"]).astype(np.int64).reshape(-1, RELIABLE + 1) for row in rows])
        kinds = np.stack([np.bincount(number, weights=column) for column in kinds.T], axis=1)
        counts = np.concatenate([unpack(row["counts"]) for row in rows]).astype(np.float64)[first]
        few = np.arange(1, RELIABLE + 1)
        taken = kinds[:, :RELIABLE] @ model.bigram_discounts[1:] - TRIM * kinds[:, RELIABLE] \
            + counts - kinds[:, :RELIABLE] @ few
        logs = np.log10(np.maximum(1 - taken / np.maximum(counts, 1), 1e-300) / np.maximum(1 - own, 1e-300))
        start, answers = 0, []
        for row, part in zip(rows, keys):
            at, doc, n = (unpack(row[name]).astype(np.int64) for name in ("unseen_at", "unseen_doc", "unseen_n"))
            if len(at):
                sums = np.bincount(doc, weights=logs[number[start + at]] * n)
                who = np.unique(doc)
                answers.append({"slice": row["slice"], "part": row["part"], "who": pack(who),
                                "sums": sums[who].tobytes()})
            start += len(part)
        return pa.concat_tables([documents, pa.Table.from_pylist(answers, documents.schema)])
    return run


def _collected(batches):
    """The documents of each slice, with what the partitions answered added in the order of partitions."""
    for batch in batches:
        kind = batch.schema.field("doc_ids").type.value_type
        for row in batch.to_pylist():
            score = np.frombuffer(row["score"]).copy()
            for part in row["parts"]:
                np.add.at(score, unpack(part["who"]).astype(np.int64), np.frombuffer(part["sums"]))
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], kind), pa.array(row["held"], pa.bool_()),
                pa.array(unpack(row["n_tokens"]).astype(np.int64)), pa.array(unpack(row["n_known"]).astype(np.int64)),
                pa.array(np.frombuffer(row["base"])), pa.array(score),
            ], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` has doc_id, text and held_out (boolean; held-out rows add nothing to any count). A-Z are lower-cased;
    tokens are the words between ASCII white space, then one end. ``base_score`` and ``score`` are log10
    probabilities of the whole text, by smoothed word counts and by the model. Null and empty text have the end as
    their only token. Repeated rows count and are scored each. With no training row the model gives every token
    probability 1 (nothing is known) and the base what its formula gives. Other columns are ignored; an empty table
    gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", "held_out", F.monotonically_increasing_id().alias("row"))
    slices = stored(rows.mapInArrow(
        _sliced_tokens, f"slice long, doc_ids array<{kind}>, held array<boolean>, lengths binary, words binary, "
                        "tokens binary, n long"), "slices")
    total, starts = slices.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.coalesce(F.sum(F.size(F.filter("held", lambda held: ~held))), F.lit(0))).first()
    bits = max(0, math.ceil(math.log2(max(total, 1) / PARTITION)))
    dealt = "part long, slice long, keys binary, counts binary"
    words = _summed(slices.mapInArrow(_words_dealt(bits), dealt), "words")
    bigrams = _summed(slices.mapInArrow(_bigrams_dealt(bits), dealt), "bigrams")
    model = _Model(_statistics(words), _statistics(bigrams))

    def returned(totals: DataFrame, name: str) -> DataFrame:
        return totals.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("part", "totals"))).alias(name))

    answered = slices.join(returned(words, "word_totals"), "slice").join(returned(bigrams, "bigram_totals"), "slice")
    asked = _ASKED.format(kind=kind)
    schema = _arrow_schema(docs, asked)
    scored = answered.mapInArrow(_asked(model, bits, int(starts), schema), asked).groupBy("part").applyInArrow(
        _weighted(model),
        f"slice long, part long, doc_ids array<{kind}>, held array<boolean>, n_tokens binary, n_known binary, "
        "base binary, score binary, who binary, sums binary")
    return scored.groupBy("slice").agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in _DOCUMENTS],
        F.sort_array(F.collect_list(F.when(F.col("who").isNotNull(), F.struct("part", "who", "sums")))).alias("parts"),
    ).mapInArrow(
        _collected, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.size).cast("long").alias("train_tokens"),
             "base_score", "score")


def _arrow_schema(docs: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(docs.sparkSession.createDataFrame([], ddl).schema)

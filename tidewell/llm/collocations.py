"""Phrase collocation mining: level by level, with double-array tries of frequent phrases broadcast to the text.

Phrases of k words can be frequent only where both of their parts of k - 1 words are. So the frequent phrases of one
level become a double-array trie over word numbers, a task advances the states of all places of its text at once, one
level of the trie after another (numpy), and where two neighbouring places both end in an accepting state there is a
candidate of k words. These pairs of states are numbered and counted by ``bincount``, and the counts of all shards of
the text are summed per phrase. Candidates are thus the ones that occur: joining frequent phrases by their overlap
instead would list all pairs around a frequent word.

A trie holds fixed-width hashes of words, of about ``BLOCK`` phrases. More phrases are several tries, to which they are
dealt by the hashes of their words; so the words at a place tell the one trie that may hold them, and a level is one pass
over the text with any number of tries. A task keeps ``HELD`` of them loaded and others only while it looks a slice up.
Hashes only select candidates. Counts are per phrase as it is written, so they are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import sliced, stored, texts

LONGEST = 5
# Phrases a broadcast trie holds: at most four 8-byte hashes, one number and a few slots each.
BLOCK = 1 << 18
# Tries that stay loaded in a task, some 10 MB each.
HELD = 8
# How many bits a word's hash moves for each place further to the right, and the bits that deal phrases out.
SHIFT, DEALT = 5, (1 << 31) - 1
# A byte that UTF-8 never has stands for the end of a piece.
END = b"\xff"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + END * 10)
# Free places tried for a node's children before they go behind all others.
TRIES = 48
SEED = 42


class DoubleArray:
    """A trie of equally long number sequences below one root per language.

    The child of state s by symbol c is state base[s] + c if check of it is s. States are slots of the two arrays; those
    at the last level are accepting, and ``number`` counts them in order of the sequences. A number goes in as two
    digits, so that the children of a state lie close together and the arrays stay about as long as there are states.
    """

    def __init__(self, roots: np.ndarray, numbers: np.ndarray):
        """``roots`` has the root (0, 1, ...) and ``numbers`` the numbers (a row) of each sequence; no two are alike."""
        self.radix = 1 << (max(int(numbers.max(initial=0)).bit_length(), 1) + 1) // 2
        symbols = np.stack([numbers // self.radix, numbers % self.radix], axis=2).reshape(len(numbers), -1)
        count = int(roots.max()) + 1 if len(roots) else 0
        self.size, self.depth = count, symbols.shape[1]
        room = count + symbols.size + self.radix + 16
        self.base, self.check = np.zeros(room, np.int32), np.full(room, -1, np.int32)
        self.check[:count] = -2
        self.free = count
        states = roots.astype(np.int64)
        order = np.lexsort([symbols[:, level] for level in reversed(range(self.depth))] + [roots])
        states, rows = states[order], symbols[order]
        for level in range(self.depth):
            states = self._level(states, rows[:, level])
        self.number = np.full(self.size, -1, np.int32)
        self.number[states] = np.arange(len(states))
        self.base, self.check = self.base[:self.size].copy(), self.check[:self.size].copy()

    def _level(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Make room for the children of all states of a level; the state of each row after its symbol."""
        if not len(parents):
            return parents
        changed = np.ones(len(parents), bool)
        changed[1:] = (parents[1:] != parents[:-1]) | (symbols[1:] != symbols[:-1])
        heads = np.flatnonzero(changed)
        node, symbol = parents[heads], symbols[heads].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        sizes = np.diff(np.r_[starts, len(node)])
        slots = np.empty(len(node), np.int64)
        for group in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")]:
            where = slice(starts[group], starts[group] + sizes[group])
            base = self._fit(symbol[where])
            slots[where] = base + symbol[where]
            self._take(int(node[starts[group]]), base, slots[where])
        # An only child fits into any free slot.
        single = starts[sizes == 1]
        self._grow(self.size + len(single) + 1)
        slots[single] = np.flatnonzero(self.check == -1)[:len(single)]
        self.base[node[single]] = slots[single] - symbol[single]
        self.check[slots[single]] = node[single]
        if len(single):
            self.size = max(self.size, int(slots[single].max()) + 1)
        return slots[np.cumsum(changed) - 1]

    def _grow(self, least: int) -> None:
        if least > len(self.check):
            more = max(least, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int32)]
            self.check = np.r_[self.check, np.full(more, -1, np.int32)]

    def _fit(self, symbols: np.ndarray) -> int:
        """A base that puts all symbols into free slots."""
        spread = int(symbols[-1] - symbols[0])
        self._grow(self.size + spread + TRIES + 2)
        while self.check[self.free] != -1:
            self.free += 1
        for slot in (self.free + np.flatnonzero(self.check[self.free:self.free + 4 * TRIES] == -1)[:TRIES]).tolist():
            base = slot - int(symbols[0])
            self._grow(slot + spread + 1)
            if (self.check[base + symbols] == -1).all():
                return base
        return self.size - int(symbols[0])

    def _take(self, parent: int, base: int, slots: np.ndarray) -> None:
        self._grow(int(slots[-1]) + 1)
        self.base[parent] = base
        self.check[slots] = parent
        self.size = max(self.size, int(slots[-1]) + 1)

    def advance(self, root: int, numbers: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """For each place the number of the sequence that begins there, or -1; with ``places``, for these ones only.

        A number below 0 is in no sequence.
        """
        places = np.flatnonzero(numbers >= 0) if places is None else places[numbers[places] >= 0]
        states = np.full(len(places), root, np.int64)
        for level in range(self.depth):
            ahead, low = divmod(level, 2)
            if ahead and not low:
                inside = places + ahead < len(numbers)
                places, states = places[inside], states[inside]
            number = numbers[places + ahead]
            target = self.base[states] + (number % self.radix if low else number // self.radix)
            inside = (number >= 0) & (target >= 0) & (target < self.size)
            places, states, target = places[inside], states[inside], target[inside]
            met = self.check[target] == states
            places, states = places[met], target[met]
        found = np.full(len(numbers), -1, np.int64)
        found[places] = self.number[states]
        return found


class PhraseTrie:
    """A double array over the words that its phrases have, which are known by their hashes."""

    def __init__(self, langs: np.ndarray, words: np.ndarray):
        self.langs, roots = np.unique(langs, return_inverse=True)
        self.words = np.unique(words)
        self.trie = DoubleArray(roots.reshape(-1), np.searchsorted(self.words, words))

    def accepted(self, lang: int, hashes: np.ndarray, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Numbers of the phrases at some places; ``codes`` (below 0: no word) point into the words' ``hashes``.

        ``places`` have a word at each of the next places that a phrase takes.
        """
        at = np.searchsorted(self.langs, lang)
        if not len(places) or at == len(self.langs) or self.langs[at] != lang:
            return np.full(len(places), -1, np.int64)
        asked = np.zeros(len(hashes), bool)
        for shift in range(self.trie.depth // 2):
            asked[codes[places + shift]] = True
        asked = np.flatnonzero(asked)
        near = np.minimum(np.searchsorted(self.words, hashes[asked]), len(self.words) - 1)
        symbols = np.full(len(hashes) + 1, -1, np.int64)
        symbols[asked] = np.where(self.words[near] == hashes[asked], near, -1)
        return self.trie.advance(int(at), symbols[codes], places)[places]


def _hash(word: bytes) -> int:
    """As Spark's xxhash64 of the word."""
    return xxhash.xxh64_intdigest(word, seed=SEED)


def _tokens(batch: pa.RecordBatch):
    """lang, its words' dictionary and, for all words of its texts in order, their codes; -1 ends a piece."""
    langs, content = batch.column("lang").to_pylist(), texts(batch)
    rows: dict[str, list[bytes]] = {}
    for lang, text in zip(langs, content):
        rows.setdefault(lang, []).append(text)
    for lang, found in rows.items():
        words = END.join(found).translate(_TABLE).replace(END, b" " + END + b" ").split()
        encoded = pa.array(words + [END], pa.large_binary()).dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes[codes == codes[-1]] = -1
        yield lang, encoded.dictionary, codes


def _rows(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([lang], pa.string()).take(pa.array(np.zeros(len(counts), np.int64))), phrases.cast(pa.string()),
        pa.array(counts, pa.int64())], ["lang", "phrase", "f"])


def _count_words(batches):
    for batch in sliced(batches):
        for lang, known, codes in _tokens(batch):
            counts = np.bincount(codes[codes >= 0], minlength=len(known))
            there = np.flatnonzero(counts)
            if len(there):
                yield _rows(lang, known.take(pa.array(there)), counts[there])


def _dealt(words: Sequence[np.ndarray], parts: int) -> np.ndarray:
    """The trie of phrases with these hashes of the first, second ... word; see ``_tries`` for the same in Spark."""
    mixed = reduce(np.bitwise_xor, [word >> np.uint64(SHIFT * place) for place, word in enumerate(words)])
    return (mixed & np.uint64(DEALT)).astype(np.int64) % parts


class _Looked:
    """The words of a slice in one language, and the number among all tries' phrases that begins at each place."""

    def __init__(self, lang: str, known: pa.Array, codes: np.ndarray, size: int, parts: int):
        self.lang, self.known, self.codes, self.name = lang, known, codes, _hash(lang.encode())
        self.hashes = np.array([_hash(word) for word in known.to_pylist()], np.uint64)
        whole = codes >= 0
        for shift in range(1, size):
            whole[:-shift] &= codes[shift:] >= 0
            whole[-shift:] = False
        self.places, self.found = np.flatnonzero(whole), np.full(len(codes), -1, np.int64)
        self.ends = np.array([len(self.places)])
        if parts > 1:
            part = _dealt([self.hashes[codes[self.places + shift]] for shift in range(size)], parts)
            self.places = self.places[np.argsort(part, kind="stable")]
            self.ends = np.cumsum(np.bincount(part, minlength=parts))

    def look(self, part: int, trie: PhraseTrie, first: int) -> None:
        places = self.places[self.ends[part - 1] if part else 0:self.ends[part]]
        numbers = trie.accepted(np.uint64(self.name), self.hashes, self.codes, places)
        self.found[places] = np.where(numbers >= 0, numbers + first, -1)


def _count_pairs(tries: Sequence, firsts: Sequence[int], size: int):
    """Counts of the phrases of ``size`` words whose parts are in the broadcast tries.

    ``firsts`` has the number of each trie's first phrase among all, and behind them how many there are.
    """
    def run(batches):
        for batch in sliced(batches):
            looked = [_Looked(*tokens, size - 1, len(tries)) for tokens in _tokens(batch)]
            for part, trie in enumerate(tries):
                if firsts[part] == firsts[part + 1]:
                    continue
                for some in looked:
                    some.look(part, trie.value, firsts[part])
                if part >= HELD:  # its file stays
                    vars(trie).pop("_value", None)
            for some in looked:
                starts, codes, known = some.found, some.codes, some.known
                places = np.flatnonzero((starts[:-1] >= 0) & (starts[1:] >= 0))
                if not len(places):
                    continue
                # Pairs are numbered by hashing, as sorting them would take several times as long.
                pairs = pa.array(starts[places] * firsts[-1] + starts[places + 1]).dictionary_encode()
                state = pairs.indices.to_numpy()
                counts, at = np.bincount(state), np.empty(len(pairs.dictionary), np.int64)
                at[state] = np.arange(len(state))
                words = [known.take(pa.array(codes[places[at] + shift])) for shift in range(size)]
                yield _rows(some.lang, pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())), counts)
    return run


COUNTS = "lang string, phrase string, f long"


def _tries(phrases: DataFrame, size: int, block: int) -> tuple[list, list[int]]:
    """Broadcast tries of all phrases of ``size`` words, about ``block`` in each, and the first number of each trie."""
    context = phrases.sparkSession.sparkContext
    parts = max(1, -(-phrases.count() // block))
    words = F.transform(F.split("phrase", " "), lambda word: F.xxhash64(word))
    mixed = reduce(lambda a, b: a.bitwiseXOR(b), [
        F.shiftrightunsigned(F.element_at("words", place + 1), SHIFT * place) for place in range(size)])
    hashed = phrases.select(F.xxhash64("lang").alias("lang"), words.alias("words")).withColumn(
        "part", (mixed.bitwiseAND(F.lit(DEALT)) % parts).cast("int"))
    # Each trie's phrases lie in a folder of their own, so that no others are read for it.
    dealt = stored(hashed, "dealt", ["part"])
    found, firsts = [], [0]
    for part in range(parts):
        # What reaches the driver at a time is one trie's.
        some = dealt.filter(F.col("part") == part).select("lang", "words").toArrow()
        langs = some.column("lang").to_numpy().view(np.uint64)
        words = some.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        found.append(context.broadcast(PhraseTrie(langs, words.reshape(-1, size)) if len(langs) else None))
        firsts.append(firsts[-1] + len(langs))
    return found, firsts


def phrase_counts(docs: DataFrame, least: int, longest: int = LONGEST, block: int = BLOCK) -> list[DataFrame]:
    """Stored tables (lang, phrase, f), first of all words and then of the phrases of 2, 3 ... words with f >= least."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    levels = [stored(rows.mapInArrow(_count_words, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")]
    frequent = levels[0].filter(F.col("f") >= least)
    for size in range(2, longest + 1):
        tries, firsts = _tries(frequent, size - 1, block)
        if not firsts[-1]:
            break
        counted = rows.mapInArrow(_count_pairs(tries, firsts, size), COUNTS).groupBy("lang", "phrase").agg(
            F.sum("f").alias("f"))
        frequent = stored(counted.filter(F.col("f") >= least), "phrases")
        levels.append(frequent)
        for trie in tries:
            trie.unpersist()
    return levels


def _wide(name: str, digits: int = 17):
    return F.col(name).cast(f"decimal({digits},0)")


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000,
                 block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases per language.

    Texts are cut at ``.,;:!?`` and line ends into pieces, these at spaces and tabs into words; A-Z counts as a-z. A
    phrase with f >= least has the score of its lowest-scoring cut (ties: the earliest), floor(1000 * a * n / (l * r)),
    computed in decimals of 38 digits. Phrases inside a longer one that is as frequent are left out. Ties in rank go by a
    and then by the phrase's bytes. Null lang is ``und``, null text empty; repeated rows all count; doc_id and other
    columns are ignored; an empty table gives no rows. A very long text is one slice of its task, and its words are
    counted whole.
    """
    words, *levels = phrase_counts(docs, least, longest, block)
    if not levels:
        levels = [words.limit(0)]
    found = reduce(DataFrame.unionByName, levels).withColumn("words", F.split("phrase", " "))
    parts = reduce(DataFrame.unionByName, [words.filter(F.col("f") >= least), *levels])
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    joined = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cut, length = F.col("cut"), F.size("words")
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), length - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut", joined(F.lit(1), cut).alias("first"),
        joined(cut + 1, length - cut).alias("rest"))
    sized = (
        cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("over", F.lit(1000).cast("decimal(4,0)") * _wide("a") * _wide("n"))
        .withColumn("under", _wide("l", 19) * _wide("r", 19))
        .withColumn("score", F.expr("over div under"))
    )
    lowest = sized.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("at"), F.first("a").alias("a"), F.first("n").alias("n"))
    inside = found.filter(length >= 3).withColumn("size", F.explode(F.sequence(F.lit(2), length - 1))).withColumn(
        "start", F.explode(F.sequence(F.lit(1), length - F.col("size") + 1)))
    longer = inside.select("lang", joined(F.col("start"), F.col("size")).alias("phrase"), "f").groupBy(
        "lang", "phrase").agg(F.max("f").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("at.score").desc(), F.col("a").desc(), F.col("phrase"))
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "at.l", "at.r", "n", "at.score")

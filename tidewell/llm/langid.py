"""Language identification by interpolated Kneser-Ney character models.

One model per language predicts the letters of a word and its end from up to ``order - 1`` characters before, the
word's start included. All languages share sorted arrays of n-gram hashes, one pair per order: the n-grams seen in
any language with each language's log probability, and the contexts with each language's backoff weight. A text is
given the language of lowest cross-entropy per character, and rejected if even that lies far above what texts of the
language have; how far is measured on labelled texts that were kept from the counts.

Words do not depend on their neighbours, so a task scores each distinct word of a slice of text once. The models come
from a bounded sample of labelled rows (``sample`` per language) and are broadcast; their size follows that bound.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import sliced, stored

ORDER = 5
SAMPLE = 1500
# One labelled row in so many is kept from the counts to calibrate the rejection.
CALIBRATION = 3
UNDETERMINED = "und"
EDGE = " "
# Rejection: excess bits per character, at this share of calibration texts, times a margin; never under the floor, which
# lies above what own texts stray and below what texts of a language not learned do.
TAIL, MARGIN, FLOOR = 0.99, 1.25, 0.8
# Text of a slice; a task scores each of its distinct words once.
SLICE = 4 << 20
# Texts this short are expected to stray further from the mean.
SHORT = 100
_BASE = np.uint64(0x9E3779B97F4A7C15)


class LanguageModels(NamedTuple):
    languages: list[str]
    order: int
    grams: list[tuple[np.ndarray, np.ndarray]]  # by length - 1: sorted hashes, log2 probability per language
    contexts: list[tuple[np.ndarray, np.ndarray]]  # by length - 1: sorted hashes, log2 backoff weight per language
    unseen: np.ndarray  # log2 probability of a character no model knows
    usual: np.ndarray  # mean bits per character of a language's own texts
    excess: np.ndarray  # bits per character above that at which a text is rejected


def _words(column) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of each text, word indices of all texts, and the lower-case words; '' for one without a letter."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    parts = pc.split_pattern_regex(lowered, r"[^\p{L}\p{M}]+")
    encoded = pc.dictionary_encode(parts.flatten())
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    words = encoded.dictionary
    lettered = pc.if_else(pc.match_substring_regex(words, r"\p{L}"), words, "")
    return sizes, encoded.indices.to_numpy(zero_copy_only=False), lettered


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """By length - 1: the hash of the n-gram that ends at each place (places too early hold rubbish)."""
    found, current = [], np.zeros(len(points), np.uint64)
    power = np.uint64(1)
    for length in range(1, order + 1):
        shifted = np.zeros(len(points), np.uint64)
        shifted[length - 1:] = points[:max(len(points) - length + 1, 0)]
        current = current + (shifted + np.uint64(1)) * power
        power = power * _BASE
        found.append(_mixed(current))
    return found


def _look_up(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, values = table
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros((len(wanted), values.shape[1]), np.float32)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[place] == wanted, values[place]


def word_scores(words: list[str], models: LanguageModels) -> tuple[np.ndarray, np.ndarray]:
    """log2 probability of each word in each language, and the number of characters predicted (0 for '')."""
    with np.errstate(over="ignore"):
        points = _code_points("".join(f"{EDGE}{word}{EDGE}" for word in words))
        lengths = np.array([len(word) + 2 for word in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        hashes = _hashes(points, models.order)
    before = np.arange(len(points)) - np.repeat(starts, lengths)  # characters of the word before each place
    places = np.flatnonzero(before > 0)
    result = np.zeros((len(points), len(models.languages)))
    length = np.minimum(before[places] + 1, models.order)
    for size in range(models.order, 0, -1):
        here = np.flatnonzero(length == size)
        at = places[here]
        seen, values = _look_up(models.grams[size - 1], hashes[size - 1][at])
        result[at[seen]] += values[seen]
        lost = ~seen
        if size == 1:
            result[at[lost]] += models.unseen
            break
        known, weights = _look_up(models.contexts[size - 2], hashes[size - 2][at[lost] - 1])
        result[at[lost][known]] += weights[known]
        length[here[lost]] = size - 1
    sums = np.add.reduceat(result, starts, axis=0) if len(words) else np.zeros((0, len(models.languages)))
    empty = lengths == 2
    sums[empty] = 0
    return sums, np.where(empty, 0, lengths - 1)


def _entropies(column, models: LanguageModels) -> tuple[np.ndarray, np.ndarray]:
    """Bits per predicted character of each text in each language, and the number of characters."""
    sizes, indices, words = _words(column)
    bits, lengths = word_scores(words.to_pylist(), models)
    ends = np.cumsum(sizes)
    sums = np.zeros((len(sizes), len(models.languages)))
    counts = np.zeros(len(sizes), np.int64)
    for language in range(len(models.languages)):
        running = np.concatenate(([0.0], np.cumsum(bits[indices, language])))
        sums[:, language] = running[ends] - running[ends - sizes]
    running = np.concatenate(([0], np.cumsum(lengths[indices])))
    counts[:] = running[ends] - running[ends - sizes]
    return -sums / np.maximum(counts, 1)[:, None], counts


def _strayed(excess: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return excess * np.sqrt(counts / (counts + SHORT))


def _counted(batches):
    """lang, word and how often, summed within a slice."""
    for batch in sliced(batches, limit=SLICE):
        sizes, indices, words = _words(batch.column("text"))
        langs = batch.column("lang").dictionary_encode()
        codes = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes)
        pairs, counts = np.unique(codes * len(words) + indices, return_counts=True)
        yield pa.RecordBatch.from_arrays([
            langs.dictionary.take(pa.array(pairs // max(len(words), 1))),
            words.take(pa.array(pairs % max(len(words), 1))), pa.array(counts, pa.int64())], ["lang", "word", "n"])


def kneser_ney(counts: dict[str, int], order: int) -> tuple[list[dict], list[dict], float]:
    """log2 p(last | rest) of each n-gram and log2 backoff weight of each context, by length - 1.

    ``counts`` has the n-grams of full ``order`` and the shorter ones that begin at a word's start. Below the full
    order an n-gram counts the distinct characters before it, except at a word's start, where nothing stands before.
    The third value is the log2 probability of a character never seen.
    """
    adjusted: list[dict] = [defaultdict(int) for _ in range(order)]
    for gram, n in counts.items():
        adjusted[len(gram) - 1][gram] = n
    for length in range(order, 1, -1):
        for gram in adjusted[length - 1]:
            shorter = gram[1:]
            if len(shorter) == 1 or shorter[0] != EDGE:
                adjusted[length - 2][shorter] += 1
    probabilities: list[dict] = [{} for _ in range(order)]
    weights: list[dict] = [{} for _ in range(order)]
    alphabet = len(adjusted[0]) + 1
    below_unseen = 1.0 / alphabet
    unseen = below_unseen
    for length in range(1, order + 1):
        table = adjusted[length - 1]
        ones = sum(1 for n in table.values() if n == 1)
        twos = sum(1 for n in table.values() if n == 2)
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        totals, kinds = defaultdict(int), defaultdict(int)
        for gram, n in table.items():
            totals[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        backoff = {context: discount * kinds[context] / totals[context] for context in totals}
        for gram, n in table.items():
            context = gram[:-1]
            lower = probabilities[length - 2][gram[1:]] if length > 1 else below_unseen
            probabilities[length - 1][gram] = (n - discount) / totals[context] + backoff[context] * lower
        if length == 1:
            unseen = backoff.get("", 1.0) * below_unseen
        else:
            weights[length - 2] = backoff
    return probabilities, weights, unseen


def _hash_of(grams: list[str], length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        points = _code_points("".join(grams))
        return _hashes(points, length)[length - 1][length - 1::length] if len(points) else np.zeros(0, np.uint64)


def _tables(per_language: list[tuple[list[dict], list[dict], float]], order: int):
    """Shared sorted hash arrays over all languages; what a language lacks is filled in by its backoff."""
    def probability(model, gram: str) -> float:
        probabilities, weights, unseen = model
        if gram in probabilities[len(gram) - 1]:
            return probabilities[len(gram) - 1][gram]
        if len(gram) == 1:
            return unseen
        return weights[len(gram) - 2].get(gram[:-1], 1.0) * probability(model, gram[1:])

    def arrays(keys: list[str], length: int, value) -> tuple[np.ndarray, np.ndarray]:
        hashes = _hash_of(keys, length)
        rank = np.argsort(hashes)
        values = np.array([[value(model, key) for model in per_language] for key in keys], np.float64)
        return hashes[rank], np.log2(values.reshape(len(keys), len(per_language)))[rank].astype(np.float32)

    grams, contexts = [], []
    for length in range(1, order + 1):
        keys = sorted(set().union(*[model[0][length - 1] for model in per_language]))
        grams.append(arrays(keys, length, probability))
        if length < order:
            keys = sorted(set().union(*[model[1][length - 1] for model in per_language]))
            contexts.append(arrays(keys, length, lambda model, key: model[1][len(key) - 1].get(key, 1.0)))
    return grams, contexts, np.log2(np.array([model[2] for model in per_language]))


def train(labelled: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> LanguageModels | None:
    """Models from rows with text and lang; None if there is no such row with a letter.

    Of each language about ``sample`` rows are used, the same ones each time (those whose hash of the text lies below
    a share of its range); one in ``CALIBRATION`` of them sets the rejection. n-gram counts of the sample reach the
    driver, nothing else.
    """
    spark = labelled.sparkSession
    rows = labelled.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40)
    sizes = rows.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return None
    # A few rows, already counted on the driver, beside the documents: no text is shuffled by language.
    shares = spark.createDataFrame([(row.lang, sample / row["count"]) for row in sizes], "lang string, share double")
    drawn = stored(
        rows.withColumn("place", place).join(F.broadcast(shares), "lang").filter(F.col("place") < F.col("share"))
        .select("lang", "text", (F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(CALIBRATION)) == 0).alias("apart")),
        "langid")
    words = drawn.filter(~F.col("apart")).select("lang", "text").mapInArrow(_counted, "lang string, word string, n long")
    edged = words.filter("word != ''").groupBy("lang", "word").agg(F.sum("n").alias("n")).withColumn(
        "edged", F.concat(F.lit(EDGE), "word", F.lit(EDGE)))
    gram = F.transform(
        F.sequence(F.lit(2), F.length("edged")),
        lambda end: F.substring("edged", F.greatest(F.lit(1), end - order + 1), F.least(F.lit(order), end)))
    counts = edged.select("lang", "n", F.explode(gram).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_language: dict[str, dict[str, int]] = defaultdict(dict)
    for batch in counts.toArrow().to_batches():
        for lang, text, n in zip(*[column.to_pylist() for column in batch.columns]):
            by_language[lang][text] = n
    languages = sorted(by_language)
    if not languages:
        return None
    grams, contexts, unseen = _tables([kneser_ney(by_language[name], order) for name in languages], order)
    blank = np.zeros(len(languages))
    models = LanguageModels(languages, order, grams, contexts, unseen, blank, blank)
    return _calibrated(spark, models, drawn.filter("apart").select("lang", "text"))


def _calibrated(spark, models: LanguageModels, apart: DataFrame) -> LanguageModels:
    shared = spark.sparkContext.broadcast(tuple(models))

    def own(batches):
        for batch in sliced(batches, limit=SLICE):
            known = LanguageModels(*shared.value)
            bits, counts = _entropies(batch.column("text"), known)
            codes = [known.languages.index(lang) if lang in known.languages else -1
                     for lang in batch.column("lang").to_pylist()]
            rows = np.array([row for row, code in enumerate(codes) if code >= 0 and counts[row]], np.int64)
            picked = bits[rows, [codes[row] for row in rows]] if len(rows) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(rows)), pa.array(picked, pa.float64()), pa.array(counts[rows])],
                ["lang", "bits", "n"])

    scored = apart.mapInArrow(own, "lang string, bits double, n long")
    means = scored.groupBy("lang").agg((F.sum(F.col("bits") * F.col("n")) / F.sum("n")).alias("usual"))
    strayed = (F.col("bits") - F.col("usual")) * F.sqrt(F.col("n") / (F.col("n") + SHORT))
    tails = scored.join(means, "lang").groupBy("lang").agg(
        F.first("usual").alias("usual"), F.percentile_approx(strayed, TAIL, 10_000).alias("tail"))
    found = {row.lang: (row.usual, row.tail) for row in tails.collect()}  # one row per language
    # A language without calibration texts is never rejected.
    usual, tail = zip(*[found.get(name, (0.0, float("inf"))) for name in models.languages])
    return models._replace(usual=np.array(usual), excess=np.maximum(np.array(tail) * MARGIN, FLOOR))


def identify(docs: DataFrame, models: LanguageModels | None, carry: bool = True) -> DataFrame:
    """Per input row: doc_id, row (all columns as a struct, with ``carry``), lang_pred, score, bits and rejected.

    ``bits`` is the cross-entropy per character in the language of lowest cross-entropy, ``score`` that language's
    share of the probability over all, with texts weighing as 64 characters at most. A text that is null or has no
    letter is ``und`` with score 0 and rejected, as is every text if there are no models; any other gets a learned
    language, and ``rejected`` says whether its bits exceed the language's calibrated limit. Ties go to the language
    first in code-point order. Texts are read whole. Rows keep their columns, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models and tuple(models))

    def run(batches):
        known = shared.value and LanguageModels(*shared.value)
        for batch in sliced(batches, limit=SLICE):
            rows = batch.num_rows
            named, score, least = np.full(rows, UNDETERMINED, object), np.zeros(rows), np.full(rows, np.nan)
            rejected = np.ones(rows, bool)
            if known is not None:
                bits, counts = _entropies(batch.column("text"), known)
                best = bits.argmin(axis=1)
                lettered = counts > 0
                own = bits[np.arange(rows), best]
                weight = np.minimum(counts, 64)[:, None]
                named[lettered] = np.array(known.languages, object)[best[lettered]]
                score[lettered] = (1.0 / np.exp2((own[:, None] - bits) * weight).sum(axis=1))[lettered]
                least[lettered] = own[lettered]
                strayed = _strayed(own - known.usual[best], counts)
                rejected = ~lettered | (strayed > known.excess[best])
            names = [name for name in batch.schema.names if carry or name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in names], pa.array(named, pa.string()), pa.array(score),
                 pa.array(least, from_pandas=True), pa.array(rejected)],
                [*names, "lang_pred", "score", "bits", "rejected"])

    # The text travels once, beside the other columns.
    others = [docs[name] for name in docs.columns if name != "text"]
    packed = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), *(
        [F.struct(*others).alias("others")] if carry else []))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema if carry or f.name != "text")
    found = packed.mapInArrow(run, f"{kinds}, lang_pred string, score double, bits double, rejected boolean")
    if not carry:
        return found
    row = F.struct(*[(F.col("text") if name == "text" else F.col("others").getField(name)).alias(name)
                     for name in docs.columns])
    return found.select("doc_id", row.alias("row"), "lang_pred", "score", "bits", "rejected")

"""Quality rules: a hashed n-gram log-likelihood ratio beside a few counts, in DataFrame operations only.

There is a model of single words and one of pairs of neighbours. Each hashes its n-grams into a fixed number of buckets.
Two multinomials are counted over them, one from trusted documents and one from the whole corpus; a document's score is
the mean log ratio of its n-grams, so length does not move it. Some trusted documents are held out of the models. Their
scores set one limit for each model that every document is held against, by the same rule whatever the number of labels.
The limits are apart because trusted pairs are seldom seen twice: in one mean with words they would draw the limit down
to what junk scores.

All trusted documents count, however many there are: those whose ids a bitmap of fixed size lets through are shuffled to
the trusted ids, no other text is. Counting sends one row per bucket and task; scoring explodes a document in place, meets
the models (one row per bucket, a fixed number, so they are broadcast) and folds again in the same task. The scores of the
documents held out are taken from those of all documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import WORD, stored
from tidewell.operators.ranking import with_position

BUCKETS = 1 << 16


class Model(NamedTuple):
    """What n-grams are counted together, in how many buckets, and by what share of the way to the lowest weight the limit
    would move beyond ``MARGIN`` if no document set it; see ``fitted_limits``."""
    orders: Sequence[int]
    buckets: int = BUCKETS
    unsure: float = 0.0


# Pairs are mostly different: in few buckets each would be full of others' counts and all weights near 0, and with few
# trusted documents most pairs of a good text are new, more or less by chance.
MODELS = (Model((1,)), Model((2,), 1 << 18, 0.8))
# Bits, of them in one row, of the bitmap of hashed ids: ids beyond some tens of millions let other documents through, too,
# which only costs the shuffle of their texts.
BITS, ROW_BITS = 1 << 26, 1 << 15
# One of so many trusted documents is held out; the limit lies a share of the way from a low quantile of their scores
# to the lowest weight there is.
HELD_OUT, QUANTILE, MARGIN = 3, 0.01, 0.2
SMOOTHING = 0.5
# The trusted multinomial is drawn to the raw one by this share of its own n-grams, so ratios are as wild with few
# labels as with many: the weight of an n-gram that no trusted document has is always log(1/3).
PRIOR = 0.5
LOWEST = math.log(PRIOR / (1 + PRIOR))
# Weights are whole numbers of so many parts of one, so that sums are exact and do not depend on row order.
UNIT = 1_000_000_000
# Places in a text fit these bits beside 44 bits of a window's hash; longer texts sort whole hashes.
PLACE_BITS = 20



def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _models(orders: Sequence[Model] | Sequence[int]) -> Sequence[Model]:
    return [Model(orders)] if isinstance(orders[0], int) else orders


def _first_slots(models: Sequence[Model]) -> list[int]:
    """Where each model's buckets begin, as they follow each other, and where the last one's end."""
    return [0, *accumulate(model.buckets for model in models)]


def _slots(models: Sequence[Model]) -> list[list[str]]:
    """Names of each model's slot columns, one for each of its orders."""
    return [[f"slot_{number}_{n}" for n in model.orders] for number, model in enumerate(models)]


def _slotted(docs: DataFrame, models: Sequence[Model], *carried: str) -> DataFrame:
    """A row for each of ``hashes``, one at least: ``carried`` and the slots of the n-grams that start there, or null.

    N-grams are put together behind the explode, where code is generated for it; in a lambda they take several times as long.
    """
    rows = docs.select(*carried, "hashes", F.posexplode_outer("hashes").alias("place", "hash"))
    found = []
    for names, model, first in zip(_slots(models), models, _first_slots(models)):
        for name, n in zip(names, model.orders):
            gram = F.col("hash") if n == 1 else F.xxhash64(
                "hash", *[F.get("hashes", F.col("place") + ahead) for ahead in range(1, n)])
            slot = F.pmod(gram, F.lit(model.buckets)).cast("int") + first
            found.append(F.when(F.col("place") + n <= F.size("hashes"), slot).alias(name))
    return rows.select(*carried, *found)


def trusted_documents(labels: DataFrame) -> DataFrame:
    """All doc_ids of quality 1, each once."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def _bit(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), doc_id), F.lit(BITS))


def marked_documents(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """good (1 or 0) and text of every document; ``trusted`` holds distinct doc_ids, as many as there are.

    Documents and labels grow alike, so they are merged at any size; of the documents only those whose bit is set.
    """
    bits = trusted.select(_bit(F.col("doc_id")).alias("bit")).select(
        F.expr(f"bit div {ROW_BITS}").alias("part"), (F.col("bit") % ROW_BITS).alias("bit"))
    # Dealt out by part first, so that ids are sent and not a bitmap of each task.
    bitmap = stored(bits.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")), "bitmap")
    bit = _bit(F.col("doc_id"))
    place = (bit % ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.expr("place div 8") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.select("doc_id", "text", F.floor(bit / ROW_BITS).alias("doc_part"), place.alias("place")).join(
        F.broadcast(bitmap), F.col("doc_part") == F.col("part"), "left").withColumn(
        "likely", F.coalesce(F.getbit(byte, F.col("place") % 8) == 1, F.lit(False)) & F.col("doc_id").isNotNull())
    likely = found.filter("likely").select("doc_id", "text").hint("merge").join(
        trusted.select(F.col("doc_id").alias("t_id")), F.col("doc_id") == F.col("t_id"), "left")
    return likely.select(F.col("t_id").isNotNull().cast("long").alias("good"), "text").union(
        found.filter("NOT likely").select(F.lit(0).cast("long").alias("good"), "text"))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), doc_id), F.lit(HELD_OUT)) == 0


def ngram_weights(docs: DataFrame, trusted: DataFrame, models: Sequence[Model] = MODELS) -> DataFrame:
    """slot and weight, the smoothed log ratio of trusted to raw probability in parts of ``UNIT``; one row for each bucket
    of the models.

    The raw counts cover every document, the trusted ones all that ``trusted`` has the distinct doc_ids of. Without a
    trusted n-gram of a model all its weights are 0.
    """
    hashed = marked_documents(docs, trusted).select("good", F.transform(
        _words(F.col("text")), lambda word: F.xxhash64(word)).alias("hashes"))
    # Stored, as the totals would read and count all texts again.
    slots = F.explode(F.array(*[name for names in _slots(models) for name in names])).alias("slot")
    counts = stored(_slotted(hashed, models, "good").select("good", slots).filter("slot IS NOT NULL").groupBy("slot").agg(
        F.count("*").alias("raw"), F.sum("good").alias("good")), "counts")
    firsts = _first_slots(models)
    model = sum(((F.col("slot") >= first).cast("int") for first in firsts[1:-1]), F.lit(0))
    totals = counts.groupBy(model.alias("model")).agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))
    every = docs.sparkSession.range(firsts[-1]).select(F.col("id").cast("int").alias("slot"))
    buckets = F.element_at(F.array(*[F.lit(model.buckets) for model in models]), model + 1)
    raw = (F.coalesce("raw", F.lit(0)) + SMOOTHING) / (F.coalesce("all_raw", F.lit(0)) + SMOOTHING * buckets)
    prior = F.greatest(PRIOR * F.coalesce("all_good", F.lit(0)), F.lit(1.0))
    good = (F.coalesce("good", F.lit(0)) + prior * raw) / (F.coalesce("all_good", F.lit(0)) + prior)
    return every.join(counts, "slot", "left").join(F.broadcast(totals), model == F.col("model"), "left").select(
        "slot", (F.log(good / raw).cast("decimal(12,9)") * UNIT).cast("long").alias("weight"))


def _score_names(models: Sequence[Model]) -> list[str]:
    return ["score", *[f"score_{number}" for number in range(2, 1 + len(models))]]


def _scored(grams: DataFrame, weights: DataFrame, models: Sequence[Model], carried: Sequence[str] = ()) -> DataFrame:
    """row_id, ``carried`` and, for each model, the mean weight of the row's n-grams, 0 without any."""
    met, firsts, means = grams, _first_slots(models), []
    for score, names, first, end in zip(_score_names(models), _slots(models), firsts, firsts[1:]):
        own = weights.filter(F.col("slot").between(first, end - 1))
        for name in names:
            met = met.join(F.broadcast(own.select(F.col("slot").alias(f"{name}_known"), F.col("weight").alias(
                f"{name}_weight"))), F.col(name) == F.col(f"{name}_known"), "left")
        total = sum((F.coalesce(F.sum(f"{name}_weight"), F.lit(0)) for name in names), F.lit(0))
        found = sum((F.count(name) for name in names), F.lit(0))
        exact = (total.cast("decimal(19,0)") / F.lit(UNIT).cast("decimal(10,0)")).cast("decimal(28,9)").cast("double")
        means.append(F.coalesce(exact / F.when(found > 0, found), F.lit(0.0)).alias(score))
    return met.groupBy("row_id").agg(*[F.first(name).alias(name) for name in carried], *means)


def low_quantile(scores: DataFrame, name: str, rows: int) -> float:
    """As Spark's ``percentile`` at ``QUANTILE``, which would bring all distinct scores together in one task."""
    position = (rows - 1) * QUANTILE
    low, high = math.floor(position), math.ceil(position)
    # Equal scores are told apart by a number, so that many of them are not one task's.
    order = [F.col(name), F.col("number")]
    placed = with_position(scores.select(name, F.monotonically_increasing_id().alias("number")), order).filter(F.col("position").isin(low + 1, high + 1))
    found = {row.position - 1: row[name] for row in placed.collect()}  # two rows at most
    if found[low] == found[high]:
        return found[low]
    return (high - position) * found[low] + (position - low) * found[high]


def fitted_limits(held: DataFrame, models: Sequence[Model] = MODELS) -> list[float | None]:
    """The least score of each model that passes, from the scores of the trusted documents that did not fit it; None
    without any.

    The limit lies ``MARGIN`` of the way from the low quantile to the lowest weight, and further by ``unsure`` times the
    chance that none of so many documents lies below the true quantile.
    """
    rows = held.count()
    shares = [MARGIN + model.unsure * (1 - QUANTILE) ** rows for model in models]
    lows = [low_quantile(held, name, rows) if rows else None for name in _score_names(models)]
    return [None if low is None else low + share * (LOWEST - low) for low, share in zip(lows, shares)]


def rule_counts(docs: DataFrame) -> DataFrame:
    """doc_id, hashes and the counts of the contract, one row per input row; ``row_id`` tells rows apart."""
    found = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id")).withColumn(
        "words", _words(F.col("text")))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda line: line.rlike(WORD))
    counted = found.select(
        "doc_id", "row_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        lines.alias("lines"), F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"))
    counted = counted.withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    starts = F.when(F.col("n_words") >= 3, F.sequence(F.lit(1), F.col("n_words").cast("int") - 2)).otherwise(
        F.array().cast("array<int>"))
    hash_at = lambda at: F.element_at("hashes", at)
    windowed = counted.withColumn(
        "windows", F.transform(starts, lambda at: F.xxhash64(hash_at(at), hash_at(at + 1), hash_at(at + 2))))
    low = (1 << PLACE_BITS) - 1
    # Sorting hashes with places in their low bits brings equal windows together; the full hashes then decide.
    packed = F.sort_array(F.transform(
        "windows", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
    whole = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    places = F.when(
        F.col("n_words") <= low, F.transform(packed, lambda p: p.bitwiseAND(F.lit(low)).cast("int"))
    ).otherwise(F.transform(whole, lambda p: p["i"].cast("int")))
    ordered = windowed.withColumn("places", places)
    at = lambda i: F.get("windows", F.get("places", i))
    repeated = ordered.withColumn("repeated", F.sort_array(F.filter(
        "places", lambda place, i: (at(i - 1) == F.get("windows", place)) | (at(i + 1) == F.get("windows", place)))))
    # A window covers three words; neighbours overlap.
    gaps = F.transform("repeated", lambda place, i: F.least(
        F.lit(3), F.coalesce(F.get("repeated", i + 1) - place, F.lit(3))))
    return repeated.withColumn(
        "n_repeat_words", F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)
    ).drop("windows", "places", "repeated")


def quality_verdicts(docs: DataFrame, labels: DataFrame, orders: Sequence[Model] | Sequence[int] = MODELS,
                     threshold: float | None = None, least_words: int = 50) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept, score and, for further models, score_2 and so on.

    ``orders`` holds the models; plain numbers, such as (1, 2), are one model of these n-grams together. A score is the
    mean log ratio of the text's n-grams (0 without any); a document is kept if it passes the base rules
    (``least_words`` words, at most half of them in repeated 3-word windows) and scores no less than the limit in every
    model, ``threshold`` if given and else that of ``fitted_limits``. Where no trusted document of ``least_words`` words
    is held out (no or very few labels) there is no limit, and only the base rules decide. Null text has no words. A null
    doc_id is never trusted. Repeated rows each get their row; other columns are ignored; an empty table gives an empty
    result. A text of any length is judged as a whole, by the task that reads it.
    """
    models = _models(orders)
    trusted = stored(trusted_documents(labels).withColumn("held", held_out(F.col("doc_id"))), "trusted")
    weights = stored(ngram_weights(docs, trusted.filter("NOT held"), models), "ngrams")
    names = _score_names(models)
    carried = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    scored = _scored(_slotted(rule_counts(docs), models, "row_id", *carried), weights, models, carried)
    limits = [threshold] * len(models)
    if threshold is None:
        # Stored, as the limits and the verdicts on them come from the same scores.
        scored = stored(scored.drop("row_id"), "scores")
        own = trusted.filter("held").select(F.col("doc_id").alias("t_id"))
        limits = fitted_limits(stored(scored.filter(F.col("n_words") >= least_words).join(
            own, F.col("doc_id") == F.col("t_id"), "left_semi").select(*names), "held"), models)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passed = F.lit(True)
    for name, limit in zip(names, limits):
        passed = passed if limit is None else passed & (F.col(name) >= limit)
    return scored.withColumn("base_failed", failed).select(
        *carried, "base_failed", (~F.col("base_failed") & passed).alias("kept"), *names)

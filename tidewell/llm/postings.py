"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations only.

The index has one posting per token of the training texts: the term (64-bit hash of the word), the row of its document
and its place. It is built where the documents lie: each task writes the postings of its rows as one index shard,
sorted by term, so no text and no posting is shuffled to build it. A posting without a term heads each document and
carries its id and its number of words.

A phrase is looked up from its rarest term. The postings of that term, moved back by its offset, are the only starts the
phrase can have; the second and third rarest term and then all others are intersected with them at their own offsets.
What is joined with the index is first cut down to the terms asked for, so a frequent word's list is read only where
every word of a phrase is frequent, and a list is spread over all shards, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ASCII letters and digits, and everything beyond ASCII. Words are cut before A-Z is lower-cased, so it is in here.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Ranks of terms, by rarity, that are intersected in one step after the rarest; the last step takes all that is left.
STEPS = ((1, 1), (2, 2), (3, None))


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


def _term(word: Column) -> Column:
    """Hash of a word with A-Z lower-cased; words of ASCII alone take the quicker function."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.xxhash64(F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER)))


def build_index(docs: DataFrame) -> DataFrame:
    """The stored postings of all whole texts: term, row, pos (from 1), doc_id.

    Each document also has one posting without a term, with its doc_id and its number of words as ``pos``; a null or
    empty text has that one alone. ``row`` tells rows apart that share a doc_id or have none. Other columns are ignored.
    """
    words = docs.select(
        F.col("doc_id"), F.monotonically_increasing_id().alias("row"), _words(F.col("text")).alias("words"))
    tokens = words.select(
        "doc_id", "row", F.size("words").alias("size"),
        F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("words"))).alias("pos", "word"))
    head = F.col("pos") == 0
    return stored(tokens.select(
        F.when(~head, _term(F.col("word"))).alias("term"), "row", F.when(head, F.col("size")).otherwise(
            F.col("pos")).alias("pos"), F.when(head, F.col("doc_id")).alias("doc_id")
    ).sortWithinPartitions("term"), "postings")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id and terms of each run of ``window`` words of an item; an item of fewer words, but not none, is one."""
    terms = items.select("item_id", F.transform(_words(F.col("text")), _term).alias("terms")).filter(
        F.size("terms") > 0)
    size = F.least(F.lit(window), F.size("terms"))
    return terms.select(
        "item_id", "terms", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("terms") - size + 1)).alias("at")
    ).select("item_id", F.expr("slice(terms, at, size)").alias("terms")).distinct()


def _ladder(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase, size, rank, term, shift: the terms of each phrase from the rarest on; phrases with an unknown term go."""
    places = phrases.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("shift", "term"))
    wanted = stored(places.select("term").distinct(), "terms")
    lengths = index.select("term").join(wanted, "term").groupBy("term").agg(F.count("*").alias("postings"))
    rarest = places.join(lengths, "term").groupBy("phrase", "size").agg(
        F.array_sort(F.collect_list(F.struct("postings", "shift", "term"))).alias("found"))
    return stored(rarest.filter(F.size("found") == F.col("size")).select(
        "phrase", "size", F.posexplode("found").alias("rank", "at")).select(
        "phrase", "size", "rank", "at.term", "at.shift"), "ladder")


def _lists(index: DataFrame, steps: DataFrame) -> DataFrame:
    """The postings of the terms in ``steps``."""
    return index.select("term", "row", "pos").join(stored(steps.select("term").distinct(), "terms"), "term", "left_semi")


def _between(ladder: DataFrame, low: int, high: int | None) -> DataFrame:
    return ladder.filter((F.col("rank") >= low) & (F.lit(high is None) | (F.col("rank") <= (high or 0))))


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase, row, start, size of each place where the terms of a phrase follow each other in a document.

    ``phrases`` has phrase (a distinct, non-null long) and terms (an array of hashes, at least one). Places overlap
    where phrases do. A term that a phrase repeats is asked for at each of its offsets.
    """
    ladder = _ladder(index, phrases)
    first = _between(ladder, 0, 0)
    alive = stored(index.select("term", "row", "pos").join(first, "term").select(
        "phrase", "size", "row", (F.col("pos") - F.col("shift")).alias("start")).filter(F.col("start") > 0), "starts")
    done = []
    for low, high in STEPS:
        done.append(alive.filter(F.col("size") <= low))
        step = _between(ladder, low, high)
        asked = alive.join(step.select("phrase", "term", "shift"), "phrase").select(
            "phrase", "size", "row", "start", "term", (F.col("start") + F.col("shift")).alias("pos"))
        met = asked.join(_lists(index, step), ["term", "row", "pos"])
        if high == low:
            kept = met.select("phrase", "size", "row", "start")
        else:
            kept = met.groupBy("phrase", "size", "row", "start").agg(F.count("*").alias("met")).filter(
                F.col("met") == F.col("size") - low).drop("met")
        alive = stored(kept, "starts")
    found = alive
    for part in done:
        found = found.unionByName(part)
    return found


def near_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """phrase, row, pos: places of a phrase's rarest word where all its words stand in some ``within`` successive words.

    ``phrases`` is as for ``phrase_matches``; order does not count and a repeated term counts once. Only postings of the
    same document and of the same or a neighbouring block of ``within`` places meet, so long texts do not pair up.
    """
    sets = phrases.select("phrase", F.array_distinct("terms").alias("terms"))
    ladder = _ladder(index, sets)
    alive = stored(index.select("term", "row", "pos").join(_between(ladder, 0, 0), "term").select(
        "phrase", "size", "row", "pos", F.array(F.struct("pos", "term")).alias("held")), "near")
    for low, high in STEPS:
        step = _between(ladder, low, high)
        asked = alive.join(step.select("phrase", "term"), "phrase").withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("pos") / within) - 1, F.floor(F.col("pos") / within) + 1)))
        lists = _lists(index, step).select(
            "term", "row", F.col("pos").alias("other"), F.floor(F.col("pos") / within).alias("block"))
        met = asked.join(lists, ["term", "row", "block"]).filter(F.abs(F.col("other") - F.col("pos")) < within)
        # A neighbourhood holds fewer than 2 * within postings.
        joined = met.groupBy("phrase", "size", "row", "pos").agg(
            F.first("held").alias("held"), F.collect_list(F.struct(F.col("other").alias("pos"), "term")).alias("more"))
        grown = joined.select("phrase", "size", "row", "pos", F.concat("held", "more").alias("held"))
        alive = stored(alive.filter(F.col("size") <= low).unionByName(grown.filter(F.col("size") > low)), "near")

    def complete(start: Column) -> Column:
        inside = F.filter("held", lambda at: (at["pos"] >= start) & (at["pos"] < start + within))
        return F.size(F.array_distinct(F.transform(inside, lambda at: at["term"]))) == F.col("size")
    return alive.filter(F.exists(F.sequence(F.col("pos") - (within - 1), F.col("pos")), complete)).select(
        "phrase", "row", "pos")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, spans (start, size; in order of start), n_hit, item_ids.

    ``spans`` are the places in the whole text where a window of an item occurs, ``n_hit`` the words they cover, and
    ``item_ids`` the items with such a window, as strings in order. Null texts have no words, on either side. Items are
    told apart by item_id; rows that repeat one are one item, and a window of an item without an id hits words but names
    nobody. Repeated documents each get their row; empty tables give no rows or no hits; other columns are ignored. A
    very long text is as many postings as it has words, and its spans are at most as many.
    """
    index = build_index(docs)
    windows = stored(item_windows(items, window), "windows")
    phrases = stored(windows.groupBy("terms").agg(F.count("*").alias("items")).select(
        F.monotonically_increasing_id().alias("phrase"), "terms"), "phrases")
    found = stored(phrase_matches(index, phrases), "matches")
    spans = found.select("row", "start", "size").distinct().groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans"))
    named = windows.filter(F.col("item_id").isNotNull()).join(phrases, "terms").select(
        "phrase", F.col("item_id").cast("string").alias("item_id")).distinct()
    who = found.select("row", "phrase").join(named, "phrase").groupBy("row", "item_id").agg(F.count("*").alias("n"))
    items_of = who.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    end = lambda span: span["start"] + span["size"]
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("words"), F.lit(0).alias("reach")), lambda seen, span: F.struct(
            (seen["words"] + F.greatest(end(span) - F.greatest(seen["reach"], span["start"]), F.lit(0))).alias("words"),
            F.greatest(seen["reach"], end(span)).alias("reach")))["words"]
    heads = index.filter(F.col("term").isNull()).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return heads.join(spans, "row", "left").join(items_of, "row", "left").select(
        "doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<start:int,size:int>>")).alias("spans"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))

"""Language, quality and language-model scores against plain Python and held-out data."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.data import frame, multiset, rows, words_of
from tidewell.llm import katz, langid, quality
from tidewell.llm.common import documents
from tidewell.llm.queries import LLM_QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    found = LLM_QUERIES["op2_language_id"](spark, FOLDER).join(documents(spark, FOLDER), "doc_id").collect()
    assert len(found) == documents(spark, FOLDER).count()
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) and 0 <= row.score <= 1
    apart = [row for row in found if row.held_out]
    assert sum(row.lang_pred == row.lang for row in apart) >= 0.99 * len(apart)
    assert sum(row.rejected for row in found) <= 0.005 * len(found)


@pytest.mark.parametrize("missing", ["de", "es", "en", "fr"])
def test_texts_of_a_language_not_learned_are_rejected(spark, missing):
    docs = documents(spark, FOLDER)
    models = langid.train(docs.filter(F.col("lang") != missing))
    found = langid.identify(docs.filter(F.col("lang") == missing), models, carry=False).collect()
    assert missing not in models.languages and sum(row.rejected for row in found) >= 0.95 * len(found)


def test_language_of_odd_texts(spark):
    prose = [("en", "the quick brown fox jumps over the lazy dog and runs " * 3 + str(i)) for i in range(40)]
    prose += [("de", "der schnelle braune fuchs springt über den faulen hund " * 3 + str(i)) for i in range(40)]
    models = langid.train(spark.createDataFrame(prose + [(None, "x"), ("en", None)], "lang string, text string"))
    assert models.languages == ["de", "en"]
    odd = langid.identify(frame(spark), models)
    assert odd.select("row.*").schema == frame(spark).schema and odd.count() == len(rows())
    for row in odd.collect():
        lettered = any(c.isalpha() for c in row.row.text or "")
        assert (row.lang_pred == "und") == (not lettered)
        if not lettered:
            assert row.score == 0 and row.rejected
    texts = spark.createDataFrame([(1, "The dog, and the FOX!"), (2, "Über den Hund"), (3, "漢字仮名交じり文" * 9)],
                                  "doc_id long, text string")
    found = {row.doc_id: row for row in langid.identify(texts, models).collect()}
    assert (found[1].lang_pred, found[2].lang_pred) == ("en", "de")
    assert found[3].rejected and not found[1].rejected
    assert langid.identify(frame(spark, []), models).count() == 0


@pytest.mark.parametrize("text", ["", "x", "ab", "abc", "abcd", "abcde", "abcdef"])
@pytest.mark.parametrize("order", [1, 2, 5, 7])
def test_hashes_of_few_code_points(text, order):
    """Each n-gram inside a text has the hash it has alone, however short the text is."""
    found = langid._hashes(langid._code_points(text), order)
    for length in range(1, order + 1):
        for end in range(length - 1, len(text)):
            alone = langid._hashes(langid._code_points(text[end - length + 1:end + 1]), length)
            assert found[length - 1][end] == alone[length - 1][length - 1]


def test_short_texts_and_marks_have_defined_languages(spark):
    prose = [("en", "the house of the people " * 3), ("de", "das haus der leute " * 3)] * 30
    models = langid.train(spark.createDataFrame(prose, "lang string, text string"))
    for text, letters in [("x", True), ("\u0301\u0301", False), ("\u0301 1", False), ("e\u0301", True), ("ab", True)]:
        # A table of its own for each, so that the text is all there is in its slice.
        row = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), models).first()
        assert (row.lang_pred in ("en", "de")) == letters and (row.lang_pred == "und") != letters
        assert letters or (row.score == 0 and row.rejected)


def test_nothing_to_learn_a_language_from(spark):
    models = langid.train(frame(spark, []))
    assert models is None
    assert {row.lang_pred for row in langid.identify(frame(spark), models).collect()} == {"und"}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=20), st.integers(1, 4))
def test_kneser_ney_adds_up_to_one(words, order):
    counts = Counter()
    for word in words:
        edged = f" {word} "
        counts.update(edged[max(0, end - order):end] for end in range(2, len(edged) + 1))
    probabilities, weights, unseen = langid.kneser_ney(dict(counts), order)

    def p(context, character):
        gram = context + character
        if gram in probabilities[len(gram) - 1]:
            return probabilities[len(gram) - 1][gram]
        return unseen if not context else weights[len(context) - 1].get(context, 1.0) * p(context[1:], character)

    alphabet = sorted(probabilities[0])
    for context in ["", *[c for table in weights for c in table]]:
        assert sum(p(context, c) for c in alphabet) + p(context, "?") == pytest.approx(1)


def brute_katz(data, held):
    tokens = [[*[w.lower() for w in words_of(row[1])], None] for row in data]
    words, pairs, contexts = Counter(), Counter(), Counter()
    for text, out in zip(tokens, held):
        if not out:
            words.update(text)
            for before, word in zip(["<s>", *text], text):
                pairs[before, word] += 1
                contexts[before] += 1
    size, types = sum(words.values()), len(words)
    seen = lambda table: katz.good_turing([sum(n == r for n in table.values()) for r in range(1, 7)])
    word_cut, pair_cut = seen(words), seen(pairs)
    cut = lambda n, table: table[n] if n <= katz.RELIABLE else n - katz.TRIM
    left = 1 - sum(cut(n, word_cut) for n in words.values()) / size if size else 1.0
    own = lambda w: cut(words[w], word_cut) / size if words[w] else left
    spent, covered = defaultdict(float), defaultdict(float)
    for (before, word), n in pairs.items():
        spent[before] += cut(n, pair_cut) / contexts[before]
        covered[before] += own(word)

    def score(before, word):
        if pairs[before, word]:
            return math.log10(cut(pairs[before, word], pair_cut) / contexts[before])
        weight = (1 - spent[before]) / (1 - covered[before]) if contexts[before] else 1.0
        return math.log10(weight * own(word))

    for context in contexts:  # exactly normalised: seen words, the other known words, and the unseen one
        total = sum(10 ** score(context, w) for w in words) + 10 ** score(context, "not a word")
        assert total == pytest.approx(1)
    return [(row[0], out, len(text), sum(words[w] > 0 for w in text), size,
             sum(math.log10((words[w] + .5) / (size + .5 * (types + 1))) for w in text),
             sum(score(before, w) for before, w in zip(["<s>", *text], text)))
            for row, out, text in zip(data, held, tokens)]


@pytest.mark.parametrize("partition", [1 << 20, 300])
def test_katz_scores_match_plain_python(spark, monkeypatch, partition):
    monkeypatch.setattr(katz, "PARTITION", partition)
    monkeypatch.setattr(katz, "SLICE", 5000)
    data = [row for row in rows() if row[1] is None or len(row[1]) < 9000]
    held = [len(row[1] or "") % 3 == 1 for row in data]
    docs = frame(spark, data).withColumn("held_out", F.coalesce(F.length("text"), F.lit(0)) % 3 == 1)
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
           for r in katz.score_documents(docs).collect()]
    want = [(*w[:5], round(w[5], 6), round(w[6], 6)) for w in brute_katz(data, held)]
    assert multiset(got) == multiset(want)


def test_katz_without_training_or_documents(spark):
    docs = frame(spark)
    unknown = katz.score_documents(docs.withColumn("held_out", F.lit(True))).collect()
    assert len(unknown) == len(rows()) and {(r.n_known, r.score) for r in unknown} == {(0, 0.0)}
    assert katz.score_documents(frame(spark, []).withColumn("held_out", F.lit(True))).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2 ** 63)))
def test_packed_numbers_come_back(values):
    array = np.array(values, np.uint64)
    assert katz.unpack(katz.pack(array)).tolist() == values
    assert katz.unpack_sorted(katz.pack_sorted(np.sort(array))).tolist() == sorted(values)


def brute_counts(text):
    words = words_of(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").encode().split(b"\n") if line.split()]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("place_bits", [20, 4])
def test_quality_counts_match_plain_python(spark, monkeypatch, place_bits):
    monkeypatch.setattr(quality, "PLACE_BITS", place_bits)  # 4 bits: most texts sort whole hashes
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = [tuple(r) for r in quality.rule_counts(frame(spark)).select(*columns).collect()]
    assert multiset(got) == multiset((row[0], *brute_counts(row[1])) for row in rows())


@pytest.mark.parametrize("orders", [(1,), (1, 2)])
def test_quality_scores_match_plain_python(spark, orders):
    import xxhash
    data = rows()
    labels = spark.createDataFrame([(i, i % 3 > 0, i % 5 == 0) for i in range(0, 60, 2)] + [(None, True, False)],
                                   "doc_id long, quality boolean, toxic boolean").withColumns(
        {"quality": F.col("quality").cast("int"), "toxic": F.col("toxic").cast("int")})
    trusted = {i for i in range(0, 60, 2) if i % 3 > 0}
    signed = lambda h: h - (1 << 64) if h >> 63 else h

    def hashed_long(value, seed):  # a long is hashed as its eight bytes, seeded by the hash before
        return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed)

    held = {r.doc_id for r in spark.createDataFrame([(i,) for i in trusted], "doc_id long").filter(
        quality.held_out(F.col("doc_id"))).collect()}

    def grams(text):
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in words_of(text)]
        found = list(hashes) if 1 in orders else []
        if 2 in orders:
            for a, b in zip(hashes, hashes[1:]):
                found.append(hashed_long(b, hashed_long(a, 42)))
        return [signed(h) % quality.BUCKETS for h in found]

    raw, good = Counter(), Counter()
    for row in data:
        raw.update(grams(row[1]))
        if row[0] in trusted - held:
            good.update(grams(row[1]))
    all_raw, all_good, b = sum(raw.values()), sum(good.values()), quality.BUCKETS

    def weight(gram):
        p = (raw[gram] + .5) / (all_raw + .5 * b)
        return math.log((good[gram] + all_good / 2 * p) / (all_good * 1.5) / p)

    def mean(found):
        return sum(map(weight, found)) / len(found) if found else 0.0

    scores = sorted(mean(grams(row[1])) for row in data if row[0] in held and len(words_of(row[1])) >= 50)
    limit = 0.8 * np.quantile(scores, 0.01) + 0.2 * math.log(1 / 3)
    assert 0 < len(held) < len(trusted) and len(scores) > 1
    got = quality.quality_verdicts(frame(spark), labels, orders).collect()
    want = []
    for row in data:
        found, counts = grams(row[1]), brute_counts(row[1])
        score = mean(found)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want.append((row[0], failed, bool(not failed and score >= limit), round(score, 6)))
    assert multiset((r.doc_id, r.base_failed, r.kept, round(r.score, 6)) for r in got) == multiset(want)


def test_quality_keeps_clean_documents_and_drops_junk(spark):
    verdicts = LLM_QUERIES["op7_quality"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = verdicts.filter("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    shares = {row.quality: row.kept for row in found}
    assert shares[1] == 1 and shares[0] < 0.1


ONE_KEPT = pytest.mark.xfail(strict=True, reason="one of 27 junk documents is kept since the limit is a fitted one")


@pytest.mark.parametrize("size", ["sf0.001", pytest.param("sf0.01", marks=ONE_KEPT), "sf0.1"])
def test_quality_drops_junk_at_any_number_of_labels(spark, size):
    folder = f"/root/testdata/{size}"
    found = LLM_QUERIES["op7_quality"](spark, folder).filter("NOT base_failed").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").groupBy("quality").agg(
        F.count("*").alias("rows"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()
    rows, kept = ({row.quality: row[name] for row in found} for name in ("rows", "kept"))
    assert rows[0] > 0 and kept[0] == 0 and kept[1] == rows[1]


def test_quality_with_few_trusted_documents(spark):
    docs, labels = documents(spark, FOLDER), spark.read.parquet(f"{FOLDER}/labels.parquet")
    few = labels.filter("quality = 1").orderBy(F.xxhash64("doc_id")).limit(80)
    found = quality.quality_verdicts(docs, few).filter("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    shares = {row.quality: row.kept for row in found}
    assert shares[1] >= 0.95 and shares[0] <= 0.3  # all junk was kept before


def judged(docs, labels, trusted):
    """Kept shares of quality 1 and 0 among documents that pass the base rules and that ``trusted`` leaves out."""
    found = quality.quality_verdicts(docs, trusted).filter("NOT base_failed").join(labels, "doc_id").join(
        trusted, "doc_id", "left_anti").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    shares = {row.quality: row.kept for row in found.collect()}
    return shares[1], shares[0]


# Shares measured, with room: (size, trusted documents) -> least kept of quality 1, most kept of quality 0.
@pytest.mark.parametrize("size, trusted, good, junk", [
    ("sf0.01", 160, 0.99, 0.15), ("sf0.01", 80, 0.99, 0.25), ("sf0.1", 1500, 0.99, 0.01)])
def test_quality_on_documents_that_did_not_fit_it(spark, size, trusted, good, junk):
    folder = f"/root/testdata/{size}"
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    kept = judged(docs, labels, labels.filter("quality = 1").orderBy(F.xxhash64("doc_id")).limit(trusted))
    assert kept[0] >= good and kept[1] <= junk, kept


def test_quality_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.quality_verdicts(frame(spark), none).collect()
    assert len(found) == len(rows()) and all(r.kept == (not r.base_failed) for r in found)
    assert quality.quality_verdicts(frame(spark, []), none).count() == 0


def test_quality_learns_from_every_trusted_document(spark, setting):
    """Documents of which each tells a word that only it has; all trusted ones that are not held out count."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("tide berth").alias("text"))
    # The documents whose hash comes last were left out when at most 20,000 were drawn by it.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    last = docs.filter(~quality.held_out(F.col("doc_id"))).orderBy(place.desc()).first().doc_id
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    text = F.when(F.col("doc_id") == last, "lantern").when(F.col("doc_id") == -1, "anchor").otherwise(F.col("text"))
    more = docs.union(spark.createDataFrame([(-1, "")], docs.schema)).withColumn("text", text)
    scores = {r.doc_id: r.score for r in quality.quality_verdicts(more, labels, [quality.MODELS[0]], least_words=1).filter(
        F.col("doc_id").isin(last, -1)).collect()}
    assert scores[last] > 0 > scores[-1]


def test_quality_limit_is_the_quantile_of_all_held_out(spark):
    values = [((i * 7919) % 1013) / 101 for i in range(1013)] + [0.5] * 30
    scores = spark.createDataFrame([(v, v / 3) for v in values], "score double, score_2 double")
    want = list(scores.agg(*[F.percentile(name, F.lit(quality.QUANTILE)) for name in scores.columns]).first())
    got = [quality.low_quantile(scores, name, len(values)) for name in scores.columns]
    assert got == want and quality.fitted_limits(scores.limit(0)) == [None, None]


def test_quality_judges_the_order_of_words(spark):
    """Passages of a few phrases are trusted; the same words in any order have equal words and other pairs."""
    rng = random.Random(5)
    phrases = [["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(6)] for _ in range(400)]
    data = []
    for number in range(300):
        words = [word for phrase in rng.sample(phrases, 25) for word in phrase]
        if number % 3 == 2:
            rng.shuffle(words)
        data.append((number, " ".join(words)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(number, 1, 0) for number in range(300) if number % 3 == 0],
                                   "doc_id long, quality int, toxic int")
    found = quality.quality_verdicts(docs, labels).collect()
    kept = {part: sum(r.kept for r in found if r.doc_id % 3 == part) for part in range(3)}
    assert kept[0] >= 99 and kept[1] >= 98 and kept[2] == 0, kept  # all 100 shuffled ones were kept before


def test_quality_models_are_those_of_their_own(spark):
    labels = spark.createDataFrame([(i, i % 3 and 1, 0) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    both = quality.quality_verdicts(frame(spark), labels).collect()
    words, pairs = (quality.quality_verdicts(frame(spark), labels, [model]).collect() for model in quality.MODELS)
    assert len({r.score_2 for r in both}) > 30
    assert multiset((r.doc_id, r.n_words, r.score) for r in both) == multiset((r.doc_id, r.n_words, r.score) for r in words)
    assert multiset((r.doc_id, r.score_2) for r in both) == multiset((r.doc_id, r.score) for r in pairs)
    kept = [{r.doc_id for r in found if r.kept and r.doc_id is not None} for found in (words, pairs, both)]
    assert kept[0] & kept[1] == kept[2]

"""Mixing, sharding, tokens and the pipeline."""

import hashlib
from collections import defaultdict
from random import Random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.data import VOCABULARY, frame, multiset, rows, words_of
from tidewell.llm import pieces
from tidewell.llm.mixing import mix_sources, mixed_documents, source_targets
from tidewell.llm.sharding import shard_documents

FOLDER = "/root/testdata/sf0.001"


def brute_targets(sizes, weights, most=3.0):
    """Share by weight, stop at the cap, share the excess again, until nothing is above."""
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weigh = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    target, full, rest = {}, set(), float(sum(sizes.values()))
    while len(full) < len(names):
        open_weight = sum(weigh[n] for n in names if n not in full)
        over = [n for n in names if n not in full and rest * weigh[n] / open_weight >= most * sizes[n]]
        if not over:
            break
        for name in over:
            target[name] = most * sizes[name]
            full.add(name)
        rest = sum(sizes.values()) - sum(target.values())
    for name in names:
        if name not in full:
            target[name] = rest * weigh[name] / sum(weigh[n] for n in names if n not in full)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1, "c": 1000, "d": 5}, {"a": 1, "b": 1000}, {None: 10, "a": 0}, {None: 0}, {"é": 7, "z": 900, "Z": 3},
])
def test_targets_share_the_excess(spark, sizes):
    got = {r.source: r.target for r in source_targets(
        spark.createDataFrame(list(sizes.items()), "source string, size long"), (5, 2, 1)).collect()}
    assert got == pytest.approx(brute_targets(sizes, (5, 2, 1)))


def test_mix_comes_near_its_targets(spark):
    data = rows()
    found = mix_sources(frame(spark)).collect()
    assert multiset((r.doc_id, r.source, r.size) for r in found) == multiset(
        (row[0], row[3], len(words_of(row[1]))) for row in data)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size <= 3 * r.size
    targets = brute_targets(sizes, (5, 2, 1))
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.copies - int(r.target // max(r.source_size, 1)) in (0, 1)
        assert abs(taken[r.source] - r.target) <= largest[r.source] / 2 + 1e-6
    assert multiset(found) == multiset(mix_sources(frame(spark).repartition(7)).collect())


def test_mix_prefers_heavy_documents(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a") for i in range(2000)] + [(i, "w", "b") for i in range(9000, 9009)],
                                 "doc_id long, text string, source string")
    heavy = F.when(F.col("doc_id") % 2 == 0, 9.0).otherwise(1.0)
    found = mix_sources(docs, weights=(1, 1), share=0.5, weight=heavy).filter("source = 'a' AND copies = 1").collect()
    even = sum(r.doc_id % 2 == 0 for r in found)
    assert 900 <= len(found) <= 1100 and even > 0.75 * len(found)


def test_mixed_documents_repeat_as_planned(spark):
    planned = defaultdict(int)
    for r in mix_sources(frame(spark)).collect():
        planned[r.doc_id, r.source, r.size] += r.copies
    mixed = mixed_documents(frame(spark))
    assert mixed.schema == frame(spark).schema
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id, r.source, len(words_of(r.text))] += 1
    assert got == {key: n for key, n in planned.items() if n}
    assert mix_sources(frame(spark, [])).count() == 0


def brute_shards(data, limit):
    hashed = []
    for row in data:
        inner = "n" if row[1] is None else hashlib.md5(row[1].encode()).hexdigest()
        key = f"{'n' if row[0] is None else f'i{row[0]}'}:{inner}"
        bits = bin(int(hashlib.md5(key.encode()).hexdigest()[:16], 16))[2:].zfill(64)
        hashed.append((row[0], len((row[1] or "").encode()), bits))
    found = []

    def split(some, depth):
        total = sum(item[1] for item in some)
        if total <= limit or depth == 64:
            found.extend((i, size, bits[:depth], total, len(some)) for i, size, bits in some)
            return
        for bit in "01":
            if part := [item for item in some if item[2][depth] == bit]:
                split(part, depth + 1)

    split(hashed, 0)
    return found


@pytest.mark.parametrize("limit", [10 ** 9, 50_000, 4_000])
def test_shards_match_recursion_over_bits(spark, limit):
    data = [row for row in dict.fromkeys(rows()) if len(row[1] or "") <= limit]
    got = [(r.doc_id, r.size, r.shard, r.shard_bytes, r.shard_docs) for r in shard_documents(
        frame(spark, data), limit).collect()]
    assert multiset(got) == multiset(brute_shards(data, limit))


def test_rows_that_are_alike_part_by_their_place(spark):
    docs = spark.range(4000).selectExpr("1L AS doc_id", "repeat('x', 100) AS text")
    found = shard_documents(docs, 30_000).collect()
    assert all(r.fits and r.shard_bytes <= 30_000 and r.depth > 64 for r in found) and len(found) == 4000
    assert sum(size for size in {(r.shard): r.shard_bytes for r in found}.values()) == 400_000


def test_a_document_above_the_limit_and_no_documents(spark):
    found = shard_documents(frame(spark), 4_000).collect()
    assert len(found) == len(rows())
    assert all(r.fits == (r.shard_bytes <= 4_000) for r in found)
    assert {r.fits for r in found if r.size > 4_000} == {False}
    assert shard_documents(frame(spark, []), 10).count() == 0


TEXTS = [None, "", " ", "   ", " a  b\n\n\t c  \n d ", "▁x ▁▁y", "日本語 ①② \U0001F600" * 7,
         "x" * 300 + "the" * 200, "ſﬁ\x00z\r\n", " " * 70 + "q" + " " * 33, "1234567890" * 30]


def test_ids_are_those_of_the_library(spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    vocabulary = pieces.load_vocabulary(VOCABULARY)
    data = rows() + [(1000 + i, text) + (None,) * 14 for i, text in enumerate(TEXTS)]
    docs = frame(spark, data).withColumn("both", F.struct("doc_id", "text"))
    encoded = pieces.encode_documents(docs, vocabulary, keep="both", decode=True)
    found = encoded.collect()
    again = pieces.decode_documents(encoded.select("both", "ids"), vocabulary).select(encoded.columns)
    assert multiset(again.collect()) == multiset(found)
    assert multiset((r.both.doc_id, r.both.text) for r in found) == multiset((row[0], row[1]) for row in data)
    for r in found:
        ids = library.encode(r.both.text or "")
        assert r.ids == ids and r.decoded == library.decode(ids)
        assert r.decoded == (r.both.text or "").replace("▁", " ")
    assert pieces.encode_documents(frame(spark, []), vocabulary).count() == 0


def test_units_end_where_no_piece_stands_across(spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    vocabulary = pieces.load_vocabulary(VOCABULARY)
    splitter = pieces.Splitter(vocabulary)
    text = "word, word. (word) naïve café—“x”漢字 éé́ß 12,000.50 www.x.com/don't WORD;word 3word\x01  a\t b"
    lengths, units = splitter.cut([text.encode(), b"", "漢字".encode()])
    found = [unit.decode() for unit in units.to_pylist()]
    assert lengths.sum() == len(found) and "".join(found) == f" {text} 漢字"
    assert {" word", ",", "."} <= set(found) and not {" word,", " word."} & set(found)
    inside = {pair for piece, _, _ in vocabulary.pieces for pair in zip(piece, piece[1:])}
    assert not any((one[-1], other[0]) in inside for one, other in zip(found[:lengths[0]], found[1:lengths[0]]))
    # One character less than what fits the bits, as many, and one more, the space in front included.
    edge = [letters[:size] for size in (60, 61, 62) for letters in ("a" * 70, "the" * 30, " " * size + "q")]
    texts = dict(enumerate([text, text[::-1], *edge]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.ids for r in pieces.encode_documents(docs, vocabulary).collect()} == {
        number: library.encode(text) for number, text in texts.items()}


def greedy_merges(unit, scores):
    """The starts of the pieces: always the best merge of two neighbours there is, leftmost among equals."""
    parts = list(unit)
    while known := [(-scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]:
        place = min(known)[1]
        parts[place:place + 2] = [parts[place] + parts[place + 1]]
    return [sum(map(len, parts[:i])) for i in range(len(parts))]


@pytest.mark.parametrize("seed", range(4))
def test_merges_in_and_out_of_the_order_of_scores(spark, seed):
    random = Random(seed)
    table = {}
    while len(table) < 14:  # each piece from two that are there; odd seeds score them in that order
        parts = [random.choice([*"abc", *table]) for _ in range(2)]
        if len("".join(parts)) <= 6:
            table.setdefault("".join(parts), -len(table) // 2 if seed % 2 else random.randrange(5))
    vocabulary = pieces.Vocabulary([(p, i, float(s)) for i, (p, s) in enumerate(table.items())], [], 99, "bpe")
    units = sorted({"".join(random.choices("abc", k=random.randint(1, 12))) for _ in range(400)})
    rows = spark.createDataFrame([(0, unit) for unit in units], "part int, unit string")
    found = {r.unit: [i for i in range(len(r.unit)) if r.bounds >> i & 1]
             for r in pieces.cut_units(rows, vocabulary).collect()}
    assert found == {unit: greedy_merges(unit, table) for unit in units}


def test_one_pass_serves_all_but_runs_of_spaces():
    assert set(pieces._late_pieces(pieces.load_vocabulary(VOCABULARY))) == {"   "}


def best_path(text, vocabulary):
    """Every segmentation of a short text: the score of the best, unknown characters at a penalty."""
    scores = {piece: score for piece, _, score in vocabulary.pieces}
    floor = min(scores.values()) - pieces.UNKNOWN_PENALTY
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            if piece in scores:
                best[end] = max(best[end], best[start] + scores[piece])
            elif end - start == 1:
                best[end] = max(best[end], best[start] + floor)
    return best[-1]


def test_viterbi_finds_the_best_path(spark):
    table = {" ": -3.0, "a": -2.0, "b": -2.5, "ab": -3.1, " a": -2.2, "ba": -1.9, "bab": -4.0, " ab": -6.0, "aa": -3.9}
    vocabulary = pieces.Vocabulary([(p, i + 3, s) for i, (p, s) in enumerate(table.items())], [], 0, "unigram")
    by_id = {i: (p, s) for p, i, s in vocabulary.pieces}
    floor = min(table.values()) - pieces.UNKNOWN_PENALTY
    texts = ["abab", "aab ba", "bababa", "c", "abcba", "aaaa", "ab" * 40 + "c", " ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pieces.encode_documents(docs, vocabulary).collect():
        whole = " " + texts[r.doc_id]
        assert sum(by_id[i][1] if i in by_id else floor for i in r.ids) == pytest.approx(sum(
            best_path(unit.decode(), vocabulary)
            for unit in pieces.Splitter(vocabulary).cut([texts[r.doc_id].encode()])[1].to_pylist()))
        assert "".join(by_id[i][0] if i in by_id else "c" for i in r.ids) == whole


def test_pipeline_stages_in_order(spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    texts = {row.doc_id: row.text for row in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        assert docs.columns == columns, name
        kept = docs.collect()
        assert all(texts[row.doc_id] == row.text for row in kept)
        if name == "language ID":
            assert len(kept) >= 0.99 * len(texts)
        if name == "exact dedup":
            assert len({row.text for row in kept}) == len(kept)
        if name == "near dedup":
            assert len(kept) > 0.8 * len(texts)
    by_id = {row.doc_id for row in docs.collect()}
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {row.doc_id for row in found} == by_id
    for row in found:
        assert row.ids == library.encode(texts[row.doc_id]) and row.n_ids == len(row.ids)


def test_stages_take_odd_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, []), FOLDER).count() == 0, name
        assert stage(spark, frame(spark), FOLDER).count() >= 0, name

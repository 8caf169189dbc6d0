"""Prefix tries, collocations and decontamination against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tests.conftest import plan_of
from tests.llm.data import frame, multiset, rows
from tidewell.llm import postings
from tidewell.llm.collocations import DoubleArray, collocations, phrase_counts
from tidewell.llm.postings import build_index, contamination, near_matches, phrase_matches
from tidewell.llm.prefixes import WIDTH, RadixTree, prefix_nodes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- prefix tries

TURNS = "conv_id long, turn long, role string, text string, cut string, seq int, conv string"


def talks(seed: int = 5, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    said = [("user", "hi"), ("user", "Hi"), ("assistant", ""), (None, None), ("", ""), ("user", "é" * 300)]
    said += [("assistant", f"answer {i}") for i in range(6)]
    found = []
    for conv in range(n):
        if conv % 7 == 3:
            continue
        for turn in range(rng.choice([1, 2, 3, 5, 9, 12])):
            # Many share their first turns.
            role, text = said[0] if turn == 0 and conv % 3 else rng.choice(said)
            found.append((conv, None if turn == 1 and conv % 11 == 0 else turn, role, text, "x", 1, None))
    found += [(n + 5, turn, "user", f"turn {turn}", "x", 1, None) for turn in range(400)]
    found += [(n + 6, turn, "user", f"turn {turn}", "x", 1, None) for turn in range(399)]
    found += [(None, 1, "user", "nobody's", "x", 1, None), (1, 0, "user", "hi", "x", 1, None)]
    rng.shuffle(found)
    return found


def brute_nodes(turns, group=5, shares=9):
    def known(role, text):
        role, text = (role or "").encode(), (text or "").encode()
        return hashlib.sha256(b"%d:" % len(role) + role + text).digest()[:16] + len(text).to_bytes(4, "big")
    own = defaultdict(list)
    for conv, turn, role, text, *_ in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, known(role, text)))
    own = {conv: [k for *_, k in sorted(found)] for conv, found in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, mine in sorted(own.items()):
        h = zlib.crc32(str(conv).encode()) % shares
        seq = tuple(own.get(conv - conv % group, [])[:h] + mine[h:])
        for depth in range(len(seq) + 1):
            members[seq[:depth]].append(conv)
        ends[seq].append(conv)
    children = Counter(prefix[:-1] for prefix in members if prefix)
    leaves, saved = Counter(), Counter()
    for prefix, found in members.items():
        spared = (len(found) - 1) * int.from_bytes(prefix[-1][-4:], "big") if prefix else 0
        for depth in range(len(prefix) + 1):
            leaves[prefix[:depth]] += not children[prefix]
            saved[prefix[:depth]] += spared
    return [(found[0], len(prefix), members[prefix[:-1]][0] if prefix else None, len(found), children[prefix],
             leaves[prefix], saved[prefix], sha(",".join(map(str, ends[prefix])))) for prefix, found in members.items()]


@pytest.mark.parametrize("most, tree_bytes", [(20_000, 4 << 20), (3, 1000), (1, 1)])
def test_prefix_nodes_match_brute_force(spark, most, tree_bytes):
    data = talks()
    found = prefix_nodes(spark.createDataFrame(data, TURNS), most=most, tree_bytes=tree_bytes)
    assert multiset(map(tuple, found.collect())) == multiset(brute_nodes(data))


def test_prefix_nodes_of_few_conversations(spark):
    assert prefix_nodes(spark.createDataFrame([], TURNS)).count() == 0
    nobody = [(None, 0, "user", "x", None, None, None)]
    assert prefix_nodes(spark.createDataFrame(nobody, TURNS)).count() == 0
    # Conversation 1 takes its first turns from conversation 0, which there is not.
    alone = [(1, 0, "user", "x", None, None, None)]
    assert multiset(map(tuple, prefix_nodes(spark.createDataFrame(alone, TURNS)).collect())) == multiset(
        brute_nodes(alone))
    assert len(brute_nodes(alone)) == 1


@pytest.mark.parametrize("seed", range(4))
def test_radix_tree_layouts_grow(seed):
    """Keys with 1 to 256 children per byte; members of every aligned prefix are counted."""
    rng = random.Random(seed)
    spread = [1, 5, 40, 256][seed]
    keys = {bytes(rng.randrange(spread) for _ in range(WIDTH * rng.randint(1, 3))) for _ in range(700)}
    keys |= {key[:WIDTH] for key in list(keys)[:50]}
    tree = RadixTree()
    for number, key in enumerate(sorted(keys, key=lambda k: (hash(k), k))):
        tree.insert(key, 1, (2, number, "h"))
    counts = Counter()
    for key in keys:
        for depth in range(1, len(key) // WIDTH + 1):
            counts[key[:depth * WIDTH]] += 2
    found = {key[:depth * WIDTH]: members for key, _, depth, members, *_ in tree.nodes()}
    assert found == counts


# --- collocations

def brute_phrases(data, longest=5):
    totals, found = Counter(), Counter()
    for _, text, lang, *_ in data:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    found[lang, tuple(words[at:at + size])] += 1
    return totals, found


def brute_collocations(data, least, top, longest=5):
    totals, f = brute_phrases(data, longest)
    candidates = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= least}
    covered = set()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                if 100 * a >= 100 * f[lang, words[at:at + size]]:
                    covered.add((lang, words[at:at + size]))
    listed = defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) in covered:
            continue
        cuts = []
        for cut in range(1, len(words)):
            left, right = f[lang, words[:cut]], f[lang, words[cut:]]
            cuts.append((Fraction(1000 * a * totals[lang], left * right).__floor__(), cut, left, right))
        score, _, left, right = min(cuts)
        phrase = " ".join(words)
        listed[lang].append((-score, -a, phrase.encode(), (lang, phrase, a, left, right, totals[lang], score)))
    return [(row[0], rank, *row[1:]) for found in listed.values()
            for rank, (*_, row) in enumerate(sorted(found)[:top], 1)]


@pytest.mark.parametrize("least, top, block", [(3, 2000, 1 << 18), (5, 7, 1 << 18), (4, 50, 40)])
def test_collocations_match_brute_force(spark, least, top, block):
    data = rows(n=40)
    found = collocations(frame(spark, data), least=least, top=top, block=block).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert multiset(map(tuple, found.collect())) == multiset(brute_collocations(data, least, top))


def test_phrase_counts_are_those_of_all_phrases(spark):
    data = rows(n=25)
    _, f = brute_phrases(data, 3)
    levels = phrase_counts(frame(spark, data), 2, 3)
    for size, level in enumerate(levels, 1):
        want = {(lang, " ".join(words)): n for (lang, words), n in f.items() if len(words) == size and (n >= 2 or size == 1)}
        assert {(r.lang, r.phrase): r.f for r in level.collect()} == want


def test_a_level_reads_the_text_once_with_any_number_of_tries(spark, monkeypatch):
    from tidewell.llm import collocations as module
    plans, tries, kept, made = [], [], module.stored, module._tries

    def stored(df, label, *parts):
        plans.append((label, plan_of(df)))
        return kept(df, label, *parts)
    monkeypatch.setattr(module, "stored", stored)
    monkeypatch.setattr(module, "_tries", lambda *asked: tries.append(made(*asked)) or tries[-1])
    data = rows(n=40)
    one, many = (phrase_counts(frame(spark, data), 2, 4, block) for block in (1 << 18, 40))
    for few, more in zip(one, many, strict=True):
        assert multiset(map(tuple, few.collect())) == multiset(map(tuple, more.collect()))
    assert max(len(found) for found, _ in tries) > module.HELD
    assert [plan.count("MapInArrow") for label, plan in plans if label in ("words", "phrases")] == [1] * 8


def test_collocations_of_no_text(spark):
    assert collocations(frame(spark, [])).count() == 0
    silent = [(1, None, None, None) + (None,) * 12, (2, " .,\n", "en", None) + (None,) * 12]
    assert collocations(frame(spark, silent), least=1).count() == 0


def test_scores_beyond_64_bits(spark):
    """Counts near 10 ** 12, put in through the same expressions, stay exact."""
    from pyspark.sql import functions as F

    from tidewell.llm.collocations import _wide
    a, n, left, right = 999_999_999_989, 9_999_999_999_971, 1_000_000_000_039, 1_000_000_000_061
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").select(
        (F.lit(1000).cast("decimal(4,0)") * _wide("a") * _wide("n")).alias("over"),
        (_wide("l", 19) * _wide("r", 19)).alias("under")).select(F.expr("over div under")).first()
    assert row[0] == 1000 * a * n // (left * right)


@pytest.mark.parametrize("seed, depth, symbols", [(0, 1, 50), (1, 2, 7), (2, 4, 3), (3, 3, 400)])
def test_double_array_finds_its_sequences(seed, depth, symbols):
    rng = np.random.default_rng(seed)
    every = np.unique(np.c_[rng.integers(0, 3, 600), rng.integers(0, symbols, (600, depth))], axis=0)
    trie = DoubleArray(every[:, 0], every[:, 1:])
    known = {tuple(row): number for number, row in enumerate(every.tolist())}
    text = rng.integers(-1, symbols, 5000)
    for root in range(3):
        found = trie.advance(root, text)
        want = [known.get((root, *text[at:at + depth].tolist()), -1) if at + depth <= len(text) else -1
                for at in range(len(text))]
        assert found.tolist() == want


# --- decontamination

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(docs, items, window):
    seen = defaultdict(set)
    for item, text, *_ in items:
        words = terms(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            seen[tuple(words[at:at + size])].add(item)
    sizes = {len(key) for key in seen}
    found = []
    for doc, text, *_ in docs:
        words, hit, named, spans = terms(text), set(), set(), []
        for at in range(len(words)):
            for size in sizes:
                key = tuple(words[at:at + size])
                if len(key) == size and key in seen:
                    hit.update(range(at, at + size))
                    named |= {str(item) for item in seen[key] if item is not None}
                    spans.append((at + 1, size))
        found.append((doc, len(words), sorted(spans), len(hit), sorted(named)))
    return found


def benchmark_of(docs) -> list[tuple]:
    passages = [" ".join((text or "").split()[5:40]) for _, text, *_ in docs[10:60:4]]
    items = [(number, passage.upper(), "t", 1) for number, passage in enumerate(passages)]
    items += [(100, "THE", "t", 1), (101, "one, two--three", "t", 1), (102, None, "t", 1), (103, "", "t", 1),
              (104, "no such words anywhere", "t", 1), (None, passages[3], "t", 1), (7, passages[8], "t", 1),
              (105, "yes " * 30, "t", 1), (105, "yes " * 30, "t", 1)]
    return items


ITEMS = "item_id long, text string, term string, row int"


def plain(found):
    return [(r.doc_id, r.n_words, [tuple(span) for span in r.spans], r.n_hit, r.item_ids) for r in found.collect()]


@pytest.mark.parametrize("window", [1, 2, 10])
def test_contamination_matches_brute_force(spark, window):
    docs = rows(n=40)
    items = benchmark_of(docs)
    found = contamination(frame(spark, docs), spark.createDataFrame(items, ITEMS), window)
    assert multiset(plain(found)) == multiset(brute_contamination(docs, items, window))


def test_contamination_of_empty_tables(spark):
    docs, nothing = rows(n=5), spark.createDataFrame([], ITEMS)
    assert multiset(plain(contamination(frame(spark, docs), nothing))) == multiset(brute_contamination(docs, [], 10))
    assert contamination(frame(spark, []), spark.createDataFrame(benchmark_of(rows()), ITEMS)).count() == 0


def test_index_is_sorted_postings_of_all_tokens(spark):
    docs = rows(n=20)
    index = build_index(frame(spark, docs))
    assert index.filter("term is not null").count() == sum(len(terms(text)) for _, text, *_ in docs)
    assert index.filter("term is null").count() == len(docs)


def test_near_matches_are_those_within_reach(spark):
    docs = rows(n=25)
    index = build_index(frame(spark, docs))
    asked = [["the", "of"], ["and", "ist", "été"], ["the", "the", "año"], ["never"], ["yes"], ["naïve", "straße", "to", "of"]]
    phrases = spark.createDataFrame(list(enumerate(asked)), "phrase long, words array<string>").selectExpr(
        "phrase", "transform(words, w -> xxhash64(w)) AS terms")
    heads = {r.row: r.doc_id for r in index.filter("term is null").collect()}
    found = {(r.phrase, heads[r.row], r.pos) for r in near_matches(index, phrases, 6).collect() if heads[r.row] is not None}
    every = Counter(word for _, text, *_ in docs for word in terms(text))
    want = set()
    for phrase, words in enumerate(asked):
        rarest = min(dict.fromkeys(words), key=lambda w: (every[w], words.index(w)))
        for doc, text, *_ in docs:
            said = terms(text)
            for at, word in enumerate(said):
                if word == rarest and doc is not None and any(
                        set(words) <= set(said[max(0, start):start + 6]) for start in range(at - 5, at + 1)):
                    want.add((phrase, doc, at + 1))
    assert found == want and {p for p, *_ in want} >= {0, 2, 4}


def test_phrases_are_met_only_as_they_stand(spark):
    index = build_index(spark.createDataFrame([(1, "a b c a b d. A-B! ba b", "x")], "doc_id long, text string, z string"))
    asked = spark.createDataFrame([(1, ["a", "b"]), (2, ["b", "a"]), (3, ["a", "b", "c", "a", "b"]), (4, ["e"])],
                                  "phrase long, words array<string>").selectExpr(
        "phrase", "transform(words, w -> xxhash64(w)) AS terms")
    assert sorted((r.phrase, r.start) for r in phrase_matches(index, asked).collect()) == [(1, 1), (1, 4), (1, 7), (3, 1)]
    assert postings.STEPS[-1][1] is None

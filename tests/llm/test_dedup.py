"""Exact, near, line and substring dedup against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.data import BREAKS, frame, multiset, rows, words_of
from tidewell.llm.exact import PatriciaTrie, exact_groups, exact_owners, without_copies
from tidewell.llm.lines import dedup_lines
from tidewell.llm.mixing import mixed_documents
from tidewell.llm.repeats import SuffixAutomaton, remove_repeats
from tidewell.llm.simhash import fingerprint, near_groups, roots_within, without_near_copies


def sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups_match_plain_python(spark, keep):
    data = rows()
    ids = defaultdict(list)
    for row in data:
        ids[row[1] or ""].append(row[0])
    pick = max if keep == "largest" else min
    want, done = [], set()
    for row in data:
        group = ids[row[1] or ""]
        owner = pick((i for i in group if i is not None), default=None)
        kept = row[0] == owner and (row[1] or "") not in done
        if kept:
            done.add(row[1] or "")
        want.append((row[0], owner, len(group), kept, sha((row[1] or "").encode())))
    got = [tuple(r) for r in exact_groups(frame(spark), keep).collect()]
    assert multiset(got) == multiset(want)


def test_exact_owner_rows_keep_their_columns(spark):
    kept = without_copies(frame(spark))
    assert kept.schema == frame(spark).schema
    texts = [row.text or "" for row in kept.collect()]
    assert sorted(texts) == sorted({row[1] or "" for row in rows()})
    assert {tuple(row) for row in kept.collect()} <= set(rows())


def test_exact_small_tries_and_an_empty_table(spark):
    whole = exact_owners(frame(spark)).select("copies", "row.doc_id").collect()
    spilled = exact_owners(frame(spark), trie_bytes=1).select("copies", "row.doc_id").collect()
    assert multiset(whole) == multiset(spilled)
    assert exact_groups(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        exact_owners(frame(spark), keep="newest")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=6).map(str.encode)), st.integers(0, 3))
def test_trie_counts_like_a_dictionary(keys, spills):
    trie, found = PatriciaTrie(), Counter()
    for number, key in enumerate(keys):
        trie.insert(key, number, number, 1)
        if spills and number % (spills + 1) == 0:
            for _, row, copies in trie.spill():
                found[keys[row]] += copies
    for _, row, copies in trie.drain():
        found[keys[row]] += copies
    assert found == Counter(keys)


def brute_fingerprint(text, size):
    words = [w.lower() for w in words_of(text)]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(len(words) - size + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_near_groups_match_all_pairs(spark):
    data = rows()
    prints = [brute_fingerprint(row[1], 4) for row in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, row in enumerate(data):
        ids[root(i)].append(row[0])
    want = [(row[0], prints[i], min((d for d in ids[root(i)] if d is not None), default=None))
            for i, row in enumerate(data)]
    got = [(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in near_groups(frame(spark)).collect()]
    assert multiset(got) == multiset(want)
    survivors = without_near_copies(frame(spark))
    assert survivors.schema == frame(spark).schema and survivors.count() == len(ids)


def test_survivors_do_not_depend_on_row_order(spark):
    """Rows alike in doc_id, source and text differ in lang only; the same one stays however they are laid out."""
    data = [(i % 5, f"same words of text {i % 5}", lang, "s") for i in range(20) for lang in ("de", None, "en", "fr")]
    schema, found = "doc_id long, text string, lang string, source string", set()
    for seed in range(4):
        docs = spark.createDataFrame(random.Random(seed).sample(data, len(data)), schema).repartition(1 + seed)
        near = without_near_copies(docs).collect()
        mixed = mixed_documents(docs, weights=(1,)).collect()
        found.add((tuple(sorted(map(str, near))), tuple(sorted(map(str, mixed)))))
    assert len(found) == 1


def test_near_groups_in_small_chunks_and_of_nothing(spark):
    def found(**options):
        return multiset((r.doc_id, r.component_id) for r in near_groups(frame(spark), **options).collect())

    # All of these are within a few bits, so one bucket is cut into many chunks.
    close = [(i, f"{'base text ' * 30} {i % 7}") for i in range(40)]
    docs = spark.createDataFrame(close, "doc_id long, text string")
    assert multiset(near_groups(docs, chunk=2).collect()) == multiset(near_groups(docs).collect())
    assert found(chunk=3) == found()
    assert near_groups(frame(spark, [])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 90), st.integers(0, 2 ** 32)), min_size=1, max_size=4), st.integers(0, 7))
def test_bit_sliced_links_match_all_pairs(groups, radius):
    values, ends = [], []
    for size, seed in groups:
        rng = random.Random(seed)
        centres = [rng.getrandbits(64) for _ in range(3)]
        own = []
        for _ in range(size):
            value = rng.choice(centres)
            for _ in range(rng.randint(0, radius + 2)):
                value ^= 1 << rng.randrange(64)
            own.append(value)
        values += own
        ends += [len(values)] * size
    got = roots_within(np.array(values, np.uint64), np.array(ends), radius)
    want = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i + 1, ends[i]):
                if bin(values[i] ^ values[j]).count("1") <= radius and want[i] != want[j]:
                    low, high = sorted((want[i], want[j]))
                    want = [low if w == high else w for w in want]
                    changed = True
    assert got.tolist() == want


def test_fingerprint_of_short_and_blank_texts():
    assert fingerprint(b" \n", 4) == 0 and fingerprint(b"", 4) == 0
    assert fingerprint(b"ONE two", 4) % (1 << 64) == xxhash.xxh64_intdigest(b"one two", 42)


@pytest.mark.parametrize("least, chars", [(10, 1), (2, 1), (2, 6), (1, 1)])
def test_lines_match_plain_python(spark, least, chars):
    data = rows()

    def keys(text):
        return [line.strip(BREAKS).lower() for line in (text or "").encode().split(b"\n")]

    holders = Counter()
    for doc_id, text in {(row[0], row[1]) for row in data}:
        holders.update({key for key in keys(text) if len(key.decode()) >= chars})
    gone = {key for key, n in holders.items() if n >= least}
    want = []
    for row in data:
        lines = (row[1] or "").encode().split(b"\n")
        kept = [line for line, key in zip(lines, keys(row[1])) if key not in gone]
        want.append((row[0], len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    got = [tuple(r) for r in dedup_lines(frame(spark), least, chars).collect()]
    assert multiset(got) == multiset(want)


def test_lines_of_nothing(spark):
    assert dedup_lines(frame(spark, [])).count() == 0


def brute_repeats(texts, window):
    seen = Counter()
    for words in texts:
        seen.update(tuple(words[i:i + window]) for i in range(len(words) - window + 1))
    kept = []
    for words in texts:
        out = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i:i + window])] > 1:
                out[i:i + window] = [True] * window
        kept.append([word for word, gone in zip(words, out) if not gone])
    return kept


@pytest.mark.parametrize("window", [1, 3, 10, 35, 80])
def test_repeats_match_brute_force(spark, window):
    data = rows()
    texts = [words_of(row[1]) for row in data]
    want = [(row[0], len(words), len(words) - len(kept), b" ".join(kept).decode())
            for row, words, kept in zip(data, texts, brute_repeats(texts, window))]
    got = [tuple(r) for r in remove_repeats(frame(spark), window).collect()]
    assert multiset(got) == multiset(want)


def test_repeats_with_a_common_phrase_dealt_by_windows(spark, monkeypatch):
    from tidewell.llm import repeats
    monkeypatch.setattr(repeats, "WIDE", 2)
    monkeypatch.setattr(repeats, "SLICE", 2000)
    test_repeats_match_brute_force(spark, 10)
    test_repeats_match_brute_force(spark, 35)


def test_repeats_of_nothing(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(frame(spark), 0)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=12), min_size=1, max_size=5), st.integers(1, 5))
def test_automaton_counts_windows(texts, window):
    automaton, seen = SuffixAutomaton(), Counter()
    for number, text in enumerate(texts):
        automaton.add(text, number + 1)
        for i in range(len(text) - window + 1):
            seen[text[i:i + window]] += number + 1
    automaton.finish()
    for text in texts:
        want = sum(1 << i for i in range(len(text) - window + 1) if seen[text[i:i + window]] > 1)
        assert automaton.repeated(text, window) == want

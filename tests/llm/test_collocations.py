"""Collocations against brute force, and the parts of the HAT-trie."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from mastlight.llm import collocations as c
from mastlight.llm.common import prepare

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, covers=80):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(zip(*[words[i:] for i in range(size)]))
    out = set()
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in frequent.items():
            for part in {p[i:i + m] for m in range(2, len(p)) for i in range(len(p) - m + 1)}:
                longest[part] = max(longest[part], a)
        rows = []
        for p, a in frequent.items():
            if 100 * longest[p] < covers * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out |= {(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)}
    return out


def test_collocations_equal_brute_force(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = random.Random(7)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    rows += [(rng.choice(["en", None, "und", ""]), " ".join(rng.choices("a A b c\tc d, e. é ü\x01 \x00 z\xa0z \x0b".split(" "), k=rng.randint(0, 40)))) for _ in range(300)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, f int, phrase string")
    for least, top in ((4, 40), (8, 10**6)):
        got = c.collocations(frame, top, least=least).collect()
        assert {tuple(r) for r in got} == brute(rows, least, top) and len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in c.collocations(frame, None, least=8).collect()} == brute(rows, 8, 10**6)


def test_collocations_of_odd_rows(spark):
    prepare(spark)
    line = "one two three four"
    long_ = " ".join(f"w{i % 7} common pair" for i in range(150_000))  # several stretches
    rows = [("x", None), (None, ""), ("x", " \t\n"), ("x", "."), ("y", long_), ("y", long_[:999]), (None, line), (None, line), ("und", line)]
    frame = spark.createDataFrame([(lang, text, lang) for lang, text in rows], "lang string, text string, n string")
    got = c.collocations(frame, 50, least=3).collect()
    assert {tuple(r) for r in got} == brute(rows, 3, 50)
    assert any(r.lang == "und" and r.phrase == line and r.a == 3 for r in got)
    assert c.collocations(frame.limit(0)).count() == 0


def test_rows_of_one_phrase(spark):
    """Ties fall to the first of equal cuts and to the smaller phrase; scores need more than 64 bits on the way."""
    prepare(spark)
    rows = [("x", "b a. a b. " * 40)]
    got = [tuple(r) for r in c.collocations(spark.createDataFrame(rows, "lang string, text string"), 5).collect()]
    assert got == [("x", 1, "a b", 40, 80, 80, 160, 500_000), ("x", 2, "b a", 40, 80, 80, 160, 500_000)]


@pytest.mark.parametrize("words,ids", [(1, 90_000), (2, 300), (4, 40)])
def test_trie_counts_bursts_and_spills(words, ids):
    rng = np.random.default_rng(words)
    trie, wanted, out, kinds = c.HatTrie(words, burst=15), Counter(), Counter(), set()
    for _ in range(30):
        n = rng.integers(1, words + 1)
        grid = rng.integers(1, ids, (500, n)) ** 2 // ids + 1  # some words are far more frequent
        keys = np.zeros(500, np.uint64)
        for i in range(n):
            keys |= grid[:, i].astype(np.uint64) << np.uint64(64 - trie.bits * (i + 1))
        wanted.update(keys.tolist())
        trie.add(keys)
        kinds |= {type(child) for child in trie.root.children}
        if rng.random() < 0.2:
            trie.settle()
            held = trie.held
            for k, v in trie.spill(0.5):
                out.update(dict(zip(k.tolist(), v.tolist())))
            assert trie.held <= held * 0.5
    assert (words == 1) or c.Node in kinds
    for k, v in trie.spill():
        out.update(dict(zip(k.tolist(), v.tolist())))
    assert out == wanted and trie.held == 0


def test_small_dictionaries_and_spills_lose_nothing(monkeypatch):
    monkeypatch.setattr(c, "TRIE_KEYS", 60)
    monkeypatch.setattr(c, "BATCH", 100)
    monkeypatch.setattr(c, "MOST_WORDS", 4)
    rng = random.Random(3)
    text = " ".join(rng.choices([f"w{i}" for i in range(30)] + ["."], k=3000)).encode()
    counter, got, wanted = c.Counter(range(3, 5), None, None), Counter(), Counter()
    counter.trie.burst = 16
    carry = np.zeros(0, np.int64)
    for part in c.stretches(text, 100):
        ids = np.concatenate([carry, counter.words.ids("x", part)])
        for batch in counter.phrases(ids, len(carry)):
            got.update(dict(zip(batch["phrase"].to_pylist(), batch["f"].to_pylist())))
        carry = ids[-3:]
    for batch in counter.spill(1.0):
        assert batch["phrase"].to_pylist() == sorted(batch["phrase"].to_pylist(), key=lambda p: p.split())  # a sorted run
        got.update(dict(zip(batch["phrase"].to_pylist(), batch["f"].to_pylist())))
    for piece in text.decode().split("."):
        words = piece.split()
        for size in (3, 4):
            wanted.update(" ".join(w) for w in zip(*[words[i:] for i in range(size)]))
    assert got == wanted


def test_stretches_are_cut_beside_blanks():
    def tokens(text):
        return text.translate(c.FOLD).replace(b".", b" . ").split()

    for text in (b"", b"abc", b"a b  c." * 50, b"x" * 500, b" " * 300):
        parts = list(c.stretches(text, 20))
        assert b"".join(parts) == text and [t for p in parts for t in tokens(p)] == tokens(text)


def test_words_are_counted_without_hashes(monkeypatch):
    """Hashes are for the bit tables, which the first pass has none of."""
    def refuse(_):
        raise AssertionError("a hash of a word")

    monkeypatch.setattr(c.xxhash, "xxh64_intdigest", refuse)
    counter = c.Counter(range(1, 2), None, None)
    runs = [*counter.count("en", b"b a. b c"), *counter.spill(1.0)]
    assert [(r["phrase"], r["f"]) for run in runs for r in run.to_pylist()] == [("a", 1), ("b", 2), ("c", 1)]


def test_runs_of_phrases_of_several_lengths_are_in_order():
    counter = c.Counter(range(3, 5), None, None)
    runs = [*counter.count("en", b"d c b a b. c b a"), *counter.spill(1.0)]
    phrases = [r["phrase"].split() for run in runs for r in run.to_pylist()]
    assert phrases == sorted(phrases) and len(phrases) == 5


def test_rare_words_take_no_room(monkeypatch):
    """What the bit table leaves out is not kept, so rare words neither fill the dictionary nor cut the runs short."""
    monkeypatch.setattr(c, "DICTIONARY", 50)
    raw = bytearray(1 << 16)
    for word in (b"often", b"again"):
        value = c.xxhash.xxh64_intdigest(b"en\0" + word)
        for at in (value, value >> 32):
            raw[(at & (1 << 19) - 1) >> 3] |= 1 << (at & 7)
    counter = c.Counter(range(2, 3), c.BitTable(bytes(raw)), None)
    text = b" ".join(b"often again rare%d" % i for i in range(300))
    assert not list(counter.count("en", text)) and not counter.words.full()
    runs = list(counter.spill(1.0))
    assert [(p, f) for b in runs for p, f in zip(b["phrase"].to_pylist(), b["f"].to_pylist())] == [("often again", 300)]


def full_table(words):
    raw = bytearray(1 << 16)
    for word in words:
        value = c.xxhash.xxh64_intdigest(b"en\0" + word)
        for at in (value, value >> 32):
            raw[(at & (1 << 19) - 1) >> 3] |= 1 << (at & 7)
    return c.BitTable(bytes(raw))


def test_pairs_are_handed_on_as_hashes(monkeypatch):
    """The pass over pairs makes no phrases, also where its trie spills and the dictionary is emptied."""
    monkeypatch.setattr(c, "TRIE_KEYS", 40)
    monkeypatch.setattr(c, "BATCH", 50)
    rng, got, wanted = random.Random(2), Counter(), Counter()
    words = [b"w%d" % i for i in range(25)]
    counter = c.Counter(range(2, 3), full_table(words), None, True)
    monkeypatch.setattr(c.Counter, "runs", None)
    hashes = {w: np.array([c.xxhash.xxh64_intdigest(b"en\0" + w)], np.uint64) for w in words}
    for _ in range(40):
        text = rng.choices(words + [b"rare"], k=60)
        for a, b in zip(text, text[1:]):
            if b"rare" not in (a, b):
                wanted[int(c.pair_hashes(hashes[a], hashes[b]).view(np.int64)[0])] += 1
        batches = list(counter.count("en", b" ".join(text)))
        if rng.random() < 0.2:
            counter.words.reset()
            batches += counter.spill(1.0)
        for batch in batches:
            for h, f in zip(batch["hash"].to_pylist(), batch["f"].to_pylist()):
                got[h] += f
    for batch in counter.spill(1.0):
        for h, f in zip(batch["hash"].to_pylist(), batch["f"].to_pylist()):
            got[h] += f
    assert got == wanted


def test_false_alarms_change_nothing(spark, monkeypatch):
    """With tables that let everything through, counts are still of the words themselves."""
    prepare(spark)
    monkeypatch.setattr(c, "TABLE_BITS", 64)
    rng = random.Random(8)
    rows = [("x", " ".join(rng.choices([f"w{i}" for i in range(60)], [1 / (i + 1) for i in range(60)], k=60))) for _ in range(80)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in c.collocations(frame, 500, least=6).collect()} == brute(rows, 6, 500)

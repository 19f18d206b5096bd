"""The training-data operators against brute force, libraries and odd tables."""

import hashlib
import json
import os
import random
import re
import time
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from mastlight.llm import decontaminate, language, neardup, pieces, pii, quality, suffixes, tokens, topk, toxicity
from mastlight.llm.common import prepare
from mastlight.session import shared_folder

FOLDER = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in any column, empty and long texts, repeated rows, and columns with clashing names."""
    prepare(spark)
    long_ = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    rows = [(1, None, "x"), (2, "", None), (None, "one two three four five six seven", "x"), (3, "Same Same same", "y"),
            (3, "Same Same same", "y"), (4, long_, "z"), (5, long_ + " end", "z"), (6, "\t\n ", "z"), (7, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.selectExpr("*", "lang AS score", "lang AS id", "lang AS n_shingles", "lang AS mark", "lang AS n_pieces", "lang AS n_tokens")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


# --- pieces ---------------------------------------------------------------------------------------
def test_pieces_equal_the_library(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = pieces.PieceCodec(pieces.codec_bytes(PIECES))
    rng = random.Random(5)
    texts = ["", " ", "  a b  c ", "▁a ▁▁", "<s> </s>", "a" * 500, " " * 700 + "b", "x y", "①é€😀\x00"]
    texts += ["".join(rng.choices(" ▁\n\tabethé€😀<>0x.,!ข", k=rng.randint(1, 60))) for _ in range(2000)]
    for text in [*texts, *[r.text for r in docs.select("text").collect()]]:
        wanted = library.encode(text, add_eos=True)
        decimal, n, decoded = codec.both(text)
        assert (list(map(int, decimal.split())), n, decoded) == (wanted, len(wanted), library.decode(wanted))
        assert codec.decode(codec.encode(text)) == decoded


def test_pieces_of_odd_rows(spark, odd, empty):
    model = spark.sparkContext.broadcast(pieces.codec_bytes(PIECES))
    got = pieces.encode_decode(odd, model).collect()
    assert len(got) == 9 and all(r.piece_ids[-1] == 2 and r.n_pieces == len(r.piece_ids) and r.decoded == (r.text or "") for r in got)
    assert pieces.encode_decode(empty, model, digests=True).count() == 0


# --- token counts ---------------------------------------------------------------------------------
def test_token_lengths_equal_longest_match():
    rng = random.Random(2)

    def brute(vocabulary, word):
        at = n = 0
        while at < len(word):
            end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
            if end is None:
                return 1
            at, n = end, n + 1
        return n

    for _ in range(800):
        vocabulary = {tuple(rng.choices(range(3), k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        automaton = tokens.LengthAutomaton(vocabulary)
        for _ in range(15):
            word = tuple(rng.choices(range(3), k=rng.randint(0, 14)))
            assert automaton.length(word) == brute(vocabulary, word)


def test_token_counts_of_rows(spark, docs, odd, empty):
    data = tokens.vocabulary_bytes(public_tokenizers.path("word_bpe_49k.json"))
    shared = spark.sparkContext.broadcast(data)
    letters = {b: c for c, b in tokens.byte_letters().items()}

    vocabulary = set(json.loads(data)["model"]["vocab"])
    for row in tokens.token_counts(docs.limit(25), shared).collect():
        total = 0
        for word in tokens.WORDS(row.text.lower()):
            left = "".join(letters[b] for b in word.encode()) + "</w>"
            while left:
                end = next(e for e in range(len(left), 0, -1) if left[:e] in vocabulary and (e == len(left) or e <= len(left) - 5))
                left, total = left[end:], total + 1
        assert total == row.n_tokens
    got = {(r.doc_id, r.n_words) for r in tokens.token_counts(odd, shared).collect()}
    assert {(1, 0), (2, 0), (None, 7), (3, 3), (6, 0)} <= got
    assert tokens.token_counts(empty, shared).count() == 0


# --- classifiers ----------------------------------------------------------------------------------
@pytest.mark.parametrize("module,label,of,held", [(quality, "quality", 4, 2), (toxicity, "toxic", 3, 1)])
def test_classifiers_on_held_out_rows(spark, module, label, of, held):
    folder = "/root/testdata/sf0.1"
    every, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    prepare(spark)
    rest = F.crc32(F.col("doc_id").cast("string")) % of
    model = module.fit(every, labels, rest != held)
    wanted = every.join(labels.where(rest == held), "doc_id").select("doc_id", "text", label)
    rows = module.score(wanted, model).select(label, "score").collect()
    right = sum((r.score >= 0.7) == (r[label] == 1) for r in rows) / len(rows)
    assert right > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_classifiers_on_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 1, 1), (3, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        for known in (labels, labels.limit(0)):
            model = module.fit(odd, known, F.lit(True))
            rows = module.score(odd, model).collect()
            assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
            assert module.score(empty, model).count() == 0


def test_quality_bags_and_scores_agree():
    settings = quality.Settings()
    model = quality.QualityModel(settings, np.random.default_rng(1).normal(size=settings.buckets), 0.3)
    for text in ("", "a", "a a a b", "Éé über alles, alles", "one\ntwo  three"):
        ids, weights = quality.bags([text.encode()], settings)[0]
        raw = model.bias + float((model.weights[ids] * weights).sum())
        assert abs(1 / (1 + np.exp(-raw)) - quality.scores([text.encode()], model)[0]) < 1e-5


def test_isotonic_steps_rise():
    rng = np.random.default_rng(3)
    at, value = toxicity.isotonic(rng.normal(size=200), rng.integers(0, 2, 200).astype(float))
    assert (np.diff(at) >= 0).all() and (np.diff(value) >= 0).all()


# --- near duplicates ------------------------------------------------------------------------------
def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(rows):
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}, {r[0]: len(s) for r, s in zip(rows, sets)}


def variants(count, words, edits, seed):
    """Copies of one text, each with some words changed: linked to the text, hardly to each other."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(count):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_near_duplicates_equal_brute_force(spark, docs):
    texts = [r.text for r in docs.select("text").limit(80).collect()] + variants(60, 90, 2, 1) + variants(40, 60, 3, 2) + ["a b", "A B", "a b c"]
    random.Random(3).shuffle(texts)
    rows = sorted(enumerate(texts))
    wanted, sizes = components(rows)
    small = neardup.Settings(leaf=6, block=8)  # all ways of comparing are taken
    for settings in (neardup.Settings(), small):
        got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()
        assert {r.doc_id: r.component_id for r in got} == wanted
        assert {r.doc_id: r.n_shingles for r in got} == sizes and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_trees_share_no_function_and_rarely_lose_a_pair():
    settings = neardup.Settings()
    used = [[neardup.function_of(tree, node, settings) for node in range(1, 7)] for tree in range(settings.trees)]
    assert len({f for tree in used for f in tree}) == 24
    kept = 1.0
    for _ in range(settings.depth):
        kept = 1 - (1 - 0.75 * kept) ** settings.branches
    assert 5.9e-5 < (1 - kept) ** settings.trees < 6.1e-5
    with pytest.raises(ValueError):
        neardup.Settings(trees=6)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == 9
    found = {(r.doc_id, r.component_id, r.kept, r.n_shingles) for r in got}
    assert {(1, 1, True, 0), (2, 2, True, 0), (3, 3, True, 1), (4, 4, True, 29996), (5, 4, False, 29997), (None, None, True, 3)} <= found
    assert neardup.near_duplicates(empty).count() == 0


def test_one_row_of_each_group_stays(spark, odd, empty):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(5, text, "a"), (5, text, "a"), (5, text + " end", "a"), (9, text, "b"), (None, text, "c"), (None, "none has a key here", "d"),
            (None, "none has a key here", "d"), (7, None, "e"), (7, "", "e"), (8, "alone with its own words", "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component string")
    kept = neardup.one_of_each(frame)
    assert kept.columns == frame.columns
    got = sorted(((r.doc_id, r.component) for r in kept.collect()), key=repr)
    assert got == [(5, "a"), (7, "e"), (7, "e"), (8, "f"), (None, "d")]
    assert neardup.one_of_each(empty).count() == 0 and neardup.one_of_each(odd).count() == 7


# --- decontamination ------------------------------------------------------------------------------
def test_phrases_and_proximity(spark, docs, odd, empty):
    items = spark.createDataFrame([(1, "three four FIVE"), (2, None), (3, ""), (None, "six seven"), (4, "three, four five"), (4, "seven")],
                                  "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.report(odd, items).collect()}
    assert (rows[None].n_words, rows[None].n_hit, rows[None]["items"]) == (7, 5, ["1", "4"])
    assert rows[3].n_words == 3 and rows[3].n_hit == 0 and rows[1].n_words == 0
    assert decontaminate.report(odd, items).count() == 9 and decontaminate.report(empty, items).count() == 0
    assert decontaminate.report(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.clean(odd, items).count() == 8
    near = spark.createDataFrame([(1, "alpha x y beta gamma"), (2, "alpha " + "z " * 12 + "beta")], "doc_id long, text string")
    wanted = spark.createDataFrame([(9, "beta alpha")], "item_id long, text string")
    shards = decontaminate.index(near)
    assert decontaminate.matches(shards, wanted).count() == 0
    assert [r.key for r in decontaminate.matches(shards, wanted, distance=4).collect()] == [1]


def test_windows_of_blocks_and_parts(spark, odd, monkeypatch):
    """Small blocks and parts give what one block gives; an item that is cut into parts is listed once."""
    rng = random.Random(12)
    vocabulary = [f"t{i}" for i in range(12)]
    items = [(i % 40, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 10, 11, 60])))) for i in range(60)]
    texts = [(i, " ".join(rng.choices(vocabulary, k=40) + rng.choice(items)[1].split() + ["x"])) for i in range(80)]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    wanted = {}
    for key, text in texts:
        words, hit, found = text.split(), set(), set()
        for item, phrase in items:
            own = phrase.split()
            for window in {tuple(own[i:i + 10]) for i in range(max(1, len(own) - 9))} if own else ():
                for at in range(len(words) - len(window) + 1):
                    if tuple(words[at:at + len(window)]) == window:
                        hit |= set(range(at, at + len(window)))
                        found.add(str(item))
        wanted[key] = (len(words), len(hit), sorted(found))
    for block, part in ((decontaminate.BLOCK_WINDOWS, decontaminate.PART), (100, 7)):
        monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
        monkeypatch.setattr(decontaminate, "PART", part)
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.report(docs, bench).collect()}
        assert got == wanted


# --- repeats --------------------------------------------------------------------------------------
def without_repeats(rows):
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(data[i : i + 100])
        left = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())
    return out


def test_repeats_equal_brute_force(spark, docs, monkeypatch):
    rng = random.Random(4)
    line = "a common line that stands in very many documents, always the same, and is a little over a hundred bytes long."
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").limit(60).collect()]
    rows += [(1000 + i, f"{rng.random()} {line} {rng.random()}" + "ab" * rng.randint(0, 120)) for i in range(40)]
    rows += [(2000, "x" * 400), (2001, "x" * 150), (2002, None), (2003, "é" * 49), (2004, rows[0][1]), (2005, "x" * 99)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (suffixes.HOT_RUNS, 5):  # with and without splitting of frequent anchors
        monkeypatch.setattr(suffixes, "HOT_RUNS", hot)
        got = suffixes.remove_repeats(frame, digests=True).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == without_repeats(rows)


def test_no_task_gathers_a_hot_string(spark, monkeypatch):
    line = "a common line that stands in very many documents, always the same, and is a little over a hundred bytes long."
    rows = [(i, f"{i * 7919} {line} {i * 104729}" + "xy" * (i % 3 * 60)) for i in range(60)]
    largest, plain = [], suffixes._earlier_starts

    def watched(runs):
        largest.append(max((r["count"] for r in runs.groupBy("anchor").count().collect()), default=0))
        return plain(runs)

    monkeypatch.setattr(suffixes, "HOT_RUNS", 5)
    monkeypatch.setattr(suffixes, "_earlier_starts", watched)
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), digests=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == without_repeats(rows)
    assert max(largest) <= 5


def test_two_stage_array_is_sorted():
    rng = random.Random(6)
    for _ in range(60):
        data = bytes(rng.choices(range(1, 4), k=rng.randint(1, 300))) + b"\0"
        order = suffixes.two_stage_array(np.frombuffer(data, np.uint8))
        cut = [data[i : i + 100] for i in order]
        assert cut == sorted(cut) and sorted(order) == list(range(len(data)))


def test_repeats_of_odd_rows(odd, empty):
    got = {(r.doc_id, r.n_removed) for r in suffixes.remove_repeats(odd).collect()}
    assert (1, 0) in got and (3, 0) in got and (4, 0) in got and any(k == 5 and n > 100_000 for k, n in got)
    assert suffixes.remove_repeats(empty).count() == 0


# --- top-k ----------------------------------------------------------------------------------------
def test_topk_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(8)
    vectors = {i: rng.normal(size=6).round(1).tolist() for i in range(300)} | {i: [1.0, 0.5, 0.0, 0.0, 0.0, 0.0] for i in range(300, 420)}
    rows = [*vectors.items(), (500, None), (501, [float("nan")] * 6), (502, [None] * 6), (503, []), (600, [1.0, 2.0]), (601, [2.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.exact_topk(frame, F.col("vec_id") % 100 == 0, 10).collect()}
    whole = {i: np.floor(1024 * np.array(v)).astype(np.int64) for i, v in vectors.items()}
    wanted = {(600, 1, 601, 6 * 1024 * 1024)}
    for q in (0, 100, 200, 300, 400):
        best = sorted((-int(v @ whole[q]), i) for i, v in whole.items() if i != q)[:10]
        wanted |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    assert got == wanted
    assert topk.exact_topk(frame.limit(0), F.col("vec_id") % 100 == 0, 10).count() == 0


# --- personal data --------------------------------------------------------------------------------
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def luhn(digits):
        return sum(x - 9 if x > 9 else x for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))) % 10 == 0

    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if ((kind == "ip" and any(int(p) > 255 for p in m[0].split("."))) or (kind == "phone" and not 8 <= len(digits) <= 15)
                    or (kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)))):
                continue
            yield f"{kind}:{m.start()}:{m.end()}"


def test_base_spans_equal_the_patterns(spark, docs):
    rng = random.Random(9)
    parts = ["a.b@c.d", "@", ".", "1.2.3.4", "256.1.1.1", "0255.1.1.01", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1",
             "é😀", " ", "x@y", "_", "-", "7", "++", "a@b@c.de"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(400)] + ["9" * 3_000, "a.b@c" + ".d" * 20_000, None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(docs.select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text"))
    for row in pii.report(frame).join(frame, "doc_id").collect():
        found = list(plain_spans(row.text))
        assert row.base_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest(), row.text
        assert row.n_email == sum(s.startswith("email") for s in found) and row.spans[: len(",".join(found))] == ",".join(found)


def test_disclosing_terms_go_and_common_ones_stay(spark):
    texts = [f"number {i} was sent by zorblax to boss@firm.example and the rest" for i in range(6)] + [f"the rest and number {i} of it" for i in range(60)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert "zorblax" not in clean[0] and "[EMAIL]" in clean[0] and "number" in clean[0] and "rest" in clean[0]
    assert all(clean[i] == texts[i] for i in range(6, 66))


def test_terms_beside_values_seen_once_go_wherever_they_stand(spark):
    far = " and the rest of it" * 12
    edge = "." * 111  # the reach ends within the word after it
    texts = [f"the qwibble said{far} the rest sent by qwibble to one@firm.example and the rest{far} qwibble",
             f"the rest to two@firm.example {edge} snorklewump and snorkle", "snork and the rest", "the rest of qwibbles"]
    texts += [f"signed plimsy the rest to n{i}@deep.example and the rest{far} plimsy" for i in range(4)]
    texts += [f"number {i} said the rest and signed to it" for i in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert "qwibble" not in clean[0] and "[EMAIL]" in clean[0] and clean[0].count("rest") == 26
    assert clean[1].endswith("snorklewump and snorkle") and clean[2] == texts[2] and clean[3] == texts[3]
    assert not any("plimsy" in clean[i] or "[EMAIL]" not in clean[i] for i in range(4, 8))  # the domain recurs, no address does
    assert all(clean[i] == texts[i] for i in range(8, 308))


def test_personal_data_of_odd_rows(odd, empty):
    assert pii.report(odd).count() == 9 and pii.report(empty).count() == 0
    assert sorted(r.text or "" for r in pii.sanitise(odd).collect()) == sorted(r.text or "" for r in odd.collect())


def test_long_texts_full_of_numbers_and_values(spark):
    """Time must grow with a text, not with its square."""
    digits = " ".join(str(i * 7919 % 99991) for i in range(180_000))
    mails = "; ".join(f"name{i} user{i}@mail{i % 50}.example" for i in range(20_000))
    assert len(digits) > 1_000_000
    rows = [(1, digits), (2, mails), (3, digits + " card 4111 1111 1111 1111 " + "é" * 50_000 + " a@b.c"), (4, "a@b.c" * 3 + "x" * 2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    for row in pii.report(frame).join(frame, "doc_id").collect():
        found = list(plain_spans(row.text))
        assert row.base_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest() and row.spans.startswith(",".join(found))
    clean = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert clean[1] == digits and "@" not in clean[2] and clean[2].count("[EMAIL]") == 20_000
    assert clean[3] == re.sub("4111 1111 1111 1111", "[CARD]", rows[2][1]).replace("a@b.c", "[EMAIL]")
    assert time.time() - began < 60


# --- language -------------------------------------------------------------------------------------
def test_language_of_pages(spark, docs):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    rows = language.identify_pages(pages, docs).collect()
    assert len(rows) == pages.count()
    assert sum(r.language == r.declared for r in rows if r.declared) >= 0.95 * sum(bool(r.declared) for r in rows)
    none = spark.createDataFrame([(1, None, None), (1, None, None), (2, "nothing", ""), (None, "http://a.b.de/", "<html lang='de'>")],
                                 "page_id long, url string, html string")
    rows = language.identify_pages(none, docs).collect()
    assert len(rows) == 4 and all(r.language for r in rows)
    assert language.identify_pages(none.limit(0), docs).count() == 0
    assert [r.language for r in language.identify_pages(none, docs.limit(0)).collect()] == [None] * 4


# --- pipeline -------------------------------------------------------------------------------------
def test_pipeline(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "pieces"]
    frame, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, frame, FOLDER)
        if name != "pieces":
            assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), after.schema)
        kept.append(after.count())
        frame = after
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.5 * docs.count()
    assert corpus_pipeline.run(spark, FOLDER).count() == kept[-1]
    assert zlib.crc32(b"5") == spark.range(1).select(F.crc32(F.lit("5"))).first()[0]


def test_large_groups_hand_on_one_link_a_class(spark, monkeypatch):
    """The links of a group of near copies with its pivots follow its size once, not once a pivot."""
    handed = []

    def spied(links):
        handed.append(links.count())
        return components_of(links)

    components_of = neardup.connected_components
    monkeypatch.setattr(neardup, "connected_components", spied)
    rows = [(i, " ".join(f"w{j}" for j in range(200)) + f" end{i}") for i in range(120)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1
    assert handed[0] > 240 and handed[-1] < 120


def test_near_duplicate_work_tables_go_when_read(spark, monkeypatch):
    """When the links are labelled, the tables that only the search for them needed are gone."""
    folder = Path(shared_folder(spark), "mastlight")
    folder.mkdir(exist_ok=True)
    before, seen = set(os.listdir(folder)), []

    def spied(links):
        out = components_of(links)
        seen.append({name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before})
        return out

    components_of = neardup.connected_components
    monkeypatch.setattr(neardup, "connected_components", spied)
    rows = [(i, " ".join(f"w{j}" for j in range(200)) + f" end{i}") for i in range(60)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and len(seen) == 2
    assert seen[-1] >= {"near-links", "standing", "numbered", "labels"}
    assert not seen[-1] & {"prints", "classes", "shared-minima", "node-stats", "links"}


def test_links_are_written_once(spark, monkeypatch):
    """Each table of links is written once, with every link once, and no block is made where no node is crowded."""
    made, handed = [], []

    def spied(df, label):
        made.append(label)
        return written_at(df, label)

    def linked(links):
        handed.append([tuple(sorted(r)) for r in links.select("a", "b").collect()])
        return components_of(links)

    written_at, components_of = neardup.written_at, neardup.connected_components
    monkeypatch.setattr(neardup, "written_at", spied)
    monkeypatch.setattr(neardup, "written", lambda df, label: spied(df, label)[0])
    monkeypatch.setattr("mastlight.llm.components.written_at", spied)
    monkeypatch.setattr(neardup, "connected_components", linked)
    monkeypatch.setattr(neardup, "_block_links", None)
    rows = [(i, " ".join(f"w{j}" for j in range(200)) + f" end{i}") for i in range(60)] * 2
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 120 and {r.component_id for r in got} == {0}
    assert all(len(x) == len(set(x)) > 0 for x in handed)
    tables = [label for label in made if label != "labels"]
    assert len(tables) == len(set(tables)) + 2 and not set(tables) & {"links", "class-components"}  # two levels of nodes

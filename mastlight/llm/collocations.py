"""Phrase collocation mining: phrases of two to four words that stand together more often than their parts do.

Contiguous words are counted in a HAT-trie per task: a shallow trie over word ids whose leaves are *containers*, hash
tables of packed word ids.  A container starts out shared by a range of words.  When it holds too many keys it
bursts: a range is cut in two; a container of one word gets a trie node of its own, over the word that follows.  When
the trie holds more keys than its budget, its largest subtrees are spilled whole, as runs in the order of their phrases.
Runs are written, dealt out by ranges of phrases (so by prefixes, where a heavy prefix takes several ranges) and merged.

Three passes count words, pairs by their hashes, and phrases of two to four words.  A phrase is at most as frequent as its parts,
so a later pass leaves out what holds a part below the least count.  Tasks know these parts by a bit table of at
most ``TABLE_BITS`` bits that is broadcast: it may let a part through too many, never one too few, so it
bounds memory and cannot change a result.  Most pairs are rare: the second pass only finds out which may be frequent, so it
hands on a hash and a count for each; pairs that share a hash count together there, and the third pass counts those
that are left by their words.

Results: everything is per language; a NULL language is ``und``, a NULL text is empty.  Texts without words
add nothing, repeated rows count each, extra columns are not read.  Long texts are read in stretches that
carry three words over.  Words are told apart by their bytes; only the bit tables work with hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mastlight.llm.common import mixed, removed, slices
from mastlight.session import new_work_folder, written

#: Words of the longest phrase, least count of a phrase, and what a longer phrase needs of a shorter one's count to replace it.
MOST_WORDS, LEAST, COVERS = 4, 30, 80
#: Score of a phrase whose parts never stand without each other is half of this.
SCALE = 2_000_000
#: Keys of a container before it bursts; keys of a trie before it spills; words a task keeps in its dictionary.
BURST, TRIE_KEYS, DICTIONARY = 1 << 15, 1 << 21, 500_000
#: Keys that are added to a trie together.
BATCH = 1 << 19
#: Bits of the table of frequent parts, at most (16 MB).
TABLE_BITS = 1 << 27
#: Bytes of a text that are read at a time.
STRETCH = 1 << 20
#: A-Z become lower case; what ends a piece becomes a full stop.
FOLD = bytes(0x2E if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
BREAKS = b" \t.,;:!?\n\x0b\x0c\r"
ROWS = 100_000


class Container:
    """An open hash table of packed word ids with counts; batches of distinct keys are added at once."""

    def __init__(self, slots: int = 1024):
        self.keys, self.counts, self.held = np.zeros(slots, np.uint64), np.zeros(slots, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        while 2 * (self.held + len(keys)) > len(self.keys):
            self._grow(2 * (self.held + len(keys)))
        self._place(keys, counts)

    def _grow(self, least: int) -> None:
        old = self.items()
        slots = 1 << (int(least) - 1).bit_length()
        self.keys, self.counts, self.held = np.zeros(slots, np.uint64), np.zeros(slots, np.int64), 0
        self._place(*old)

    def _place(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        slot = (mixed(keys) & mask).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            # Of several keys that claim a free slot the last one written has it; the others go on to the next slot.
            self.keys[slot[free]] = keys[free]
            there = self.keys[slot] == keys
            self.held += int(np.count_nonzero(there & free))
            self.counts[slot[there]] += counts[there]
            left = ~there
            keys, counts, slot = keys[left], counts[left], (slot[left] + 1) & int(mask)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        used = self.keys != 0
        return self.keys[used], self.counts[used]


class Node:
    """A trie node over the words at one place of the phrase: ascending first words of its children's ranges."""

    def __init__(self, shift: int, child: Container):
        self.shift, self.starts, self.children = shift, [0], [child]


class HatTrie:
    """Counts of packed phrases; a key holds word ids from the highest bits down, 0 where a phrase has ended."""

    def __init__(self, words: int, burst: int = BURST, levels: int = 2):
        self.bits, self.burst, self.levels = 64 // max(words, 2), burst, min(levels, words)
        self.mask = np.uint64((1 << self.bits) - 1)
        self.root, self.held = Node(64 - self.bits, Container()), 0
        self.waiting: list[np.ndarray] = []
        self.waits = 0

    @property
    def most_words(self) -> int:
        return (1 << min(self.bits, 31)) - 1

    def add(self, keys: np.ndarray) -> None:
        """Count every key of an array; arrays wait until a batch has come together."""
        self.waiting.append(keys)
        self.waits += len(keys)
        if self.waits >= BATCH:
            self.settle()

    def settle(self) -> None:
        """Put what waits into the trie."""
        if self.waits:
            distinct, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.waiting, self.waits = [], 0
            self._add(self.root, distinct, counts)

    def _add(self, node: Node, keys: np.ndarray, counts: np.ndarray) -> None:
        """Ascending keys with one path down to this node: a contiguous part of them belongs to each child."""
        symbols = (keys >> np.uint64(node.shift)) & self.mask
        cuts = np.append(np.searchsorted(symbols, np.array(node.starts, np.uint64)), len(keys))
        for i in reversed(np.flatnonzero(np.diff(cuts)).tolist()):  # backwards: a burst moves later children only
            part, child = slice(cuts[i], cuts[i + 1]), node.children[i]
            if isinstance(child, Node):
                self._add(child, keys[part], counts[part])
                continue
            before = child.held
            child.add(keys[part], counts[part])
            self.held += child.held - before
            if child.held > self.burst:
                self._burst(node, i)

    def _burst(self, node: Node, i: int) -> None:
        keys, counts = node.children[i].items()
        symbols = (keys >> np.uint64(node.shift)) & self.mask
        middle = np.partition(symbols, len(symbols) // 2)[len(symbols) // 2]
        low = symbols.min()
        cut = middle if middle > low else (symbols[symbols > low].min() if (symbols > low).any() else None)
        if cut is None:  # one word only: a level of its own, unless the trie is as deep as it gets
            if node.shift > 64 - self.bits * self.levels:
                below = Node(node.shift - self.bits, node.children[i])
                node.children[i] = below
                self._burst(below, 0)
            return
        left, right = Container(), Container()
        for child, own in ((left, symbols < cut), (right, symbols >= cut)):
            child.add(keys[own], counts[own])
        node.starts[i:i + 1] = [node.starts[i], int(cut)]
        node.children[i:i + 1] = [left, right]

    def _items(self, child: Node | Container) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if isinstance(child, Container):
            yield child.items()
        else:
            for below in child.children:
                yield from self._items(below)

    def spill(self, share: float = 1.0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, largest first, until the share of all keys is gone; one (keys, counts) each."""
        self.settle()
        sizes = [sum(len(k) for k, _ in self._items(child)) for child in self.root.children]
        least = self.held * (1 - share)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            if self.held <= least:
                break
            parts = list(self._items(self.root.children[i]))
            self.root.children[i] = Container()
            self.held -= sizes[i]
            if sizes[i]:
                yield np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class Dictionary(dict):
    """Word ids of one language; 0 for words that cannot be in a phrase, which are not kept: most are never met again."""

    def __init__(self, words: Words, lang: str):
        super().__init__()
        self[b"."] = 0
        self.words, self.lang, self.prefix = words, lang, lang.encode() + b"\0"
        # The bit table's content, tested in place: most words that are asked for are rare.
        table = words.table
        self.raw, self.mask = (table.raw, table.mask) if table else (None, 0)

    def __missing__(self, word: bytes) -> int:
        raw = self.raw
        if raw is None:  # every word counts, and no hash is asked for
            listed = self.words.listed
            self[word] = number = len(listed)
            listed.append((self.lang, word))
            return number
        value = xxhash.xxh64_intdigest(self.prefix + word)
        a, b = value & self.mask, value >> 32 & self.mask
        if raw[a >> 3] >> (a & 7) & 1 and raw[b >> 3] >> (b & 7) & 1:
            listed = self.words.listed
            self[word] = number = len(listed)
            listed.append((self.lang, word))
            self.words.hashes.append(value)
            return number
        return 0


class Words:
    """The words a task has seen: ids by language, and for each id its language, bytes and, where there is a table, hash."""

    def __init__(self, table: BitTable | None):
        self.table = table
        self.reset()

    def reset(self) -> None:
        self.by_lang: dict[str, Dictionary] = {}
        self.listed: list[tuple[str, bytes]] = [("", b"")]
        self.hashes: list[int] = [0]
        self.array = np.zeros(0, np.uint64)

    def hashes_of(self, ids: np.ndarray) -> np.ndarray:
        fresh = self.hashes[len(self.array):]
        if fresh:
            self.array = np.append(self.array, np.array(fresh, np.uint64))
        return self.array[ids]

    def full(self) -> bool:
        return sum(map(len, self.by_lang.values())) > DICTIONARY

    def ids(self, lang: str, data: bytes) -> np.ndarray:
        """Ids of the words of a stretch, 0 between pieces and for words left out."""
        known = self.by_lang.get(lang)
        if known is None:
            known = self.by_lang[lang] = Dictionary(self, lang)
        found = data.translate(FOLD).replace(b".", b" . ").split()
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))


class BitTable:
    """Which hashes are in a set, with false alarms: two bits each."""

    def __init__(self, raw: bytes):
        self.raw, self.bits, self.mask = raw, np.frombuffer(raw, np.uint8), 8 * len(raw) - 1

    def holds(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for part in (values, values >> np.uint64(32)):
            at = part & np.uint64(self.mask)
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def stretches(text: bytes, size: int = STRETCH) -> Iterator[bytes]:
    """Parts of a text, cut beside a blank or the end of a piece."""
    begin = 0
    while len(text) - begin > size:
        end = begin + size
        while end < len(text) and text[end] not in BREAKS:
            end += 1
        yield text[begin:end]
        begin = end
    yield text[begin:]


class Counter:
    """Counts phrases of the given lengths; hands out runs of (language, phrase, count), or with ``hashed``, for pairs under a
    table of words, of (hash, count) in no order."""

    def __init__(self, lengths: range, words: BitTable | None, pairs: BitTable | None, hashed: bool = False):
        self.lengths, self.pairs, self.words, self.hashed = lengths, pairs, Words(words), hashed
        self.trie = HatTrie(lengths[-1])
        self.total: dict[str, int] = {}
        self.renewed()

    def renewed(self) -> None:
        """No word has an id in the trie yet."""
        self.small = np.zeros(1024, np.int64)
        self.own_words: list[tuple[str, bytes]] = [("", b"")]
        self.own_hashes = [np.zeros(1, np.uint64)]

    def small_ids(self, ids: np.ndarray) -> np.ndarray:
        """Ids within the trie, given to words as they come."""
        if len(self.words.listed) > len(self.small):
            self.small = np.append(self.small, np.zeros(len(self.words.listed), np.int64))
        fresh = np.unique(ids[self.small[ids] == 0])
        fresh = fresh[fresh > 0]
        self.small[fresh] = np.arange(len(self.own_words), len(self.own_words) + len(fresh))
        self.own_words += [self.words.listed[i] for i in fresh.tolist()]
        if self.hashed and len(fresh):
            self.own_hashes.append(self.words.hashes_of(fresh))
        return self.small[ids].astype(np.uint64)

    def count(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """Count one stretch of texts, whose texts are parted by a full stop or carry on from the last one."""
        ids = self.words.ids(lang, text)
        if self.lengths[0] == 1:
            self.total[lang] = self.total.get(lang, 0) + int(np.count_nonzero(ids))
        yield from self.phrases(ids, 0)

    def phrases(self, ids: np.ndarray, carried: int) -> Iterator[pa.RecordBatch]:
        """Add all phrases that end behind the words carried over."""
        # live[i]: the words from i to i + length - 1 are in one piece and every pair of them may be frequent.
        live, starts = ids > 0, {}
        if self.pairs is not None and len(ids) > 1:
            hashes = self.words.hashes_of(ids)
            linked = live[:-1] & live[1:]
            at = np.flatnonzero(linked)
            linked[at] = self.pairs.holds(pair_hashes(hashes[at], hashes[at + 1]))
        else:
            linked = live[:-1] & live[1:]
        for length in range(1, self.lengths[-1] + 1):
            if length > 1:
                live = live[:-1] & linked[length - 2:]
            if length in self.lengths:
                starts[length] = np.flatnonzero(live)
                starts[length] = starts[length][starts[length] + length > carried]
        used = np.zeros(len(ids), bool)
        for length, at in starts.items():
            for step in range(length):
                used[at + step] = True
        room = self.trie.most_words - len(self.own_words)
        if np.count_nonzero(used) > room and len(np.unique(ids[used])) > room:
            yield from self.spill(1.0)
        small = np.zeros(len(ids), np.uint64)
        small[used] = self.small_ids(ids[used])
        for length, at in starts.items():
            key = np.zeros(len(at), np.uint64)
            for step in range(length):
                key |= small[at + step] << np.uint64(64 - self.trie.bits * (step + 1))
            self.trie.add(key)
        if self.trie.held > TRIE_KEYS:
            yield from self.spill(0.5)

    def spill(self, share: float) -> Iterator[pa.RecordBatch]:
        """Hand out subtrees as runs; with all of them gone, ids start anew."""
        yield from self.hashed_runs(share) if self.hashed else self.runs(share)
        if not self.trie.held:
            self.trie = HatTrie(self.lengths[-1])
            self.renewed()

    def hashed_runs(self, share: float) -> Iterator[pa.RecordBatch]:
        hashes, bits, mask = np.concatenate(self.own_hashes), self.trie.bits, self.trie.mask
        for keys, counts in self.trie.spill(share):
            value = pair_hashes(hashes[keys >> np.uint64(64 - bits)], hashes[(keys >> np.uint64(64 - 2 * bits)) & mask]).view(np.int64)
            for begin in range(0, len(keys), ROWS):
                rows = slice(begin, begin + ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(value[rows]), pa.array(counts[rows])], names=["hash", "f"])

    def runs(self, share: float) -> Iterator[pa.RecordBatch]:
        langs = pa.array([w[0] for w in self.own_words], pa.string())
        words = pa.array([w[1] for w in self.own_words], pa.binary())
        # Places count from 1: 0 is left for the end of a phrase, so no place needs more bits than an id.
        place = np.empty(len(self.own_words), np.uint64)
        place[pc.sort_indices(words.slice(1)).to_numpy() + 1] = np.arange(1, len(self.own_words))
        place[0] = 0
        bits, mask = self.trie.bits, self.trie.mask
        for keys, counts in self.trie.spill(share):
            columns = [((keys >> np.uint64(64 - bits * (i + 1))) & mask).astype(np.int64) for i in range(64 // bits)]
            order = np.argsort(np.bitwise_or.reduce([place[c] << np.uint64(64 - bits * (i + 1)) for i, c in enumerate(columns)]))
            sizes = sum((c > 0).astype(int) for c in columns)
            for begin in range(0, len(order), ROWS):
                rows = order[begin:begin + ROWS]
                phrases, spots = [], []
                for length in np.unique(sizes[rows]).tolist():
                    own = rows[sizes[rows] == length]
                    parts = [words.take(pa.array(columns[i][own])) for i in range(length)]
                    phrases.append(pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if length > 1 else parts[0])
                    spots.append(np.flatnonzero(sizes[rows] == length))
                back = np.argsort(np.concatenate(spots), kind="stable")
                joined = pa.concat_arrays([p.combine_chunks() if isinstance(p, pa.ChunkedArray) else p for p in phrases])
                yield run_batch(langs.take(pa.array(columns[0][rows])), joined.take(pa.array(back)), counts[rows])

    def totals(self) -> pa.RecordBatch:
        """The number of words of each language, under the empty phrase."""
        return run_batch(pa.array(list(self.total), pa.string()), pa.array([b""] * len(self.total), pa.binary()),
                         np.array(list(self.total.values()), np.int64))


def run_batch(lang: pa.Array, phrase: pa.Array, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), pa.array(count, pa.int64())], names=["lang", "phrase", "f"])


def _runs(docs: DataFrame, lengths: range, words, pairs, hashed: bool = False) -> DataFrame:
    """Runs of partial counts of the phrases of the given lengths; one row for a phrase of a spilled subtree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(lengths, words and BitTable(words.value), pairs and BitTable(pairs.value), hashed)

        def whole(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            """Short texts together; of a long one, stretch after stretch with the last words carried over."""
            if sum(map(len, texts)) <= STRETCH or len(texts) > 1:
                yield from counter.count(lang, b".".join(texts))
                return
            carry = np.zeros(0, np.int64)
            for part in stretches(texts[0]):
                ids = counter.words.ids(lang, part)
                if lengths[0] == 1:
                    counter.total[lang] = counter.total.get(lang, 0) + int(np.count_nonzero(ids))
                ids = np.concatenate([carry, ids])
                yield from counter.phrases(ids, len(carry))
                carry = ids[-(MOST_WORDS - 1):]

        for batch, texts in slices(batches, "text", STRETCH):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), texts):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                yield from whole(lang, own)
            if counter.words.full():
                counter.words.reset()
                yield from counter.spill(1.0)
        yield from counter.spill(1.0)
        if counter.total:
            yield counter.totals()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "hash long, f long" if hashed else "lang string, phrase string, f long")


def _merged(runs: DataFrame, label: str, least: int) -> DataFrame:
    """(lang, phrase, f) of the phrases that reach the least count: the runs, written, then dealt out by ranges and summed."""
    spark, folder = runs.sparkSession, new_work_folder(runs.sparkSession, f"runs-{label}")
    # Hardly a phrase comes twice in a file: a dictionary of them would be built only to be thrown away.
    runs.write.option("parquet.enable.dictionary#phrase", "false").parquet(folder)
    dealt = spark.read.parquet(folder).repartitionByRange("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    counts = written(dealt.where((F.col("f") >= least) | (F.col("phrase") == "")), f"counts-{label}")
    removed(spark, folder)
    return counts


def frequent_pairs(docs: DataFrame, words, least: int) -> DataFrame:
    """Hashes of pairs, written: those of all pairs that reach the least count, and seldom another."""
    summed = _runs(docs, range(2, 3), words, None, hashed=True).repartition("hash").groupBy("hash").agg(F.sum("f").alias("f"))
    return written(summed.where(F.col("f") >= least).select("hash"), "pair-hashes")


def word_hashes(counts: DataFrame) -> DataFrame:
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [xxhash.xxh64_intdigest(lang.encode() + b"\0" + word.encode())
                     for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.uint64).view(np.int64))], names=["hash"])

    return counts.where("phrase <> ''").select("lang", "phrase").mapInArrow(hashes, "hash long")


def bit_table(hashes: DataFrame, entries: int) -> bytes:
    """The bit table of so many hashes: its size follows their number up to a fixed bound."""
    bits = 1 << min(TABLE_BITS.bit_length() - 1, max(16, (32 * entries).bit_length()))
    both = F.array("hash", F.shiftrightunsigned("hash", 32))
    cells = (
        hashes.select(F.explode(both).alias("part")).select(F.col("part").bitwiseAND(F.lit(bits - 1)).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("held"))
    ).toArrow()  # at most TABLE_BITS / 64 rows
    table = np.zeros(bits // 64, np.int64)
    table[cells["cell"].to_numpy()] = cells["held"].to_numpy()
    return table.astype("<i8").tobytes()


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f): all phrases of up to four words that occur at least so often, and the number of words of a
    language under the empty phrase."""
    context = docs.sparkSession.sparkContext
    words = _merged(_runs(docs, range(1, 2), None, None), "words", least)
    known = context.broadcast(bit_table(word_hashes(words), words.where("phrase <> ''").count()))
    pairs = frequent_pairs(docs, known, least)
    linked = context.broadcast(bit_table(pairs, pairs.count()))
    return words.unionByName(_merged(_runs(docs, range(2, MOST_WORDS + 1), known, linked), "phrases", least))


def collocations(docs: DataFrame, top: int | None = 2000, *, least: int = LEAST, covers: int = COVERS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases, all of them with ``top=None``.

    Of the ways to cut a phrase in two, the one of the lowest score counts (the first of equals); a phrase that lies in a
    longer one which occurs ``covers`` percent as often goes.
    """
    counts = phrase_counts(docs, least)
    totals = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    known = counts.where("phrase <> ''")
    candidates = known.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w")).where(F.size("w") > 1)
    cut = candidates.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                     F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"))
    part = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    scored = (
        cut.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
        .withColumn("score", F.expr(f"cast({SCALE} AS decimal(19, 0)) * a div (cast(l AS decimal(19, 0)) + r)"))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    size = F.size("w")
    inside = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    covering = (
        candidates.where(size > 2).select("lang", "a", F.explode(F.array_distinct(inside)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    )
    kept = scored.join(covering, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | F.expr(f"cast(longest AS decimal(19, 0)) * 100 < cast(a AS decimal(19, 0)) * {covers}"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(  # one row a language
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Exact merge-type (BPE) encoding and decoding with a SentencePiece vocabulary.

The encoding of a text is the only way to cut it into pieces such that every two adjacent pieces are
*compatible*: merging their joint text again from single characters, best score first, gives the same two
pieces.  So no merge queue over the text is needed.  A cursor walks forward with the longest vocabulary match
(Aho-Corasick); where a match is not compatible with the piece before, the next shorter prefix is tried; where
none is left, the position is marked as failed in a bitfield and the last piece is taken back.  Each position
fails at most once, so the walk is linear in the number of (position, prefix) pairs.

Texts are cut first where no piece can cross: before a blank run that follows other characters, and around
characters outside the vocabulary.  Encodings of such segments are kept in tables
that are bounded in bytes and emptied when the task ends.

Results: NULL counts as empty text; an empty text has the end id only.  Repeated rows are encoded each; other
columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mastlight.llm.common import let_go, slices

#: The mark that stands for a blank in pieces (fixed by the file format).
BLANK = "▁"
#: Kinds of pieces in the model file (fixed by the file format).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes, by estimate, of all tables of encodings that a task keeps, and the share of each.
KEPT_BYTES = 144 << 20
SHARES = {"pairs": 0.25, "words": 0.55, "segments": 0.05, "runs": 0.15}
#: Bytes of an entry: of a pair of pieces, of a word, and of another text, apart from their characters.
PAIR, WORD, ENTRY = 100, 150, 250


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field number and value of each entry of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            value: object = number()
        elif kind == 2:
            size = number()
            value = data[at : at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


class Kept(dict):
    """A table that computes what it misses, bounded in bytes; when half full, it becomes the old generation of a new one."""

    def __init__(self, compute: Callable, limit: float):
        super().__init__()
        self.compute, self.limit, self.held, self.old = compute, limit / 2, 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        size = (PAIR if isinstance(key, int) else WORD + len(key) + len(value) if isinstance(value, str)
                else ENTRY + len(key) + len(value[0]) + len(value[1]))
        if self.held + size > self.limit:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        self.held += size
        return value

    def forget(self) -> None:
        self.clear()
        self.held, self.old = 0, {}


class Vocabulary:
    """Pieces, scores and kinds of a merge-type model file with the identity normaliser."""

    def __init__(self, data: bytes):
        import struct

        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.dummy_prefix, self.byte_fallback, self.eos = True, False, 2
        for field, value in _fields(data):
            if field == 1:
                piece, score, kind = "", 0.0, NORMAL
                for inner, x in _fields(value):
                    if inner == 1:
                        piece = x.decode()
                    elif inner == 2:
                        score = struct.unpack("<f", x)[0]
                    elif inner == 3:
                        kind = x
                self.pieces.append(piece)
                self.scores.append(score)
                self.kinds.append(kind)
            elif field == 2:
                settings = dict(_fields(value))
                if settings.get(3, 1) != 2:
                    raise ValueError("the model is not of the merge type")
                self.byte_fallback = bool(settings.get(35, 0))
                self.eos = settings.get(42, 2)
            elif field == 3:
                settings = dict(_fields(value))
                if settings.get(1, b"") != b"identity" or settings.get(2, b"") or settings.get(4, 1):
                    raise ValueError("only models with the identity normaliser that keep blanks are read")
                self.dummy_prefix = bool(settings.get(3, 1))
        if USER in self.kinds:
            raise ValueError("user-defined pieces are not supported")
        self.unknown = self.kinds.index(UNKNOWN)
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.crossing = any(BLANK in p.lstrip(BLANK) for p in self.ids)


class PieceCodec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, model: bytes):
        self.vocabulary = v = Vocabulary(model)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in v.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.lengths = [len(p) for p in v.pieces]
        self.decimal = [f"{i} " for i in range(len(v.pieces))]
        self.rank = {p: -v.scores[i] for p, i in v.ids.items()}
        self.known = {p for p in v.ids if len(p) == 1}
        #: Neighbouring characters that some piece holds; between others no merge can cross.
        self.neighbours = {pair for p in v.ids for pair in zip(p, p[1:])}
        # For each piece, the longest other piece that is a prefix of it: the chain of shorter matches.
        self.shorter = [-1] * len(v.pieces)
        for piece, i in v.ids.items():
            self.shorter[i] = next((v.ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in v.ids), -1)
        self.whole: dict[int, bool] = {}  # a flag a piece at most
        self.pairs, self.words, self.segments, self.runs = (
            Kept(compute, KEPT_BYTES * SHARES[name]) for name, compute in (
                ("pairs", self.compatible), ("words", self.word), ("segments", self.segment), ("runs", self.run)))
        self.cutter = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+").findall

    def merged(self, text: str) -> list[str]:
        """Best-score-first, leftmost-first merging from single characters; used on pieces and pairs of pieces only."""
        parts, rank, never = list(text), self.rank, float("inf")
        costs = [rank.get(a + b, never) for a, b in zip(parts, parts[1:])]
        while costs:
            best = min(costs)
            if best == never:
                break
            i = costs.index(best)
            parts[i] += parts.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = rank.get(parts[i] + parts[i + 1], never)
            if i:
                costs[i - 1] = rank.get(parts[i - 1] + parts[i], never)
        return parts

    def compatible(self, pair: int) -> bool:
        """Whether merging the joint text of two pieces (numbered in one number) again gives these two."""
        first, second = divmod(pair, len(self.lengths))
        a, b = self.vocabulary.pieces[first], self.vocabulary.pieces[second]
        return self.merged(a + b) == [a, b]

    def reachable(self, piece: int) -> bool:
        known = self.whole.get(piece)
        if known is None:
            text = self.vocabulary.pieces[piece]
            known = self.whole[piece] = self.merged(text) == [text]
        return known

    def forget(self) -> None:
        """Empty the tables: what a task has kept ends with it."""
        for table in (self.pairs, self.words, self.segments, self.runs):
            table.forget()

    def backtrack(self, text: str) -> list[int]:
        """Encode characters that are all in the vocabulary."""
        lengths, shorter, pairs, many = self.lengths, self.shorter, self.pairs, len(self.lengths)
        found = [-1] * len(text)
        for end, piece in self.automaton.iter(text):
            found[end + 1 - lengths[piece]] = piece  # a later end is a longer match
        out: list[int] = []
        at, size, end = 0, len(text), 0
        failed = bytearray(size + 1)
        piece = found[0]
        while True:
            # The longest match here that may follow the last piece and does not end where all ways fail.
            while piece >= 0:
                end = at + lengths[piece]
                if not failed[end] and (pairs[out[-1] * many + piece] if out else self.reachable(piece)):
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at = end
                if at == size:
                    return out
                piece = found[at]
            else:
                failed[at] = 1
                if not out:
                    raise AssertionError(f"no encoding for {text!r}")
                last = out.pop()
                at -= lengths[last]
                piece = shorter[last]

    def segment_runs(self, segment: str) -> list[str]:
        """Cut a segment between neighbours that no piece holds; characters outside the vocabulary stand alone."""
        if self.vocabulary.crossing and BLANK in segment:
            return [segment]
        neighbours = self.neighbours
        cuts = [i for i, pair in enumerate(zip(segment, segment[1:]), 1) if pair not in neighbours]
        return [segment[a:b] for a, b in zip([0, *cuts], [*cuts, len(segment)])]

    def segment_ids(self, segment: str) -> list[int]:
        """Ids of one segment; characters outside the vocabulary become bytes (or the unknown id)."""
        v, out = self.vocabulary, []
        for run in self.segment_runs(segment):
            if run[0] in self.known:
                out += self.backtrack(run)
            else:
                out += [v.bytes[b] for b in run.encode()] if v.byte_fallback else [v.unknown]
        return out

    def cuts(self, text: str) -> list[str]:
        """The segments of a text: blanks and the other characters after them, as no piece crosses from
        another character to a blank.  The blank put before a text belongs to the first."""
        if not text:
            return []
        text = text.replace(" ", BLANK)
        if self.vocabulary.dummy_prefix:
            text = BLANK + text
        return [text] if self.vocabulary.crossing else self.cutter(text)

    def encode(self, text: str) -> list[int]:
        """All ids, the end id last."""
        return [i for s in self.cuts(text) for i in self.segment_ids(s)] + [self.vocabulary.eos]

    def piece_text(self, ids: Iterable[int]) -> str:
        """Text of a run of ids, blanks still marked; byte ids that form no character become replacement marks."""
        v, out, raw = self.vocabulary, [], bytearray()
        for i in [*ids, -1]:
            if i >= 0 and v.kinds[i] == BYTE:
                raw.append(int(v.pieces[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i >= 0 and v.kinds[i] == NORMAL:
                out.append(v.pieces[i])
            elif i == v.unknown:
                out.append(" ⁇ ")
        return "".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; control ids have none, the blank put before the text goes."""
        text = self.piece_text(ids).replace(BLANK, " ")
        return text[1:] if self.vocabulary.dummy_prefix and text.startswith(" ") else text

    def run(self, run: str) -> tuple[str, str]:
        ids = self.backtrack(run) if run[0] in self.known else self.segment_ids(run)
        return "".join([self.decimal[i] for i in ids]), self.piece_text(ids)

    def segment(self, segment: str) -> tuple[str, str]:
        """Of a segment: its ids in decimal (each followed by a blank), and the text they decode to."""
        rows = [self.runs[run] for run in self.segment_runs(segment)]
        return "".join([r[0] for r in rows]), "".join([r[1] for r in rows]).replace(BLANK, " ")

    def word(self, word: str) -> str:
        """Ids in decimal of a word after one blank; empty if they do not decode to just that."""
        if word.isalpha() and self.known.issuperset(word):
            marked, pieces, decimal = BLANK + word, self.vocabulary.pieces, self.decimal
            ids = self.backtrack(marked)  # letters: hardly ever a cut, and none is needed
            # Plain pieces decode to themselves.
            return "".join([decimal[i] for i in ids]) if "".join([pieces[i] for i in ids]) == marked else ""
        decimals, decoded = self.segment(BLANK + word)
        return decimals if decoded == " " + word else ""

    def both(self, text: str) -> tuple[str, int, str]:
        """Decimal ids joined by blanks, their count, and the decoded text."""
        v, end = self.vocabulary, str(self.vocabulary.eos)
        if not text:
            return end, 1, ""
        marked = text.replace(" ", BLANK)
        if v.dummy_prefix and not v.crossing and BLANK * 2 not in marked and marked[0] != BLANK and marked[-1] != BLANK:
            words = list(map(self.words.__getitem__, marked.split(BLANK)))
            if "" not in words:  # every word decodes to itself, so the text does
                ids = "".join(words)
                return ids + end, ids.count(" ") + 1, marked.replace(BLANK, " ")
        ids, decoded = map("".join, zip(*map(self.segments.__getitem__, self.cuts(text))))
        if v.dummy_prefix and decoded.startswith(" "):
            decoded = decoded[1:]
        return ids + end, ids.count(" ") + 1, decoded


@lru_cache(maxsize=1)
def codec_of(model: bytes) -> PieceCodec:
    """One codec per worker process: the vocabulary stays, the tables are emptied when a task ends."""
    return PieceCodec(model)


def codec_bytes(path: str) -> bytes:
    """The model file; its size is that of a vocabulary, whatever the data."""
    with open(path, "rb") as file:
        return file.read()


def encode_decode(docs: DataFrame, model: Broadcast, text: str = "text", *, digests: bool = False) -> DataFrame:
    """Encode and decode every text; works batch by batch with no shuffle.

    Adds ``piece_ids`` (array), ``n_pieces`` and ``decoded`` to the columns of ``docs``, whose own columns of these
    names win no clash (they are replaced).  With ``digests`` the ids and the decoded text come as SHA-256 hex
    strings, ``ids_sha256`` and ``decoded_sha256``, instead.
    """
    added = (
        [T.StructField("n_pieces", T.LongType()), T.StructField("ids_sha256", T.StringType()),
         T.StructField("decoded_sha256", T.StringType())]
        if digests else
        [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
         T.StructField("decoded", T.StringType())]
    )
    names = {f.name for f in added}
    kept = docs.drop(*[c for c in docs.columns if c in names])
    schema = T.StructType(list(kept.schema.fields) + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model.value)
        try:
            yield from encoded(codec, batches)
        finally:
            codec.forget()
            let_go()

    def encoded(codec: PieceCodec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            rows = [codec.both(t.decode("utf-8", "replace")) for t in texts]
            counts = pa.array([r[1] for r in rows], pa.int64())
            if digests:
                new = [counts, pa.array([hashlib.sha256(r[0].encode()).hexdigest() for r in rows], pa.string()),
                       pa.array([hashlib.sha256(r[2].encode()).hexdigest() for r in rows], pa.string())]
            else:
                new = [pa.array([list(map(int, r[0].split())) for r in rows], pa.list_(pa.int32())), counts,
                       pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)

"""SentencePiece encoding by suffix-array matching, and decoding.

The model's pieces merge by score (byte-pair encoding). No piece goes from a non-space to a space, so
the runs of spaces with what follows them up to the next space are encoded on their own, and each
different one of a batch once. These units are laid end to end and indexed by a suffix array; the
range of suffixes that begin with a piece is found by binary search, for all pieces at once. Every
occurrence is an edge. Edges are sorted by where they end in their unit and relaxed in that order: of
the pieces that end at a place exactly one can be last in the encoding of what stands before it, the
one whose pair with the last piece before is not merged otherwise. Whether two pieces stay side by side
depends on these two alone, is worked out by merging their characters, and is remembered.

Characters that no piece holds become their UTF-8 bytes. Decoding puts bytes together again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

SPACE = "▁"
BETWEEN = "\x00"
# Characters of texts that a task encodes at a time, and units and pairs that it remembers.
CHARS = 1 << 20
UNITS = 1 << 19
PAIRS = 1 << 19
NEVER = float("-inf")
# Bits of the table that tells which runs of three characters a text has.
TRIPLES = 22
MODEL = "piece_bpe_32k.model"


@dataclass
class Vocabulary:
    """The pieces of a byte-pair model with byte fallback and no normalisation but a leading space."""

    names: list[str]
    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    whole: dict[str, int] = field(default_factory=dict)
    longest: int = 1
    alone: str = ""

    @staticmethod
    def load(path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [
            i for i in range(len(names))
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        vocabulary = Vocabulary(
            names, {names[i]: model.get_score(i) for i in plain}, {names[i]: i for i in plain}, byte_ids
        )
        if any(SPACE in name.lstrip(SPACE) for name in vocabulary.ids):
            raise ValueError("pieces that go on over a space are not supported")
        # Only pieces that are their own encoding are ever part of one.
        vocabulary.whole = {name: i for name, i in vocabulary.ids.items() if vocabulary.merges(name)[0] == [name]}
        vocabulary.longest = max(map(len, vocabulary.whole))
        joined = {c for name in vocabulary.ids if len(name) > 1 for c in name}
        vocabulary.alone = "".join(c for c in map(chr, range(1, 128)) if c not in joined and c != " ")
        return vocabulary

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The encoding of a short text by repeated merges of the best, then leftmost pair; and each
        merge's score with the first and the last part after it."""
        parts, scores, steps = list(text), self.scores, []
        while len(parts) > 1:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1], NEVER)
                if score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
        return parts, steps


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Where the suffixes of ``text`` start, sorted by their first ``depth`` characters at least."""
    n = len(text)
    order = np.argsort(text)
    rank = np.zeros(n, dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], text[order[1:]] != text[order[:-1]])))
    known = 1
    while known < depth and known < n:
        later = np.zeros(n, dtype=np.int64)
        later[: n - known] = rank[known:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key)
        ranked = key[order]
        rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
        known *= 2
    return order


def ranges(text: np.ndarray, suffixes: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each piece (rows of characters, padded with zeros) the range of ``suffixes`` that begin with it."""
    depth = pieces.shape[1]
    padded = np.concatenate([text, np.zeros(depth, dtype=text.dtype)])
    length = (pieces > 0).sum(axis=1)
    rows = np.arange(len(pieces))

    def bound(after: bool) -> np.ndarray:
        low, high = np.zeros(len(pieces), dtype=np.int64), np.full(len(pieces), len(suffixes), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            there = padded[suffixes[middle][:, None] + np.arange(depth)]
            differ = (there != pieces[open_]) & (np.arange(depth) < length[open_, None])
            first = differ.argmax(axis=1)
            some = differ.any(axis=1)
            here = rows[: len(open_)]
            smaller = np.where(some, there[here, first] < pieces[open_, first], after)
            low[open_[smaller]] = middle[smaller] + 1
            high[open_[~smaller]] = middle[~smaller]

    return bound(False), bound(True)


def triples(text: np.ndarray) -> np.ndarray:
    """A number below ``2**TRIPLES`` for every three characters in a row (along the last axis)."""
    wide = text.astype(np.uint64)
    mixed = (wide[..., :-2] * np.uint64(0x9E3779B97F4A7C15) + wide[..., 1:-1]) * np.uint64(0x9E3779B97F4A7C15) + wide[..., 2:]
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TRIPLES)).astype(np.int64)


class Stays(dict):
    """Whether two pieces, as one number, stay side by side; works out and remembers what it is asked for."""

    def __init__(self, found) -> None:
        self.found = found

    def __missing__(self, pair: int) -> bool:
        value = self[pair] = self.found(pair)
        return value


class Encoder:
    """Encodes texts, remembering the units and pairs that it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.names = vocabulary.names
        self.piece_ids = np.array(list(vocabulary.whole.values()), dtype=np.int64)
        self.pieces = np.zeros((len(vocabulary.whole), vocabulary.longest), dtype=np.uint32)
        for i, name in enumerate(vocabulary.whole):
            self.pieces[i, : len(name)] = [ord(c) for c in name]
        self.lengths = (self.pieces > 0).sum(axis=1)
        # Where a piece has no three characters left, the first three stand for them; short ones have none.
        inside = np.arange(self.pieces.shape[1] - 2) + 3 <= self.lengths[:, None]
        self.triples = np.where(inside, triples(self.pieces), triples(self.pieces)[:, :1])
        self.short = self.lengths < 3
        alone = re.escape(vocabulary.alone)
        rest = f"[^{SPACE}{alone}]"
        self.cut = re.compile(f"{SPACE}+{rest}*|{rest}+|[{alone}]" if alone else f"{SPACE}+{rest}*|{rest}+")
        # A character that is no piece is an edge of its own, beyond all pieces.
        self.other = len(self.names)
        self.start = self.other + 1
        self.forget()

    def forget(self) -> None:
        self.steps: dict[str, list[tuple[float, str, str]]] = {}
        self.units: dict[str, int] = {}
        self.stay = Stays(self._stays)
        self.first = np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def _stays(self, pair: int) -> bool:
        left, right = divmod(pair, self.start + 1)
        return left >= self.other or right >= self.other or self._apart(self.names[left], self.names[right])

    def _steps(self, name: str) -> list[tuple[float, str, str]]:
        steps = self.steps.get(name)
        if steps is None:
            steps = self.steps[name] = self.vocabulary.merges(name)[1]
        return steps

    def _apart(self, a: str, b: str) -> bool:
        """Merges the characters of two whole pieces, the best pair first and the left one of equals,
        until a pair across their border is next."""
        first, second, scores = self._steps(a), self._steps(b), self.vocabulary.scores
        i = j = 0
        last, head = a[-1], b[0]
        while True:
            left = first[i][0] if i < len(first) else NEVER
            right = second[j][0] if j < len(second) else NEVER
            across = scores.get(last + head, NEVER)
            if across > left and across >= right and across > NEVER:
                return False
            if left == right == NEVER:
                return True
            if left >= right:
                last, i = first[i][2], i + 1
            else:
                head, j = second[j][1], j + 1

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.units) > UNITS or len(self.stay) > PAIRS:
            self.forget()
        found = [self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        fresh = set().union(*found) - self.units.keys()
        if fresh:
            self._learn(sorted(fresh))
        out = []
        for units in found:
            at = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
            start, size = self.first[at], self.first[at + 1] - self.first[at]
            inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            out.append(self.flat[np.repeat(start, size) + inside])
        return out

    def _learn(self, units: list[str]) -> None:
        whole = BETWEEN.join(units)
        text = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
        size = np.fromiter(map(len, units), np.int64, len(units))
        begin = np.cumsum(size + 1) - (size + 1)
        unit = np.repeat(np.arange(len(units)), size + 1)[: len(text)]
        place = np.arange(len(text)) - begin[unit]

        suffixes = suffix_array(text, self.vocabulary.longest)
        # A piece with a character that is nowhere in the text need not be looked for.
        there = np.zeros(max(int(text.max()), int(self.pieces.max())) + 1, dtype=bool)
        there[text] = there[0] = True
        some = there[self.pieces].all(axis=1)
        # Nor one with three characters in a row that are nowhere.
        met = np.zeros(1 << TRIPLES, dtype=bool)
        met[triples(text)] = True
        some &= self.short | met[self.triples].all(axis=1)
        low, high = ranges(text, suffixes, self.pieces[some])
        times = high - low
        inside = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        start = suffixes[np.repeat(low, times) + inside]
        piece = np.repeat(self.piece_ids[some], times)
        length = np.repeat(self.lengths[some], times)
        covered = np.zeros(len(text), dtype=bool)
        covered[start[length == 1]] = True
        bare = np.flatnonzero(~covered & (text != 0) | (text == 0) & (place < size[unit]))
        start = np.concatenate([start, bare])
        piece = np.concatenate([piece, np.full(len(bare), self.other)])
        length = np.concatenate([length, np.ones(len(bare), dtype=np.int64)])

        end = place[start] + length
        # Short ends sort by radix.
        order = np.argsort(end.astype(np.uint16) if end.max(initial=0) < 1 << 16 else end, kind="stable")
        start, piece, length, end = start[order], piece[order], length[order], end[order]
        # ``last[i]`` is the last piece of the encoding of the unit up to before character ``i``; the
        # separator after a unit stands for its end.
        last, back = np.full(len(text) + 1, -1, dtype=np.int64), np.zeros(len(text) + 1, dtype=np.int64)
        last[begin] = self.start
        steps = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1]))) if len(end) else np.zeros(0, dtype=np.int64)
        for a, b in zip(steps, np.append(steps[1:], len(end)), strict=True):
            s, p, n = start[a:b], piece[a:b], length[a:b]
            reached = last[s] >= 0
            s, p, n = s[reached], p[reached], n[reached]
            pairs, which = np.unique(last[s] * (self.start + 1) + p, return_inverse=True)
            good = np.fromiter(map(self.stay.__getitem__, pairs.tolist()), bool, len(pairs))[which]
            last[s[good] + n[good]], back[s[good] + n[good]] = p[good], s[good]

        at, who, tokens, owners, turns, turn = begin + size, np.arange(len(units)), [], [], [], 0
        while len(who):
            tokens.append(np.stack([last[at], back[at]]))
            owners.append(who)
            turns.append(np.full(len(who), -turn))
            at, turn = back[at], turn + 1
            more = at > begin[who]
            at, who = at[more], who[more]
        token, owner, turn_of = np.concatenate(tokens, axis=1), np.concatenate(owners), np.concatenate(turns)
        order = np.lexsort((turn_of, owner))
        token, owner = token[:, order], owner[order]
        # Characters that are no piece give their bytes.
        bare = token[0] == self.other
        spelt = {c: chr(c).encode("utf-8", "surrogatepass") for c in np.unique(text[token[1][bare]]).tolist()}
        many = np.ones(len(owner), dtype=np.int64)
        many[bare] = [len(spelt[c]) for c in text[token[1][bare]].tolist()]
        ids = np.repeat(token[0], many)
        if bare.any():
            values = [self.vocabulary.byte_ids[b] for c in text[token[1][bare]].tolist() for b in spelt[c]]
            ids[np.repeat(bare, many)] = values
        counts = np.bincount(owner, weights=many, minlength=len(units)).astype(np.int64)
        known = len(self.units)
        self.units.update(zip(units, range(known, known + len(units)), strict=True))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.raw = [name.replace(SPACE, " ").encode() if name in vocabulary.ids else b"" for name in vocabulary.names]
        for value, i in enumerate(vocabulary.byte_ids):
            self.raw[i] = bytes([value])

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD, the leading space goes."""
        data = b"".join(map(self.raw.__getitem__, ids))
        text = data.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHARS`` characters together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encoded(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts, nulls and empty texts having none. Rows may repeat; an empty
    table stays empty; a column of the name of ``ids_col`` is replaced."""
    vocabulary = Vocabulary.load(model)
    kept = docs.drop(ids_col)
    names = [*kept.columns, ids_col]
    place = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for a, b in _groups(texts):
                ids = pa.array(encoder.encode(texts[a:b]), pa.list_(pa.int32()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=names)

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(ids_col, ArrayType(IntegerType()))]))


def decoded(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of its ids; null ids give null."""
    vocabulary = Vocabulary.load(model)
    kept = rows.drop(text_col)
    names = [*kept.columns, text_col]
    place = kept.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            ids = batch.column(place)
            texts = []
            for i in range(batch.num_rows):
                value = ids[i].values
                texts.append(None if value is None else decoder.decode(value.to_numpy().tolist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(text_col, StringType())]))


def piece_counts(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, the columns to ``keep``, ``n_pieces, ids_sha256, round_trip, ids``: one row per row of ``docs``, which may
    repeat; an empty table gives none. Texts are encoded and decoded whole, however long. The digest is of the ids as 4-byte numbers, the lowest byte first. A text comes back as it was, but for
    U+2581, which is how the model writes a space, and null, which comes back empty."""
    vocabulary = Vocabulary.load(model)
    text = F.col(text_col).cast("string").alias("_text")
    narrow = docs.select(F.col(id_col).alias("doc_id"), *keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Both ways in one task, so that ids need not come back to be decoded.
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in _groups(texts):
                ids = encoder.encode(texts[a:b])
                digests = [hashlib.sha256(some.astype("<i4").tobytes()).hexdigest() for some in ids]
                same = [
                    decoder.decode(some.tolist()) == (text or "").replace(SPACE, " ")
                    for some, text in zip(ids, texts[a:b], strict=True)
                ]
                counts = pa.array([len(some) for some in ids], pa.int64())
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else [], pa.int32()))
                kept = batch.slice(a, b - a).columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, counts, pa.array(digests), pa.array(same), lists], names=names)

    schema = StructType(
        [
            *narrow.schema.fields[:-1],
            StructField("n_pieces", LongType()),
            StructField("ids_sha256", StringType()),
            StructField("round_trip", BooleanType()),
            StructField("ids", ArrayType(IntegerType())),
        ]
    )
    names = schema.names
    return narrow.mapInArrow(run, schema)

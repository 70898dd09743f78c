"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut where no piece of the vocabulary can span the cut; each part is encoded by an
agenda: all adjacent symbol pairs that form a piece wait in a heap ordered by score, then by
place, and the best pair is merged until none is left. New parts of one length keep their
agendas side by side in arrays, and each round takes the best pair of each. Parts repeat a lot, so each task keeps
those it has met, in bounded memory; each new part is checked against the sentencepiece library, batch by batch,
and a difference fails the task.

Defined cases: a null text is the empty text, which has no ids and decodes to the empty text.
Rows that repeat are encoded alike; an empty table gives an empty result; other columns are
passed on or ignored as the caller asks.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from tallybook.llm.text import releasing

#: Parts that a worker remembers in each of two generations, and the longest one worth it.
MEMORY_PARTS = 250_000
MEMORY_LENGTH = 48
#: Parts up to this length are encoded together with others of their length.
TOGETHER = 64

#: Texts encoded at once.
STEP = 200

_SPACE = "▁"


class Vocabulary:
    """Pieces, scores and byte pieces of a model with an identity normalizer."""

    def __init__(self, path: str) -> None:
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            data = file.read()
        model.ParseFromString(data)
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("only merge-type models with byte fallback are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces):
            raise ValueError("only models with an identity normalizer and a leading space are supported")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.rank: dict[str, tuple[float, int]] = {}
        self.bytes: dict[int, int] = {}
        self.shown: list[str | int] = []
        for number, piece in enumerate(model.pieces):
            shown: str | int = piece.piece.replace(_SPACE, " ")
            if piece.type == kinds.NORMAL:
                self.rank[piece.piece] = (-piece.score, number)
            elif piece.type == kinds.BYTE:
                shown = int(piece.piece[3:5], 16)
                self.bytes[shown] = number
            elif piece.type in (kinds.USER_DEFINED, kinds.UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
            else:
                shown = "" if piece.type == kinds.CONTROL else " ⁇ "
            self.shown.append(shown)
        if any(re.search(f"[^{_SPACE}]{_SPACE}|.\n|\n.", p, re.S) for p in self.rank):
            raise ValueError("a piece spans a space or a line end, so texts can't be cut there")
        self.names = [str(n) for n in range(len(self.shown))]
        self.plain = {n for _, n in self.rank.values()}
        # A checked part follows this one, from which no piece reaches into it.
        self.lead = self.library.encode("a")

    def encode_part(self, part: str) -> list[int]:
        """Ids of one part by an agenda of adjacent pairs, the best score and leftmost first."""
        rank = self.rank
        symbols: list[str] = list(part)
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        agenda = []
        for i in range(size - 1):
            found = rank.get(symbols[i] + symbols[i + 1])
            if found:
                agenda.append((found[0], i, symbols[i] + symbols[i + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, left, joined = heapq.heappop(agenda)
            right = after[left]
            # The pair is stale if either side was merged meanwhile.
            if not symbols[left] or right >= size or symbols[left] + symbols[right] != joined:
                continue
            symbols[left], symbols[right] = joined, ""
            follower = after[left] = after[right]
            if follower < size:
                before[follower] = left
                pair = joined + symbols[follower]
                found = rank.get(pair)
                if found:
                    heapq.heappush(agenda, (found[0], left, pair))
            leader = before[left]
            if leader >= 0:
                pair = symbols[leader] + joined
                found = rank.get(pair)
                if found:
                    heapq.heappush(agenda, (found[0], leader, pair))
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                found = rank.get(symbol)
                if found:
                    ids.append(found[1])
                else:
                    ids.extend(self.bytes[b] for b in symbol.encode())
        return ids

    @functools.cached_property
    def _pairs(self) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of pieces, sorted keys of pairs that form a piece, and per pair its piece and rank."""
        number = {piece: n for piece, (_, n) in self.rank.items()}
        size = len(self.shown)
        found = [
            (number[piece[:cut]] * size + number[piece[cut:]], n, self.rank[piece][0])
            for piece, n in number.items()
            for cut in range(1, len(piece))
            if piece[:cut] in number and piece[cut:] in number
        ]
        found.sort()
        keys, pieces, ranks = (np.array([f[i] for f in found]) for i in range(3))
        return number, np.append(keys, np.iinfo(np.int64).max), np.append(pieces, 0), np.append(ranks, np.inf)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (infinite if there is none) and number of the piece that each pair forms."""
        _, keys, pieces, ranks = self._pairs
        key = left.astype(np.int64) * len(self.shown) + right
        at = np.searchsorted(keys, key)
        return np.where(keys[at] == key, ranks[at], np.inf), pieces[at]

    def encode_parts(self, parts: list[str]) -> list[list[int]]:
        """Ids of many parts. Parts of one length go through the agenda together: in each round the
        best pair of every part, the leftmost one of equals, is merged."""
        number = self._pairs[0]
        out: list[list[int] | None] = [None] * len(parts)
        lengths: dict[int, list[int]] = {}
        for at, part in enumerate(parts):
            if len(part) <= TOGETHER and all(map(number.__contains__, part)):
                lengths.setdefault(len(part), []).append(at)
            else:
                out[at] = self.encode_part(part)
        for length, places in lengths.items():
            symbols = np.array([number[c] for at in places for c in parts[at]], dtype=np.int32).reshape(-1, length)
            sizes = np.full(len(places), length)
            final = symbols.copy()
            rows = np.arange(len(places))
            rank, piece = self._look_up(symbols[:, :-1], symbols[:, 1:])
            while symbols.shape[1] > 1:
                best = rank.argmin(axis=1)
                every = np.arange(len(rows))
                merging = np.isfinite(rank[every, best])
                final[rows[~merging], : symbols.shape[1]] = symbols[~merging]
                rows, best = rows[merging], best[merging]
                if not len(rows):
                    break
                symbols, rank, piece = symbols[merging], rank[merging], piece[merging]
                every = np.arange(len(rows))
                symbols[every, best] = piece[every, best]
                # Close the gap of the right symbol, and of its pair.
                place = np.arange(symbols.shape[1] - 1)
                symbols = np.take_along_axis(symbols, place + (place > best[:, None]), axis=1)
                sizes[rows] -= 1
                place = place[:-1]
                if not len(place):
                    rank = rank[:, :0]
                    break
                rank = np.take_along_axis(rank, place + (place >= best[:, None]), axis=1)
                piece = np.take_along_axis(piece, place + (place >= best[:, None]), axis=1)
                for near in (best - 1, best):
                    some = np.flatnonzero((near >= 0) & (near < len(place)))
                    where = near[some]
                    rank[some, where], piece[some, where] = self._look_up(symbols[some, where], symbols[some, where + 1])
            if len(rows):
                final[rows, : symbols.shape[1]] = symbols
            for at, row, size in zip(places, final.tolist(), sizes.tolist()):
                out[at] = row[:size]
        return out

    def decode(self, ids: list[int], at_start: bool = True) -> str:
        """Text of ids; runs of byte pieces are UTF-8, and the leading space is dropped."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            shown = self.shown[i]
            if isinstance(shown, int):
                run.append(shown)
                continue
            if run:
                out.append(_from_bytes(run))
                run = bytearray()
            out.append(shown)
        if run:
            out.append(_from_bytes(run))
        text = "".join(out)
        return text[1:] if at_start and ids and str(self.shown[ids[0]]).startswith(" ") else text

    def check(self, parts: list[str], ids: list[list[int]]) -> None:
        """Compare with the library, which sees each part after a lead it can't merge with."""
        spaced = [p[0] == _SPACE for p in parts]
        asked = [p[1:] if s else "a" + p for p, s in zip(parts, spaced)]
        for part, own, theirs, s in zip(parts, ids, self.library.encode(asked, num_threads=1), spaced):
            # The library encodes an empty text as nothing, and a lone space as two.
            if part == _SPACE:
                continue
            if own != (theirs if s else theirs[len(self.lead) :]):
                raise ValueError(f"encoding of {part[:80]!r} differs from the library's")


def _from_bytes(run: bytearray) -> str:
    """Bytes as UTF-8, each byte of an invalid sequence as one replacement character."""
    out = []
    data = bytes(run)
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[: error.start].decode() + "�")
            data = data[error.start + 1 :]
    return "".join(out)


_PARTS = re.compile(f"\n|{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+")


def parts_of(text: str) -> list[str]:
    """Cut a text, with its leading space, before spaces that follow something else and at line ends."""
    if not text:
        return []
    if "  " in text or text[0] == " " or _SPACE in text:
        return _PARTS.findall(_SPACE + text.replace(" ", _SPACE))
    return (_SPACE + text.replace(" ", " " + _SPACE).replace("\n", " \n")).split(" ")


class Encoder:
    """A vocabulary with the parts met so far, each with its ids joined by commas.

    Parts decode to themselves, with blanks for the marked spaces; any that should not is kept
    apart, with what it decodes to.
    """

    def __init__(self, path: str, memory_parts: int | None = None) -> None:
        self.vocabulary = Vocabulary(path)
        self.memory_parts = memory_parts or MEMORY_PARTS
        self.recent: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.odd: dict[str, str] = {}

    def learn(self, parts: set[str]) -> dict[str, str]:
        """Encode the parts that aren't remembered; those too long to keep are returned."""
        passing: dict[str, str] = {}
        new = []
        for part in parts:
            held = self.older.get(part)
            if held:
                self.recent[part] = held
            else:
                new.append(part)
        ids = self.vocabulary.encode_parts(new)
        if new:
            self.vocabulary.check(new, ids)
        names, plain = self.vocabulary.names, self.vocabulary.plain
        for part, own in zip(new, ids):
            (self.recent if len(part) <= MEMORY_LENGTH else passing)[part] = ",".join([names[i] for i in own])
            # Plain pieces are what was joined to form them.
            if not plain.issuperset(own):
                decoded = self.vocabulary.decode(own, at_start=False)
                if decoded != part.replace(_SPACE, " "):
                    self.odd[part] = decoded
        return passing

    def forget(self) -> None:
        """Drop what was met: the next task of this worker may be another operator's, with its own needs."""
        self.recent, self.older, self.odd = {}, {}, {}

    def turn(self) -> None:
        """Bound the memory: start a new generation when the recent one is full."""
        if len(self.recent) > self.memory_parts:
            self.older, self.recent = self.recent, {}
            self.odd = {p: d for p, d in self.odd.items() if p in self.older}

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids joined by commas, decoded text) of each text."""
        cut = [parts_of(t) for t in texts]
        unknown = {p for parts in cut for p in parts if p not in self.recent}
        passing = self.learn(unknown) if unknown else {}
        recent, odd, out = self.recent, self.odd, []
        for parts in cut:
            ids = [recent.get(p) or passing[p] for p in parts] if passing else [recent[p] for p in parts]
            if odd:
                decoded = "".join([odd.get(p) or p.replace(_SPACE, " ") for p in parts])
            else:
                decoded = "".join(parts).replace(_SPACE, " ")
            out.append((",".join(ids), decoded[1:] if parts and parts[0][0] == _SPACE else decoded))
        self.turn()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for the model file, which every machine has."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_texts(
    docs: DataFrame, model_path: str, text_column: str = "text", digests: bool = False, memory_parts: int = MEMORY_PARTS
) -> DataFrame:
    """Replace the text by `piece_ids` (array of int) and `decoded`, or by their digests.

    The digests are n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256; they keep long arrays out of the result where nobody reads them. A task
    remembers up to twice `memory_parts` parts, at some 220 bytes each; fewer cost time only.
    """
    from pyspark.sql.types import ArrayType, IntegerType

    passed = [c for c in docs.columns if c != text_column]
    schema = docs.drop(text_column).schema
    if digests:
        schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    else:
        schema = schema.add("piece_ids", ArrayType(IntegerType())).add("decoded", "string")

    def encoded(batches):
        own = encoder(model_path)
        own.memory_parts = memory_parts
        try:
            for batch in batches:
                for begin in range(0, batch.num_rows, STEP):
                    rows = batch.slice(begin, STEP)
                    results = own.encode([t or "" for t in rows.column(text_column).to_pylist()])
                    if digests:
                        made = [
                            pa.array([i.count(",") + 1 if i else 0 for i, _ in results], pa.int64()),
                            pa.array([hashlib.sha256(i.encode()).hexdigest() for i, _ in results], pa.string()),
                            pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in results], pa.string()),
                        ]
                    else:
                        made = [
                            pa.array([list(map(int, i.split(","))) if i else [] for i, _ in results], pa.list_(pa.int32())),
                            pa.array([d for _, d in results], pa.string()),
                        ]
                    yield pa.RecordBatch.from_arrays([rows.column(c) for c in passed] + made, names=schema.names)
        finally:
            own.forget()

    return docs.mapInArrow(releasing(encoded), schema)

"""SentencePiece encoding of the merge (BPE) kind, exactly, by backtracking, and decoding.

The library merges the best-scored adjacent pair, leftmost first, until no pair of symbols
is a piece. A sequence of pieces is that result just when each two neighbours are, merged
again from their characters, themselves. So the encoder takes the longest piece found by
an Aho-Corasick automaton, asks whether it goes with its left neighbour (remembered per
pair), tries the next shorter one if not, and steps back over the last piece when none
goes; it remembers from which positions no way leads on.

Whether two pieces go together is read from the merges of each, noted when the model is
loaded: they do unless their boundary is, at some turn, better than what both merge next.

Texts are cut where no piece can reach across: between a character and a following ``\\u2581``,
between letters and others (letters are the largest set of characters that pieces chain
together) and around characters that are in no piece. Those are written as byte pieces.

Model files of this kind only: identity normalisation, byte fallback. The path is a
parameter; each Python worker reads the file it names.

Defined cases: a null text is empty and encodes to the end id alone; repeated rows are
encoded each; an empty table gives an empty table; other columns are not read. Texts of any
length are encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"

#: Chunks and pairs that a worker remembers before it starts anew: bounds its memory.
REMEMBERED_CHUNKS = 200_000
REMEMBERED_PAIRS = 400_000

#: What is this long is not remembered.
LONG = 64

#: Rows that leave a worker together: token ids take several times the room of the texts.
SENT_ROWS = 500

#: The text on its way to the encoder; a column kept beside it may be named as it likes.
_WHOLE = "__whole_text"


class Remembered(dict):
    """Answers of ``make``. At ``most`` it starts anew; what is asked again comes back."""

    def __init__(self, make: Callable, most: int) -> None:
        super().__init__()
        self._make, self._most, self._older = make, most, {}

    def __missing__(self, asked):
        answer = self._older.get(asked)
        if answer is None:
            answer = self._make(asked)
        if len(asked) < LONG:
            if len(self) >= self._most:
                self._older = dict(self)
                self.clear()
            self[asked] = answer
        return answer


class PieceCodec:
    """Encoder and decoder over the pieces and scores of a model file."""

    def __init__(self, model_path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.end_id = model.eos_id()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.decoded: list[bytes | int] = [b""] * size
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.decoded[i] = value
            elif model.is_unknown(i):
                self.unknown = self.decoded[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
                self.decoded[i] = piece.replace(SPACE, " ").encode()
        self.known = {c for piece in self.ids for c in piece}
        #: Of each merge that a piece comes from, and at its end: the score, and the symbol
        #: that the piece has last (first) until then.
        self._last: dict[str, list[tuple[float, str]]] = {}
        self._first: dict[str, list[tuple[float, str]]] = {}
        for piece in self.ids:
            symbols, turns = self._merged(piece)
            if symbols == [piece]:  # else never a result
                self._last[piece] = [(score, last) for score, _, last in turns]
                self._first[piece] = [(score, first) for score, first, _ in turns]
        reached = self._last
        self._automaton = ahocorasick.Automaton()
        #: The longest piece that is a shorter prefix, or nothing.
        self._shorter: dict[str, str] = {}
        for piece in reached:
            self._automaton.add_word(piece, piece)
            ends = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self._shorter[piece] = next((p for p in ends if p in reached), "")
        self._automaton.make_automaton()
        self._longest_piece = max(map(len, reached), default=1)
        self._numbers = {piece: str(i) for piece, i in self.ids.items()}
        self._pairs = Remembered(self._go_together, REMEMBERED_PAIRS)
        #: A chunk's ids in decimal, one space between, and what these are decoded to.
        self._chunks = Remembered(self._coded_chunk, REMEMBERED_CHUNKS)
        spaced = any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        if spaced:
            raise ValueError("pieces with an inner space mark are not of this kind")
        letters = re.escape("".join(sorted(self._letters())))
        marks, other = f"{SPACE}+", f"[^{letters}{SPACE}]+"
        self._parts = re.compile(f"{SPACE}*[{letters}]+|{SPACE}*{other}|{marks}")

    def _letters(self) -> set[str]:
        """The largest set of characters that no piece has next to any other, but for marks."""
        kinds = {c: {c} for c in self.known if c != SPACE}
        for piece in self.ids:
            for a, b in pairwise(piece.lstrip(SPACE)):
                if kinds[a] is not kinds[b]:
                    joined = kinds[a] | kinds[b]
                    kinds |= dict.fromkeys(joined, joined)
        return max(kinds.values(), key=lambda kind: (len(kind), min(kind)), default=set())

    def _merged(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """What single characters merge to, best score first, leftmost of equals; and each
        merge's score with the first and last symbol before it, ending with no score."""
        symbols, turns, scores = list(text), [], self.scores
        while True:
            best, place = -math.inf, -1
            for i in range(len(symbols) - 1):
                score = scores.get(symbols[i] + symbols[i + 1])
                if score is not None and score > best:
                    best, place = score, i
            turns.append((best, symbols[0], symbols[-1]))
            if place < 0:
                return symbols, turns
            symbols[place : place + 2] = [symbols[place] + symbols[place + 1]]

    def _go_together(self, pair: tuple[str, str]) -> bool:
        """Whether both are what their characters, merged again, come to: no merge across
        their boundary is better than the next on its left and as good as that on its right."""
        scores = self.scores
        lefts, rights = iter(self._last[pair[0]]), iter(self._first[pair[1]])
        left, last = next(lefts)
        right, first = next(rights)
        while True:
            score = scores.get(last + first)
            if score is not None and score > left and score >= right:
                return False
            if left < right:
                right, first = next(rights)
            elif left > -math.inf:
                left, last = next(lefts)
            else:
                return True

    def _tokens(self, text: str) -> list[str]:
        """The pieces of a text whose characters are all known."""
        longest, shorter, pairs = self._automaton.iter_long, self._shorter, self._pairs
        size, reach = len(text), self._longest_piece
        seen = 4 * reach
        failed = bytearray(size + 1)  # by position
        taken: list[str] = []
        at, left = 0, ""
        # Longest pieces one after the other, as they are in the whole text while they begin
        # at ``sure`` or before; a shorter piece or a step back needs a new look.
        ahead, sure, moved = longest(text[:seen]), seen - reach, False
        piece = next(ahead)[1]
        while True:
            first = piece
            while piece:
                end = at + len(piece)
                if not failed[end] and (not left or pairs[left, piece]):
                    break
                piece = shorter[piece]
            if piece:
                taken.append(piece)
                if end == size:
                    return taken
                at, left = end, piece
                if moved or piece is not first or at > sure:
                    ahead, sure, moved = longest(text[at : at + seen]), at + seen - reach, False
                piece = next(ahead)[1]
            else:
                failed[at] = True
                piece = taken.pop()
                at -= len(piece)
                left = taken[-1] if taken else ""
                piece, moved = shorter[piece], True

    def _coded_chunk(self, chunk: str) -> tuple[str, bytes]:
        ids = self._chunk_ids(chunk)
        return " ".join(ids), b"".join(map(self._written.__getitem__, ids))

    def _chunk_ids(self, chunk: str) -> list[str]:
        numbers = self._numbers
        if self.known.issuperset(chunk):
            return [numbers[piece] for piece in self._tokens(chunk)]
        ids: list[str] = []
        start = 0
        for i, c in enumerate(chunk):
            if c not in self.known:
                if start < i:
                    ids += [numbers[piece] for piece in self._tokens(chunk[start:i])]
                ids += [str(self.byte_ids[b]) for b in c.encode()]
                start = i + 1
        if start < len(chunk):
            ids += [numbers[piece] for piece in self._tokens(chunk[start:])]
        return ids

    def _cut(self, text: str) -> Iterable[str]:
        return self._parts.findall(SPACE + text.replace(" ", SPACE)) if text else ()

    def coded(self, text: str) -> tuple[str, str]:
        """All ids of a text with the end id, in decimal, one space between, and the text
        that they are decoded to."""
        end = (str(self.end_id), b"")
        parts, written = zip(*map(self._chunks.__getitem__, self._cut(text)), end, strict=True)
        ids = " ".join(parts)
        return ids, self._as_text(b"".join(written), ids)

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.coded(text)[0].split(" ")]

    def decode(self, ids: Iterable[int]) -> str:
        parts = [*map(str, ids)]
        return self._as_text(b"".join(map(self._written.__getitem__, parts)), " ".join(parts))

    @functools.cached_property
    def _written(self) -> dict[str, bytes]:
        return {
            str(i): bytes([piece]) if isinstance(piece, int) else piece
            for i, piece in enumerate(self.decoded)
        }

    def _as_text(self, written: bytes, ids: str) -> str:
        """Text of decimal ids and their bytes: control ids vanish, as does the first space
        of the text; bytes that are no UTF-8 each give the replacement character."""
        pieces = (self.decoded[int(i[0])] for i in re.finditer("[0-9]+", ids))
        try:
            text = written.decode()
        except UnicodeDecodeError:
            return self._decoded_with_loose_bytes(pieces)
        if text[:1] == " ":
            first = next(piece for piece in pieces if piece != b"")
            if not isinstance(first, int) and first is not self.unknown:
                return text[1:]
        return text

    def _decoded_with_loose_bytes(self, pieces: Iterable[bytes | int]) -> str:
        out, loose, first = bytearray(), bytearray(), True
        for piece in pieces:
            if isinstance(piece, int):
                loose.append(piece)
                continue
            if loose:
                out += _as_utf8(loose)
                loose.clear()
                first = False
            if first and piece:
                out += piece[1:] if piece[:1] == b" " and piece is not self.unknown else piece
                first = False
            else:
                out += piece
        out += _as_utf8(loose)
        return out.decode()


def _as_utf8(loose: bytearray) -> bytes:
    try:
        loose.decode()
        return bytes(loose)
    except UnicodeDecodeError:
        out, i = bytearray(), 0
        while i < len(loose):
            for n in (1, 2, 3, 4):
                try:
                    bytes(loose[i : i + n]).decode()
                except UnicodeDecodeError:
                    continue
                out += loose[i : i + n]
                i += n
                break
            else:
                out += "�".encode()
                i += 1
        return bytes(out)


@functools.lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    return PieceCodec(model_path)


def _encoded(model_path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_path)
        for batch in (b.slice(at, SENT_ROWS) for b in batches for at in range(0, len(b), SENT_ROWS)):
            counts, id_hashes, text_hashes, ids = [], [], [], []
            for text in batch[_WHOLE]:
                written, decoded = tool.coded(text.as_py())
                counts.append(written.count(" ") + 1)
                id_hashes.append(hashlib.sha256(written.encode()).hexdigest())
                text_hashes.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    ids.append(np.array(written.split(" "), np.int32))
            columns = {
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(id_hashes, pa.string()),
                "decoded_sha256": pa.array(text_hashes, pa.string()),
            }
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(ends, np.concatenate(ids))
            kept = [n for n in batch.schema.names if n != _WHOLE]
            yield pa.RecordBatch.from_arrays(
                [batch[n] for n in kept] + list(columns.values()), names=[*kept, *columns]
            )

    return run


def encode_documents(
    docs: DataFrame,
    model_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Iterable[str] = (),
    with_ids: bool = True,
) -> DataFrame:
    """Each text's ``ids`` (with the end id), ``n_tokens`` and the digests of its ids and of
    what they decode to, beside ``doc_id`` and the columns in ``keep``. No shuffle."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        *(F.col(f"`{name}`") for name in keep),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(_WHOLE),
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != _WHOLE]
    fields += ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>"] if with_ids else []
    return rows.mapInArrow(_encoded(model_path, with_ids), ", ".join(fields))


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``text`` of ``doc_id`` and ``ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_path)
        for batch in batches:
            texts = [tool.decode(ids.as_py() or ()) for ids in batch["ids"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")

"""SentencePiece BPE: ids of texts by a prefix table, and texts of ids.

Merging is best score first, leftmost on ties. A sequence of pieces is the encoding of its text exactly
when each two neighbours are the encoding of theirs: the first merge across a border of the whole would
be as good in the pair alone. So every prefix of a text has one last piece, found from left to right:
of the pieces that end there (an Aho-Corasick automaton gives them) the one that fits the last piece of
the prefix before it. The ids are then read off backwards, in time and memory linear in the text.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# How the vocabulary writes a space, and what stands for an unknown id and an invalid byte.
SPACE = "▁"
UNKNOWN = " ⁇ "
INVALID = "�"

# Parts of a text (twice so many at most) and pairs of pieces each encoder remembers; longer parts are worked out each time.
KNOWN_PARTS = 200_000
KNOWN_PAIRS = 400_000
KNOWN_LENGTH = 48
# Ids that one Arrow batch of results may hold before the next begins.
BATCH_IDS = 1_000_000


class PieceEncoder:
    """``encoder(text)`` gives the ids of a text, without begin and end.

    The library normalises the text (white space, its own rules) and lists the vocabulary; the
    segmentation is this class's. Models without pieces set aside for later only."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.vocab_size()
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in range(size)]
        if any(self.library.is_unused(i) for i in range(size)):
            raise ValueError(f"{path}: pieces marked as unused are not supported")
        names = {self.library.id_to_piece(i): i for i in range(size) if not special[i]}
        self.score = {name: self.library.get_score(i) for name, i in names.items()}
        spelled = [self.library.id_to_piece(i) for i in range(size) if self.library.is_byte(i)]
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if len(spelled) == 256 else None
        self.names = {i: name for name, i in names.items()}
        self.size = size
        self.automaton = ahocorasick.Automaton()
        for name, i in names.items():
            if len(name) == 1 or self.merge(name) == [name]:  # a piece that no merging makes is never an encoding's
                self.automaton.add_word(name, (len(name), i))
        self.automaton.make_automaton()
        self.parts = self._parts(names)
        self.beside = {pair for name in names for pair in zip(name, name[1:], strict=False)}
        self.pairs: dict[int, bool] = {}  # by the first's id times the vocabulary's size, plus the second's
        self.known: dict[str, bytes] = {}  # ids as four bytes each
        self.older: dict[str, bytes] = {}  # those before the last emptying; of use again, they come back

    @staticmethod
    def _parts(names: Iterable[str]) -> re.Pattern:
        """Stretches no piece reaches out of: a space begins one, as no piece has a space behind
        another character; a character of no longer piece stands alone."""
        inside = {c for name in names if len(name) > 1 for c in name}
        if any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names):
            every = "".join(map(re.escape, sorted(inside | {SPACE})))
            return re.compile(f"[{every}]+|.", re.S)
        word = "".join(map(re.escape, sorted(inside - {SPACE})))
        return re.compile(f"{SPACE}+[{word}]*|[{word}]+|." if word else ".", re.S)

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging outright."""
        symbols = list(text)
        while True:
            made = [(self.score.get(a + b), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))]
            made = [(-s, i) for s, i in made if s is not None]
            if not made:
                return symbols
            i = min(made)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    def fits(self, before: int, piece: int) -> bool:
        """Whether two pieces side by side are the encoding of their text: merging never reaches over their border."""
        first = self._name(before)
        symbols, border, score = list(first + self.names[piece]), len(first), self.score.get  # border: symbols before it
        fit = True
        while fit:
            best, at = None, -1
            for i, both in enumerate(map(str.__add__, symbols, symbols[1:])):
                made = score(both)
                if made is not None and (best is None or made > best):
                    best, at = made, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            fit = at != border - 1
            border -= at < border
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        self.pairs[before * self.size + piece] = fit = fit and len(symbols) == 2
        return fit

    def _name(self, piece: int) -> str:
        """Text of a piece's id; a character that no piece has is written as a number below zero."""
        return self.names[piece] if piece >= 0 else chr(-1 - piece)

    def pieces(self, part: str) -> list[int]:
        """Ids of the pieces of a part by its prefix table, any length; characters that no piece has below zero."""
        last: list[int] = []  # of each prefix, its last piece
        sizes: list[int] = []
        known, size, done = self.pairs.get, self.size, 0
        for end, (length, piece) in self.automaton.iter(part):
            if end < done:
                continue
            while done < end:  # no listed piece ends there: a character that has none
                last.append(-1 - ord(part[done]))
                sizes.append(1)
                done += 1
            start = end - length  # the last character before the piece
            if start >= 0:
                before = last[start]
                fit = known(before * size + piece)
                if fit is None:
                    fit = self.fits(before, piece)
                if not fit:
                    continue
            last.append(piece)
            sizes.append(length)
            done += 1
        for c in part[done:]:
            last.append(-1 - ord(c))
            sizes.append(1)
        out, end = [], len(part) - 1
        while end >= 0:
            out.append(last[end])
            end -= sizes[end]
        out.reverse()
        return out

    def _of_piece(self, piece: int) -> tuple[int, ...]:
        if piece >= 0:
            return (piece,)
        return tuple(self.bytes[b] for b in chr(-1 - piece).encode()) if self.bytes else (self.library.unk_id(),)

    def of_part(self, part: str) -> bytes:
        """Ids of a part, cut further between characters that no piece has side by side."""
        if part in self.older:
            return self._keep(part, self.older[part])
        beside = self.beside
        if beside.issuperset(zip(part, part[1:], strict=False)):
            return self.of_stretch(part)
        start, cuts = 0, []
        for at, pair in enumerate(zip(part, part[1:], strict=False), 1):
            if pair not in beside:
                cuts.append(part[start:at])
                start = at
        cuts.append(part[start:])
        return self._keep(part, b"".join([self.known.get(cut) or self.of_stretch(cut) for cut in cuts]))

    def of_stretch(self, part: str) -> bytes:
        found = self.pieces(part)
        if min(found, default=0) < 0:
            found = [i for piece in found for i in self._of_piece(piece)]
        return self._keep(part, array("i", found).tobytes())

    def _keep(self, part: str, ids: bytes) -> bytes:
        if len(part) <= KNOWN_LENGTH:
            if len(self.known) >= KNOWN_PARTS:
                self.older = dict(self.known)
                self.known.clear()
            self.known[part] = ids
        return ids

    def __call__(self, text: str) -> array:
        text = self.library.normalize(text)
        found = self.parts.findall(text) if len(text) < 1_000_000 else (m[0] for m in self.parts.finditer(text))
        known, of_part, ids = self.known.get, self.of_part, array("i")
        ids.frombytes(b"".join([known(part) or of_part(part) for part in found]))
        if not self.bytes:  # the library writes unknown characters in a row as one
            unknown = self.library.unk_id()
            ids = array("i", (x for k, x in enumerate(ids) if x != unknown or not k or ids[k - 1] != unknown))
        return ids


def shared_encoder(path: str) -> PieceEncoder:
    """The encoder of this process for a model: a Python worker serves one task after another, and what it has
    worked out for one, within the bounds above, is of use to the next. Code that travels by value is a copy
    of its own in every task, so the encoders hang on a module that stays."""
    stays = sys.modules.setdefault("_sediment_piece_encoders", types.ModuleType("_sediment_piece_encoders"))
    known = stays.__dict__.setdefault("encoders", {})
    if path not in known:
        known[path] = PieceEncoder(path)
    return known[path]


def _bytes_as_text(run: bytes) -> str:
    """UTF-8 with each invalid byte marked by itself."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(INVALID)
            at += 1
    return "".join(out)


def piece_decoder(path: str) -> Callable[[list[int]], str]:
    """A function from ids to text. Byte pieces in a row are read as UTF-8; of the first piece the
    space that encoding puts before a text goes; begin and end give nothing."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    size = library.vocab_size()
    names = [library.id_to_piece(i) for i in range(size)]
    single = [library.is_byte(i) for i in range(size)]
    silent = [library.is_control(i) for i in range(size)]
    shown = [
        b"" if silent[i] else bytes([int(names[i][3:-1], 16)]) if single[i]
        else (UNKNOWN if library.is_unknown(i) else names[i].replace(SPACE, " ")).encode()
        for i in range(size)
    ]
    put_before = library.normalize("a").startswith(SPACE)
    spaced = {i for i in range(size) if names[i].startswith(SPACE) and not single[i]}

    def decode(ids: list[int]) -> str:
        first = next((i for i in ids if not silent[i]), None)
        skip = int(put_before and first in spaced)
        try:
            return b"".join(map(shown.__getitem__, ids)).decode()[skip:]
        except UnicodeDecodeError:
            pass
        out, run = [], bytearray()
        for i in ids:
            if single[i]:
                run += shown[i]
                continue
            out += [_bytes_as_text(bytes(run)), shown[i].decode()]
            run.clear()
        return "".join([*out, _bytes_as_text(bytes(run))])[skip:]

    return decode


def _joined(batch: pa.RecordBatch, values: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], schema=schema)


def _named(batch: pa.RecordBatch, name: str, kind: pa.DataType) -> pa.Schema:
    return pa.schema([*batch.schema, pa.field(name, kind)])


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows and columns of ``df``, and ``ids`` (array of int): the ids of the text.

    Equal to the library's ``encode`` for BPE models, whole texts of any length; NULL and empty texts
    have no ids. A column that bears the name of ``ids`` (case apart) is replaced; other columns,
    repeated rows and ties pass as they are. ``model`` is a file every executor can open."""
    kept = [c for c in df.columns if c.lower() != ids.lower()]
    source = df.select(*(f"`{c}`" for c in kept))
    at = [c.lower() for c in kept].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(model)
        for batch in batches:
            schema = _named(batch, ids, pa.list_(pa.int32()))
            start, ends, values = 0, [0], array("i")
            for row, one in enumerate(batch.column(at)):
                values.extend(encoder(one.as_py() or ""))
                ends.append(len(values))
                if len(values) >= BATCH_IDS or row == batch.num_rows - 1:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(values, np.int32)))
                    yield _joined(batch.slice(start, row + 1 - start), lists, schema)
                    start, ends, values = row + 1, [0], array("i")

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows and columns of ``df``, and ``text``: what the ids stand for.

    Equal to the library's ``decode``, for any ids of the vocabulary; NULL and empty lists give an empty
    text, NULL ids inside a list are left out, others outside the vocabulary raise. A column of the
    result's name is replaced."""
    kept = [c for c in df.columns if c.lower() != text.lower()]
    source = df.select(*(f"`{c}`" for c in kept))
    at = [c.lower() for c in kept].index(ids.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = piece_decoder(model)
        for batch in batches:
            schema = _named(batch, text, pa.string())
            lists = batch.column(at)
            ends, values = lists.offsets.to_pylist(), lists.values
            if values.null_count:
                out = [reader([i for i in one or () if i is not None]) for one in lists.to_pylist()]
            else:
                flat = values.to_numpy()
                out = [reader(flat[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
            yield _joined(batch, pa.array(out, pa.string()), schema)

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(text, T.StringType())]))

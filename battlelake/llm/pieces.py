"""SentencePiece BPE with source offsets: normalisation that keeps its alignment, merging, decoding.

A text is normalised from the left: at each place the longest prefix that the model's compiled character map knows is
replaced, anything else stays, and every character written remembers the source byte it came from. Pieces of the
normalised text are so projected to byte spans of the original. The map is a double array of 32-bit cells with the
replacements behind it; whether a character can begin an entry is asked of it once per distinct character.

The normalised text is cut where no piece of the vocabulary holds both neighbours, so no merge can cross a cut. Each
distinct unit is merged once per worker: the neighbouring pair with the best score, the leftmost of equals, until none
is left. A character outside the vocabulary becomes one piece for each of its bytes, the last of which has its span.

Rows are independent: nothing is shuffled. Defined cases: a null or empty text has the begin and the end id only and decodes
to nothing; strings of control pieces in a text are ordinary text; rows are encoded one by one, so repeated
rows and ids are fine; an ``ids`` array that is null decodes to nothing, one with ids outside the vocabulary is an error.
Models that are no BPE, lack byte pieces, set marks at word ends or have unused or user-defined pieces are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from battlelake.llm import bytesets

#: The sign that stands for a blank, and what an unknown piece decodes to. Fixed values.
MARK, BLANK = "▁", " "

#: Kinds of pieces and of models, as the model file numbers them. Fixed values.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2

#: Units that a worker remembers besides those of its present slice, units merged side by side, and the longest of
#: those in characters; none of them changes a result.
MAX_UNITS, UNITS_PER_MERGE, LONG_UNIT = 500_000, 20_000, 64

#: The rank of a pair that is no piece.
NONE = 1 << 30


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message of the model file."""
    at = 0

    def varint() -> int:
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
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at:at + size]
        at += size


class Model:
    """What encoding needs of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer: dict = {}
        normaliser: dict = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        odd = set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}
        if trainer.get(3, 1) != BPE or odd or trainer.get(24, 0) or not trainer.get(35, 0):
            raise ValueError("not a BPE model with byte pieces and marks before words")
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        ids = dict(zip(self.pieces, range(len(self.pieces)), strict=True))
        self.begin, self.end = (ids[trainer.get(number, name).decode()] for number, name in ((46, b"<s>"), (47, b"</s>")))
        self.charsmap = normaliser.get(2, b"")
        self.dummy_prefix, self.fewer_blanks, self.escaped = (bool(normaliser.get(n, 1)) for n in (3, 4, 5))


class Charsmap:
    """The compiled character map: longest prefix to replacement."""

    def __init__(self, data: bytes):
        size = struct.unpack_from("<I", data)[0]
        self.cells = np.frombuffer(data, "<u4", size // 4, 4).tolist()
        self.texts = data[4 + size:]
        self.begins = np.zeros(0x110000, np.int8)

    def _steps(self, key: bytes, at: int) -> Iterator[tuple[int, int | None]]:
        """Bytes of the key that are in the map so far, and where its replacement stands if they are an entry."""
        cells = self.cells
        cell = cells[0]
        node = (cell >> 10) << ((cell & 0x200) >> 6)
        for i in range(at, len(key)):
            node ^= key[i]
            cell = cells[node] if node < len(cells) else 0x80000000
            if cell & 0x800000FF != key[i]:
                return
            node ^= (cell >> 10) << ((cell & 0x200) >> 6)
            yield i + 1 - at, cells[node] & 0x7FFFFFFF if cell & 0x100 else None

    def can_begin(self, codes: np.ndarray) -> np.ndarray:
        """Positions of the characters that begin some entry."""
        known = self.begins[codes]
        if not known.all():
            for code in np.unique(codes[known == 0]).tolist():
                char = chr(code).encode()
                self.begins[code] = 1 if sum(1 for _ in self._steps(char, 0)) == len(char) else -1
            known = self.begins[codes]
        return np.flatnonzero(known == 1)

    def longest(self, source: bytes, at: int) -> tuple[int, str] | None:
        """Bytes of the longest entry at ``at`` and its replacement."""
        size = place = None
        for length, found in self._steps(source, at):
            if found is not None:
                size, place = length, found
        return None if size is None else (size, self.texts[place:self.texts.index(0, place)].decode())


class Normaliser:
    def __init__(self, model: Model):
        self.model, self.map = model, Charsmap(model.charsmap) if model.charsmap else None

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters of the normalised text, and the source byte of each and of the end."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        places = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), out=places[1:])
        end, chunks = int(places[-1]), places[:-1]
        if self.map is not None and len(at := self.map.can_begin(codes)):
            codes, chunks = self._replaced(text.encode(), codes, places, at)
        blank = codes == 0x20
        mark = ord(MARK) if self.model.escaped else 0x20
        start = 0
        if self.model.fewer_blanks and len(codes):
            # A chunk loses the blanks it begins with where a blank (or the text's edge) is before it.
            first = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1]))
            chunk = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(codes))))
            solid = np.cumsum(~blank)
            before = np.append(0, solid)[first]
            leading = blank & (solid == before[chunk])
            dropped = leading & np.append(True, blank)[first][chunk]
            heading = np.flatnonzero(~((np.diff(np.append(first, len(codes))) == 1) & blank[first]))
            if not len(heading):
                return np.zeros(0, np.uint32), np.array([end])
            start = int(chunks[first[heading[0]]])
            codes, chunks, blank = codes[~dropped], chunks[~dropped], blank[~dropped]
        codes = np.where(blank, np.uint32(mark), codes)
        if self.model.dummy_prefix:
            codes, chunks = np.append(np.uint32(mark), codes), np.append(start, chunks)
        if self.model.fewer_blanks:
            kept = np.flatnonzero(codes != mark)
            size = int(kept[-1]) + 1 if len(kept) else 0
            end = int(chunks[size]) if size < len(codes) else end
            codes, chunks = codes[:size], chunks[:size]
        return codes, np.append(chunks, end)

    def _replaced(self, source: bytes, codes: np.ndarray, places: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, origin, done = [], [], 0
        for i in at.tolist():
            if i < done:
                continue
            found = self.map.longest(source, int(places[i]))
            if found is None:
                continue
            size, text = found
            new = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            out += [codes[done:i], new]
            origin += [places[done:i], np.full(len(new), places[i])]
            done = int(np.searchsorted(places, places[i] + size))
        out.append(codes[done:])
        origin.append(places[done:-1])
        return np.concatenate(out), np.concatenate(origin)


class Encoder:
    """One model in one worker process."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = self.model = Model(file.read())
        self.normalise = Normaliser(model)
        self.plain = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        self.bytes_at = [model.pieces.index(f"<0x{b:02X}>") for b in range(256)]
        # A character has its own number, also one that is no piece; 0 stands for those that no piece has.
        chars = sorted({c for p in self.plain for c in p} - self.plain.keys())
        symbols = {p: i + 1 for p, i in self.plain.items()} | {c: len(model.pieces) + 1 + i for i, c in enumerate(chars)}
        self.base = len(model.pieces) + len(chars) + 1
        self.char_symbol = np.zeros(0x110000, np.int64)
        for char, number in symbols.items():
            if len(char) == 1:
                self.char_symbol[ord(char)] = number
        order = {score: place for place, score in enumerate(sorted({-x for x in model.scores}))}
        merges = sorted(
            (symbols[p[:k]] * self.base + symbols[p[k:]], order[-model.scores[i]], i + 1) for p, i in self.plain.items()
            for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
        self.keys, self.ranks, self.results = (np.array(x, np.int64) for x in zip(*(merges or [(-1, NONE, 0)]), strict=True))
        self.merges = {m[0]: m[1:] for m in merges}
        pairs = {p[k:k + 2] for p in self.plain for k in range(len(p) - 1)}
        # Characters of such pairs are numbered from 1; ``apart`` says which two no piece holds side by side.
        self.numbers = np.zeros(0x110000, np.uint16)
        inner = sorted({c for pair in pairs for c in pair})
        self.numbers[[ord(c) for c in inner]] = np.arange(1, len(inner) + 1)
        self.apart = np.ones((len(inner) + 1, len(inner) + 1), bool)
        for a, b in pairs:
            self.apart[self.numbers[ord(a)], self.numbers[ord(b)]] = False
        #: Of each unit met: pairs of an id and the number of characters that it stands for, packed.
        self.units: dict[str, bytes] = {}
        #: Whether pieces give a text back behind a blank as long as it holds no mark of its own.
        self.gives_back = self.normalise.map is None and model.dummy_prefix and model.escaped and not model.fewer_blanks
        blank = MARK if model.escaped else None
        self.raw = [
            bytes([self.bytes_at.index(i)]) if kind == BYTE else b"" if kind == CONTROL else model.unknown_text.encode() if kind == UNKNOWN
            else (piece.replace(blank, BLANK) if blank else piece).encode()
            for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds, strict=True))
        ]
        self.special = np.array([k in (CONTROL, UNKNOWN) for k in model.kinds])

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair; ``NONE`` where there is no such piece."""
        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        there = self.keys[at] == wanted
        return np.where(there, self.ranks[at], NONE), self.results[at]

    def merged(self, units: list[str]) -> list[bytes]:
        """Packed ids and widths of short units, all merged side by side: one pair of each in a round."""
        lengths = np.array([len(u) for u in units], np.int64)
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        token, width, unit = self.char_symbol[codes], np.ones(len(codes), np.int64), np.repeat(np.arange(len(units)), lengths)
        rank, result = self.looked_up(token[:-1], token[1:])
        rank[unit[:-1] != unit[1:]] = NONE
        rank, result = np.append(rank, NONE), np.append(result, 0)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(token):
            starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), starts)
            going = best >> 32 < NONE
            at = best[going] & 0xFFFFFFFF
            token[at] = result[at]
            width[at] += width[at + 1]
            kept = np.repeat(going, np.diff(np.append(starts, len(token))))
            done.append((unit[~kept], token[~kept], width[~kept]))
            kept[at + 1] = False
            place = np.cumsum(kept) - 1
            token, width, unit, rank, result = (x[kept] for x in (token, width, unit, rank, result))
            at = place[at]
            if not len(token):
                break
            for left in (at, at[at > 0] - 1):
                inside = left + 1 < len(token)
                inside[inside] = unit[left[inside]] == unit[left[inside] + 1]
                rank[left[~inside]] = NONE
                left = left[inside]
                rank[left], result[left] = self.looked_up(token[left], token[left + 1])
        unit, token, width = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(unit, kind="stable")
        token, width = token[order], width[order]
        firsts = np.append(0, np.cumsum(np.bincount(unit, minlength=len(units))))
        unknown = np.flatnonzero((token == 0) | (token > len(self.model.pieces)))
        pairs = np.stack((token - 1, width), axis=1).astype("<u4").tobytes()
        bounds = (8 * firsts).tolist()
        packed = [pairs[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        if len(unknown):
            places = np.cumsum(width) - width
            for k in np.unique(np.searchsorted(firsts, unknown, "right") - 1).tolist():
                own = slice(firsts[k], firsts[k + 1])
                packed[k] = self._packed(units[k], token[own].tolist(), (places[own] - places[firsts[k]]).tolist(), width[own].tolist())
        return packed

    def _packed(self, unit: str, tokens: list[int], places: list[int], widths: list[int]) -> bytes:
        """Ids and widths where some characters are no pieces: such a one gives an id for each of its bytes."""
        ids: list[int] = []
        sizes: list[int] = []
        for token, at, width in zip(tokens, places, widths, strict=True):
            if 0 < token <= len(self.model.pieces):
                ids.append(token - 1)
                sizes.append(width)
            else:
                raw = unit[at].encode()
                ids += [self.bytes_at[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [1]
        return np.array((ids, sizes), "<u4").T.tobytes()

    def merged_long(self, unit: str) -> bytes:
        """The same for a long unit, with its pairs in a heap."""
        n, merges, base = len(unit), self.merges, self.base
        token = self.char_symbol[np.frombuffer(unit.encode("utf-32-le"), np.uint32)].tolist()
        width, before = [1] * n, list(range(-1, n - 1))
        heap = [(found[0], i, 2, found[1]) for i in range(n - 1) if (found := merges.get(token[i] * base + token[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, size, new = heapq.heappop(heap)
            j = i + width[i]
            if not width[i] or j >= n or width[i] + width[j] != size or merges.get(token[i] * base + token[j], (0, -1))[1] != new:
                continue
            token[i], width[i], width[j] = new, size, 0
            after = i + size
            if after < n:
                before[after] = i
                if found := merges.get(new * base + token[after]):
                    heapq.heappush(heap, (found[0], i, size + width[after], found[1]))
            if (k := before[i]) >= 0 and (found := merges.get(token[k] * base + new)):
                heapq.heappush(heap, (found[0], k, size + width[k], found[1]))
        places = [i for i in range(n) if width[i]]
        return self._packed(unit, [token[i] for i in places], places, [width[i] for i in places])

    def _learn(self, units: set[str]) -> None:
        """Merge the units of one call that are not remembered yet."""
        new = list(units - self.units.keys())
        if len(self.units) + len(new) > MAX_UNITS:
            self.units.clear()
            new = list(units)
        short = [u for u in new if len(u) <= LONG_UNIT]
        for at in range(0, len(short), UNITS_PER_MERGE):
            some = short[at:at + UNITS_PER_MERGE]
            self.units.update(zip(some, self.merged(some), strict=True))
        for unit in new:
            if len(unit) > LONG_UNIT:
                self.units[unit] = self.merged_long(unit)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text: ids, and first and end byte of the source that each stands for; without begin and end ids."""
        cut: list[tuple[list[str], np.ndarray]] = []
        for text in texts:
            codes, origin = self.normalise(text) if text else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
            whole, number = codes.astype("<u4").tobytes().decode("utf-32-le"), self.numbers[codes]
            cuts = (np.flatnonzero(self.apart[number[:-1], number[1:]]) + 1).tolist()
            cut.append(([whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)], strict=True)] if whole else [], origin))
        self._learn(set().union(*(units for units, _ in cut)))
        out = []
        for units, origin in cut:
            ids, width = np.frombuffer(b"".join(map(self.units.__getitem__, units)), "<u4").reshape(-1, 2).T
            width = width.astype(np.int64)
            ends = np.cumsum(width)
            begins = origin[ends - width]
            out.append((ids, begins, np.where(width > 0, origin[ends], begins)))
        for units, _ in cut:
            for unit in units:
                if len(unit) > LONG_UNIT:
                    self.units.pop(unit, None)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for; runs of byte pieces are read as UTF-8."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.raw)):
            raise ValueError("an id outside the vocabulary")
        if len(ids) and ids[0] == self.model.begin:
            ids = ids[1:]
        if len(ids) and ids[-1] == self.model.end:
            ids = ids[:-1]
        if not self.special[ids].any():
            body = b"".join(map(self.raw.__getitem__, ids.tolist()))
            try:
                return body[self._lead(ids):].decode()
            except UnicodeDecodeError:
                pass
        out, run, at_start = [], b"", True
        for i in ids.tolist():
            kind = self.model.kinds[i]
            if kind == BYTE:
                run += self.raw[i]
                continue
            out.append(_lenient(run))
            run = b""
            at_start = at_start and not any(out)
            piece = self.raw[i].decode()
            if at_start and kind == NORMAL and (self.model.dummy_prefix or self.model.fewer_blanks) and piece.startswith(BLANK):
                piece, at_start = piece[1:], self.model.fewer_blanks
            out.append(piece)
        out.append(_lenient(run))
        return "".join(out)

    def _lead(self, ids: np.ndarray) -> int:
        """Blanks that the first pieces lose."""
        lost = 0
        if self.model.dummy_prefix or self.model.fewer_blanks:
            for i in ids.tolist():
                if self.model.kinds[i] == BYTE or not self.raw[i].startswith(b" "):
                    break
                lost += 1
                if not self.model.fewer_blanks or self.raw[i] != b" ":
                    break
        return lost


def _lenient(run: bytes) -> str:
    """UTF-8 text; each byte that belongs to no character gives one replacement sign."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at:at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns, and ``ids``, ``begins``, ``ends`` (or free names): pieces and their byte spans in the whole text."""
    schema, at = StructType([*docs.schema.fields]), docs.columns.index(text)
    for name, kind in (("ids", IntegerType()), ("begins", LongType()), ("ends", LongType())):
        schema = schema.add(bytesets.free_name(docs, name), ArrayType(kind))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=[str(i) for i in range(batch.num_columns)])
            for part in bytesets.slices(batch, str(at)):
                found = own.encode(part.column(at).fill_null("").to_pylist())
                offsets = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32())
                columns = [
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[k] for f in found]).astype(kind)))
                    for k, kind in enumerate((np.int32, np.int64, np.int64))]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return bytesets.map_arrow(docs, encoded, schema)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns, and ``decoded`` (or a free name)."""
    schema, at = StructType([*df.schema.fields]).add(bytesets.free_name(df, "decoded"), StringType()), df.columns.index(ids)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [own.decode(x or []) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return bytesets.map_arrow(df, decoded, schema)


def report(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids with begin and end id, and digests of ids, decoded text and byte spans.

    ``spans_sha256`` is of the first and end bytes of all pieces, pair after pair, as little-endian 64-bit integers.
    """
    rows = bytesets.only(docs, doc_id="bigint", text="string")
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        begin, end = (np.array([i], "<u4") for i in (own.model.begin, own.model.end))
        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                columns: list[list] = [[], [], [], []]
                for ids, begins, ends in own.encode(part.column("text").fill_null("").to_pylist()):
                    ids = np.concatenate((begin, ids, end))
                    columns[0].append(len(ids))
                    for column, data in zip(columns[1:], (
                        ids.tobytes(), own.decode(ids).encode(), np.stack((begins, ends), axis=1).astype("<i8").tobytes(),
                    ), strict=True):
                        column.append(hashlib.sha256(data).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])], names=names)

    return bytesets.map_arrow(rows, digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")

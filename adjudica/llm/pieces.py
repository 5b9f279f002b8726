"""SentencePiece encoding that keeps offsets, and decoding.

The model file gives the vocabulary, the compiled character map and the
normaliser's settings. Normalisation takes the longest entry of the character
map that is a prefix of the rest of the text (one character where none is) and
records for every byte it writes the source byte it came from; a piece is then
projected through that record to the bytes of the original text. The library chooses the pieces.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from adjudica.llm.common import texts

SPACE = "▁"  # written for a space in normalised text
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
ROWS = 256  # texts of one result batch
ENCODED = "doc_id long, ids array<int>, start int, ends array<int>, decoded string"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
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
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            at += size
            yield tag >> 3, data[at - size : at]
        else:
            size = 4 if kind == 5 else 8
            at += size
            yield tag >> 3, data[at - size : at]


class CharacterMap:
    """Longest-prefix lookup in the compiled map: a double-array trie, then its strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size :] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest entry that starts at ``at``."""
        if not self.units:
            return None
        found, unit, node = None, self.units[0], 0
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = self.units[node] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        value, length = found
        return self.strings[value : self.strings.index(b"\0", value)], length


class Model:
    """A model file: its settings, its pieces and the library's encoder."""

    def __init__(self, serialized: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialized)
        self.pieces: list[str] = []
        self.types: list[int] = []
        settings = {2: b"", 3: 1, 4: 1, 5: 1}
        self.suffix = False
        for field, value in _fields(serialized):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.types.append(piece.get(3, NORMAL))
            elif field == 2:
                self.suffix = bool(dict(_fields(value)).get(24, 0))
            elif field == 3:
                settings |= dict(_fields(value))
        self.map = CharacterMap(settings[2])
        self.dummy_prefix, self.remove_extra, self.escape = bool(settings[3]), bool(settings[4]), bool(settings[5])
        self.symbols = sorted((p.encode() for p, t in zip(self.pieces, self.types) if t == USER_DEFINED), key=len, reverse=True)
        self.bytes_of = [
            bytes([int(_BYTE_PIECE.match(p)[1], 16)]) if t == BYTE else b"" if t == CONTROL else p.replace(SPACE, " ").encode()
            for p, t in zip(self.pieces, self.types)
        ]
        self.sizes = np.array([1 if t == BYTE else len(p.encode()) for p, t in zip(self.pieces, self.types)])
        self.unknown = self.processor.unk_id()

    def _prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        for symbol in self.symbols:
            if data.startswith(symbol, at):
                return symbol, len(symbol)
        found = self.map.longest(data, at)
        if found is not None:
            return found
        first = data[at]
        length = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[at : at + length], length

    def normalise(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised bytes, and the source byte of each (and of their end)."""
        data, at = text.encode(), 0
        if self.remove_extra:
            while at < len(data):
                written, length = self._prefix(data, at)
                if written != b" ":
                    break
                at += length
        out, source = bytearray(), []
        if at == len(data):
            return b"", [0]
        space = SPACE.encode() if self.escape else b" "

        def add(written: bytes, at: int) -> None:
            out.extend(written)
            source.extend([at] * len(written))

        if self.dummy_prefix and not self.suffix:
            add(space, at)
        after_space = self.remove_extra
        while at < len(data):
            written, length = self._prefix(data, at)
            if after_space:
                written = written.lstrip(b" ")
            if written:
                if written == data[at : at + length] and b" " not in written:
                    out.extend(written)  # as it was: byte for byte
                    source.extend(range(at, at + length))
                else:
                    for byte in (written[i : i + 1] for i in range(len(written))):
                        add(space if byte == b" " else byte, at)
                after_space = written.endswith(b" ")
            at += length
            if not self.remove_extra:
                after_space = False
        if self.remove_extra:
            while out.endswith(space):
                at = source[len(out) - len(space)]
                del out[-len(space) :], source[-len(space) :]
        if self.dummy_prefix and self.suffix:
            add(space, at)
        source.append(at)
        return bytes(out), source

    def alignment(self, text: str) -> np.ndarray:
        """The source byte of every normalised byte, and of their end."""
        if self.map.units or self.remove_extra or self.suffix or self.symbols:
            return np.array(self.normalise(text)[1])
        # Without a character map every entry is one character: only spaces change their size.
        data = np.frombuffer(text.encode(), np.uint8)
        width = len(SPACE.encode()) if self.escape else 1
        source = np.repeat(np.arange(len(data)), np.where(data == ord(" "), width, 1))
        return np.concatenate([np.zeros(width * self.dummy_prefix, np.int64), source, [len(data)]])

    def encode(self, text: str | None) -> tuple[np.ndarray, int, np.ndarray]:
        """Ids; the first source byte; the source byte where each piece ends, which is
        where the next one begins. Null and empty texts have no ids."""
        found = self.processor.encode(text) if text else []
        if not found:
            return np.empty(0, np.int32), 0, np.empty(0, np.int32)
        ids = np.array(found, np.int32)
        sizes = self.sizes[ids]
        if self.unknown in found:
            names = self.processor.encode(text, out_type=str)
            sizes = np.array([1 if self.types[i] == BYTE else len(p.encode()) for i, p in zip(found, names)])
        ends, source = np.cumsum(sizes), self.alignment(text)
        if ends[-1] != len(source) - 1:
            raise ValueError("the pieces do not add up to the normalised text")
        return ids, int(source[0]), source[ends].astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of some ids: pieces joined, byte pieces read as UTF-8 (U+FFFD
        where they are not), the space of the dummy prefix left out."""
        if self.unknown in ids or self.remove_extra or self.suffix:
            return self.processor.decode(ids)
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        try:
            text = data.decode()
        except UnicodeDecodeError:
            return self.processor.decode(ids)
        return text[1:] if self.dummy_prefix and ids and self.types[ids[0]] != BYTE and text.startswith(" ") else text


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, start, ends, decoded) of every row, whole texts.

    Piece i covers the source bytes from ends[i - 1] (start for the first) to
    ends[i]; ``decoded`` is the text of the ids. Null and empty texts have no ids
    and decode to an empty text. Repeated rows and null ids stay.
    """
    with open(model_path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [model.encode(t) for t in part["text"].to_pylist()]
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0] + [len(f[0]) for f in found]), pa.int32()),
                        pa.array(np.concatenate([f[k] for f in found]), pa.int32()),
                    )
                    for k in (0, 2)
                ]
                decoded = pa.array([model.decode(f[0].tolist()) for f in found], pa.string())
                start = pa.array([f[1] for f in found], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], lists[0], start, lists[1], decoded], names=["doc_id", "ids", "start", "ends", "decoded"]
                )

    return texts(docs).mapInArrow(run, ENCODED)

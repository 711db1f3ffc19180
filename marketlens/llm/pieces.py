"""SentencePiece encoding with byte spans of the source, and decoding.

The text is normalised by the model's compiled character map: at every place
the longest prefix that the map holds is replaced, and each byte of the result
records the source byte it stems from. The merges then run over the normalised
text, and the borders of every piece are projected through that record, so each
id comes with the span of source bytes it stands for.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
#: Bytes of texts worked on before a batch of results is handed on.
BATCH_BYTES = 8 << 20

ENCODED = "doc_id long, ids binary, starts binary, ends binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, source_bytes long, spans_crc32 long"

#: Kinds of vocabulary entries in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


class CharacterMap:
    """A compiled character map: a double array over byte strings and the replacement strings.

    The blob holds the array's size, its units of 32 bits, and replacement
    strings that end with a zero byte.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = memoryview(blob[4 : 4 + size]).cast("I") if size else None
        self.replacements = blob[4 + size :]
        self._plain: dict[str, bool] = {}

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped prefix of ``data[at:]``."""
        if self.units is None:
            return None
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if not found:
            return None
        return found[0], self.replacements[found[1] : self.replacements.index(b"\0", found[1])]

    def starts_none(self, character: str) -> bool:
        """Whether no mapped string begins with the character."""
        known = self._plain.get(character)
        if known is None:
            known = self._plain[character] = self._starts_none(character.encode())
        return known

    def _starts_none(self, data: bytes) -> bool:
        if self.units is None:
            return True
        unit = self.units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for byte in data:
            node ^= byte
            if node >= len(self.units) or self.units[node] & 0x800000FF != byte:
                return True
            unit = self.units[node]
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                return False
        return False


class PieceModel:
    """A byte-pair SentencePiece model.

    The text is normalised here; the library, with its own normalisation
    switched off, merges the normalised text. Models of another kind, with unused entries, or that write word marks
    behind the words are refused.
    """

    def __init__(self, serialized: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model_format

        model = model_format.ModelProto.FromString(serialized)
        trainer, rules = model.trainer_spec, model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if trainer.model_type != BPE or UNUSED in kinds or trainer.treat_whitespace_as_suffix or not rules.escape_whitespaces:
            raise ValueError("only byte-pair models with leading word marks and without unused entries")
        self.processor = SentencePieceProcessor(model_proto=serialized)
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.dummy_prefix, self.squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        own = sorted((p.piece for p in model.pieces if p.type == USER_DEFINED), key=len, reverse=True)
        self.own = re.compile("|".join(map(re.escape, own))) if own else None
        self.simple = not rules.precompiled_charsmap and not self.squeeze and self.own is None
        self.whole = BYTE in kinds
        self.end = trainer.eos_id
        self.widths = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        rules.precompiled_charsmap, rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces = b"", False, False, False
        self.merges = SentencePieceProcessor(model_proto=model.SerializeToString())

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its bytes (and its end) the source byte it stems from."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.uint32)
        if self.simple:
            codes = np.frombuffer(data, np.uint8)
            first = np.maximum.accumulate(np.where(codes & 0xC0 == 0x80, 0, np.arange(len(codes), dtype=np.uint32)))
            origin = np.repeat(first, np.where(codes == 0x20, 3, 1)).astype(np.uint32)
            lead = np.zeros(3 if self.dummy_prefix else 0, np.uint32)
            return MARK * self.dummy_prefix + text.replace(" ", MARK), np.concatenate([lead, origin, np.array([len(codes)], np.uint32)])
        parts, origin, at, after_space = [], [], 0, self.squeeze
        for taken, part in self._prefixes(text, data):
            if after_space and not parts:
                if part == b" ":
                    at += taken
                    continue
            if not parts and self.dummy_prefix:
                parts.append(MARK.encode())
                origin += [at] * 3
            if after_space:
                part = part.lstrip(b" ")
            if part:
                after_space = part.endswith(b" ")
                shown = part.replace(b" ", MARK.encode())
                parts.append(shown)
                origin += [at] * len(shown)
            elif not parts:
                parts.append(b"")
            at += taken
            if not self.squeeze:
                after_space = False
        whole, end, mark = b"".join(parts), at, MARK.encode()
        while self.squeeze and whole.endswith(mark):
            whole = whole[:-3]
            end = origin[len(whole)]
        return whole.decode(), np.array([*origin[: len(whole)], end], np.uint32)

    def _prefixes(self, text: str, data: bytes) -> Iterator[tuple[int, bytes]]:
        """Source bytes taken and their replacement, from left to right."""
        own = {m.start(): m.end() for m in self.own.finditer(text)} if self.own else {}
        at, i = 0, 0
        while i < len(text):
            if i in own:
                part = text[i : own[i]].encode()
                yield len(part), part
                at, i = at + len(part), own[i]
                continue
            character = text[i]
            hit = None if self.map.starts_none(character) else self.map.longest(data, at)
            if hit is None:
                part = character.encode()
                yield len(part), part
                at, i = at + len(part), i + 1
            else:
                yield hit
                i += len(data[at : at + hit[0]].decode())
                at += hit[0]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids without an end id, and the first and behind-last source byte of each."""
        normal, origin = self.normalise(text or "")
        ids = np.array(self.merges.encode(normal) if normal else [], np.uint32)
        if self.whole:
            widths = self.widths[ids]
        else:
            # The id of what is unknown doesn't tell its width.
            widths = np.array([len(p.encode()) for p in self.merges.encode(normal, out_type=str)] if normal else [], np.int64)
        borders = np.concatenate([np.zeros(1, np.int64), np.cumsum(widths)])
        if borders[-1] != len(origin) - 1:
            raise ValueError("the pieces do not cover the normalised text")
        return ids, origin[borders[:-1]], origin[borders[1:]]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, by the library."""
        return self.processor.decode(ids) if ids else ""


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The worker's model of a file."""
    if path not in _models:
        with open(path, "rb") as file:
            _models[path] = PieceModel(file.read())
    return _models[path]


def default_model() -> str:
    """The public model of 32,000 entries."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _rows(batches: Iterator[pa.RecordBatch], work: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``work`` on every row (as a tuple), handed on in batches of bounded size."""
    for batch in batches:
        out, size = [], 0
        for i in range(batch.num_rows):
            row = tuple(column[i].as_py() for column in batch.columns)
            size += sum(len(v) for v in row if isinstance(v, str | bytes))
            out.append(work(*row))
            if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out, size = [], 0


def _with_end(pieces: PieceModel, text: str | None, end: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, starts, ends = pieces.encode(text)
    if end:
        last = np.array([len((text or "").encode())], np.uint32)
        ids, starts, ends = np.append(ids, np.uint32(pieces.end)), np.append(starts, last), np.append(ends, last)
    return ids.astype("<u4"), starts.astype("<u4"), ends.astype("<u4")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")


def encode_documents(docs: DataFrame, path: str | None = None, end: bool = True) -> DataFrame:
    """``doc_id, ids, starts, ends`` of every whole text.

    The three columns hold little-endian unsigned 32-bit numbers: ids (with the
    model's end id last, if ``end``) and the source bytes [start, end) each id
    stands for; the end id stands for nothing at the end of the text. Of a
    character written as byte entries the last one carries its span. A null
    text counts as empty and has the end id alone. Rows are worked on one by one:
    repeated rows and null ids are kept as they are, an empty table gives an
    empty one, and other columns are left out.
    """
    path = path or default_model()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())])

    def run(batches):
        pieces = model(path)
        return _rows(batches, lambda doc_id, text: (doc_id, *(a.tobytes() for a in _with_end(pieces, text, end))), schema)

    return _texts(docs).mapInArrow(run, ENCODED)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""
    path = path or default_model()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        pieces = model(path)
        return _rows(batches, lambda doc_id, ids: (doc_id, pieces.decode(np.frombuffer(ids or b"", "<u4").tolist())), schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of ids and spans as in ``encode_documents``, and of the texts decoded from the ids.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256, source_bytes, spans_crc32``:
    the last two are the end of the last span and the crc32 of all starts and
    then all ends. Encoded and decoded in one pass, so that no ids move between processes.
    """
    path = path or default_model()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
                        ("source_bytes", pa.int64()), ("spans_crc32", pa.int64())])

    def run(batches):
        pieces = model(path)
        decimal = [str(i) for i in range(pieces.processor.get_piece_size())]

        def work(doc_id, text):
            ids, starts, ends = _with_end(pieces, text, True)
            each = ids.tolist()
            written = " ".join([decimal[i] for i in each])
            return (doc_id, len(each), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(pieces.decode(each).encode()).hexdigest(),
                    int(ends[-1]), zlib.crc32(ends.tobytes(), zlib.crc32(starts.tobytes())))

        return _rows(batches, work, schema)

    return _texts(docs).mapInArrow(run, DIGESTS)

"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read field by field; from it a tokenizers pipeline is
rebuilt: the normaliser (character map, white space rules, the metaspace mark
for a space and the mark in front of a text), the unigram scores or, for a BPE
model, the merges that its piece scores order, and byte fallback for what the
vocabulary lacks.

Whole texts are encoded in batches, each batch in one multithreaded call of the
library. The pieces' bytes put together are held against the normalised text
(round trip), and the sentencepiece library is the judge of the ids: it encodes
every whole text too, and its ids must be the same (parity).
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, decoders, models, normalizers

METASPACE = "▁"
#: Fixed values of the model format: model kinds and piece kinds.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_TEXT_BYTES = 1 << 19


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) fields of a protobuf message: numbers, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"unknown protobuf wire type {kind}")
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a SentencePiece model file says. Fields left out there have the format's defaults."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    whitespace_suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def read_model(data: bytes) -> Model:
    """Parse a SentencePiece model protobuf."""
    out = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            out.pieces.append((piece, score, kind))
        elif number == 2:
            trainer = dict(_fields(value))
            out.kind = trainer.get(3, UNIGRAM)
            out.whitespace_suffix = bool(trainer.get(24, 0))
            out.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            rules = dict(_fields(value))
            out.charsmap = rules.get(2, b"")
            out.dummy_prefix = bool(rules.get(3, 1))
            out.remove_extra = bool(rules.get(4, 1))
            out.escape = bool(rules.get(5, 1))
    if out.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if any(p[2] == USER_DEFINED for p in out.pieces) or out.whitespace_suffix or not out.escape:
        raise ValueError("user-defined pieces, white space as a suffix and unescaped white space are not supported")
    return out


def _merges(model: Model) -> list[tuple[str, str]]:
    """Every way to join two pieces to a third, best score first (then by ids)."""
    normal = {p: (s, i) for i, (p, s, k) in enumerate(model.pieces) if k in (NORMAL, UNUSED)}
    found = []
    for piece, (score, _) in normal.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in normal and right in normal:
                found.append((-score, normal[left][1], normal[right][1], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def normalizer(model: Model) -> normalizers.Normalizer:
    steps: list[normalizers.Normalizer] = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(METASPACE))
    return normalizers.Sequence([*steps, normalizers.Replace(" ", METASPACE)])


def build(model: Model) -> tokenizers.Tokenizer:
    """The tokenizers pipeline of a model. Control pieces are never matched in a text."""
    if model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(
            vocab, _merges(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback
        )
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    out = tokenizers.Tokenizer(core)
    out.normalizer = normalizer(model)
    steps = [decoders.Replace(METASPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(steps)
    return out


class Codec:
    """Encodes and decodes batches of texts with a model.

    With a ``judge`` (the sentencepiece library's processor of the same model)
    every whole text's ids are compared with the judge's.
    """

    def __init__(self, data: bytes, judge: sentencepiece.SentencePieceProcessor | None = None) -> None:
        self.model = read_model(data)
        self.judge = judge
        self.whole = build(self.model)
        self.normalise = self.whole.normalizer.normalize_str
        # the bytes that a piece stands for; control and unknown pieces stand for none
        self.bytes_of = pa.array(
            [bytes([int(p[3:5], 16)]) if k == BYTE else p.encode() if k in (NORMAL, UNUSED) else None for p, _, k in self.model.pieces],
            pa.large_binary(),
        )
        plain = not self.model.charsmap and not self.model.remove_extra
        self.simple = plain and self.model.dummy_prefix  # the normaliser is a prefix and a replacement
        # texts are normalised once, for their ids and for the round trip
        self.whole.normalizer = None

    def normal(self, text: str) -> str:
        if not self.simple:
            return self.normalise(text)
        return METASPACE + text.replace(" ", METASPACE) if text else ""

    def _ids(self, normal: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self.whole.encode_batch_fast(list(normal), add_special_tokens=False)]

    def _stand_for(self, normal: Sequence[str], ids: Sequence[Sequence[int]]) -> list[bool]:
        """Whether the ids of each text decode to its normalised form: their bytes put together are its bytes."""
        said = self.bytes_of.take(pa.array(np.concatenate([np.asarray(i, np.int32) for i in ids])))
        ends = np.cumsum([0, *map(len, ids)])
        size = pc.fill_null(pc.binary_length(said), 0).to_numpy(zero_copy_only=False)
        places, unsaid = (np.concatenate([[0], np.cumsum(x)])[ends].tolist() for x in (size, pc.is_null(said).to_numpy(zero_copy_only=False)))
        data = memoryview(said.buffers()[2] or b"")
        return [
            unsaid[i] == unsaid[i + 1] and bytes(data[places[i] : places[i + 1]]) == n.encode() for i, n in enumerate(normal)
        ]

    def _stands_for(self, text: str, ids: Sequence[int]) -> bool:
        return self._stand_for([self.normal(text)], [ids])[0]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [np.array(ids, np.int32) for ids in self._ids(list(map(self.normal, texts)))]

    def encode_checked(self, texts: Sequence[str]) -> list[tuple[np.ndarray, bool, bool]]:
        """The ids of each text, whether decoding them gives its normalised form back,
        and whether the judge, if any, has the same ids."""
        if not texts:
            return []
        normal = list(map(self.normal, texts))
        found = self._ids(normal)
        told = found if self.judge is None else self.judge.encode(list(texts), num_threads=1)
        arrays = [np.array(ids, np.int32) for ids in found]
        same = [ids == other for ids, other in zip(found, told)]
        return list(zip(arrays, self._stand_for(normal, arrays), same))

    def decode(self, ids: Sequence[Sequence[int]]) -> list[str]:
        return self.whole.decode_batch([list(map(int, x)) for x in ids], skip_special_tokens=False)


@lru_cache(maxsize=2)
def _codec(data: bytes, judged: bool) -> Codec:
    """The codec of a Python worker, kept from task to task."""
    # a task's share of the cores; the library's pool would take all of the machine's for each worker
    task = TaskContext.get()
    os.environ.setdefault("RAYON_NUM_THREADS", str(task.cpus() if task else 1))
    return Codec(data, sentencepiece.SentencePieceProcessor(model_proto=data) if judged else None)


def load(spark: SparkSession, path: str) -> bytes:
    """The model file's bytes, read by Spark from any store that it reads (one file of a fixed model)."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about _TEXT_BYTES bytes of text."""
    lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    sizes = np.cumsum(lengths.astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _TEXT_BYTES)))
        yield batch.slice(at, end - at)
        at = end


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, ids, round_trip) for each row of ``docs``: the whole text's ids, and whether
    they decode to its normalised form. A null text has null ids and round_trip, an empty one
    no ids. Repeated rows keep their rows; other columns are ignored."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, False)
        for batch in batches:
            for some in _batches(batch):
                texts = some["text"].to_pylist()
                found = codec.encode_checked([t or "" for t in texts])
                ids = pa.array([None if t is None else i for t, (i, _, _) in zip(texts, found)], pa.list_(pa.int32()))
                same = pa.array([None if t is None else s for t, (_, s, _) in zip(texts, found)], pa.bool_())
                yield pa.record_batch([some["doc_id"], ids, same], ["doc_id", "ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): null ids give null, no ids an empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, False)
        for batch in batches:
            ids = batch["ids"].to_pylist()
            texts = codec.decode([i or [] for i in ids])
            texts = pa.array([None if i is None else t for i, t in zip(ids, texts)], pa.string())
            yield pa.record_batch([batch["doc_id"], texts], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def crc32_of_ids(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<i4").tobytes())


def encode_digest(docs: DataFrame, model: bytes, judge: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip, parity) for each row of ``docs``.

    Encodes like :func:`encode` without keeping the ids. ``parity`` tells whether
    the sentencepiece library gives the same ids to the whole text (null unless ``judge``). A null text has nulls.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, judge)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        for batch in batches:
            for some in _batches(batch):
                rows = []
                texts = some["text"].to_pylist()
                found = codec.encode_checked([t or "" for t in texts])
                for doc, text, (ids, same, parity) in zip(some["doc_id"].to_pylist(), texts, found):
                    said = (len(ids), crc32_of_ids(ids), same, parity if judge else None)
                    rows.append((doc, *(said if text is not None else [None] * 4)))
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n_tokens", "ids_crc32", "round_trip", "parity"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, parity boolean"
    )

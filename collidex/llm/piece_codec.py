"""Operator 12: byte-level BPE encoding and decoding through a sentencepiece model.

The vocabulary (a file of byte strings and ranks) is serialised as a sentencepiece
BPE model: bytes become the printable signs of byte-level vocabularies, each piece's
score is its negative rank, and the normaliser changes nothing. The text is cut into
pre-tokens by the vocabulary's pattern, the model encodes each of them, and decoding
maps ids back to pieces and signs back to bytes. Nothing is trained.
"""

from __future__ import annotations

import base64
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import table

#: Pre-tokens remembered by one worker (beyond that it starts anew between batches), and their longest length in signs.
CACHE_WORDS, CACHE_LENGTH = 400_000, 40
#: Types of the model file's fields: piece, piece score and kind, model kind, normaliser switches.
NORMAL, UNKNOWN, BPE = 1, 2, 2
#: A sign that is neither letter, number nor white space in every version of Unicode.
OTHER_SIGN = "\u2020"


def byte_signs() -> list[str]:
    """The sign of each byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    return [chr(b) if own[b] else chr(256 + b - sum(own[:b])) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message: bytes are length-delimited, floats fixed, integers varints."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model whose piece number i is the token of the i-th smallest rank."""
    signs = byte_signs()
    out = bytearray()
    for token in sorted(ranks, key=ranks.__getitem__):
        piece = "".join(map(signs.__getitem__, token)).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-ranks[token])) + _field(3, NORMAL))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN))
    out += _field(2, _field(3, BPE) + _field(4, len(ranks) + 1) + _field(40, len(ranks)))
    out += _field(3, _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


def newer_signs() -> list[tuple[int, int]]:
    """Ranges of code points that are letters and numbers to the split pattern's engine, but not to the library's (their Unicode versions differ).

    Only signs that are unassigned in Python's own, older tables can differ; the library is asked about each of these.
    """
    import regex
    import tiktoken

    late = "".join(ch for ch in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if unicodedata.category(ch) == "Cn")
    late = "".join(regex.findall(r"[\p{L}\p{N}]", late))
    probe = tiktoken.Encoding("probe", pat_str=r"\p{L}|\p{N}", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    ranges: list[tuple[int, int]] = []
    for cp in sorted(map(ord, set(late) - set(probe.decode(probe.encode_ordinary(late))))):
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1] = ranges[-1][0], cp
        else:
            ranges.append((cp, cp))
    return ranges


class Codec:
    """Encoder and decoder of one vocabulary. ``special`` strings inside texts are ordinary text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.findall = regex.compile(pattern).findall
        newer = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in newer_signs())
        self.newer = re.compile(f"[{newer}]") if newer else None
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.ranks = ranks
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.rank_of = np.array([ranks[t] for t in tokens], "<u4")
        signs = byte_signs()
        self.sign = dict(enumerate(signs))
        to_byte = {s: b for b, s in enumerate(signs)}
        self.bytes_of = {r: bytes(map(to_byte.__getitem__, self.model.id_to_piece(i))) for i, r in enumerate(self.rank_of.tolist())}
        self.cache: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The text's pre-tokens, in order."""
        if text.isascii() or self.newer is None or not self.newer.search(text):
            return self.findall(text)
        out, at = [], 0
        for part in self.findall(self.newer.sub(OTHER_SIGN, text)):
            out.append(text[at:at + len(part)])
            at += len(part)
        return out

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each pre-token as little-endian bytes. A pre-token that is itself a token is that token."""
        out, todo = {}, []
        for w in words:
            raw = w.encode()
            if (r := self.ranks.get(raw)) is not None:
                out[w] = struct.pack("<I", r)
            else:
                todo.append((w, "".join(map(self.sign.__getitem__, raw))))
        if todo:
            for (w, _), pieces in zip(todo, self.model.encode([s for _, s in todo], out_type=int, num_threads=1)):
                out[w] = self.rank_of[pieces].tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text, as little-endian unsigned 32-bit integers. All new pre-tokens go to the model in one call."""
        split, cache = [self.split(t) for t in texts], self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        got = self._words(list({w for words in split for w in words if w not in cache}))
        long = {w: got.pop(w) for w in list(got) if len(w) > CACHE_LENGTH}
        cache.update(got)
        return [b"".join([cache[w] if w in cache else long[w] for w in words]) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(file: str) -> Codec:
    import public_tokenizers
    with open(public_tokenizers.path(file), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Codec(ranks, public_tokenizers.PATTERN)


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def encode(docs: DataFrame, file: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids`` (binary: little-endian unsigned 32-bit integers), one row per row of ``docs``.

    A null text counts as empty and has no ids. Null ids and repeated rows each give their
    row, other columns are not read, an empty table gives an empty result. Texts and
    pre-tokens of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        for b in batches:
            for part in _parts(b):
                ids = c.encode(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, file: str = VOCABULARY) -> DataFrame:
    """The inverse: ``doc_id, n_tokens, ids, bytes`` of ``doc_id, ids``. Null ids count as none; unknown ids raise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        for b in batches:
            for part in _parts(b):
                ids = [x or b"" for x in part.column(1).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([c.decode(x) for x in ids], pa.binary())], names=["doc_id", "n_tokens", "ids", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, bytes binary")


def _parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that few long texts and their ids are held at a time."""
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode(encode(table(spark, sf_dir, "documents")))
    return d.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))

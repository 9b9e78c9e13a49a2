"""BPE encoding and decoding with reuse of content-defined chunks."""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from hotrank.llm.common import pick, read, small, texts

TOKENIZER = "byte_bpe_50k.json"
#: A chunk ends after one in this many bytes, on average.
SPACING = 512
#: Bytes the rolling hash looks at: 2**_DOUBLINGS.
_DOUBLINGS = 5
#: Bytes of chunks, and of longest chunk, that a task remembers in each of two generations.
_MEMO, _LONGEST = 24 << 20, 1 << 14
#: Texts of these bytes only (code points below U+0370, in every Unicode version alike) and of this
#: length at most take the quicker of two libraries with the same vocabulary and pattern.
_EARLY, _SHORT = re.compile(rb"(?:[\x00-\x7F]|[\xC2-\xCC][\x80-\xBF])*"), 1 << 14
#: Fixed value: how the vocabulary's texts are split before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank between characters that pre-tokenisation never joins across: text before it and from
#: it on is encoded apart as it is together. Added tokens hold no blank.
_SAFE = re.compile(rb"(?:[\x21-\x7E]|\xC3[\x80-\xBF]) (?=[\x21-\x7E]|\xC3[\x80-\xBF])")


def chunk_ends(text: bytes, spacing: int = SPACING) -> list[int]:
    """Where content-defined chunks end: after characters whose rolling hash hits one in ``spacing``.

    The hash of the last 32 bytes follows from two hashes of half the length, five times over.
    """
    data = np.frombuffer(text, np.uint8)
    if len(data) < 64:
        return [len(text)] if text else []
    rolled = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    rolled ^= rolled >> np.uint32(15)
    factor = 0x85EBCA6B
    for i in range(_DOUBLINGS):
        earlier = rolled[: -(1 << i)] * np.uint32(factor)
        rolled[1 << i :] += earlier
        factor = factor * factor & 0xFFFFFFFF
    hit = (rolled >> np.uint32(8)) % np.uint32(spacing) == 0
    # Only before a character's first byte.
    hit[:-1] &= (data[1:] & 0xC0) != 0x80
    ends = (np.flatnonzero(hit[:-1]) + 1).tolist()
    return [*ends, len(text)]


def inner(chunk: bytes) -> tuple[int, int] | None:
    """First and last safe cut of a chunk, None if it has none."""
    first = _SAFE.search(chunk)
    if not first:
        return None
    start = first.end() - 1
    at = chunk.rfind(b" ")
    while at > start and not _SAFE.match(chunk, at - 1) and not _SAFE.match(chunk, at - 2):
        at = chunk.rfind(b" ", 0, at)
    return start, max(start, at)


def token_bytes(path: str) -> list[bytes]:
    """What each id decodes to: byte-level characters back to bytes, added tokens as they are."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    of_char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = spec["model"]["vocab"]
    added = {t["id"]: t["content"] for t in spec["added_tokens"]}
    table = [b""] * (1 + max([*vocabulary.values(), *added]))
    for token, i in vocabulary.items():
        table[i] = bytes(of_char[c] for c in token)
    for i, token in added.items():
        table[i] = token.encode()
    return table


class Encoder:
    """Encodes texts, each chunk once as long as it is remembered."""

    def __init__(self, path: str, spacing: int = SPACING):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.spacing = spacing
        self.bytes_of = token_bytes(path)
        self.quick = tiktoken.Encoding(
            "quick", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                x: i for i, x in enumerate(self.bytes_of) if x not in self.added},
        )
        self.digits = [b"%d" % i for i in range(len(self.bytes_of))]
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}
        self.size = 0
        self.encoded = self.reused = 0

    def _encode(self, parts: list[bytes]) -> list[list[int]]:
        quick = [
            len(p) <= _SHORT and _EARLY.fullmatch(p) and not any(x in p for x in self.added)
            for p in parts
        ]
        rest = iter(self.tokenizer.encode_batch_fast(
            [p.decode() for p, q in zip(parts, quick) if not q], add_special_tokens=False))
        ordinary = self.quick.encode_ordinary
        return [ordinary(p.decode()) if q else next(rest).ids for p, q in zip(parts, quick)]

    def _recall(self, chunk: bytes):
        entry = self.young.get(chunk)
        if entry is None and (entry := self.old.get(chunk)) is not None:
            self._remember(chunk, entry)
        return entry

    def _remember(self, chunk: bytes, entry: tuple) -> None:
        if len(chunk) > _LONGEST:
            return
        if self.size > _MEMO:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[chunk] = entry
        self.size += len(chunk)

    def encode(self, many: list[bytes]) -> list[list[tuple[int, bytes, bytes]]]:
        """For each text parts of (number of ids, ids in digits, decoded bytes).

        Chunks are encoded between their first and last safe cut. What lies around a join, from
        the last safe cut before to the first one after it, is encoded again as one; where a
        chunk has none, the stretch grows over it. At safe cuts both sides agree with the
        encoding of the whole text.
        """
        cut, fresh = [], {}
        for text in many:
            ends = chunk_ends(text, self.spacing)
            chunks = [text[a:b] for a, b in zip([0, *ends], ends)]
            for chunk in chunks:
                if chunk in fresh or self._recall(chunk) is not None:
                    self.reused += 1
                else:
                    fresh[chunk] = None
            cut.append(chunks)
        new = [(chunk, inner(chunk)) for chunk in fresh]
        self.encoded += len(new)
        ids = iter(self._encode([chunk[span[0] : span[1]] for chunk, span in new if span]))
        for chunk, span in new:
            fresh[chunk] = (span, self._part(next(ids)) if span else None)
            self._remember(chunk, fresh[chunk])
        joins: dict[bytes, tuple | None] = {}
        texts_parts = []
        for chunks in cut:
            parts, open_from = [], b""
            for chunk in chunks:
                span, part = fresh[chunk] if chunk in fresh else self._recall(chunk) or self._again(chunk)
                if span is None:
                    open_from += chunk
                    continue
                parts += [open_from + chunk[: span[0]], part]
                open_from = chunk[span[1] :]
            parts.append(open_from)
            for p in parts[::2]:
                joins[p] = None
            texts_parts.append(parts)
        for join, found in zip(list(joins), self._encode(list(joins))):
            joins[join] = self._part(found)
        return [[joins[p] if isinstance(p, bytes) else p for p in parts] for parts in texts_parts]

    def _again(self, chunk: bytes) -> tuple:
        """A chunk forgotten since it was looked up."""
        span = inner(chunk)
        return span, self._part(self._encode([chunk[span[0] : span[1]]])[0]) if span else None

    def _part(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        digits, decoded = self.digits, self.bytes_of
        return (
            len(ids), b",".join([digits[i] for i in ids]), b"".join([decoded[i] for i in ids])
        )


def digest(parts: list[tuple[int, bytes, bytes]]) -> tuple[int, str, str]:
    filled = [p for p in parts if p[0]]
    decoded = b"".join([p[2] for p in filled]).decode(errors="replace")
    return (
        sum(p[0] for p in filled),
        hashlib.sha256(b",".join([p[1] for p in filled])).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def encode_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Digests of each whole text's ids and of their decoding; one row per row of ``docs``.

    ``with_ids`` adds the ids themselves. Documents are cut at content-defined places, and a
    chunk that a task meets again, in this or another document, is not encoded again. Chunks are
    remembered within a task and in bounded memory: shuffling all texts and ids to share them
    between tasks would move more bytes than encoding anew costs. No shuffle. Null texts are
    empty: no ids. The tokenizer's file must be readable on the executors under ``path``.
    """
    import pyarrow as pa

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    rows = pick(docs, doc_id=id_col, text=text_col)

    def run(batches):
        encoder = Encoder(path)
        for batch in small(batches, 2 << 20):
            parts = encoder.encode(texts(batch.column("text")))
            made = [digest(p) for p in parts]
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate(
                (pa.int64(), pa.string(), pa.string()))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(
                    [[int(i) for p in ps if p[0] for i in p[1].split(b",")] for ps in parts],
                    pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_texts(read(spark, folder, "documents"))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return encode_texts(docs)

"""Encoding of whole texts in tasks, with the tokenizers library.

Texts are cut where the tokenizer cuts them anyway (at spaces), and the ids of
the parts are remembered, so the library sees each frequent part once a task
instead of every time. Parts that are plain words go straight to the library's
merge model; everything else takes its whole way. Tokenizers of other kinds
encode each text whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_columns

#: Bounds of what a worker remembers: parts as they stand in texts, and the words in them.
CACHE_PARTS, CACHE_WORDS = 800_000, 300_000
CACHED_CHARS = 64
SLICE_ROWS = 256  #: texts turned into Python strings at a time
DECODED_IDS = 1 << 16  #: ids turned into bytes at a time


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters whose lower case is one letter, in composed form: here lower-casing and composing have no context.
_LATIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


def _latin_classes() -> bytes:
    """For each Latin-1 character: a letter or number, white space, ``.`` for full stop and comma, other marks as ``p``.

    ``!`` are the four characters that Python alone takes for white space.
    """

    def one(c: str) -> str:
        if c in ".,":
            return "."
        if "\x1c" <= c <= "\x1f":
            return "!"
        return " " if c.isspace() else "a" if unicodedata.category(c)[0] in "LN" else "p"

    return "".join(one(chr(i)) for i in range(256)).encode()


_CLASSES = _latin_classes()
_DOUBLE_SPACE = re.compile(r"\s\s").search
_SPACE_AFTER_TEXT = re.compile(r"(?<=\S)(?= )")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class PartEncoder(dict):
    """Ids of texts, as little-endian bytes of ``dtype``; the mapping is of parts already encoded."""

    def __init__(self, path: str):
        # Spark runs a worker on each core; the library would start as many threads in each again
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        self._code = "H" if self.dtype == "<u2" else "I"
        self._alphabet = _byte_alphabet()
        self._latin = {i: "".join(map(self._alphabet.__getitem__, chr(i).encode())) for i in range(128, 256)}
        width = 2 if self._code == "H" else 4
        self._packed = [i.to_bytes(width, "little") for i in range(self.size)]
        # where a text may be cut: at spaces if they are dropped, before them if they lead their word
        spec = json.loads(self.tokenizer.to_str())
        self.style = self._style(spec)
        self._words: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})  # without and with a leading space
        self._marks = {m: self._merge(m, False) for m in ".,\n"} if self.style != "whole" else {}

    @staticmethod
    def _style(spec: dict) -> str:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        model = spec.get("model") or {}
        plain = (
            model.get("type") == "BPE"
            and spec.get("post_processor") is None
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback"))
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
        )
        if not plain:
            return "whole"
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "lead"
        steps = [s.get("type") for s in pre.get("pretokenizers", [])]
        norms = [s.get("type") for s in (norm or {}).get("normalizers", [])]
        if steps == ["Split", "ByteLevel"] and norms == ["NFC", "Replace", "Lowercase"]:
            split = pre["pretokenizers"][0]
            pattern = split["pattern"].get("Regex", "")
            drops = split["behavior"] == "Removed" and split["invert"] and r"[^\s\p{L}\p{N}]+" in pattern
            if drops and r"[\p{L}]+" in pattern and model.get("end_of_word_suffix"):
                return "drop"
        return "whole"

    @cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The bytes behind all ids one after another, where those of an id begin, and how many; None unless byte-level."""
        if (json.loads(self.tokenizer.to_str()).get("decoder") or {}).get("type") != "ByteLevel":
            return None
        back, tokens = {c: b for b, c in self._alphabet.items()}, [b""] * self.size
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            if i >= self.size:  # numbers with gaps
                return None
            tokens[i] = bytes(map(back.__getitem__, token)) if all(c in back for c in token) else token.encode()
        sizes = np.array([len(t) for t in tokens], np.int32)
        return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes, dtype=np.int32) - sizes, sizes

    def decode(self, encoded: list[np.ndarray]) -> pa.Array:
        """The texts of sequences of ids, as the library decodes them, special tokens included."""
        if self._bytes is not None:
            table, start, size = self._bytes
            ids, parts = np.concatenate([np.zeros(0, "<u4"), *encoded]), []
            ends = np.cumsum([0, *map(len, encoded)])
            behind = np.concatenate([[0], np.cumsum(size[ids], dtype=np.int64)])[ends]
            for at in range(0, len(ids), DECODED_IDS):
                n = size[some := ids[at : at + DECODED_IDS]]
                first = start[some] - (np.cumsum(n, dtype=np.int32) - n)
                parts.append(table[np.repeat(first, n) + np.arange(n.sum(), dtype=np.int32)])
            data = np.concatenate([np.zeros(0, np.uint8), *parts])
            buffers = [None, pa.py_buffer(behind.astype(np.int64)), pa.py_buffer(data)]
            try:
                return pa.Array.from_buffers(pa.large_binary(), len(encoded), buffers).cast(pa.large_string()).cast(pa.string())
            except pa.ArrowInvalid:  # no text: the library puts its mark in place of such bytes
                pass
        return pa.array(self.tokenizer.decode_batch([x.tolist() for x in encoded], skip_special_tokens=False), pa.string())

    def library_ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _merge(self, word: str, lead: bool) -> bytes:
        if not word.isascii() or word == "\n":
            word = self._alphabet[10] if word == "\n" else word.translate(self._latin)
        tokens = self.tokenizer.model.tokenize(self._alphabet[32] + word if lead else word)
        return b"".join([self._packed[t.id] for t in tokens])

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _plain(self, part: str, lead: bool) -> bytes | None:
        """Ids of a word with a full stop or comma after it, if any; None if ``part`` is anything else."""
        mark = self._marks.get(part[-1:], b"")
        word = part[:-1] if mark else part
        if not word.isalpha() or not (word.isascii() or _LATIN_WORD(word)):
            return None
        known = self._words[lead]
        found = known.get(word)
        if found is None:
            found = self._merge(word, lead)
            if len(word) <= CACHED_CHARS:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                known[word] = found
        return found + mark

    def __missing__(self, part: str) -> bytes:
        """``part`` is what stands between two spaces; the space before it belongs to it in style ``lead``."""
        if self.style == "drop" and part.isalpha() and (part.isascii() or _LATIN_WORD(part)):
            packed = self._merge(part.lower(), False)
            if len(part) <= CACHED_CHARS:
                if len(self) >= CACHE_PARTS:
                    self.clear()
                self[part] = packed
            return packed
        lead = self.style == "lead"
        packed = self._plain(part, True) if lead else None
        if packed is None and lead and part.count("\n") == 1:
            # a single line break between words is a token of its own, and the next word has no space
            left, right = part.split("\n")
            left, right = self._plain(left, True), self._plain(right, False)
            packed = None if left is None or right is None else left + self._marks["\n"] + right
        if packed is None:
            packed = self._pack(self.library_ids(" " + part if lead else part))
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHE_PARTS:
                self.clear()
            self[part] = packed
        return packed

    @staticmethod
    def _dropped_spaces(text: str) -> list[str]:
        """Parts of a text whose white space means nothing.

        In Latin text, lower case has no context, and a full stop or comma that
        touches no other mark stands alone; then words and marks are parts.
        """
        try:
            classes = text.encode("latin-1").translate(_CLASSES)
        except UnicodeEncodeError:
            classes = b"!"
        if b"!" in classes or b".." in classes or b".p" in classes or b"p." in classes or "<|" in text:
            return text.replace("\n", " ").split(" ")
        return text.lower().replace(".", " . ").replace(",", " , ").split()

    def encode(self, text: str) -> bytes:
        """The ids of the whole text, as the library gives them without special tokens added."""
        if self.style == "whole":
            return self._pack(self.library_ids(text))
        if self.style == "drop":
            return b"".join(map(self.__getitem__, self._dropped_spaces(text)))
        if _DOUBLE_SPACE(text):
            first, *rest = _SPACE_AFTER_TEXT.split(text)
            rest = [p[1:] for p in rest]
        else:
            first, *rest = text.split(" ")
        return self._pack(self.library_ids(first)) + b"".join(map(self.__getitem__, rest))


_encoders: dict[str, PartEncoder] = {}


def encoder(path: str) -> PartEncoder:
    """This worker process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = PartEncoder(path)
    return _encoders[path]


def text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def encoded_documents(docs: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """doc_id, n_tokens and ``ids`` (little-endian, two bytes an id if the vocabulary allows) of every document.

    ``end_id``, if any, follows the ids of each text.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = b"" if end_id is None else own._pack([end_id])
        width = np.dtype(own.dtype).itemsize
        for batch in text_slices(batches):
            ids = [own.encode(t) + end for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // width for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return document_columns(docs).mapInArrow(encode, "doc_id long, n_tokens long, ids binary")


def wide(ids: bytes, dtype: str) -> np.ndarray:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, dtype).astype("<u4")


def documents_of(docs: DataFrame) -> DataFrame:
    return document_columns(docs).withColumn("order", F.xxhash64("text"))

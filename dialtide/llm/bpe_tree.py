"""Byte-level BPE of whole texts, long ones in parallel, by tree concatenation.

A long text is cut into pieces that tasks encode side by side. Neighbours are
then joined, two by two, up a tree: the text around a join is encoded once more
in a window that grows until its first id agrees with the left side and its
last one with the right side. All neighbouring ids then also stand side by side
in an encoding of the library, which is what makes a sequence the encoding of
its text; and between the agreeing ids the library itself has split the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_columns
from .tokens import PartEncoder, default_path, encoder, text_slices, wide

PIECE_CHARS = 32_768
WINDOW_IDS = 4

ENCODED = "doc_id long, ids binary, decoded string"


class Joiner:
    """Joins encodings of neighbouring texts."""

    def __init__(self, own: PartEncoder):
        self.own = own
        tokenizer = own.tokenizer
        self.specials = sorted({t.content for t in tokenizer.get_added_tokens_decoder().values()})
        back = {c: b for b, c in own._alphabet.items()}
        sizes = np.zeros(own.size, np.int64)
        for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
            sizes[i] = len(token.encode()) if token in self.specials or not all(c in back for c in token) else len(token)
        self.sizes = sizes  #: bytes of text behind each id

    def cuts(self, text: str, size: int) -> list[int]:
        """Ends of pieces of about ``size`` characters; none lies inside a special token's text."""
        ends, at = [], size
        while at < len(text):
            cut = at
            for s in self.specials:
                found = text.find(s, max(cut - len(s) + 1, 0), cut + len(s) - 1)
                if 0 <= found < cut:
                    cut = found
            if cut > (ends[-1] if ends else 0):
                ends.append(cut)
            at += size
        return [*ends, len(text)]

    @staticmethod
    def _inside(text: bytes, at: int) -> bool:
        return 0 < at < len(text) and text[at] & 0xC0 == 0x80

    def join(self, text: bytes, left: np.ndarray, right: np.ndarray, middle: int, first: int, last: int) -> np.ndarray:
        """Ids of ``text[first:last]`` from those of ``text[first:middle]`` and ``text[middle:last]``."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        k = WINDOW_IDS
        while True:
            i, j = max(len(left) - k, 0), min(k, len(right))
            start = middle - int(self.sizes[left[i:]].sum())
            end = middle + int(self.sizes[right[:j]].sum())
            while self._inside(text, start):  # whole characters only
                i -= 1
                start -= int(self.sizes[left[i]])
            while self._inside(text, end):
                end += int(self.sizes[right[j]])
                j += 1
            window = np.frombuffer(self.own._pack(self.own.library_ids(text[start:end].decode())), self.own.dtype)
            agrees_left = i == 0 or window[0] == left[i]
            agrees_right = j == len(right) or window[-1] == right[j - 1]
            if agrees_left and agrees_right:
                return np.concatenate([left[:i], window, right[j:]])
            k *= 2

    def tree(self, pieces: list[str], ids: list[np.ndarray]) -> np.ndarray:
        """Ids of the joined pieces, from the ids of each."""
        parts = [p.encode() for p in pieces]
        text = b"".join(parts)
        ends = np.cumsum([0, *map(len, parts)]).tolist()
        nodes = [(ends[n], ends[n + 1], x) for n, x in enumerate(ids)]
        while len(nodes) > 1:
            joined = [
                (a[0], b[1], self.join(text, a[2], b[2], a[1], a[0], b[1])) for a, b in zip(nodes[::2], nodes[1::2])
            ]
            nodes = joined + ([nodes[-1]] if len(nodes) % 2 else [])
        return nodes[0][2]


def _finished(own: PartEncoder, doc_ids: list, encoded: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array([x.tobytes() for x in encoded], pa.binary()), own.decode(encoded)],
        names=["doc_id", "ids", "decoded"],
    )


def bpe_round_trip(docs: DataFrame, tokenizer: str | None = None, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Every document's ids (32-bit, little-endian) and the text they decode to.

    Ids are those of the library for the whole text, without added special
    tokens, truncation or padding; a special token's text counts as that token.
    A null or empty text has no ids. Repeated rows are encoded each, an empty
    table gives an empty result, and other columns are not read. Texts of more
    than ``piece_chars`` characters are cut, encoded in parallel and joined;
    only they are shuffled.

    Returns doc_id, ids, decoded.
    """
    path = tokenizer or default_path("byte_bpe_50k.json")
    texts = document_columns(docs)
    small = F.char_length("text") <= piece_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in text_slices(batches):
            encoded = [wide(own.encode(t), own.dtype) for t in batch.column("text").to_pylist()]
            yield _finished(own, batch.column("doc_id").to_pylist(), encoded)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner = Joiner(encoder(path))
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                ends = joiner.cuts(one["text"], piece_chars)
                parts = [one["text"][a:b] for a, b in zip([0, *ends], ends)]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([one["row"]] * n, pa.int64()),
                        pa.array([one["doc_id"]] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array(parts, pa.string()),
                    ],
                    names=["row", "doc_id", "k", "piece"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                ids = own.encode(one.column("piece").to_pylist()[0])
                yield pa.RecordBatch.from_arrays(
                    [*one.columns, pa.array([ids], pa.binary())], names=["row", "doc_id", "k", "piece", "ids"]
                )

    def join(table: pa.Table) -> pa.Table:
        own = encoder(path)
        table = table.sort_by("k")
        ids = [np.frombuffer(x, own.dtype) for x in table.column("ids").to_pylist()]
        result = Joiner(own).tree(table.column("piece").to_pylist(), ids)
        return pa.Table.from_batches([_finished(own, [table.column("doc_id")[0].as_py()], [result.astype("<u4")])])

    piece = "row long, doc_id long, k int, piece string"
    pieces = (
        texts.filter(~small)
        .withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(cut, piece)
        .repartition("row", "k")
        .mapInArrow(encode, piece + ", ids binary")
    )
    joined = pieces.groupBy("row").applyInArrow(join, ENCODED)
    return texts.filter(small).mapInArrow(whole, ENCODED).union(joined)

"""Byte-level BPE of whole texts by tree reduction: halves are encoded on their own, neighbours joined at their seam.

A *cut* is a white-space character of the list below right after a character that is no white space. Every match of the
pattern ends at or before a cut, since no alternative of it goes on from such a character into white space, and its only
look-ahead concerns white space at the end of a run, of which there is none left of a cut. The pattern never looks back.
So the ids of ``a + b`` are those of ``a`` followed by those of ``b`` whenever the seam is a cut. When two halves are joined,
the window between the last cut on the left and the first one on the right is therefore encoded anew, and all ids outside
of it stay; where a half has no cut, the window grows over it whole and on into the next join.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from ludoscope.llm.frames import ready

#: Code points of a text that is encoded at once.
LEAF = 1024
_CUT = re.compile(r"(?<=\S)[ \n\t\r]")
Encoder = Callable[[str], list[int]]


def load_ranks(path: str, pattern: str) -> tiktoken.Encoding:
    """The vocabulary of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_tables(path: str, pattern: str) -> tuple[list[str], list[bytes]]:
    """Each id's decimal text and its bytes."""
    encoding = load_ranks(path, pattern)
    return [str(i) for i in range(encoding.n_vocab)], [encoding.decode_single_token_bytes(i) for i in range(encoding.n_vocab)]


@dataclass(slots=True)
class Part:
    """An encoded stretch: its ids, the text before its first cut with the number of ids it has, and that from its last cut on."""

    ids: list[int]
    head: str
    n_head: int
    tail: str
    n_tail: int
    cut: bool


def _last_cut(text: str) -> int:
    """Where the last cut is, looked for in growing windows from the end; -1 if there is none."""
    reach = 64
    while True:
        low = max(0, len(text) - reach)
        found = -1
        for m in _CUT.finditer(text, low):
            found = m.start()
        if found >= 0 or low == 0:
            return found
        reach *= 8


def leaf(text: str, encode: Encoder) -> Part:
    """A short stretch encoded at once."""
    first = _CUT.search(text)
    if first is None:
        ids = encode(text)
        return Part(ids, text, len(ids), text, len(ids), False)
    a, b = first.start(), _last_cut(text)
    head, middle, tail = encode(text[:a]), encode(text[a:b]), encode(text[b:])
    return Part(head + middle + tail, text[:a], len(head), text[b:], len(tail), True)


def join(left: Part, right: Part, encode: Encoder) -> Part:
    """The associative step: only the window between the nearest cuts of two neighbours is encoded anew."""
    if not (left.cut or right.cut) and _CUT.match(left.tail[-1:] + right.head[:1], 1):
        return Part(left.ids + right.ids, left.head, left.n_head, right.tail, right.n_tail, True)
    window = encode(left.tail + right.head)
    ids = left.ids[: len(left.ids) - left.n_tail] + window + right.ids[right.n_head :]
    head, n_head = (left.head, left.n_head) if left.cut else (left.tail + right.head, len(window))
    tail, n_tail = (right.tail, right.n_tail) if right.cut else (left.tail + right.head, len(window))
    return Part(ids, head, n_head, tail, n_tail, left.cut or right.cut)


def encode_tree(text: str, encode: Encoder, size: int = LEAF) -> list[int]:
    """The ids of a whole text: leaves of at most ``size`` code points, joined in pairs up the tree."""
    if len(text) <= size:
        return encode(text)
    n = -(-len(text) // size)
    bounds = [len(text) * i // n for i in range(n + 1)]
    level = [leaf(text[a:b], encode) for a, b in zip(bounds, bounds[1:])]
    while len(level) > 1:
        level = [join(level[i], level[i + 1], encode) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0].ids


def decode_tree(ids: list[int], tokens: list[bytes], size: int = LEAF) -> bytes:
    """The bytes of some ids: those of leaves of ``size`` ids, joined in pairs up the tree."""
    level = [b"".join(map(tokens.__getitem__, ids[i : i + size])) for i in range(0, len(ids), size)] or [b""]
    while len(level) > 1:
        level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0]


def encode_texts(docs: DataFrame, path: str, pattern: str, ids: bool = True, digests: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_tokens, and as asked its ids (array) and the SHA-256 digests of the ids and of
    the bytes that decoding them gives.

    Special tokens are not looked for: their text is text. A null text is empty and has no ids. A lone code point cannot be
    split by Spark's strings, so every text decodes to itself. Rows are taken one by one, repeated or not, whatever
    their doc_id; further columns are ignored.
    """
    fields = ["doc_id long", "n_tokens long", *(["ids array<int>"] if ids else []), *(["ids_sha256 string", "decoded_sha256 string"] if digests else [])]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_ranks(path, pattern).encode_ordinary
        names, tokens = token_tables(path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows: list[list] = []
                for text in part.column("text").to_pylist():
                    own = encode_tree(text or "", encode)
                    row: list = [len(own)]
                    if ids:
                        row.append(own)
                    if digests:
                        row.append(hashlib.sha256(" ".join(map(names.__getitem__, own)).encode()).hexdigest())
                        row.append(hashlib.sha256(decode_tree(own, tokens)).hexdigest())
                    rows.append(row)
                kinds = [pa.int64(), *([pa.list_(pa.int32())] if ids else []), *([pa.string()] * 2 if digests else [])]
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=[f.split()[0] for f in fields])

    return ready(docs).select("doc_id", "text").mapInArrow(work, ", ".join(fields))


def decode_texts(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) back to (doc_id, text); null ids give a null text, bytes that are no UTF-8 become U+FFFD."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_tables(path, pattern)[1]
        for batch in batches:
            texts = [None if own is None else decode_tree(own, tokens).decode("utf-8", "replace") for own in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, text string")

"""Ids against the tokenizer libraries, packing against its constraints."""

import hashlib
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ludoscope.llm import bpe, catalog, packing

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "'s", "1", "23", "=", "...", "中", " ", "\x1c", "\x85", "😀", "Z", "\r\n", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def texts():
    rng = random.Random(4)
    return ["", "x", " " * 5000, "a" * 5000, "ab" * 3000 + " " + "c" * 3000] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 400))) for _ in range(300)]


def test_tree_gives_the_library_ids(library):
    encode, tokens = bpe.load_ranks(RANKS, PATTERN).encode_ordinary, bpe.token_tables(RANKS, PATTERN)[1]
    for text in texts():
        want = library(text)
        for size in (1, 3, 16, 1024):
            if size > 3 or len(text) < 500:
                assert bpe.encode_tree(text, encode, size) == want, (text, size)
        assert bpe.decode_tree(want, tokens, 7) == text.encode()


def test_round_trip_and_edges(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, None, None), (1, "again", "y"), (1, "again", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode_texts(docs, RANKS, PATTERN, digests=True)
    back = bpe.decode_texts(encoded, RANKS, PATTERN)
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t, _ in rows)
    for r in encoded.collect():
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
    assert bpe.encode_texts(docs.limit(0), RANKS, PATTERN).count() == 0


def test_bins_hold_all_items():
    rng = np.random.default_rng(3)
    for high in (1023, 500, 340, 30):
        counts = Counter(int(x) for x in rng.integers(1, high + 1, 5000))
        bins = packing.plan_bins(counts)
        held = Counter()
        for items, n in bins:
            assert sum(items) <= 1024 and n > 0
            assert sum(3 * size > 1024 for size in items) <= 2
            for size in items:
                held[size] += n
        assert held == counts
        assert sum(n for _, n in bins) <= 1.02 * sum(k * n for k, n in counts.items()) / 1024 + 2
    assert packing.plan_bins({}) == []
    # 600 and 424 match, 700 takes the small ones.
    assert sorted(packing.plan_bins({600: 1, 424: 1, 700: 1, 324: 1})) == [((600, 424), 1), ((700, 324), 1)]
    with pytest.raises(ValueError):
        packing.plan_bins({1025: 1})


def test_packed_pieces(spark, library):
    rows = [(i, t) for i, t in enumerate(texts()) if i % 4 == 0] + [(900, "word " * 5000), (901, None), (902, "same"), (902, "same"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(packing.token_pieces(docs, RANKS, PATTERN, ids=True), group_rows=10).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for own in by_sequence.values():
        place = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == place
            place += r["length"]
        assert place <= 1024
    for doc_id, text in rows:
        if doc_id == 902:
            assert len(by_doc[902]) == 2
            continue
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [i for r in pieces for i in r["ids"]] == [*library(text or ""), 2]
        assert all(r["length"] == 1024 for r in pieces[1:]) and [r["piece"] for r in pieces] == list(range(len(pieces)))
    assert packing.pack(packing.token_pieces(docs.limit(0), RANKS, PATTERN)).count() == 0


def test_query_takes_added_tokens_as_the_library_does(spark, tmp_path):
    """The library as it is by default: op6 and the pipeline's last stage give its ids for the text of an added token."""
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = list(enumerate([*texts(), "a <|endoftext|> b", "<|endoftext|>" * 3, "x  <|endoftext|>\n <|endoftext|", "word " * 1023 + "<|endoftext|>"]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = catalog.table(spark, str(tmp_path), "documents")
    for packed in (catalog.op6_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))):
        got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packed.collect()}
        want = {}
        for doc_id, text in rows:
            own = np.array([*default.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
            first = (len(own) - 1) % 1024 + 1
            for k, stop in enumerate(range(first, len(own) + 1, 1024)):
                start = 0 if k == 0 else stop - 1024
                want[doc_id, k] = (start, stop - start, zlib.crc32(own[start:stop].tobytes()))
        assert got == want


def test_packing_keeps_columns_with_names_of_our_own(spark):
    rows = [(i, 0, 0, 100 + i, f"n{i}", f"s{i}", f"r{i}", f"b{i}") for i in range(30)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, _number string, _salt string, _row string, _before string")
    got = packing.pack(pieces).collect()
    assert sorted((r["doc_id"], r["_number"], r["_salt"], r["_row"], r["_before"]) for r in got) == sorted((r[0], *r[4:]) for r in rows)
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in own) <= 1024 and all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) for own in filled.values())

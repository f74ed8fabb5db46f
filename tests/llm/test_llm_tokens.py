"""Token counts and BPE against the public libraries."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import sha
from tokenizers import Tokenizer

from creditlake.llm import bpe, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "ab", "the", " ", "  ", "\n", "é", "漢", "😀", "▁", "1", "00", "\t", "ing", "<s>", "\u0000", "​", "---", "<|endoftext|>", "'s", "don't", "!!", " "]


def texts(seed, n=150, most=120):
    rng = random.Random(seed)
    out = ["".join(rng.choice(rng.sample(ALPHABET, rng.randint(1, 6))) for _ in range(rng.randint(0, most))) for _ in range(n)]
    return [*out, None, "", " ", "a" * 3000, "ab" * 900, " " * 500, "\n" * 300 + "x", "xyz" * 900 + " " + "q" * 99, "".join(rng.choice("etaoinshrdlu") for _ in range(4000)), "漢字" * 700]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_counts_equal_the_library(spark, library):
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts(1))]
    out = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3), PIECES)
    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, _ in rows]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_slices_of_long_texts_do_not_matter(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 50)
    some = [t or "" for t in texts(2)]
    assert token_counts.Segmenter(PIECES).count(some).tolist() == [len(x) for x in library.encode(some)]


def test_overlapping_pairs_merge_from_the_left(library):
    some = ["=" * n for n in range(1, 60)] + [" " * n for n in range(1, 40)] + ["ab" * n + "a" for n in range(20)]
    assert token_counts.Segmenter(PIECES).count(some).tolist() == [len(x) for x in library.encode(some)]


def test_only_its_kind_of_model_is_taken(tmp_path):
    with pytest.raises(Exception):  # noqa: B017  whatever the library raises for a broken file
        broken = tmp_path / "m.model"
        broken.write_bytes(b"no model")
        token_counts.Segmenter(str(broken))


@pytest.mark.parametrize("piece", [4, 64])
def test_encoding_equals_the_library_however_texts_are_cut(spark, piece):
    known = Tokenizer.from_file(BYTES)
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    out = bpe.encode(docs, BYTES, long_chars=20, piece_chars=piece)
    want = [(i, known.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in out.collect()), key=repr) == sorted(want, key=repr)
    back = bpe.decode(out, BYTES).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=repr) == sorted(((i, t or "") for i, t, _ in rows), key=repr)


def test_digests(spark):
    known = Tokenizer.from_file(BYTES)
    docs = spark.createDataFrame([(1, "Hello <|endoftext|> wörld\n\n x")], "doc_id long, text string")
    out = bpe.encode(docs, BYTES, emit=bpe.emit_digests, emitted="n_tokens long, ids_sha256 string, decoded_sha256 string").first()
    ids = known.encode("Hello <|endoftext|> wörld\n\n x", add_special_tokens=False).ids
    assert tuple(out) == (1, len(ids), sha(",".join(map(str, ids))), sha(known.decode(ids, skip_special_tokens=False)))


def test_joins_of_periodic_runs():
    """Runs that agree nowhere near the join make the window grow to the whole."""
    codec, known = bpe.Codec(BYTES), Tokenizer.from_file(BYTES)
    for run in ("a" * 1001, "ab" * 333, "abc" * 200, "-" * 777, " " * 500 + "x", "é" * 301):
        parts = [codec.lone.encode_ordinary(p) for p in bpe.halves(run, 7)]
        assert codec.concatenate(parts) == codec.lone.encode_ordinary(run)
        assert codec.encode(run) == known.encode(run, add_special_tokens=False).ids


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, PIECES).count() == 0
    assert bpe.encode(none, BYTES).count() == 0
    assert np.array_equal(token_counts.segmenter(PIECES).count([]), [])


def test_tokens_of_few_texts_are_held_at_once():
    """A batch of many texts is encoded in slices, all rows once and in order; only long texts load the second encoding."""
    import pyarrow as pa

    rows = ["x" * (i % 7 * 100) if i % 11 else None for i in range(500)] + ["y" * 5000, "z"]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(rows))), "t": rows})
    parts = list(bpe.portions(iter([batch, batch.slice(0, 0)]), "t", 1000))
    assert [x for p in parts for x in p.column("n").to_pylist()] == list(range(len(rows)))
    assert max(sum(len(t or "") for t in p.column("t").to_pylist()) for p in parts if p.num_rows > 1) <= 1000
    codec = bpe.Codec(BYTES)
    codec.encode("some words, <|endoftext|> and 12")
    assert "lone" not in vars(codec)

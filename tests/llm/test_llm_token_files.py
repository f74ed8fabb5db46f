"""Token files: the library's ids, the places of documents, encodings, and selective reads."""

from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from creditlake.llm import queries, token_files
from creditlake.llm.grams import Texts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a", "B", "é", "É", "ß", "Σ", "ς", "\u0301", "\u0327", "e", "'", "s", "'s", "'LL", ".", ",", "!", "?", ";", ":", "...", '"', "«", "…", " ", "\n", "\t",
    "\x0b", "\x0c", "\x1c", "\u00a0", "\u2009", "\x85", "1", "²", "٣", "×", "÷", "中", "가", "ᄀ", "ᅡ", "😀", "\u200d", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|",
    "|>", "İ", "ǅ", "ﬁ", "A\u030a", "Å", "-", "_", "\x00", "word", "x" * 90,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 14))) for _ in range(8000)] + [f"{chr(c)}.{chr(c)} é{chr(c)}" for c in range(1, 0x2000)]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    own = token_files.Words(PATH)
    for at in range(0, len(texts), 700):
        ids, counts = own.encode(Texts.of(pa.array(texts[at : at + 700])))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want[at : at + 700]


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, TypeError, KeyError)):
        token_files.check_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def corpus():
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(ODD, k=rng.randint(0, 30))), "en") for i in range(300)]
    return rows + [(400, None, None), (401, "", "de"), (402, "word " * 30000, "en"), (7, "again", "en"), (7, "again", "en"), (None, "no id", "fr")]


@pytest.fixture(scope="module", params=["dictionary", "delta"])
def folder(request, spark, tmp_path_factory):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string").repartition(3)
    path = str(tmp_path_factory.mktemp("tokens") / "files")
    return token_files.write(docs, PATH, path, keep=("lang",), ids_encoding=request.param, shard_bytes=1 << 14, row_group_bytes=1 << 16, page_bytes=1 << 12), request.param


def test_stream_and_reads(spark, library, folder):
    path, kind = folder
    rows = corpus()
    starts = token_files.shard_starts(spark, path)
    got = token_files.with_start(token_files.checksums(spark, path), starts).collect()
    got.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == [None, *sorted(r[0] for r in rows if r[0] is not None)]
    made = {(r[0], r[1] or ""): [*library.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    of_id = {k[0]: v for k, v in made.items() if k[0] != 7}
    stored = {r["doc_id"]: r["ids"] for r in spark.read.parquet(path).collect() if r["doc_id"] != 7}
    assert stored == of_id
    at, stream = 0, []
    for r in got:
        own = of_id.get(r["doc_id"]) or made[(7, "again")] if r["doc_id"] != 7 or r["n_tokens"] == len(made[(7, "again")]) else None
        own = own if own is not None else next(v for k, v in made.items() if k[0] == 7 and len(v) == r["n_tokens"])
        assert (r["start"], r["n_tokens"], r["crc32"]) == (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        stream += own
        at += len(own)
    for first, count in ((0, 10), (at // 2, 500), (at - 3, 100), (at + 5, 3)):
        parts = sorted(token_files.span(spark, path, first, count).collect(), key=lambda r: r["start"])
        assert [x for p in parts for x in p["ids"]] == stream[first : first + count]
    some = token_files.documents(spark, path, 10, 19)
    assert sorted(r["doc_id"] for r in some.collect()) == list(range(10, 20))
    plan = token_files.metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]


def test_files(folder):
    path, kind = folder
    groups = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i) for i in range(meta.num_columns)}
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
            assert "DELTA_BINARY_PACKED" in columns["at"].encodings and "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
            found = columns["ids.list.element"].encodings
            assert ("RLE_DICTIONARY" in found) == (kind == "dictionary")
    assert groups > 1


def test_names_and_empty(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, shard int")
    with pytest.raises(ValueError):
        token_files.write(empty, PATH, str(tmp_path / "x"), keep=("shard",))
    path = token_files.write(empty, PATH, str(tmp_path / "files"))
    assert token_files.with_start(token_files.checksums(spark, path), token_files.shard_starts(spark, path)).count() == 0


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"] or "") for r in pq.read_table(f"{sf}/documents.parquet").to_pylist())
    want, at = [], 0
    for i, text in docs:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in queries.op13_token_files(spark, sf).collect()) == want

"""Strings of added tokens in texts: the queries give the ids of an unchanged tokenizer."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm.queries import QUERIES
from millrace.llm.tokens import PartEncoder
from tests.llm.cases import documents, frame

BPE = public_tokenizers.path("byte_bpe_50k.json")
MARK = "<|endoftext|>"
TEXTS = [f"see {MARK} here", MARK, f"a{MARK}b", f"{MARK}{MARK} x", f" {MARK}  \n y {MARK}", "see <|endoftext| > here", "plain words here", f"word {MARK}, " * 400]


def rows():
    return documents() + [(100 + i, t, "k", 1, 2, 3, 4, 0, "s") for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def expected():
    tokenizer = Tokenizer.from_file(BPE)
    return [(r[0], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in rows()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('added')}"
    frame(spark, rows()).write.parquet(f"{path}/documents.parquet")
    return path


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_parts_with_added_tokens(expected):
    got = PartEncoder(BPE, keep=40, special=True).encode([r[1] for r in rows()])
    assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == [ids[:-1] for _, ids in expected]
    assert np.frombuffer(got[len(documents())], "<u2").tolist() == [3826, 220, 50256, 994]


def test_token_files_query(spark, folder, expected):
    got = QUERIES["op10_token_files"](spark, folder).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(k), len(i), crc(i)) for k, i in expected)


@pytest.mark.parametrize("name", ["op8_pack_nnls", "pipeline"])
def test_packing_queries(spark, folder, expected, name):
    if name == "pipeline":
        found = corpus_pipeline.packing(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    else:
        found = QUERIES[name](spark, folder)
    texts = {}
    for k, ids in expected:
        texts.setdefault((str(k), len(ids)), []).append(ids)
    rows = found.collect()
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected)
    assert {(str(r.doc_id), r.doc_tokens) for r in rows} == texts.keys()
    for r in rows:  # pieces may begin and end anywhere
        assert r.ids_crc32 in [crc(ids[r.start : r.start + r.length]) for ids in texts[(str(r.doc_id), r.doc_tokens)]]

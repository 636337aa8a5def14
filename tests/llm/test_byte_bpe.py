import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from ratekit.llm import byte_bpe as B
from ratekit.llm.queries import QUERIES, tokenizer
from llm_helpers import SF

RANKS = B.read_ranks(B.read_vocabulary(P.path("byte_bpe_50k.tiktoken")))
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def want(text):
    return np.array(REFERENCE.encode_ordinary(text or ""), "<u4").tobytes()


def odd_texts():
    rng = random.Random(3)
    fixed = [None, "", " ", "a" * 3000, "-" * 700, "ab" * 2000, " " * 5000, "x" * 512, "x" * 513, "日本" * 300,
             " é\x00" * 50, "½²Ⅷ" * 9, "a b\x85c\x1cd", "it's'll 've'd", "<|endoftext|>", "é" * 40]
    letters = "ab zé\n\t  9_!'strevdlmßŸ"
    fixed += ["".join(rng.choice(letters) for _ in range(900)) for _ in range(20)]
    return fixed + ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x4E00, 0x9000),
                                            rng.randrange(0x1F300, 0x1F600), 10, 32])) for _ in range(500))
                    for _ in range(20)]


def test_encodes_as_the_reference_library_and_round_trips():
    coder = B.ByteBPE(RANKS, P.PATTERN)
    texts = odd_texts()
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids == want(text)
        assert B.decode_ids(ids, coder.bytes_of) == (text or "").encode()


def test_cache_that_overflows_changes_nothing(monkeypatch):
    monkeypatch.setattr(B, "PIECE_CACHE", 50)
    monkeypatch.setattr(B, "MATRIX_CELLS", 64)
    coder = B.ByteBPE(RANKS, P.PATTERN)
    for text in odd_texts():
        assert coder.encode([text]) == [want(text)]


def test_query_over_the_whole_table(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(texts)
    for d in texts:
        ids, r = want(d.text), rows[d.doc_id]
        assert r.n_tokens == len(ids) // 4
        assert r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_nulls_repeats_empty_table_and_clashing_names(spark, docs_of):
    coder = tokenizer(spark)
    docs = docs_of([(1, None), (1, None), (None, "it is"), (2, "")])
    out = docs.withColumn("ids", coder.encode(F.col("text"))).withColumn("back", coder.decode(F.col("ids")))
    assert sorted(bytes(r.back) for r in out.collect()) == [b"", b"", b"", b"it is"]
    assert docs.limit(0).select(coder.encode(F.col("text"))).count() == 0


def test_a_vocabulary_too_large_to_broadcast_is_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(B, "MAX_VOCABULARY", 3)
    (tmp_path / "v").write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        B.read_vocabulary(str(tmp_path / "v"))

"""Byte-level BPE against the tiktoken library, and exact round trips."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, queries

#: Characters at which the pattern cuts, of one to four bytes, and ones that engines class differently.
ALPHABET = "abcZ9_'-   　\x85\x1c​\n\t\r\x00éß中😀́ⅷ²ſK"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(byte_bpe.default_ranks())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(library, rows):
    out = Counter()
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        out[(r.doc_id, len(ids), np.array(ids, dtype="<u4").tobytes(), (r.text or "").encode())] += 1
    return out


def found(df):
    rows = byte_bpe.decode(byte_bpe.encode(df)).collect()
    assert all(np.array(r.tokens, dtype="<u4").tobytes() == bytes(r.ids) for r in rows)
    return Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.bytes)) for r in rows)


def test_equals_the_library_on_awkward_texts(spark, awkward, library):
    draw = random.Random(3)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 120))) for _ in range(400)]
    texts += ["I'm you're 'tis ''s don'tx '", " " * 3000 + "x", "a" * 5001, "thequickbrownfox" * 30, "abab" * 700, "=" * 999, "١٢٣ 中文字 " * 50]
    more = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    docs = awkward.select("doc_id", "text").union(more).repartition(3)
    assert found(docs) == wanted(library, docs.collect())


def test_empty_table_and_clashing_columns(awkward, empty):
    assert byte_bpe.decode(byte_bpe.encode(empty)).count() == 0
    docs = awkward.where("doc_id in (4, 7)")
    for name in ("chunk", "found", "tokens", "size", "words"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert found(docs) == found(docs.select("doc_id", "text"))


def test_chunks_end_inside_a_partition(awkward, library, monkeypatch):
    docs = awkward.select("doc_id", "text").where("doc_id <> 8").coalesce(1)
    monkeypatch.setattr(byte_bpe, "CHUNK_BYTES", 40)
    chunks = byte_bpe._chunks(docs, byte_bpe.default_pattern()).select("chunk", "doc_id").collect()
    assert len(chunks) == 1 or len({r.chunk for r in chunks}) == len(chunks)
    assert sorted(str(k) for r in chunks for k in r.doc_id) == sorted(str(r.doc_id) for r in docs.collect())


def test_long_and_short_folds_agree(spark, library):
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdeé ") for _ in range(draw.randint(1, 60))).encode() for _ in range(300)]
    df = spark.createDataFrame([(bytearray(w),) for w in words], "w binary").repartition(4)

    def ids(table, fold):
        letters = F.transform(
            F.sequence(F.lit(1), F.octet_length("w")), lambda i: F.get(table["bytes"], F.shiftright(F.crc32(F.substring("w", i, F.lit(1))), 24).cast("int"))
        )
        return byte_bpe.let(letters, lambda parts: fold(parts, table))

    table = byte_bpe.rank_map(byte_bpe.default_ranks())
    both = df.select("w", byte_bpe.let(table, lambda t: F.struct(ids(t, byte_bpe._short_word).alias("a"), ids(t, byte_bpe._long_word).alias("b"))).alias("x")).collect()
    assert len(both) == len(words)
    for r in both:
        assert r.x.a == r.x.b == library._core_bpe.encode_single_piece(bytes(r.w)) or bytes(r.w) in byte_bpe.read_ranks(byte_bpe.default_ranks())


def test_null_tokens_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [0, 256])], "k int, tokens array<int>")
    pieces = {v: k for k, v in byte_bpe.read_ranks(byte_bpe.default_ranks()).items()}
    assert {r.k: r.bytes and bytes(r.bytes) for r in byte_bpe.decode(rows).collect()} == {1: None, 2: bytearray(), 3: pieces[0] + pieces[256]}


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter((d, n, sha(i), sha(t)) for (d, n, i, t), c in wanted(library, spark.read.parquet(f"{folder}/documents.parquet").collect()).items() for _ in range(c))
    rows = queries.QUERIES["op13_byte_bpe"](spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(map(tuple, rows)) == want

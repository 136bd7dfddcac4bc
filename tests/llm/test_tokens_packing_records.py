import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import curve_packing, record_files, tokens
from tidemark.llm.common import new_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def plain_ids(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()


pieces = st.sampled_from(["don't", "x", "<|endoftext|>", "<|startoftext|>", "İ", "Σ", "é", "́", "\x1c", " ", "\xa0", "\x85", "12", "'s", "ﬁ", "😀"])


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.text(max_size=12), pieces, st.sampled_from([" ", "\n", "\t", "\r", "  "])), max_size=14))
def test_word_encoder_equals_the_library(parts):
    from tokenizers import Tokenizer

    encoder = tokens.encoder(tokens.default_tokenizer())
    text = "".join(parts).encode("utf-8", "ignore").decode()
    library = encoder.tokenizer
    assert isinstance(library, Tokenizer)
    assert encoder.ids(text) == np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_word_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    e = tokens.WordEncoder(tokens.default_tokenizer())
    for text in ("a b c d", "e f g h i j k", "a b z " + "y" * 100):
        assert e.ids(text) == e._raw([text])[0]


def test_plain_words_are_encoded_run_by_run(monkeypatch):
    """Cases of one run of letters and the marks behind it take the model once; only other words go through the whole tokenizer."""
    e = tokens.WordEncoder(tokens.default_tokenizer())
    words = [f"{run}{marks}" for run in ("garten", "Garten", "ÉTÉ", "été", "s", "ll", "ßx") for marks in ("", ",", "!!", "$$$")]
    want = e._raw(words)
    together = []
    monkeypatch.setattr(e, "_together", lambda left: together.extend(left) or e._raw(left))
    e.runs.clear()
    assert e._words(words) == want and not together and len(e.runs) == 5 + 3
    odd = ["don't", "a-b", "x1", "e\u0301", "İx", "a<|endoftext|>"]
    assert e._words([*odd, "garten"]) == [*e._raw(odd), want[0]] and together == odd


def test_crc32c_vectors():
    # published check values
    data = [b"123456789", b"", bytes(32), b"\xff" * 32, bytes(range(32))]
    assert [hex(x) for x in record_files.crc32c(data)] == ["0xe3069283", "0x0", "0x8a9136aa", "0x62a8ab43", "0x46dd794e"]
    table = [0] * 256
    for i in range(256):
        c = i
        for _ in range(8):
            c = c >> 1 ^ (record_files.POLYNOMIAL if c & 1 else 0)
        table[i] = c
    rng = np.random.default_rng(1)
    blobs = [rng.bytes(n) for n in (1, 63, 64, 65, 127, 128, 129, 1000, 4097)]
    for blob, got in zip(blobs, record_files.crc32c(blobs)):
        c = 0xFFFFFFFF
        for b in blob:
            c = table[(c ^ b) & 255] ^ c >> 8
        assert int(got) == c ^ 0xFFFFFFFF


def test_frames_round_trip_and_damage():
    payloads = [b"", b"x", b"abc" * 1000]
    blob = b"".join(record_files.frames(payloads))
    assert record_files.unframed(blob) == (payloads, len(blob))
    assert record_files.unframed(blob[:-1])[0] == payloads[:2]
    for at in (0, 9, 20, len(blob) - 2):
        bad = bytearray(blob)
        bad[at] ^= 4
        with pytest.raises(record_files.DamagedRecord):
            found, used = record_files.unframed(bytes(bad))
            if used < len(blob):
                raise record_files.DamagedRecord("cut short")
    assert record_files.from_payload(record_files.payload(-5, np.array([1, 70000], "<u4").tobytes())) == (-5, np.array([1, 70000], "<u4").tobytes())
    assert record_files.from_payload(record_files.payload(None, b"")) == (None, b"")


def test_records_round_trip(spark, awkward, library):
    folder = new_path(spark, "test-records")
    index = record_files.write_records(awkward, folder)
    rows = record_files.read_records(spark, folder).orderBy("start").collect()
    want = sorted(((r.doc_id, plain_ids(library, r.text)) for r in awkward.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in rows] == [k for k, _ in want]
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in rows) == sorted((str(k), b) for k, b in want)
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    assert index.count() == len(rows)
    shuffled = record_files.read_shuffled(spark, folder, seed=3).collect()
    assert sorted((str(r.doc_id), zlib.crc32(r.ids)) for r in shuffled) == sorted((str(r.doc_id), zlib.crc32(r.ids)) for r in rows)


def test_records_of_an_empty_table(spark, empty):
    assert record_files.write_and_read(empty).collect() == []


def test_hilbert_key_is_a_curve():
    """Every cell once, and neighbours along the curve are neighbours in the grid."""
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
        grid = np.stack([a.ravel() for a in axes], axis=1)
        key = curve_packing.hilbert_key(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=20), st.lists(st.integers(1, 20), max_size=3))
def test_pieces_are_gapless(lengths, splits):
    """Documents dealt over several tasks: every token in one piece, sequences gapless, short ones a power of two."""
    total, size = sum(lengths), 16
    tail = curve_packing.cut_points(total, size)
    at, found = 0, []
    chunks, rest = [], list(lengths)
    for s in splits:
        chunks.append(rest[:s])
        rest = rest[s:]
    chunks.append(rest)
    base = 0
    for chunk in chunks:
        if not chunk:
            continue
        d, start, length, sequence, offset = curve_packing.pieces_of(base, np.array(chunk), tail, size)
        found += [(base, int(x), int(a), int(n), int(q), int(o)) for x, a, n, q, o in zip(d, start, length, sequence, offset)]
        base += sum(chunk)
    fill = {}
    for _, _, _, n, q, o in found:
        assert fill.get(q, 0) == o and n > 0
        fill[q] = o + n
    assert sorted(fill) == list(range(len(fill))) and sum(fill.values()) == total
    assert all(n == size or n & (n - 1) == 0 for n in fill.values()) and max(fill.values()) <= size
    assert at == 0


def test_packing_holds_every_token(spark, awkward, empty, library):
    rows = curve_packing.pack(awkward, length=64).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
        assert r.length == len(r.ids) // 4
    whole = {}
    for r in awkward.collect():
        ids = plain_ids(library, r.text)
        whole.setdefault((r.doc_id, len(ids) // 4), []).append(ids)
    assert set(by_doc) == set(whole)
    for k, texts in whole.items():
        assert b"".join(b for _, b in sorted(by_doc[k])) == b"".join(sorted(b for t in texts for b in [t])) or len(texts) > 1
    assert sum(r.length for r in rows) == sum(len(t) // 4 for ts in whole.values() for t in ts)
    for q in {r.sequence_id for r in rows}:
        mine = sorted((r.offset, r.length) for r in rows if r.sequence_id == q)
        assert [o for o, _ in mine] == np.cumsum([0] + [n for _, n in mine])[:-1].tolist()
    assert curve_packing.pack(empty).collect() == []


def test_near_documents_share_sequences(spark):
    """Two vocabularies: most sequences hold documents of one of them."""
    rows = [(i, " ".join(f"{'alpha beta gamma delta' if i % 2 else 'uno dos tres cuatro'} " for _ in range(20)), "en", "s", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    packed = curve_packing.pack(df, length=512).groupBy("sequence_id").agg(F.countDistinct(F.col("doc_id") % 2).alias("kinds"))
    mixed = packed.where("kinds > 1").count()
    assert mixed <= 2 < packed.count()

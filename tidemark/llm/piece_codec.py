"""SentencePiece encoding and decoding in batched numpy.

Equal-length words advance together. Substrings are probed by hash in the
sorted piece keys. A unigram model is decoded by Viterbi over the word lattice,
with vectorised maxima that store backpointers. A BPE model is not a best path
over its scores, so its words take the same probes and maxima to merge the best
pair, all words of a length at once, until none is left.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import slices

BLANK = "▁"
#: Words whose ids a Python worker remembers, and the longest such word.
CACHE_WORDS = 400_000
CACHE_CHARS = 64
BASE = np.uint64(0x100000001B3)
UNIGRAM, BPE = 1, 2


def default_model() -> str:
    """Path of the SentencePiece file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes (mod 2**64) of all prefixes of each row of code points."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    for k in range(codes.shape[1]):
        out[:, k + 1] = out[:, k] * BASE + codes[:, k]
    return out


def _codes(words: list[str]) -> np.ndarray:
    n = len(words[0])
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(words), n).astype(np.uint64) + np.uint64(1)


class PieceTable:
    """Pieces as sorted hash keys with ids and scores."""

    def __init__(self, pieces: list[str], scores: list[float], ids: list[int]):
        self.longest = max(map(len, pieces))
        keys = np.zeros(len(pieces), dtype=np.uint64)
        by_length: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(k)
        for mine in by_length.values():
            keys[mine] = _prefix_hashes(_codes([pieces[k] for k in mine]))[:, -1]
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.ids = np.array(ids, dtype=np.int64)[order]
        self.scores = np.array(scores, dtype=np.float64)[order]
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(self.longest + 1, BASE)])
        self.pieces = [pieces[k] for k in order]

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the keys, or -1."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def viterbi(words: list[str], table: PieceTable, unknown: float) -> tuple[np.ndarray, ...]:
    """Best segmentation of equal-length words: ``word, start, end, place`` of every piece in order, place -1 for a character that is no piece.

    All words advance over the end positions together; at each, the maximum
    over the piece lengths is taken for all words at once and its length stored
    as backpointer. Ties go to the shorter last piece.
    """
    codes = _codes(words)
    count, n = codes.shape
    hashes = _prefix_hashes(codes)
    best = np.full((count, n + 1), -np.inf)
    best[:, 0] = 0.0
    back, place = np.zeros((count, n + 1), dtype=np.int64), np.full((count, n + 1), -1, dtype=np.int64)
    rows = np.arange(count)
    for end in range(1, n + 1):
        lengths = np.arange(1, min(end, table.longest) + 1)
        starts = end - lengths
        found = table.probe(hashes[:, [end]] - hashes[:, starts] * table.powers[lengths])
        gain = np.where(found >= 0, table.scores[found], -np.inf)
        gain[:, 0] = np.where(found[:, 0] >= 0, gain[:, 0], unknown)
        total = best[:, starts] + gain
        top = np.argmax(total, axis=1)
        best[:, end], back[:, end], place[:, end] = total[rows, top], lengths[top], found[rows, top]
    # back along the pointers, all words at once
    on_path = np.zeros((count, n + 1), dtype=bool)
    at = np.full(count, n)
    while (alive := rows[at > 0]).size:
        on_path[alive, at[alive]] = True
        at[alive] -= back[alive, at[alive]]
    word, end = np.nonzero(on_path)
    return word, end - back[word, end], end, place[word, end]


def merges(words: list[str], table: PieceTable) -> tuple[np.ndarray, ...]:
    """BPE segmentation of equal-length words, in the form of :func:`viterbi`: the best-scored pair merges first, the leftmost of equals."""
    codes = _codes(words)
    count, n = codes.shape
    hashes = _prefix_hashes(codes)
    rows = np.arange(count)
    end = np.tile(np.arange(1, n + 1), (count, 1))  # of the symbol that starts here
    before = np.tile(np.arange(-1, n - 1), (count, 1))  # start of the symbol before
    score = np.full((count, n), -np.inf)  # of merging the symbol that starts here with the next

    def places(w: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = stop - start
        fits = size <= table.longest
        found = table.probe(hashes[w, stop] - hashes[w, start] * table.powers[np.clip(size, 0, table.longest)])
        return np.where(fits, found, -1)

    def rate(w: np.ndarray, start: np.ndarray) -> None:
        middle = end[w, start]
        found = places(w, start, end[w, np.minimum(middle, n - 1)])
        score[w, start] = np.where((found >= 0) & (middle < n), table.scores[found], -np.inf)

    if n > 1:
        first = np.tile(np.arange(n - 1), (count, 1)).ravel()
        rate(np.repeat(rows, n - 1), first)
    alive = rows
    while len(alive):
        at = np.argmax(score[alive], axis=1)
        more = score[alive, at] > -np.inf
        alive, at = alive[more], at[more]
        if not len(alive):
            break
        middle = end[alive, at]
        stop = end[alive, middle]
        end[alive, at] = stop
        end[alive, middle] = 0  # no symbol starts here any more
        score[alive, middle] = -np.inf
        inner = stop < n
        before[alive[inner], stop[inner]] = at[inner]
        left = before[alive, at]
        has = left >= 0
        rate(np.concatenate((alive, alive[has])), np.concatenate((at, left[has])))
    word, start = np.nonzero(end)
    stop = end[word, start]
    return word, start, stop, places(word, start, stop)


class PieceCodec:
    """Whole-text encoder and decoder for a SentencePiece file whose pieces never hold a blank behind another character.

    Such a model gives a text the ids of its words one after another, a word
    being a run of blanks with what follows it. Characters that are no piece
    become their UTF-8 bytes, where the model has byte pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        ids = [k for k in range(m.get_piece_size()) if not (m.is_control(k) or m.is_unknown(k) or m.is_byte(k) or m.is_unused(k))]
        pieces = [m.id_to_piece(k) for k in ids]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError(f"{path}: pieces cross words; words cannot be encoded alone")
        self.table = PieceTable(pieces, [m.get_score(k) for k in ids], ids)
        self.bytes = {int(m.id_to_piece(k)[3:-1], 16): k for k in range(m.get_piece_size()) if m.is_byte(k)}
        self.unknown = m.unk_id()
        blob = m.serialized_model_proto()
        self.kind = _model_kind(blob)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"{path}: neither a unigram nor a BPE model")
        # fixed value: the library's penalty of an unknown character below the lowest score
        self.unknown_score = float(self.table.scores.min()) - 10.0
        self.prefix = m.encode("a") == m.encode(" a") or m.decode(m.encode("a")) == "a" and m.id_to_piece(m.encode("a")[0]).startswith(BLANK)
        self.cache: dict[str, bytes] = {}
        self.names = {k: (bytes([b]) if b is not None else None) for b, k in self.bytes.items()}
        self.names |= {i: p.replace(BLANK, " ").encode() for p, i in zip(self.table.pieces, self.table.ids.tolist())}

        probe = "It's  12 ﬁne\n\tÇa va? 😀 x"
        if np.frombuffer(self.encode(probe), dtype="<u4").tolist() != m.encode(probe):
            raise ValueError(f"{path}: the model changes text before it is cut, which this codec does not")

    def words(self, text: str) -> list[str]:
        """Runs of blanks with the characters that follow, after the dummy blank at the front."""
        if not text:
            return []
        marked = (BLANK if self.prefix else "") + text.replace(" ", BLANK)
        out, parts = [], marked.split(BLANK)
        if parts[0]:
            out.append(parts[0])
        blanks = 0
        for part in parts[1:]:
            blanks += 1
            if part:
                out.append(BLANK * blanks + part)
                blanks = 0
        if blanks:
            out.append(BLANK * blanks)
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        known = {}
        for n, group in by_length.items():
            step = max(1, (1 << 20) // (n * min(n, self.table.longest)))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                found = merges(part, self.table) if self.kind == BPE else viterbi(part, self.table, self.unknown_score)
                known.update(zip(part, self._ids(part, *found)))
        return known

    def _ids(self, words: list[str], owner: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray) -> list[bytes]:
        """Ids of each word from its pieces; a character that is no piece gives its bytes, or the unknown id."""
        ids = self.table.ids[np.maximum(place, 0)].astype("<u4")
        counts = np.bincount(owner, minlength=len(words))
        line, stops = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        out = [line[i:j] for i, j in zip([0, *stops[:-1]], stops)]
        for w in np.unique(owner[place < 0]).tolist():
            word, parts = words[w], []
            for k in np.flatnonzero(owner == w).tolist():
                if place[k] >= 0:
                    parts.append(int(self.table.ids[place[k]]))
                elif self.bytes:
                    parts += [self.bytes[b] for b in word[start[k] : end[k]].encode("utf-8", "surrogatepass")]
                else:
                    parts.append(self.unknown)
            out[w] = np.array(parts, dtype="<u4").tobytes()
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. New words of all texts are cut together, so that those of a length make a large batch."""
        cut = [self.words(t) for t in texts]
        known = self.cache
        new = set().union(*cut).difference(known)
        if new:
            long = {w for w in new if len(w) > CACHE_CHARS}
            if len(known) + len(new) > CACHE_WORDS:
                self.cache = known = {}
                new = set().union(*cut)
                long = {w for w in new if len(w) > CACHE_CHARS}
            known.update(self._learn([w for w in new if w not in long]))
            if long:
                known = known | self._learn(list(long))
        return [b"".join(map(known.__getitem__, words)) for words in cut]

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces and bytes joined, without the dummy blank."""
        text = b"".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _varint(blob: bytes, at: int) -> tuple[int, int]:
    value, shift = 0, 0
    while True:
        byte = blob[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Top-level fields of a protocol buffer."""
    at = 0
    while at < len(blob):
        tag, at = _varint(blob, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(blob, at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(blob, at)
            value, at = blob[at : at + size], at + size
        yield tag >> 3, value


def _model_kind(blob: bytes) -> int:
    """The model type of a SentencePiece file: field 3 of its trainer specification (field 2); unigram if unset."""
    trainer = next((v for k, v in _fields(blob) if k == 2), b"")
    return next((v for k, v in _fields(trainer) if k == 3), UNIGRAM)


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of this Python worker for a SentencePiece file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, n_tokens`` of every row of ``docs``: ids of the whole text as little-endian unsigned 32-bit integers.

    A null text has null ids and no token; an empty one has no token; repeated
    rows are encoded each; a null ``doc_id`` stays null; other columns are
    ignored; an empty table gives an empty result. No shuffle.
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                ids = [None if t is None else x for t, x in zip(texts, pieces.encode_all([t or "" for t in texts]))]
                sizes = pa.array([0 if x is None else len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), sizes], ["doc_id", "ids", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids binary, n_tokens bigint")


def decode(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``rows`` with a last column ``text``, the text of ``ids``; null ids give null."""
    path = model or default_model()
    schema = StructType([*rows.schema.fields, StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in batches:
            for part in slices(batch):
                texts = [None if x is None else pieces.decode(x) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "text"])

    return rows.mapInArrow(run, schema)

"""Token ids of whole texts with a ``tokenizers`` file, word by word with a bounded cache."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

#: Words whose ids a Python worker remembers; the cache starts anew when it is full.
CACHE_WORDS = 1_000_000
#: Words that go to the library at once.
BATCH_WORDS = 4000
#: Marks that a tokenizer takes as a token run of their own behind letters.
MARKS = ".,;:!?"
#: Longer words are encoded each time.
CACHE_CHARS = 64
#: Letters that stay one character in every normal form and case, and marks that a tokenizer takes as one run behind them.
LETTERS = "".join(chr(c) for r in ((65, 91), (97, 123), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x100)) for c in range(*r))
RUN_MARKS = ".,;:!?*$#%&"


def default_tokenizer() -> str:
    """Path of the word-level BPE file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes texts with a tokenizer that never joins characters across a blank, line feed or tab.

    Such a tokenizer gives a text the ids of its words one after another, so a
    word is encoded once and its ids are remembered as little-endian unsigned
    32-bit bytes. The constructor refuses a tokenizer for which that does not
    hold on a probe.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {"": b""}
        self.model, self.runs = self.tokenizer.model, {}
        self.symbols = None
        marks = [(k, t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized and not t.lstrip and not t.rstrip]
        self.mark = max(marks, default=None)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[k for w, k in vocabulary.items() if w.endswith(suffix)]] = True
        probe = "It's 12 o'clock,\n\tnot  13! Ça va? x́ y"
        if self.ids(probe) != self._raw([probe])[0]:
            raise ValueError(f"{path}: tokens cross white space; words cannot be encoded alone")
        probe_words = ["word", "Ça", "İi", "end.", "why?", "x!", "don't", "12,", "ﬁne;", "a-b"]
        if self._together(probe_words) != self._raw(probe_words):
            self.ends = None  # runs of letters do not end in such tokens
        self.symbols = self._symbols()
        self.split = re.compile(f"([{LETTERS}]+)([{re.escape(RUN_MARKS)}]*)").fullmatch
        probe_words = [LETTERS, LETTERS[::-1], *(x + RUN_MARKS[k:] + x for k in range(3) for x in RUN_MARKS), "word", "Ça", "eÉß.", "x!!", "Naïve$$$", "s", "t,", "Re", "ll"]
        probe_words = [w if w[0] in LETTERS else f"a{w}" for w in probe_words]
        if self.symbols and [self._run_ids(w) for w in probe_words] != self._raw(probe_words):
            self.symbols = None  # runs are not encoded one by one

    def _symbols(self) -> "dict[int, str] | None":
        """The model's symbol of each letter and mark, by the tokenizer's own normalizer and pre-tokenizer."""
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or cut is None:
            return None
        found = {ord(c): cut.pre_tokenize_str(normal.normalize_str(c)) for c in LETTERS + RUN_MARKS}
        return {c: x[0][0] for c, x in found.items()} if all(len(x) == 1 for x in found.values()) else None

    def _run(self, run: str) -> bytes:
        """Ids of one run of letters or of marks, by the tokenizer's model."""
        runs = self.runs
        if len(runs) >= max(1, CACHE_WORDS // 2):
            runs.clear()
        ids = runs[run] = array("I", [t.id for t in self.model.tokenize(run)]).tobytes()
        return ids

    def _run_ids(self, word: str) -> "bytes | None":
        """Ids of a word of plain letters and marks behind them, run by run; None for any other word."""
        cut = self.split(word)
        if cut is None:
            return None
        letters, marks = cut.groups()
        letters = letters.translate(self.symbols)
        ids = self.runs.get(letters) or self._run(letters)
        if marks:
            marks = marks.translate(self.symbols)
            ids += self.runs.get(marks) or self._run(marks)
        return ids

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word: plain runs from the model, the others from few calls of the library, which has a high price per call."""
        if self.symbols is None:
            return self._together(words)
        found = [self._run_ids(w) for w in words]
        left = [w for w, ids in zip(words, found) if ids is None]
        rest = iter(self._together(left) if left else ())
        return [next(rest) if ids is None else ids for ids in found]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of each word, with runs of letters and other words in one text each."""
        easy: list[str] = []
        other: list[str] = []
        ends: list[int] = []
        for w in words if self.ends is not None else ():
            if w.lower().isalpha():
                ends.append(1)
            elif w[-1] in MARKS and w[:-1].lower().isalpha():
                ends.append(2)
            else:
                other.append(w)
                continue
            easy.append(w)
        known = dict(zip(easy, self._spaced(easy, ends))) if easy else {}
        left = other if easy else words
        known.update(zip(left, self._marked(left)))
        return [known[w] for w in words]

    def _spaced(self, words: list[str], ends: list[int]) -> list[bytes]:
        """Words that are one run of letters, or one and a mark, as one text: each has one or two tokens that end a run."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        at = np.flatnonzero(self.ends[ids])
        last = np.cumsum(ends)
        if len(at) != last[-1]:
            return self._marked(words)
        line, stops = ids.tobytes(), (4 * (at[last - 1] + 1)).tolist()
        return [line[i:j] for i, j in zip([0, *stops[:-1]], stops)]

    def _marked(self, words: list[str]) -> list[bytes]:
        """Any words as one text with a special token between them, which cuts it there."""
        if self.mark and len(words) > 1:
            number, mark = self.mark
            ids = np.array(self.tokenizer.encode_batch_fast([mark.join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(ids == number)
            if len(cuts) == len(words) - 1:  # no word holds the token itself
                line, at = ids.tobytes(), (4 * cuts).tolist()
                return [line[i:j] for i, j in zip([0, *(k + 4 for k in at)], [*at, len(line)])]
        return self._raw(words)

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def ids(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the new words of all of them are encoded together."""
        cut = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        known = self.cache
        new = set().union(*cut).difference(known)
        if new:
            if len(known) + len(new) > CACHE_WORDS:
                self.cache = known = {"": b""}
                new = set().union(*cut) - {""}
            long = [w for w in new if len(w) > CACHE_CHARS]
            if long:
                new.difference_update(long)
            short = list(new)
            for at in range(0, len(short), BATCH_WORDS):
                part = short[at : at + BATCH_WORDS]
                known.update(zip(part, self._words(part)))
            if long:
                known = known | dict(zip(long, self._raw(long)))
        return [b"".join(map(known.__getitem__, words)) for words in cut]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]

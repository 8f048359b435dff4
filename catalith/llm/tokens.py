"""Token ids and counts of whole texts, by the public tokenizer files.

Both encoders live once per Python worker and are found by file name, so no file's content travels
with a task.  ``WordIds`` gives exactly the ids of the ``tokenizers`` library for a vocabulary whose
merges never cross white space; it asks the library for each distinct word only once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import public_tokenizers

# Python parts words at all white space that pre-tokenizers of this kind drop, and at these besides.
SEPARATORS = "\x1c\x1d\x1e\x1f"
BLANKS = re.compile(r"[ \t\n\r]+")
MARKS = '.,;:!?*%&#$()"-'


def words_of(text: str | None) -> list[str]:
    """Parts of a text between white space, which no id crosses."""
    if not text:
        return []
    return BLANKS.split(text) if any(c in text for c in SEPARATORS) else text.split()


class WordIds:
    """Ids of texts for a word-bounded BPE vocabulary, as little-endian unsigned 32-bit bytes.

    Words between blanks are encoded apart, because pre-tokens and the vocabulary's special strings
    hold no white space.  New words are encoded together: the last id of a pre-token is one that
    closes a word, which shows where to part them; a word of letters is one pre-token, and so is a
    run of marks behind it.  Other words go to the library one by one.  ``keep`` bounds the words
    remembered; beyond it the memory starts anew, which changes nothing but time.
    """

    def __init__(self, name: str, keep: int = 1_600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.keep, self.known = keep, {"": b""}

    def _alone(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _together(self, words: list[str], parts: list[int]) -> list[bytes]:
        """Ids of words of known numbers of pre-tokens, encoded as one text and parted behind the last of each."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        last = np.cumsum(parts)
        if len(ends) != last[-1] or ends[-1] != len(ids):
            return self._alone(words)
        data, ends = ids.tobytes(), (4 * ends[last - 1]).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, words: list[str]) -> None:
        stems = [w.rstrip(MARKS) for w in words]
        plain = [(w, 1 + (len(s) < len(w))) for w, s in zip(words, stems) if s.isalpha()]
        for at in range(0, len(plain), 4000):
            block, parts = zip(*plain[at: at + 4000])
            self.known.update(zip(block, self._together(block, parts)))
        rest = [w for w, s in zip(words, stems) if not s.isalpha()]
        self.known.update(zip(rest, self._alone(rest)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """One byte string of ids per text; a missing text has none."""
        words = [words_of(t) for t in texts]
        needed = set().union(*words)
        fresh = needed.difference(self.known)
        if len(self.known) + len(fresh) > self.keep:
            self.known, fresh = {"": b""}, needed
        self._learn(list(fresh))
        return [b"".join(map(self.known.__getitem__, w)) for w in words]


@lru_cache(maxsize=4)
def word_ids(name: str, keep: int = 1_600_000) -> WordIds:
    """The worker's encoder for a vocabulary file."""
    return WordIds(name, keep)


@lru_cache(maxsize=4)
def _pieces(name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))


@lru_cache(maxsize=4)
def _plain(name: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def counts(name: str, texts: list[str]) -> list[int]:
    """Tokens of each whole text, without begin, end or added special tokens."""
    if name.endswith(".model"):
        return [len(ids) for ids in _pieces(name).encode(texts, num_threads=1)]
    found = _plain(name).encode_batch_fast(texts, add_special_tokens=False)
    return [len(e.ids) for e in found]

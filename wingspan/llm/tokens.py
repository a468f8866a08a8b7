"""Token ids of whole texts with a public tokenizer file.

The pre-tokenizer of the word-end BPE file never joins characters across
white space, and splits a run of letters from the punctuation after it; so
the ids of a text are the ids of its words in order.  Each Python worker
keeps a bounded table from words to ids and asks the tokenizer only for
words it has not met.
"""

from __future__ import annotations

import os
import re
from array import array

DEFAULT_FILE = "word_bpe_49k.json"
CACHE_WORDS = 400_000
BLOCK_WORDS = 50_000
# runs that the pre-tokenizer keeps whole: Latin letters (unchanged by NFC) and punctuation after them
_RUNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&$#*|\"()\[\]]*)")
_SPACES = re.compile(r"[^\S\x1c-\x1f]+")  # the tokenizer's white space
_ASCII_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_encoders: dict[str, WordEncoder] = {}


def _byte_level() -> dict[int, str]:
    """Byte-level spelling: printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_BYTE_LEVEL = _byte_level()


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_FILE)


class WordEncoder:
    """Encodes texts word by word; ids come back as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}

    def runs(self, word: str) -> bytes | None:
        """Ids of a word of letters and trailing punctuation straight from the BPE model, else None."""
        if word.isascii() and word.isalpha():
            core, tail = word.lower(), ""
        else:
            m = _RUNS.fullmatch(word)
            if m is None:
                return None
            core, tail = m[1].lower(), m[2]
        got = self.known.get(core)
        if got is None:
            got = self.known[core] = self._model_ids(
                core if core.isascii() else core.encode().decode("latin-1").translate(_BYTE_LEVEL))
        if not tail:
            return got
        end = self.known.get(tail)
        if end is None:
            end = self.known[tail] = self._model_ids(tail)
        return got + end

    def _model_ids(self, run: str) -> bytes:
        return array("I", [x.id for x in self.tokenizer.model.tokenize(run)]).tobytes()

    def learn(self, words: list[str]) -> None:
        """Add words to the table."""
        if len(self.known) + 2 * len(words) > CACHE_WORDS:
            self.known.clear()
        odd = []
        for w in words:
            got = self.runs(w)
            if got is None:
                odd.append(w)
            else:
                self.known[w] = got
        for w, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            self.known[w] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, special tokens not added; blocks of a bounded number of words at a time."""
        out: list[bytes] = []
        block: list[list[str]] = []
        held = 0
        for t in texts:
            plain = t.isascii() and not _ASCII_SEPARATORS.search(t)
            block.append(t.split() if plain else _SPACES.split(t))
            held += len(block[-1])
            if held >= BLOCK_WORDS:
                out += self._block(block)
                block, held = [], 0
        return out + self._block(block)

    def _block(self, split: list[list[str]]) -> list[bytes]:
        words = set().union(*split) if split else set()
        words.discard("")
        new = [w for w in words if w not in self.known]
        if new:
            full = len(self.known) + 2 * len(new) > CACHE_WORDS  # learn() starts over: all words again
            self.learn(list(words) if full else new)
        self.known.setdefault("", b"")
        get = self.known.__getitem__
        return [b"".join(map(get, ws)) for ws in split]


def encoder(path: str | None = None) -> WordEncoder:
    """The encoder of this Python process for a tokenizer file."""
    path = path or default_path()
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]

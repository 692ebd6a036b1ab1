"""Token ids of whole texts by a public tokenizer, with a bounded memory of known words."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa

# Both tokenizers cut at every change from anything to ASCII white space, so a
# text's ids are those of its pieces in a row: words for the one that drops white
# space, words with the white space before them for the other.
SPLITS = {"word_bpe_49k.json": bytes.split, "byte_bpe_50k.json": re.compile(rb"\s*\S+|\s+").findall}
# White space beyond ASCII. A run that mixes it with ASCII must not be cut.
WIDE_SPACE = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
# White space other than lone spaces and line ends, and the byte used to cut at those.
UNEVEN_SPACE = re.compile(rb"[\t\r\x0b\x0c\x00]|[ \n][ \n]")
# A word after one space; the byte-level tokenizer marks the first of its ids.
SPACED = re.compile(rb" [^\s]+")
SPACE_MARK = "\u0120"
# Marks that end a sentence or clause.
ENDS = (b".", b",")
# Pieces and words a generation of the memory holds, some 200 bytes each; there are two.
KNOWN_PIECES = 300_000
KNOWN_WORDS = 400_000
# New words are encoded this many at a time, with this special token between them.
BATCH = 20_000
BETWEEN = "<|endoftext|>"


class Encoder:
    """Encodes texts to bytes of little-endian unsigned 32-bit ids.

    A word seen lately is looked up. A comma or full stop that ends a piece is
    encoded apart where a letter stands before it, as the tokenizers do. Of two
    generations of known words, and of pieces, the older goes once the younger is full,
    so that frequent ones stay.
    """

    def __init__(self, name: str, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(BETWEEN)
        self.split = SPLITS[name]
        self.folds_case = self.split is bytes.split
        if not self.folds_case:
            marked = [(i, t) for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()]
            self.opens = np.zeros(max(marked)[0] + 1, dtype=bool)
            self.opens[[i for i, t in marked if t.startswith(SPACE_MARK)]] = True
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def _learn(self, words: list[bytes]) -> None:
        odd = [w for w in words if b"<|" in w]
        for word in odd:
            self.young[word] = self._ids(word.decode()).tobytes()
        if odd:
            words = [w for w in words if b"<|" not in w]
        if not self.folds_case:
            spaced = [w for w in words if SPACED.fullmatch(w)]
            words = [w for w in words if not SPACED.fullmatch(w)]
            for at in range(0, len(spaced), BATCH):
                some = spaced[at : at + BATCH]
                # A text of its own: every space begins a word, and an id of its own.
                ids = self._ids(b"".join(some).decode())
                starts = (4 * np.flatnonzero(self.opens[ids])).tolist()
                data = ids.tobytes()
                for word, start, end in zip(some, starts, [*starts[1:], len(data)], strict=True):
                    self.young[word] = data[start:end]
        for at in range(0, len(words), BATCH):
            some = words[at : at + BATCH]
            ids = self._ids(BETWEEN.join([w.decode() for w in some]))
            ends = np.flatnonzero(ids == self.between).tolist()
            data, start = ids.tobytes(), 0
            for word, end in zip(some, [*ends, len(ids)]):
                self.young[word] = data[4 * start : 4 * end]
                start = end + 1

    def _meet(self, pieces: set[bytes]) -> None:
        """Enter pieces into the memory."""
        if len(self.young) > KNOWN_WORDS:
            self.old, self.young = self.young, {}
        young, old, lower = self.young, self.old, self.folds_case
        words, ended = [], []
        for piece in pieces:
            if piece[-1:] in ENDS and piece[-2:-1].isalpha():
                ended.append(piece)
                piece = piece[:-1]
            words.append(piece.lower() if lower and b"<|" not in piece else piece)
        words += ENDS
        new = []
        for word in set(words):
            if word not in young:
                if word in old:
                    young[word] = old[word]
                else:
                    new.append(word)
        self._learn(new)
        self.known.update(zip(pieces, map(young.__getitem__, words)))
        for piece in ended:
            self.known[piece] += young[piece[-1:]]

    def _pieces(self, text: bytes) -> list[bytes] | None:
        """What a text is cut into; None if it has to be encoded whole."""
        if self.folds_case:
            return text.split()
        if not text.isascii() and WIDE_SPACE.search(text.decode()):
            return None
        if UNEVEN_SPACE.search(text):
            return self.split(text)
        # Lone spaces and line ends: a cut before each of them.
        return text.replace(b" ", b"\0 ").replace(b"\n", b"\0\n").split(b"\0")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as bytes, without special tokens of the tokenizer's own."""
        collecting = gc.isenabled()
        # Millions of pieces in lists, none of them in a cycle.
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        cut = [self._pieces(text) for text in texts]
        known = self.known.__contains__
        met = {p for pieces in cut if pieces for p in filterfalse(known, pieces)}
        if len(self.known) > KNOWN_PIECES:
            # What this call needs of the younger generation is in the older one now.
            self.before, self.known = self.known, {}
            met = set(chain.from_iterable(p for p in cut if p))
        before = self.before
        seen = met.intersection(before)
        self.known.update((p, before[p]) for p in seen)
        self._meet(met - seen)
        return [
            self._ids(text.decode()).tobytes()
            if pieces is None
            else b"".join(map(self.known.__getitem__, pieces))
            for text, pieces in zip(texts, cut)
        ]


@lru_cache(maxsize=2)
def encoder(name: str, path: str) -> Encoder:
    """One encoder per worker, whose memory outlives a task."""
    return Encoder(name, path)


def release() -> None:
    """Free the encoders that this worker holds from stages before, some 300 MB each."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        pa.default_memory_pool().release_unused()


def slices(texts: list[bytes | None], limit: int = 8_000_000) -> Iterable[tuple[int, list[bytes]]]:
    """Consecutive texts of some eight megabytes together, with the place of the first."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or b"")
        if size > limit and k > at:
            yield at, [t or b"" for t in texts[at:k]]
            at, size = k, len(text or b"")
    if at < len(texts):
        yield at, [t or b"" for t in texts[at:]]

"""Token ids by a public tokenizer file, word by word through bounded caches.

The tokenizer's own pattern never crosses white space and its normaliser treats
each word alone, so the ids of a text are those of its words in order. A task
encodes each distinct word of a block once and remembers ids. Words of ASCII and Latin-1
letters are normalised and cut here and their pieces given to the library's BPE
model; all other words go through the library's whole chain. Each cache is bounded
by ``CACHE_BYTES``, begun anew when full, and emptied when its task ends. A probe tells
whether a file behaves so; if not, whole texts go through the library.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from tidemark.llm import kernels as K

END_ID = 1
CACHE_BYTES = 64 << 20
ENTRY_BYTES = 160  # of a cache entry beside its characters and ids
#: Words that need no more than lower case before the tokenizer's pattern.
_PLAIN = re.compile("[!-;=-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")  # no '<', which may begin a special token
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
_CONTROL = re.compile("[\x1c-\x1f]")
_ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
_PROBE = "Two words,\nthe  2nd line's end! 12 345\té ß  x"


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def split_words(text: str) -> list[str]:
    # str.split() also cuts at U+001C-U+001F, which are no white space to the tokenizer
    return [w for w in _ASCII_SPACE.split(text) if w] if _CONTROL.search(text) else text.split()


class Encoder:
    """Ids of texts as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = 2 if self.code == "H" else 4
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.cache: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.cache_bytes = self.piece_bytes = 0
        self.model = self.tokenizer.model
        self.letters = {i: c for i, c in enumerate(_byte_letters())}
        whole = self._encode([_PROBE])[0]
        self.by_word = whole == b"".join(self._encode(split_words(_PROBE)))
        self.by_piece = self.by_word and whole == b"".join(self._words(split_words(_PROBE)))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        """The ids of one piece of the pattern, already in lower case."""
        if (ids := self.pieces.get(piece)) is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
            self.piece_bytes += ENTRY_BYTES + len(piece) + len(ids)
            if self.piece_bytes > CACHE_BYTES:
                self.pieces.clear()
                self.piece_bytes = ENTRY_BYTES + len(piece) + len(ids)
            self.pieces[piece] = ids
        return ids

    def release(self) -> None:
        self.cache.clear()
        self.pieces.clear()
        self.cache_bytes = self.piece_bytes = 0

    def _words(self, words: list[str]) -> list[bytes]:
        out, other = [], []
        for i, w in enumerate(words):
            if _PLAIN.fullmatch(w):
                out.append(b"".join([self._piece(p) for p in _PIECE.findall(w.lower())]))
            else:
                out.append(b"")
                other.append(i)
        for i, ids in zip(other, self._encode([words[i] for i in other])):
            out[i] = ids
        return out

    def _distinct(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        found = list(map(self.cache.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        spelled = [words[i].decode() for i in missing]
        for i, ids in zip(missing, (self._words if self.by_piece else self._encode)(spelled)):
            found[i] = ids
        self.cache_bytes += sum(ENTRY_BYTES + len(words[i]) + len(found[i]) for i in missing)
        if self.cache_bytes > CACHE_BYTES:  # what this block does not hold goes
            self.cache.clear()
            self.cache_bytes = 0
            if (size := sum(ENTRY_BYTES + len(w) + len(ids) for w, ids in zip(words, found))) <= CACHE_BYTES:
                self.cache.update(zip(words, found))
                self.cache_bytes = size
            return found
        for i in missing:
            self.cache[words[i]] = found[i]
        return found

    def encode(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts (null: empty), and where each text's ids begin, with an end mark."""
        tail = b"" if end_id is None else array(self.code, [end_id]).tobytes()
        if not self.by_word:
            parts = [ids + tail for ids in self._encode([t or "" for t in texts.to_pylist()])]
            sizes = np.array([len(p) // self.width for p in parts], dtype=np.int64)
            return np.frombuffer(b"".join(parts), dtype=self.dtype), np.concatenate(([0], np.cumsum(sizes)))
        data, offsets = K.string_buffers(texts)
        starts, ends, first = K.word_bounds(data, offsets)
        _, index, inverse = np.unique(K.word_hashes(data, starts, ends, fold_case=False), return_index=True, return_inverse=True)
        raw = data.tobytes()
        known = self._distinct([raw[a:b] for a, b in zip(starts[index].tolist(), ends[index].tolist())])
        known.append(tail)
        size = np.fromiter(map(len, known), np.int64, len(known)) // self.width
        begin = np.cumsum(size) - size
        order = np.insert(inverse, first[1:], len(known) - 1)  # each text's end id is one more word
        lengths = size[order]
        after = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(begin[order] - after[:-1], lengths) + np.arange(after[-1])
        edges = np.concatenate(([0], first[1:] + np.arange(1, len(first))))
        return np.frombuffer(b"".join(known), dtype=self.dtype)[at], after[edges]


def _byte_letters() -> list[str]:
    """The character by which byte-level vocabularies spell each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """The worker's encoder for ``file``."""
    if file not in _ENCODERS:
        _ENCODERS[file] = Encoder(file)
    return _ENCODERS[file]


def release() -> None:
    """For the end of a task: empty caches, free memory."""
    for enc in _ENCODERS.values():
        enc.release()
    K.trim()


def encode_array(texts: pa.Array, file: str, end_id: int | None = END_ID, block: int = 4 << 20):
    """Yield the ids of each text (null: empty), with ``end_id`` at the end; block by block."""
    enc = encoder(file)
    for i, j in K.blocks(texts, block):
        ids, at = enc.encode(texts.slice(i, j - i), end_id)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield ids[a:b]

"""Exact subword encoding with the ``tokenizers`` library, word by word.

The library's byte-level pre-tokenizer never joins what stands before a space
with the space when a visible character follows it, and never joins across a
lone newline between visible characters.  Texts are cut at these places, each
distinct piece is encoded by the library once per task, and a document's ids
are the joined ids of its pieces.  Texts with other white space are cut only
where the rule holds.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corral.llm.common import kept_between_tasks

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# A piece of one letter run and at most one run of plain marks: two pre-tokens.
_PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{|}~]*)")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_level_table() -> dict[int, str]:
    """Byte value to the character that stands for it in byte-level vocabularies:
    printable Latin-1 characters stand for themselves, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_level_chars() -> str:
    """The characters of ``byte_level_table`` in the order of their bytes."""
    table = byte_level_table()
    return "".join([table[b] for b in range(256)])


_ID = attrgetter("id")


def token_ids(model, text: str) -> bytes:
    """Ids from the library's merge model of one pre-token in byte-level characters."""
    return array("I", map(_ID, model.tokenize(text))).tobytes()


def model_ids(model, chars: str, word: str) -> bytes:
    """Ids of one pre-token from the library's merge model."""
    return token_ids(model, codecs.charmap_decode(word.encode(), "strict", chars)[0])


class _Memory(dict):
    """Ids by piece; a piece that is not there is taken from the older memory, or
    learned, when it is asked for."""

    def __init__(self, learn: Callable[[str], bytes], older: dict[str, bytes]):
        self.learn, self.older = learn, older

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.learn(key)
        self[key] = ids
        return ids


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    Pieces are remembered between batches.  A memory over ``max_words`` pieces
    becomes the older one, from which pieces still in use are taken over, and
    the oldest is dropped: about twice ``max_words`` are held at most, plus one
    batch."""

    def __init__(self, path: str, max_words: int = 500_000):
        self.tok = load_tokenizer(path)
        self.max_words = max_words
        self.known = _Memory(self._learn, {})  # its older one: before the last change of memories
        self.model, self.chars = self.tok.model, byte_level_chars()
        self.space = self.chars[32]
        self.marks: dict[str, bytes] = {}

    @staticmethod
    def _spaced(text: str) -> tuple[str, str] | None:
        """``text`` up to its tail, so that a split at spaces gives its keys, and the tail;
        None for a text with other white space."""
        body = text.rstrip(" \n")
        # printable: no white space but plain spaces, nothing that is no character
        odd = not body.replace("\n", "").isprintable()
        spaced = body.replace("\n", " \n")
        # white space beside white space shows as two spaces, or a newline before a space
        if odd or "  " in spaced or "\n " in spaced or body[:1] == "\n":
            return None
        return "\0" + spaced, text[len(body) :]

    @classmethod
    def pieces(cls, text: str) -> list[str]:
        """Keys of the pieces of ``text``: ``\\0`` + piece, a piece that starts
        with a newline, or the rest of a piece that starts with a space."""
        plain = cls._spaced(text)
        if plain is None:
            body = text.rstrip(" \n")
            cut = body.split(" ")
            whole = [cut[0]]
            for part in cut[1:]:
                if part and part[0].isprintable():
                    whole.append(" " + part)
                else:
                    whole[-1] += " " + part
            # the end of an odd text may be white space that belongs to the tail
            whole[-1] += text[len(body) :]
            return ["\0" + w for w in whole]
        spaced, tail = plain
        keys = spaced.split(" ")
        if tail:
            keys.append("\0" + tail)
        return keys

    def _run(self, word: str) -> bytes:
        """Ids of a new letter run after a space."""
        if word.isascii():
            return token_ids(self.model, self.space + word)
        return model_ids(self.model, self.chars, " " + word)

    def _word(self, word: str) -> bytes:
        """Ids of a letter run after a space; its key is the run itself."""
        got = self.known.get(word)
        if got is None:
            got = self.known[word] = self.known.older.get(word) or self._run(word)
        return got

    def _marks(self, marks: str) -> bytes:
        if (ids := self.marks.get(marks)) is None:
            ids = self.marks[marks] = model_ids(self.model, self.chars, marks) if marks else b""
        return ids

    def _learn(self, key: str) -> bytes:
        """Ids of a new piece: a plain one by its two pre-tokens, others whole."""
        if key.isascii():
            if key.isalpha():
                return self._run(key)
            word = key.rstrip(_MARKS)
            if word.isalpha():
                return self._word(word) + self._marks(key[len(word) :])
        m = _PLAIN.fullmatch(key)
        if m is None:
            text = key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        newline, word, marks = m.groups()
        if newline:
            ids = model_ids(self.model, self.chars, newline) + model_ids(self.model, self.chars, word)
        elif not marks:
            return self._run(word)
        else:
            ids = self._word(word)
        return ids + self._marks(marks)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.max_words:
            self.known, self.marks = _Memory(self._learn, self.known), {}
            self.known.older.older = {}
        ids_of = self.known.__getitem__
        plain = [self._spaced(t) for t in texts]
        tails = [p and p[1] for p in plain]
        found = self._joined(pa.array([p[0] for p in plain if p], pa.large_string()))
        del plain
        out = []
        for text, tail in zip(texts, tails):
            if tail is None:
                out.append(b"".join(map(ids_of, self.pieces(text))))
            else:
                out.append(next(found) + ids_of("\0" + tail) if tail else next(found))
        return out

    def _joined(self, spaced: pa.Array, keys: int = 8192) -> Iterator[bytes]:
        """Ids of texts with their keys between spaces.  A key of several places is looked
        up once; ids are gathered for about ``keys`` places (one text at least) at a time."""
        if not len(spaced):
            return
        lists = pc.split_pattern(spaced, " ")
        codes = lists.flatten().dictionary_encode()
        known = [self.known[key] for key in codes.dictionary.to_numpy(zero_copy_only=False)]
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        ids = np.frombuffer(b"".join(known), dtype="<u4")
        del known
        start = np.cumsum(size) - size
        which, cuts = codes.indices.to_numpy(), lists.offsets.to_numpy()
        first = 0
        while first < len(spaced):
            last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + keys, side="right")) - 1)
            own = which[cuts[first] : cuts[last]]
            n = size.take(own)
            ends = np.cumsum(n)
            places = np.repeat(start.take(own) - ends + n, n)
            places += np.arange(len(places))
            data = ids.take(places).tobytes()
            edges = 4 * np.concatenate([[0], ends]).take(cuts[first : last + 1] - cuts[first])
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                yield data[i:j]
            first = last


_ENCODERS: dict[str, WordEncoder] = kept_between_tasks()


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for ``path`` (loaded once per Python worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]

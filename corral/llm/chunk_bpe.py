"""Encoding and decoding with reuse of content-defined chunks."""

from __future__ import annotations

import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corral.llm.common import map_batches, text_batches, texts_of
from corral.llm.encode import byte_level_chars, load_tokenizer, model_ids

WINDOW = 32  # characters that decide on a cut
# One letter run with at most one run of plain marks: two pre-tokens of this vocabulary.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{|}~]*)")


def cut_points(texts: list[str], mean_chars: int) -> list[list[int]]:
    """Cut positions of every text: where a rolling hash of the last ``WINDOW``
    characters has ``log2(mean_chars)`` zero bits.  Equal passages get equal cuts
    wherever they stand, from their ``WINDOW``-th character on.
    """
    bits = max(1, int(mean_chars).bit_length() - 1)
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    h = (joined * np.uint32(2654435761)) ^ (joined >> np.uint32(3))
    step = 1
    while step < WINDOW:  # h[i] sums the last `step` characters, weighted by age
        older = np.zeros_like(h)
        older[step:] = h[:-step] if len(h) > step else 0
        h = h + older * np.uint32(pow(31, step, 1 << 32))
        step *= 2
    h ^= h >> np.uint32(15)
    hits = np.flatnonzero((h * np.uint32(2246822519)) >> np.uint32(32 - bits) == 0) + 1
    ends = np.cumsum([len(t) for t in texts])
    out, at = [], 0
    firsts = np.searchsorted(hits, np.concatenate(([0], ends[:-1])) + WINDOW, side="left")
    lasts = np.searchsorted(hits, ends, side="left")
    for a, b, text in zip(firsts.tolist(), lasts.tolist(), texts):
        out.append((hits[a:b] - at).tolist() if b > a else [])
        at += len(text)
    return out


class ChunkEncoder:
    """Encodes texts chunk by chunk, each distinct chunk once per batch window.

    A chunk is cut at arbitrary characters, so the ids at its two ends may be
    wrong in context.  ``_chunk`` encodes it and keeps the ids between its first
    and last space, which no context can change, apart from its raw ends.
    Where two chunks meet, the text from the last space of the left to the
    first space of the right is encoded anew; if a chunk has no space, the
    repair widens over it to the next chunk, up to the whole text, until both of
    its ends agree with ids that stay.
    """

    def __init__(self, path: str, mean_chars: int = 512, max_chunks: int = 60_000, max_words: int = 400_000):
        self.tok = load_tokenizer(path)
        self.mean_chars, self.max_chunks, self.max_words = mean_chars, max_chunks, max_words
        self.words: dict[str, bytes] = {"": b""}
        self.chunks: dict[str, tuple[str, bytes | None, str]] = {}
        self.model, self.chars = self.tok.model, byte_level_chars()
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.reused = self.encoded = 0

    def _learn(self, words) -> None:
        hard, known, older = [], self.words, self.older
        for word in words:
            if word in older:
                known[word] = older[word]
                continue
            m = _PLAIN.fullmatch(word)
            if m is None:
                hard.append(word)
                continue
            letters, marks = m.groups()
            ids = known.get(letters) or older.get(letters)
            if ids is None:
                low = letters.lower()
                if low.isascii():
                    ids = array("I", [t.id for t in self.model.tokenize(low)]).tobytes()
                else:
                    ids = model_ids(self.model, self.chars, low)
            known[letters] = ids
            if marks:
                if (tail := self.marks.get(marks)) is None:
                    tail = self.marks[marks] = model_ids(self.model, self.chars, marks)
                known[word] = ids + tail
        for word, enc in zip(hard, self.tok.encode_batch(hard, add_special_tokens=False)):
            known[word] = array("I", enc.ids).tobytes()

    def _encode(self, text: str) -> bytes:
        """Ids of a text that context cannot change: white space always parts
        pre-tokens of this vocabulary and leaves no id."""
        words = text.replace("\n", " ").split(" ")
        known = self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            self._learn(set(words).difference(known))
            return b"".join([known[w] for w in words])

    def _chunk(self, chunk: str) -> tuple[str, bytes | None, str]:
        """Raw head, ids of the inside (None: no space in it), raw tail."""
        got = self.chunks.get(chunk)
        if got is None:
            first, last = chunk.find(" "), chunk.rfind(" ")
            if first < 0:
                got = (chunk, None, "")
            else:
                got = (chunk[:first], self._encode(chunk[first:last]) if last > first else b"", chunk[last + 1 :])
            self.chunks[chunk] = got
            self.encoded += 1
        else:
            self.reused += 1
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.max_words:
            self.words, self.older, self.marks = {"": b""}, self.words, {}
        if len(self.chunks) > self.max_chunks:
            self.chunks.clear()
        out = []
        for text, cuts in zip(texts, cut_points(texts, self.mean_chars)):
            ids, open_text, at = [], "", 0
            for cut in [*cuts, len(text)]:
                head, inside, tail = self._chunk(text[at:cut])
                at = cut
                if inside is None:
                    open_text += head  # no safe place yet: widen the repair
                    continue
                ids.append(self._encode(open_text + head))
                ids.append(inside)
                open_text = tail
            ids.append(self._encode(open_text))
            out.append(b"".join(ids))
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}
_TOKENS: dict[str, list[str]] = {}


def chunk_encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def decoder(path: str):
    """A function from a list of ids to the text the library's decode gives
    (special tokens kept); for vocabularies without a decoder, which the library
    joins with single spaces."""
    if path not in _TOKENS:
        tok = load_tokenizer(path)
        if tok.decoder is not None:
            raise ValueError("vocabularies with a decoder step are not handled here")
        size = tok.get_vocab_size(with_added_tokens=True)
        _TOKENS[path] = [tok.id_to_token(i) or "" for i in range(size)]
    tokens = _TOKENS[path]
    return lambda ids: " ".join([tokens[i] for i in ids])


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)`` of every row: the ids the library gives for the
    whole text without special tokens, and the text its decode gives for them.

    One pass without a shuffle; chunks and words seen before in the same Python
    worker are not encoded again (both memories are bounded).  Null text: empty,
    so no ids and an empty decoded text.  Null or repeated ids and repeated rows
    are kept as they are.  Empty table: no rows.
    """

    def run(batches):
        enc, dec = chunk_encoder(tokenizer), decoder(tokenizer)
        for ids, texts in text_batches(batches, max_chars=1_000_000):
            lists = [np.frombuffer(b, dtype="<u4").tolist() for b in enc.encode(texts)]
            yield {"doc_id": ids, "ids": lists, "decoded": [dec(x) for x in lists]}

    return map_batches(texts_of(docs, id_col, text_col), run, "doc_id long, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """Digest columns of :func:`encode_decode`'s rows."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Token ids of whole texts with the public ``word_bpe`` tokenizer.

The vocabulary drops white space and never joins across it, so a text's ids are
the ids of its words one after the other. Each task encodes a distinct word once
with the tokenizers library and reuses its ids; ``tests/llm`` holds the result
against encoding the whole text.
"""

from __future__ import annotations

import os

import numpy as np

WORD_BPE = "word_bpe_49k.json"
CACHE_WORDS = 300_000  # words remembered per Python worker before it starts over
CACHE_BYTES = 16 << 20
CHUNK = 200  # words encoded in one call

# Marks that the pre-tokenizer always cuts off a preceding letter. Quotes (they
# start contractions) and the characters of special tokens are not among them.
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?*%$&#")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyz")] = True


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


def words_of(text: bytes) -> list[bytes]:
    """Runs of a text whose ids are independent: its words, cut once more between a
    letter a-z and a mark, so that a word is met in fewer spellings."""
    if b"<|" in text:  # may hold a special token, whose spelling counts
        return text.split()
    text = text.lower()
    codes = np.frombuffer(text, np.uint8)
    cuts = np.flatnonzero(_LETTER[codes[:-1]] & _MARK[codes[1:]]) + 1
    if len(cuts):
        spaced = np.full(len(codes) + len(cuts), 32, np.uint8)
        keep = np.ones(len(spaced), bool)
        keep[cuts + np.arange(len(cuts))] = False
        spaced[keep] = codes
        text = spaced.tobytes()
    return text.split()


class WordEncoder:
    """Texts (UTF-8 bytes) to ids as little-endian 16-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        if max(vocabulary.values()) > 0xFFFF:
            raise ValueError("ids must fit 16 bits")
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self._ends[i] = piece.endswith("</w>")
        self._ids: dict[bytes, bytes] = {}
        self._held = 0

    def _put(self, word: bytes, ids: bytes) -> None:
        self._ids[word] = ids
        self._held += len(word) + len(ids)

    def _encode_each(self, words: list[bytes]) -> None:
        found = self._tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        for w, e in zip(words, found):
            self._put(w, np.array(e.ids, "<u2").tobytes())

    def _encode_words(self, words: list[bytes]) -> None:
        """Words of letters only are one pre-token each: encoded together, cut at word ends."""
        plain, other = [], []
        for w in words:
            (plain if w.isalpha() or w.decode().isalpha() else other).append(w)
        for i in range(0, len(plain), CHUNK):
            part = plain[i : i + CHUNK]
            ids = np.array(self._tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u2")
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(part):  # a letter that normalises to more than a letter
                self._encode_each(part)
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(part, (2 * ends).tolist()):
                self._put(w, raw[at:end])
                at = end
        if other:
            self._encode_each(other)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self._ids) > CACHE_WORDS or self._held > CACHE_BYTES:
            self._ids.clear()
            self._held = 0
        split = [words_of(t) for t in texts]
        new: set[bytes] = set()
        for words in split:
            new.update(words)
        new = new.difference(self._ids)  # looks up the new words, doesn't walk the memory
        if new:
            self._encode_words(list(new))
        get = self._ids.__getitem__
        return [b"".join(map(get, words)) for words in split]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This Python worker's encoder; its word memory lasts over tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop this Python worker's encoders and their words."""
    _encoders.clear()


GROUP_BYTES = 1 << 20


def encoded_groups(batches, path: str):
    """(doc ids, id arrays) for runs of rows of about ``GROUP_BYTES`` of text.

    ``batches`` have columns (doc_id, text bytes); a null text counts as empty.
    """
    enc = encoder(path)
    for batch in batches:
        keys = batch.column(0).to_pylist()
        texts: list[bytes] = []
        size = first = 0
        for i, item in enumerate(batch.column(1)):
            text = item.as_py() or b""
            texts.append(text)
            size += len(text)
            if size >= GROUP_BYTES or i + 1 == len(keys):
                yield keys[first : i + 1], [np.frombuffer(x, "<u2") for x in enc.encode(texts)]
                texts, size, first = [], 0, i + 1

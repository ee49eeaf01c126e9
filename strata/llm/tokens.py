"""Token ids of whole texts, with a published byte-level BPE vocabulary.

The ids are those of the ``tokenizers`` library. It is slow on running text but
its first step cuts the text at white space and before stops, so the ids of a text are the ids
of these pieces one after another. A special token's string in a text is that token, as in a plain call. A task therefore encodes each
distinct piece once and looks repeated ones up in a direct-mapped table. Of a vocabulary that lower-cases, a
piece which its normaliser and pattern do no more to than lower-case goes straight to the library's BPE model.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from strata.llm import arrays

SLOTS = 20  # 2**20 table entries
STORE_IDS = 1 << 23  # the table starts anew beyond this many ids
ENCODED = 1 << 11  # pieces in one call of the library: what it returns holds far more than the ids

STOPS = b".,;:!?"

# What LowerCasing may take to the model alone: a word, and signs other than an apostrophe behind it, in a
# vocabulary with exactly this way to the model. The letters (ASCII, U+00C0 to U+00FF) compose with nothing there.
PLAIN = re.compile(r" ?([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_SPECIAL = re.compile(r"<\|\w+\|>")  # never part of a plain piece
_WAY = {
    "truncation": None,
    "padding": None,
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}


def public(name: str) -> str:
    """The path of a published vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary(path: str | None = None) -> str:
    """The vocabulary file's text (read on the driver, about 2 MB)."""
    with open(path or public("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


class Encoder:
    """Encodes texts with one vocabulary; made once per worker process."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def of(cls, vocabulary_json: str) -> Encoder:
        key = f"{cls.__name__} {hashlib.md5(vocabulary_json.encode()).hexdigest()}"
        if key not in cls._made:
            cls._made[key] = cls(vocabulary_json)
        return cls._made[key]

    def __init__(self, vocabulary_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary_json)
        self.reset()

    def reset(self) -> None:
        self.tag = np.zeros(1 << SLOTS, dtype=np.uint64)
        self.at = np.zeros(1 << SLOTS, dtype=np.int64)
        self.length = np.zeros(1 << SLOTS, dtype=np.int32)
        self.store = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def keep(self, ids: np.ndarray) -> int:
        at = self.used
        if at + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(max(len(self.store), len(ids)), np.uint32)])
        self.store[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def encode_pieces(self, words: list[str]) -> list[list[int]]:
        parts = (words[lo : lo + ENCODED] for lo in range(0, len(words), ENCODED))
        return [x.ids for part in parts for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; where each text's ids start, and the end)."""
        if self.used > STORE_IDS:
            self.reset()
        start = pieces(data, at)
        end = np.append(start[1:], len(data))
        h = arrays.segment_hash(data, start, end) | np.uint64(1)  # 0 marks an empty slot
        slot = (h >> np.uint64(64 - SLOTS)).astype(np.int64)
        where, length = self.at[slot], self.length[slot]
        missing = np.flatnonzero(self.tag[slot] != h)
        if len(missing):
            new, first, again = np.unique(h[missing], return_index=True, return_inverse=True)
            first = missing[first]
            raw = data.tobytes()
            ids = self.encode_pieces([raw[s:e].decode() for s, e in zip(start[first].tolist(), end[first].tolist())])
            n = np.array([len(x) for x in ids], dtype=np.int64)
            begin = self.keep(np.array([i for x in ids for i in x], dtype=np.uint32)) + np.cumsum(n) - n
            where[missing], length[missing] = begin[again], n[again]
            self.tag[slot[first]], self.at[slot[first]], self.length[slot[first]] = h[first], begin, n
        out = self.store[np.repeat(where, length) + arrays.spread(length)]
        total = np.concatenate([[0], np.cumsum(length)])
        return out, total[np.searchsorted(start, at)]

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, starts) for consecutive slices of an Arrow column."""
        for lo, _, data, at in arrays.chunks(column, arrays.CHUNK_BYTES // 2):
            yield lo, *self.encode(data, at)


class LowerCasing(Encoder):
    """For a vocabulary that lower-cases its texts: words that differ in the case of A-Z are one piece."""

    def __init__(self, vocabulary_json: str):
        super().__init__(vocabulary_json)
        from tokenizers import pre_tokenizers

        made = json.loads(vocabulary_json)
        known = all(made.get(k) == v for k, v in _WAY.items()) and all(_SPECIAL.fullmatch(x["content"]) for x in made["added_tokens"])
        self.model = self.tokenizer.model if known else None
        # The model takes bytes as characters; those of ASCII stand for themselves.
        way = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: way.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def encode_pieces(self, words: list[str]) -> list[list[int]]:
        if self.model is None:
            return super().encode_pieces(words)
        tokenize, letters = self.model.tokenize, self.letters
        out: list = []
        other = []
        for w in words:
            m = PLAIN.fullmatch(w)
            if not m:
                other.append(len(out))
                out.append(None)
                continue
            word, signs = m.groups()
            word = word.lower() if word.isascii() else word.lower().translate(letters)
            ids = [x.id for x in tokenize(word)]
            if signs:
                ids += [x.id for x in tokenize(signs)]
            out.append(ids)
        for i, ids in zip(other, super().encode_pieces([words[i] for i in other])):
            out[i] = ids
        return out

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # A special token's string is one only as written, so a slice with "<|" stays as it is.
        if len(data) and not ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any():
            # A letter before a combining mark stays too: W with a ring has no single character, w has one.
            alone = np.ones(len(data), dtype=bool)
            alone[:-1] = data[1:] < 0x80
            data = data + ((data - np.uint8(0x41) < 26) & alone).view(np.uint8) * np.uint8(0x20)
        return super().encode(data, at)


def pieces(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places where a text can be cut without changing its ids.

    Before a single space, and on both sides of a single line feed, that stands
    between two characters that are surely not white space (ASCII graphic, or
    U+00C0 to U+00FF), and between an ASCII letter and a stop: there the vocabularies' patterns
    always start a new match, and what follows can't change the match before.
    """
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n:
        graphic = data - np.uint8(0x21) < 0x5E
        latin = data == 0xC3
        before = np.zeros(n, dtype=bool)
        before[1:] = graphic[:-1]
        before[2:] |= latin[:-2]
        after = np.zeros(n, dtype=bool)
        after[:-1] = graphic[1:] | latin[1:]
        alone = before & after
        cut[:n] = alone & (data == 0x20)
        line = np.flatnonzero(alone & (data == 0x0A))
        cut[line] = True
        cut[line + 1] = True
        letter = (data | np.uint8(0x20)) - np.uint8(0x61) < 26
        stop = np.zeros(n, dtype=bool)
        for b in STOPS:
            stop |= data == b
        cut[1:n] |= letter[:-1] & stop[1:]
    cut[at] = True
    cut[n] = False
    return np.flatnonzero(cut)

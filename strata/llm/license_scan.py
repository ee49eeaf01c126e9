"""License scans by template-markup matching.

Each template's markup is compiled into a token automaton: mandatory words must
stand exactly and in order, optional regions may be skipped, replaceable
regions take a bounded number of any words. Automata run only where a
template's first mandatory words stand, which the word hashes of a whole slice
find at once; a match is a place where an automaton accepts.

Beside them stand the base phrases, found as consecutive words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.

Templates are the notices and short licences of ``license_templates.TEMPLATES`` and the full
texts of the long ones; they are broadcast (bounded by the templates, about 130 KB) and compiled once per
worker.

Defined cases: a null text is empty and has no words and no labels; a very long text is
scanned whole; where several templates accept at one place all count; repeated
rows are scanned one by one; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.license_templates import EQUAL, TEMPLATES, full_texts
from strata.llm.session import ship_code

# The base phrases and their labels.
PHRASES: dict[str, str] = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
MARKUP = re.compile(r"<<(beginOptional|endOptional|var \d+)>>")
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ANY = None
_EQUAL = {a.encode(): b.encode() for a, b in EQUAL.items()}


def words_of(text: str) -> list[bytes]:
    lower = arrays.LOWER[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes()
    return [_EQUAL.get(w, w) for w in WORD.findall(lower)]


class Automaton:
    """A template as a nondeterministic automaton over words.

    ``moves[s]`` is (word or ANY, next state); ``skips[s]`` are states reached
    without a word; the last state accepts. ``anchor`` holds the first
    mandatory words: an optional region before them decides nothing.
    """

    def __init__(self, template: str):
        self.moves: list[tuple[bytes | None, int] | None] = [None]
        self.skips: list[list[int]] = [[]]
        self.mandatory = 0
        parts = MARKUP.split(template)
        self.anchor: list[bytes] = []
        opened: list[int] = []
        anchoring = True
        for k, part in enumerate(parts):
            if k % 2 == 0:
                words = words_of(part)
                if not opened:
                    self.mandatory += len(words)
                    if anchoring:
                        self.anchor += words
                if opened and not self.anchor:
                    continue  # optional wording before the anchor
                for w in words:
                    self._step(w)
            elif part == "beginOptional":
                opened.append(len(self.moves) - 1)
                anchoring = anchoring and not self.anchor
            elif part == "endOptional":
                start = opened.pop()
                if start != len(self.moves) - 1:
                    self.skips[start].append(len(self.moves) - 1)
            elif self.anchor:
                anchoring = False
                start = [len(self.moves) - 1]
                for _ in range(int(part.split()[1])):
                    self._step(ANY)
                    start.append(len(self.moves) - 1)
                for s in start[:-1]:
                    self.skips[s].append(start[-1])
        if opened or not self.anchor:
            raise ValueError("a template needs mandatory words first and closed optional regions")

    def _step(self, word: bytes | None) -> None:
        self.moves[-1] = (word, len(self.moves))
        self.moves.append(None)
        self.skips.append([])

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skips[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def longest(self, words: Iterator[bytes]) -> int:
        """How many words the longest accepted prefix has, or 0."""
        accept = len(self.moves) - 1
        states, n, best = self._closed({0}), 0, 0
        for w in words:
            moves = (self.moves[s] for s in states)
            states = self._closed({m[1] for m in moves if m and (m[0] is ANY or m[0] == w)})
            n += 1
            if accept in states:
                best = n
            if not states or states == {accept}:
                break
        return best


class Scanner:
    _made: dict[tuple, Scanner] = {}

    @classmethod
    def of(cls, templates: dict[str, str]) -> Scanner:
        key = tuple(sorted(templates.items()))
        if key not in cls._made:
            cls._made = {key: cls(templates)}
        return cls._made[key]

    def __init__(self, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        self.automata = {label: Automaton(t) for label, t in templates.items()}
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.equal = [(_one_hash(a), _one_hash(b)) for a, b in _EQUAL.items()]

    def scan(self, w: arrays.Words) -> Iterator[tuple[str, str, int, int, int]]:
        """("base" or "template", label, document, first word, number of words)."""
        h = w.hashes()
        for phrase, label in self.phrases:
            for i in _places(w, h, phrase):
                if w.text(i, len(phrase)) == b" ".join(phrase):
                    yield "base", label, int(w.doc[i]), i - int(w.first[w.doc[i]]), len(phrase)
        if any((h == variant).any() for variant, _ in self.equal):
            h = h.copy()
            for variant, plain in self.equal:
                h[h == variant] = plain
        for label, automaton in self.automata.items():
            for i in _places(w, h, automaton.anchor[:4]):
                n = automaton.longest(_following(w, i))
                if n:
                    yield "template", label, int(w.doc[i]), i - int(w.first[w.doc[i]]), n


def _one_hash(word: bytes) -> np.uint64:
    data = np.frombuffer(word, dtype=np.uint8)
    return arrays.segment_hash(data, np.array([0]), np.array([len(data)]))[0]


def _places(w: arrays.Words, h: np.ndarray, words: list[bytes]) -> list[int]:
    """Where these words' hashes stand one after another in one text."""
    m = len(h) - len(words) + 1
    if m <= 0:
        return []
    at = np.flatnonzero(h[:m] == _one_hash(words[0]))
    for k, x in enumerate(words[1:], 1):
        at = at[h[at + k] == _one_hash(x)]
    return at[w.doc[at] == w.doc[at + len(words) - 1]].tolist()


def _following(w: arrays.Words, i: int) -> Iterator[bytes]:
    """The words of word i's text from i on."""
    for k in range(i, int(w.first[w.doc[i] + 1])):
        x = w.data[w.start[k] : w.end[k]].tobytes()
        yield _EQUAL.get(x, x)


def scan_licenses(documents: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, found: array of (kind, label, first, n) in word positions.

    templates: those of ``license_templates`` unless others are given.

    kind is "base" for a phrase and "template" for an accepted template.
    """
    ship_code(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(TEMPLATES | full_texts() if templates is None else templates)
    kind = documents.schema["doc_id"].dataType.simpleString()
    place = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("first", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner.of(shared.value)
        for batch in batches:
            counts, found = [], []
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                w = arrays.Words(data, at)
                mine: list[list[dict]] = [[] for _ in range(hi - lo)]
                for kind_, label, doc, first, n in scanner.scan(w):
                    mine[doc].append({"kind": kind_, "label": label, "first": first, "n": n})
                counts += w.count.tolist()
                found += mine
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(found, place)], ["doc_id", "n_words", "found"]
            )

    schema = f"doc_id {kind}, n_words long, found array<struct<kind:string,label:string,first:long,n:long>>"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def op8_license_scan(documents: DataFrame) -> DataFrame:
    """The contract's digest. score: 1 with an accepted template, 0.5 with a base phrase only, else 0."""
    base = F.filter("found", lambda x: x["kind"] == "base")
    starts = F.transform(base, lambda x: x["first"])

    def joined(places: F.Column) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")

    accepted = F.exists("found", lambda x: x["kind"] == "template")
    return scan_licenses(documents).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        F.when(accepted, 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"),
        F.filter("found", lambda x: x["kind"] == "template").alias("templates"),
    )

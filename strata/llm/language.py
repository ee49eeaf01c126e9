"""Language ID by prediction by partial matching over bytes.

Training counts, per language, every byte after its three preceding bytes over
all training texts (a text starts after three zero bytes): the context tree of
depth three, whose shorter contexts are its marginals. The counts are made in
the tasks and summed with map-side partial sums. Every counted context is kept.

The tree is broadcast only within a proven bound: its size is measured first,
and beyond ``BLOCK_CELLS`` it is dealt over blocks by the two bytes before a
byte (a single such pair is never split). Each block is read, broadcast and
scored with in a pass of its own, whose code lengths are written before the next
block is read; then they are summed per document. The driver holds one block at
a time, and the counts of two bytes (at most 65,536 for a language).

Frozen statistics then give every byte an exact probability (PPM, escape method
C, with exclusion): in a context with n bytes seen, d of them different, a seen
byte has count / (n + d), and the others share d / (n + d) in proportion to
their probability in the next shorter context; at the end stands the uniform
distribution. A text's code length in a language is the sum over its bytes, and
the shortest one wins.

The model is a few tables: the code length of each three-byte context's known
bytes in every language, and of what escapes from it. Scoring is a table
look-up per byte of whole texts.

Defined cases: a text without a letter (a character of the Unicode categories L; a fraction, a
superscript or a Roman numeral sign is none), or null, is ``und`` with score 0, and so
is every text if no language was learned; equal code lengths go to the first
language in order; a null doc_id is neither held out nor trained on; repeated rows are counted
and predicted one by one; a very long text is read whole; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.session import checkpointed, ship_code

BLOCK_CELLS = 1 << 22  # of a block's table: listed grams times languages
PAIRS = 1 << 16  # contexts of two bytes
UNDETERMINED = "und"
FOLDS, HELD_OUT = 5, 0
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
EMPTY = np.uint32(0xFFFFFFFF)


def grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each byte with its three predecessors in its text, as one number (zeros before a text)."""
    n = len(data)
    g = data.astype(np.uint32)
    since = np.arange(n) - np.repeat(at[:-1], np.diff(at))  # place in the text
    for k in (1, 2, 3):
        before = np.zeros(n, dtype=np.uint32)
        before[k:] = data[:-k] if n > k else before[k:]
        before[since < k] = 0
        g |= before << np.uint32(8 * k)
    return g


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), dtype=object)
        for lo, hi, data, at in arrays.chunks(batch["text"], 4 << 20):
            g = grams(data, at)
            size = np.diff(at)
            for lang in dict.fromkeys(langs[lo:hi].tolist()):
                mine = np.repeat(langs[lo:hi] == lang, size)
                u, n = np.unique(g[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(u), pa.string()), pa.array(u.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                )


class Model:
    """Code lengths in bits under frozen context trees, for all languages side by side.

    ``counts`` holds each language's grams and their counts. A block of a larger
    tree has the grams whose two middle bytes are in ``span``, and ``pairs``, the
    counts of two bytes in the whole tree; it scores the bytes after such a pair.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], pairs: dict[str, tuple[np.ndarray, np.ndarray]] | None = None, span: tuple[int, int] = (0, PAIRS)):
        self.languages, self.span = sorted(counts if pairs is None else pairs), span
        parts: dict[str, list[np.ndarray]] = {k: [] for k in ("bits2", "bits3", "bits4", "escape2", "escape3")}
        none = np.zeros(0, dtype=np.uint32)
        four = {lang: _summed(*counts.get(lang, (none, none))) for lang in self.languages}
        three = {lang: _summed(g & np.uint32(0xFFFFFF), n) for lang, (g, n) in four.items()}
        self.u4 = np.unique(np.concatenate([none, *(g for g, _ in four.values())]))
        self.u3 = np.unique(np.concatenate([none, *(g for g, _ in three.values())]))
        self.contexts = np.unique(self.u4 >> np.uint32(8))
        suffix = np.searchsorted(self.u3, self.u4 & np.uint32(0xFFFFFF))
        for lang in self.languages:
            g3, n3 = three[lang]
            g2, n2 = (g3, n3) if pairs is None else pairs[lang]
            byte = np.bincount(g2 & np.uint32(255), weights=n2, minlength=256)
            p1 = _blend(byte[None, :], np.full((1, 256), 1 / 256))[0]
            pair = np.zeros((256, 256))
            np.add.at(pair, ((g2 >> np.uint32(8)) & np.uint32(255), g2 & np.uint32(255)), n2)
            p2 = _blend(pair, np.broadcast_to(p1, (256, 256)))
            # Context of two bytes, then of three: only the known bytes of a context are listed.
            low = self.u3 & np.uint32(0xFFFF)
            p3, escape2 = _listed(self.u3, g3, n3, p2.reshape(-1)[low], np.arange(1 << 16, dtype=np.uint32))
            p4, escape3 = _listed(self.u4, *four[lang], p3[suffix], self.contexts)
            for name, x in (("bits2", p2.reshape(-1)), ("bits3", p3), ("bits4", p4), ("escape2", escape2), ("escape3", escape3)):
                parts[name].append(-np.log2(np.maximum(x, 1e-300)).astype(np.float32))
        for name, x in parts.items():
            setattr(self, name, np.stack(x, axis=1) if x else np.zeros((0, 0), np.float32))
        self._index()

    def _index(self) -> None:
        """A hash table from four bytes to their row of ``bits4``."""
        size = 1 << max(4, int(np.ceil(np.log2(max(len(self.u4), 1)))) + 2)
        self.shift = np.uint32(32 - int(np.log2(size)))
        self.keys, self.rows = np.full(size, EMPTY), np.zeros(size, dtype=np.int32)
        left = np.arange(len(self.u4))
        slot = self._slot(self.u4)
        while len(left):
            free = self.keys[slot] == EMPTY
            first = np.unique(slot[free], return_index=True)[1]
            win = np.flatnonzero(free)[first]
            self.keys[slot[win]], self.rows[slot[win]] = self.u4[left[win]], left[win]
            rest = np.ones(len(left), dtype=bool)
            rest[win] = False
            left, slot = left[rest], (slot[rest] + 1) & (size - 1)

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return ((g * np.uint32(0x9E3779B1)) >> self.shift).astype(np.int64)

    def find(self, g: np.ndarray) -> np.ndarray:
        """The row of each four bytes, or -1."""
        slot = self._slot(g)
        seen = self.keys[slot]
        out = np.where(seen == g, self.rows[slot], -1).astype(np.int64)
        open_ = np.flatnonzero((seen != g) & (seen != EMPTY))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & (len(self.keys) - 1)
            seen = self.keys[slot]
            hit = seen == g[open_]
            out[open_[hit]] = self.rows[slot[hit]]
            go = ~hit & (seen != EMPTY)
            open_, slot = open_[go], slot[go]
        out[g == EMPTY] = -1
        return out

    def bits(self, g: np.ndarray) -> np.ndarray:
        """(bytes, languages): each byte's code length."""
        row = self.find(g)
        out = self.bits4[np.maximum(row, 0)] if len(self.bits4) else np.zeros((len(g), len(self.languages)), np.float32)
        rare = np.flatnonzero(row < 0)
        if len(rare):
            x = g[rare]
            cost = np.zeros((len(x), len(self.languages)), dtype=np.float32)
            at, known = _lookup(self.contexts, x >> np.uint32(8))
            cost[known] += self.escape3[at[known]]
            at, known = _lookup(self.u3, x & np.uint32(0xFFFFFF))
            cost[known] += self.bits3[at[known]]
            far = ~known
            cost[far] += self.escape2[(x[far] >> np.uint32(8)) & np.uint32(0xFFFF)] + self.bits2[x[far] & np.uint32(0xFFFF)]
            out[rare] = cost
        return out

    def code_lengths(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(texts, languages): total code length in bits."""
        out = np.zeros((len(at) - 1, len(self.languages)))
        full = np.flatnonzero(np.diff(at) > 0)
        if len(full) and self.languages:
            g = grams(data, at)
            if self.span == (0, PAIRS):
                bits = self.bits(g)
            else:
                pair = (g >> np.uint32(8)) & np.uint32(PAIRS - 1)
                mine = (pair >= self.span[0]) & (pair < self.span[1])
                bits = np.zeros((len(g), len(self.languages)), dtype=np.float32)
                bits[mine] = self.bits(g[mine])
            out[full] = np.add.reduceat(bits, at[full], axis=0, dtype=np.float64)
        return out


def _summed(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(g.astype(np.uint32), return_inverse=True)
    return u, np.bincount(at, weights=n, minlength=len(u))


def _lookup(sorted_keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return at, sorted_keys[at] == x


def _blend(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Rows of probabilities over all bytes from rows of counts and the next shorter context's probabilities."""
    total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    seen = counts > 0
    rest = np.where(seen, 0.0, shorter).sum(axis=1, keepdims=True)
    # Nothing is left to escape to once all bytes are known.
    escape = np.where(kinds < counts.shape[1], kinds, 0)
    p = np.where(seen, counts / np.maximum(total + escape, 1), escape / np.maximum(total + escape, 1) * shorter / np.maximum(rest, 1e-300))
    return np.where(total > 0, p, shorter)


def _listed(grams_: np.ndarray, known: np.ndarray, n: np.ndarray, shorter: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each listed gram; factor on the shorter context's probability of unlisted ones, per context).

    The listed grams are those that any language knows; this language knows
    ``known`` with counts ``n``. ``shorter`` holds each listed gram's
    probability without its first byte.
    """
    count = np.zeros(len(grams_))
    count[np.searchsorted(grams_, known)] = n
    context = np.searchsorted(contexts, grams_ >> np.uint32(8))
    m = len(contexts)
    total = np.bincount(context, weights=count, minlength=m)
    kinds = np.bincount(context, weights=count > 0, minlength=m)
    taken = np.bincount(context, weights=np.where(count > 0, shorter, 0.0), minlength=m)
    escape = np.where(kinds < 256, kinds, 0)
    all_ = np.maximum(total + escape, 1)
    factor = np.where(total > 0, escape / all_ / np.maximum(1 - taken, 1e-12), 1.0)
    return np.where(count > 0, count / all_[context], factor[context] * shorter), factor


def counted(documents: DataFrame) -> DataFrame:
    """lang, gram, n: the counts over all rows with a text and a lang, written to the shared folder."""
    ship_code(documents.sparkSession)
    texts = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    return checkpointed(
        texts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def _by_language(counts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    rows = counts.select("lang", "gram", "n").toArrow()
    grams_, n = rows["gram"].to_numpy().astype(np.uint32), rows["n"].to_numpy().astype(np.float64)
    lang = rows["lang"].combine_chunks().dictionary_encode()
    which = lang.indices.to_numpy()
    return {name: (grams_[which == i], n[which == i]) for i, name in enumerate(lang.dictionary.to_pylist())}


def train(documents: DataFrame) -> Model:
    """The context trees of all rows with a text and a lang, in one piece; columns text, lang."""
    return Model(_by_language(counted(documents)))


class Blocks:
    """The unpruned context trees of all rows with a text and a lang, as one ``Model`` after another."""

    def __init__(self, documents: DataFrame, block_cells: int = BLOCK_CELLS):
        self.counts = counted(documents)
        pair = F.shiftright("gram", 8).bitwiseAND(F.lit(PAIRS - 1))
        two = self.counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(PAIRS - 1)).alias("gram")).agg(F.sum("n").alias("n"))
        self.pairs = _by_language(two)
        self.languages = sorted(self.pairs)
        self.counts = self.counts.withColumn("pair", pair)
        sizes = self.counts.select("pair", "gram").distinct().groupBy("pair").count().collect()
        self.spans, at, cells = [], 0, 0
        for p, n in sorted((r["pair"], r["count"] * len(self.pairs)) for r in sizes):
            if cells and cells + n > block_cells:
                self.spans.append((at, p))
                at, cells = p, 0
            cells += n
        self.spans.append((at, PAIRS))

    def __iter__(self) -> Iterator[Model]:
        for span in self.spans:
            mine = self.counts.where((F.col("pair") >= span[0]) & (F.col("pair") < span[1]))
            yield Model(_by_language(mine), self.pairs, span)


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or not text.isascii() and any(c.isalpha() for c in text.decode())


PREDICTED = "lang_pred string, score double, bits_per_byte double"


def _verdicts(languages: list[str], bits: np.ndarray, length: list[int]) -> list[pa.Array]:
    """The columns PREDICTED of texts with these code lengths; ``length`` is in bytes, 0 for a text without a letter."""
    names, scores, rates = [], [], []
    for k, n in enumerate(length):
        if not languages or not n:
            names.append(UNDETERMINED)
            scores.append(0.0)
            rates.append(None)
            continue
        best = int(bits[k].argmin())
        names.append(languages[best])
        scores.append(float(1 / np.exp2(np.maximum(bits[k, best] - bits[k], -1000)).sum()))
        rates.append(float(bits[k, best] / n))
    return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]


def _lengths(data: np.ndarray, at: np.ndarray) -> list[int]:
    texts = (data[s:e].tobytes() for s, e in zip(at[:-1], at[1:]))
    return [len(t) if has_letter(t) else 0 for t in texts]


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (its posterior share among the languages), bits_per_byte. Reads only text."""
    spark = documents.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                found = _verdicts(m.languages, m.code_lengths(data, at), _lengths(data, at))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), *found], ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {PREDICTED}")


def predict_in_blocks(documents: DataFrame, blocks: Blocks) -> DataFrame:
    """What ``predict`` gives with the whole tree. One block (the usual case) is one narrow pass over the documents.

    Several are a pass each; their code lengths meet per document (rows that
    agree in doc_id and text have the same ones).
    """
    spark = documents.sparkSession
    if len(blocks.spans) == 1:
        return predict(documents, next(iter(blocks)))
    ship_code(spark)
    slim = documents.select("doc_id", F.xxhash64("text").alias("k"), "text")
    kind, languages = slim.schema["doc_id"].dataType.simpleString(), blocks.languages

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                n = pa.array(_lengths(data, at), pa.int64())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), batch["k"].slice(lo, hi - lo), n], ["doc_id", "k", "length"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((len(batch), len(languages)))
            for i, parts in enumerate(batch["parts"].to_pylist()):
                for x in sorted(parts or [], key=lambda x: x["block"]):
                    bits[i] += x["bits"]
            found = _verdicts(languages, bits, batch["length"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *found], ["doc_id", "lang_pred", "score", "bits_per_byte"])

    parts = None
    for number, model in enumerate(blocks):
        run, shared = _scorer(spark, model)
        mine = checkpointed(slim.mapInArrow(run, f"doc_id {kind}, k long, bits array<double>")).withColumn("block", F.lit(number))
        shared.destroy()
        parts = mine if parts is None else parts.union(mine)
    total = (
        parts.groupBy("doc_id", "k", "block")
        .agg(F.first("bits").alias("bits"))
        .groupBy("doc_id", "k")
        .agg(F.collect_list(F.struct("block", "bits")).alias("parts"))
    )
    rows = slim.mapInArrow(lengths, f"doc_id {kind}, k long, length long")
    same = rows["doc_id"].eqNullSafe(total["doc_id"]) & (rows["k"] == total["k"])
    return rows.join(total, same, "left").select(rows["doc_id"], "length", "parts").mapInArrow(decide, f"doc_id {kind}, {PREDICTED}")


def _scorer(spark: SparkSession, model: Model):
    """(the function for mapInArrow that gives each row's code lengths under one block, the broadcast it reads)."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                bits = pa.array(shared.value.code_lengths(data, at).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), batch["k"].slice(lo, hi - lo), bits], ["doc_id", "k", "bits"])

    return run, shared


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def op4_language_id(documents: DataFrame, block_cells: int = BLOCK_CELLS) -> DataFrame:
    blocks = Blocks(documents.where(fold() != HELD_OUT), block_cells)
    return predict_in_blocks(documents, blocks).select(
        "doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )

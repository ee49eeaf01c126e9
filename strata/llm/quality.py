"""Quality classifier: weak labels from overlapping heuristics, then a hashed linear scorer.

1. Nine heuristic labellers look at each whole text and vote good, bad or
   nothing (``LABELLERS``). Their thresholds are round numbers, not fitted.
2. Expectation-maximisation (Dawid and Skene) over the counts of the vote
   patterns of all documents estimates the share of good documents and, for
   each labeller, how often it votes what in either class. No gold label is
   used. There are at most 3**9 patterns, so the counts are small whatever the
   corpus, and come from a map-side partial aggregate.
3. The posterior of a document's pattern is its label. A linear scorer over
   hashed token shapes learns them from a sample of ``TRAIN_DOCS`` documents
   (those with the smallest hashes of their rows), and scores every document.

The scorer sees how a text is written throughout, not the thresholds, and
decides where labellers disagree or abstain.

Defined cases: a null or empty text is scored as a text without tokens (the
``empty`` labeller calls it bad); a very long text is read whole; a score equal to the threshold
is kept; repeated rows get equal scores; an empty table gives an empty result; other columns pass
through unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.session import same_columns, ship_code

DIMENSIONS = 1 << 12
TRAIN_DOCS = 8192
THRESHOLD = 0.5
U64 = np.uint64



def short(m: dict[str, np.ndarray]) -> np.ndarray:
    """Too few tokens for a share to say much: a number or an address weighs heavily."""
    return m["tokens"] < 30


def few_repeats(m: dict[str, np.ndarray]) -> np.ndarray:
    return m["repeat_share"] * m["tokens"] <= np.maximum(1, 0.05 * m["tokens"])


# Each labeller sees the measures of ``measures`` and says where it votes bad and
# where good; elsewhere it abstains. A good vote needs positive evidence, so a
# text with one kind of defect is not voted good by those that look at others.
LABELLERS = (
    ("symbols", lambda m: m["symbol_share"] >= 0.10, None),
    ("capitals", lambda m: (m["capital_share"] >= 0.50) & (m["tokens"] >= 5), None),
    ("repeats", lambda m: m["repeat_share"] >= 0.20, None),
    ("separators", lambda m: m["separator_share"] >= 0.10, None),
    ("exclamations", lambda m: m["exclamation_share"] >= 0.20, None),
    ("empty", lambda m: m["tokens"] < 2, None),
    ("variety", lambda m: m["distinct_share"] < 0.20, lambda m: (m["distinct_share"] >= 0.45) & few_repeats(m)),
    ("prose", lambda m: (m["plain_share"] < 0.40) & ~short(m), lambda m: (m["plain_share"] >= np.where(short(m), 0.45, 0.85)) & few_repeats(m)),
    ("letters", lambda m: (m["letter_share"] < 0.50) & ~short(m), lambda m: (m["letter_share"] >= np.where(short(m), 0.35, 0.90)) & (m["capital_share"] <= 0.30) & few_repeats(m)),
)
PATTERNS = 3 ** len(LABELLERS)

_b = np.arange(256)
_SPACE = (_b == 32) | ((_b >= 9) & (_b <= 13))
_UPPER, _LOWER, _DIGIT, _HIGH = (_b >= 65) & (_b <= 90), (_b >= 97) & (_b <= 122), (_b >= 48) & (_b <= 57), _b >= 128
_LETTER = _UPPER | _LOWER | _HIGH
_PROSE = np.isin(_b, np.frombuffer(b".,;:'\"-()?!", dtype=np.uint8))
_SYMBOL = ~(_SPACE | _LETTER | _DIGIT | _PROSE)
_SHAPE = np.where(_UPPER, 65, np.where(_LOWER | _HIGH, 97, np.where(_DIGIT, 57, _b))).astype(np.uint8)


class Tokens:
    """The white-space tokens of a slice of texts, as segments of its bytes."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at, self.n_docs = data, at, len(at) - 1
        inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[at] = True
        self.start = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])[: len(data)]))
        self.end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)[: len(data)])) + 1
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.count)

    def bytes_in(self, kind: np.ndarray) -> np.ndarray:
        """How many bytes of each text are of a kind (256 flags)."""
        sums = np.concatenate([[0], np.cumsum(kind[self.data])])
        return sums[self.at[1:]] - sums[self.at[:-1]]

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc[flags], minlength=self.n_docs)


def measures(t: Tokens) -> dict[str, np.ndarray]:
    h = arrays.segment_hash(arrays.LOWER[t.data], t.start, t.end)
    same_text = t.doc[1:] == t.doc[:-1]
    repeat = np.append(False, (h[1:] == h[:-1]) & same_text)[: len(h)]
    order = np.lexsort((h, t.doc))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (t.doc[order][1:] != t.doc[order][:-1])
    sums = np.concatenate([[0], np.cumsum(_LETTER[t.data])])
    letters = sums[t.end] - sums[t.start]
    tokens = np.maximum(t.count, 1)
    last = t.data[t.end - 1] if len(t.end) else t.data[:0]
    solid = np.maximum(t.bytes_in(~_SPACE), 1)
    # Variety falls with length in any language: look at it per stretch of 100 tokens at most.
    expected = np.sqrt(np.maximum(t.count, 100) / 100.0)
    return {
        "tokens": t.count,
        "letter_share": t.bytes_in(_LETTER) / solid,
        "symbol_share": t.bytes_in(_SYMBOL) / solid,
        "capital_share": t.bytes_in(_UPPER) / np.maximum(t.bytes_in(_LETTER), 1),
        "repeat_share": t.per_doc(repeat) / tokens,
        "separator_share": t.per_doc(letters == 0) / tokens,
        "exclamation_share": t.per_doc(last == 33) / tokens,
        "distinct_share": np.bincount(t.doc[order][new], minlength=t.n_docs) / tokens * expected,
        "plain_share": t.per_doc((letters > 0) & (letters >= t.end - t.start - 1)) / tokens,
    }


def votes(t: Tokens, m: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """(documents, labellers): 1 good, 2 bad, 0 no vote. Without tokens only ``empty`` votes."""
    m = m or measures(t)
    out = np.zeros((t.n_docs, len(LABELLERS)), dtype=np.int64)
    for j, (name, bad, good) in enumerate(LABELLERS):
        if good is not None:
            out[good(m), j] = 1
        out[bad(m), j] = 2
        if name != "empty":
            out[t.count == 0, j] = 0
    return out


def pattern(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(len(LABELLERS)))


def unpacked(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // (3 ** np.arange(len(LABELLERS)))[None, :] % 3


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, P(vote | class) as [labeller, class, vote], posterior of good per pattern).

    Starts from "good unless a labeller objects"; class 0 is bad, class 1 good. Counts
    are smoothed by one pseudo-vote, so no probability is zero.
    """
    v = unpacked(patterns)
    post = np.where((v == 2).any(axis=1), 0.1, 0.9)
    one_hot = (v[:, :, None] == np.arange(3)).astype(np.float64)
    for _ in range(rounds):
        mass = np.stack([counts * (1 - post), counts * post])
        prior = (mass.sum(axis=1) + 1) / (counts.sum() + 2)
        table = (np.einsum("cp,pjv->jcv", mass, one_hot) + 1) / (mass.sum(axis=1)[None, :, None] + 3)
        log = np.log(prior)[:, None] + np.einsum("pjv,jcv->cp", one_hot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return float(prior[1]), table, post


def features(t: Tokens, m: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, dimension, value) of the hashed features, by document.

    Token shapes (letter case, digits, punctuation; runs collapsed), pairs of
    shapes and repeated tokens, together of length 1; and flags for the share
    of repeated and of distinct tokens and for the text's length.
    """
    shape = _SHAPE[t.data]
    start_flag = np.zeros(len(shape), dtype=bool)
    start_flag[t.start] = True
    kept = np.ones(len(shape), dtype=bool)
    kept[1:] = (shape[1:] != shape[:-1]) | start_flag[1:]
    place = np.concatenate([[0], np.cumsum(kept)])
    h = arrays.segment_hash(shape[kept], place[t.start], place[t.end])
    exact = arrays.segment_hash(arrays.LOWER[t.data], t.start, t.end)
    follows = np.flatnonzero(t.doc[1:] == t.doc[:-1])
    again = follows[exact[follows] == exact[follows + 1]]
    docs = np.concatenate([t.doc, t.doc[follows], t.doc[again]])
    names = np.concatenate([h, arrays.mix(h[follows] * arrays.BASE + h[follows + 1]), np.full(len(again), 0xA11CE, dtype=U64)])
    cell = docs * DIMENSIONS + (arrays.mix(names) >> U64(52)).astype(np.int64)
    cell, n = np.unique(cell, return_counts=True)
    doc, dim, value = cell // DIMENSIONS, cell % DIMENSIONS, np.log1p(n)
    value /= np.sqrt(np.bincount(doc, weights=value**2, minlength=t.n_docs))[doc]
    # How much of the text is repeated, and its length: one flag each.
    m = m or measures(t)
    flags = [np.floor(10 * m["repeat_share"]), np.floor(10 * np.minimum(m["distinct_share"], 1)), np.floor(np.log2(t.count + 1.0))]
    rows = np.arange(t.n_docs)
    flag = [(arrays.mix(x.astype(U64) + U64(1000 * (k + 1))) >> U64(52)).astype(np.int64) for k, x in enumerate(flags)]
    doc, dim, value = np.concatenate([doc, rows, rows, rows]), np.concatenate([dim, *flag]), np.concatenate([value, np.full(3 * len(rows), 0.5)])
    order = np.argsort(doc, kind="stable")
    return doc[order], dim[order], value[order]


def fit(doc: np.ndarray, dim: np.ndarray, value: np.ndarray, label: np.ndarray, rounds: int = 300, ridge: float = 1e-5) -> np.ndarray:
    """Weights (and bias, last) of logistic regression on soft labels, by Adagrad over the whole sample."""
    w = np.zeros(DIMENSIONS + 1)
    seen = np.full(DIMENSIONS + 1, 1e-8)
    n = max(len(label), 1)
    for _ in range(rounds):
        miss = (probability(doc, dim, value, len(label), w) - label) / n
        g = np.append(np.bincount(dim, weights=value * miss[doc], minlength=DIMENSIONS), miss.sum()) + ridge * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def probability(doc: np.ndarray, dim: np.ndarray, value: np.ndarray, n_docs: int, w: np.ndarray) -> np.ndarray:
    z = np.bincount(doc, weights=value * w[dim], minlength=n_docs) + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, at in arrays.chunks(batch["text"]):
            yield pa.RecordBatch.from_arrays([pa.array(pattern(votes(Tokens(data, at))))], ["pattern"])


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, at in arrays.chunks(batch["text"]):
            t = Tokens(data, at)
            m = measures(t)
            doc, dim, value = features(t, m)
            ends = pa.array(np.searchsorted(doc, np.arange(t.n_docs + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["h"].slice(lo, hi - lo),
                    pa.array(pattern(votes(t, m))),
                    pa.ListArray.from_arrays(ends, pa.array(dim, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(value, pa.float32())),
                ],
                ["h", "pattern", "dim", "value"],
            )


class Model:
    """What the documents taught: see ``train``."""

    def __init__(self, patterns: np.ndarray, posterior: np.ndarray, prior: float, accuracy: np.ndarray, weights: np.ndarray):
        self.posterior = np.full(PATTERNS, prior)
        self.posterior[patterns] = posterior
        self.prior, self.accuracy, self.weights = prior, accuracy, weights


def train(documents: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Labeller accuracies from all documents, scorer weights from about ``train_docs`` of them."""
    ship_code(documents.sparkSession)
    text = documents.select("text")
    counted = text.mapInArrow(_patterns, "pattern long").groupBy("pattern").count().collect()  # at most 3**9 rows
    patterns = np.array([r["pattern"] for r in counted], dtype=np.int64)
    counts = np.array([r["count"] for r in counted], dtype=np.float64)
    if not len(counts):
        return Model(patterns, np.zeros(0), 0.5, np.zeros((len(LABELLERS), 2, 3)), np.zeros(DIMENSIONS + 1))
    order = np.argsort(patterns)
    patterns, counts = patterns[order], counts[order]
    prior, table, posterior = expectation_maximisation(patterns, counts)
    model = Model(patterns, posterior, prior, table, np.zeros(0))

    share = min(1.0, train_docs / counts.sum())
    by_row = F.pmod(F.xxhash64(*[documents[f"`{c}`"] for c in ("doc_id", "text")]), F.lit(1 << 30))
    chosen = documents.select("text", by_row.alias("h")).where(F.col("h") < int(share * (1 << 30)))
    # A hash shares rows out evenly, but equal rows all share one fate: the bound is enforced, and those
    # with the smallest hashes stay, in whatever partitions they are.
    made = chosen.mapInArrow(_sample, "h long, pattern long, dim array<int>, value array<float>")
    rows = made.orderBy("h", "pattern", F.xxhash64("dim", "value")).limit(2 * train_docs).select("pattern", "dim", "value").toArrow().combine_chunks()
    dims, values = (rows[c].combine_chunks() for c in ("dim", "value"))
    model.weights = fit(
        np.repeat(np.arange(len(rows)), dims.value_lengths().to_numpy()),
        dims.flatten().to_numpy().astype(np.int64),
        values.flatten().to_numpy().astype(np.float64),
        model.posterior[rows["pattern"].to_numpy()],
    )
    return model


def _judged(column: pa.Array, posterior: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, weak label, votes) of each text."""
    scores, weak, all_votes = [np.zeros(0)], [np.zeros(0)], [np.zeros((0, len(LABELLERS)), dtype=np.int64)]
    for _, _, data, at in arrays.chunks(column):
        t = Tokens(data, at)
        m = measures(t)
        v = votes(t, m)
        scores.append(probability(*features(t, m), t.n_docs, weights))
        weak.append(posterior[pattern(v)])
        all_votes.append(v)
    return np.concatenate(scores), np.concatenate(weak), np.concatenate(all_votes)


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), weak_label (posterior of its votes), votes (per labeller: 1, 0 or -1)."""
    spark = documents.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast((model.posterior, model.weights))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, weak, v = _judged(batch["text"], *shared.value)
            as_votes = np.array([0, 1, -1])[v]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(score), pa.array(weak), pa.array(as_votes.tolist(), pa.list_(pa.int32()))],
                ["doc_id", "score", "weak_label", "votes"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, weak_label double, votes array<int>")


def good_documents(documents: DataFrame, model: Model | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, all columns kept; a narrow pass."""
    spark = documents.sparkSession
    model = model or train(documents)
    shared = spark.sparkContext.broadcast((model.posterior, model.weights))
    text_at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_judged(batch.column(text_at), *shared.value)[0] >= threshold))

    return same_columns(documents, run)


def op1_quality_classifier(documents: DataFrame) -> DataFrame:
    """doc_id, score, weak_label, kept (score >= 0.5)."""
    return scored(documents, train(documents)).select(
        "doc_id", "score", "weak_label", (F.col("score") >= THRESHOLD).alias("kept")
    )

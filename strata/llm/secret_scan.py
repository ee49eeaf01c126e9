"""Secret scans: base patterns, and a linear-chain CRF that tags tokens as begin, inside or outside of a secret.

Base spans are the patterns' matches (leftmost, not overlapping, per kind);
they are always reported. The CRF learns from them: all documents are labelled
first; about ``TRAIN_DOCS`` of those with a base span give ``TRAIN_WINDOWS``
labelled windows around base secrets, and about as many of all documents give as
many around other unusual tokens (each sample by a hash of the rows, at most ``PER_TEXT`` of a text), each secret
also once with its neighbours and the file's features hidden, so that the shape of a secret counts
without a keyword before it, and once with other random characters in its place (``disguised``), so that it isn't
the one shape that counts which the table's secrets happen to have. Its features are a token's shape (length, character sets, switches
between letters and digits), its first bytes, the neighbouring words, and what
the file contains. Whole texts are then decoded by Viterbi; a tagged span that
does not lie wholly inside one base span is reported as kind ``crf``.

Tokens are runs of letters, digits, ``_`` and non-ASCII bytes, and runs of
other visible characters. Offsets are code points, ends exclusive.

Defined cases: a null text is empty and has no spans; without any base secret
in the table the CRF adds nothing; a very long text is scanned whole; spans that start at one place
are ordered by kind, then end; repeated rows are scanned one by one; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays, crf
from strata.llm.session import ship_code

KINDS = ("assign", "access", "hex", "crf")
# The base patterns and the least length of what they match.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "api", "key", "apikey", "api_key", "auth", "bearer", "credential", "access", "private")
# Bounds of the training sample; whole texts are scanned whatever they are.
TRAIN_DOCS, TRAIN_WINDOWS, PER_TEXT = 20_000, 1_000, 8
WINDOW, AROUND = 24, 11
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
U64 = np.uint64

_b = np.arange(256)
_SPACE = (_b == 32) | ((_b >= 9) & (_b <= 13))
_DIGIT, _UPPER, _LOWER, _HIGH = (_b >= 48) & (_b <= 57), (_b >= 65) & (_b <= 90), (_b >= 97) & (_b <= 122), _b >= 128
_NAME = _DIGIT | _UPPER | _LOWER | _HIGH | (_b == 95)
_HEX = _DIGIT | ((_b >= 97) & (_b <= 102)) | ((_b >= 65) & (_b <= 70))
_HEX_RUN = _DIGIT | ((_b >= 97) & (_b <= 102))
_ASSIGN_MARK = (_b == 58) | (_b == 61)
_TYPE = np.where(_SPACE, 0, np.where(_NAME, 1, 2))

# Slots of a token's features, and how many values each has.
SIZES = (32, 64, 512, 9, 9, 9, 9, 243, 32)
OFFSETS = np.cumsum((0, *SIZES))


def base_spans(text: bytes) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) in bytes."""
    found = []
    if b"=" in text or b":" in text:
        found += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if b"AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    data = np.frombuffer(text, dtype=np.uint8)
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = _HEX_RUN[data]
    edge = np.diff(flags)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= MIN_HEX  # maximal runs are what HEX matches
    found += [("hex", s, e, s) for s, e in zip(start[long].tolist(), end[long].tolist())]
    return found


class Tokens:
    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at = data, at
        kind = _TYPE[data]
        change = np.zeros(len(data) + 1, dtype=bool)
        change[at] = True
        change[1:-1] |= kind[1:] != kind[:-1]
        edges = np.flatnonzero(change)
        start, end = edges[:-1], edges[1:]
        solid = kind[start] > 0
        self.start, self.end = start[solid], end[solid]
        self.kind = kind[self.start]
        self.first = np.searchsorted(self.start, at)
        self.doc = np.repeat(np.arange(len(at) - 1), np.diff(self.first))

    def count(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags[self.data], dtype=np.int32)])
        return sums[self.end] - sums[self.start]


_KEY_HASHES = np.sort(
    np.array([arrays.segment_hash(np.frombuffer(k.encode(), np.uint8), np.array([0]), np.array([len(k)]))[0] for k in KEYWORDS], dtype=U64)
)


def features(t: Tokens) -> np.ndarray:
    """(tokens, slots) ids into one weight table."""
    n = len(t.start)
    out = np.zeros((n, len(SIZES)), dtype=np.int64)
    if not n:
        return out + OFFSETS[:-1]
    length = t.end - t.start
    digits, upper, lower, high, hexes = (t.count(x) for x in (_DIGIT, _UPPER, _LOWER, _HIGH, _HEX))
    letter = ~_DIGIT[t.data]
    switch = np.zeros(len(t.data) + 1, dtype=np.int32)
    np.cumsum(np.append(False, letter[1:] != letter[:-1]), out=switch[1:])
    switches = switch[t.end] - switch[np.minimum(t.start + 1, t.end)]
    size = np.searchsorted([4, 8, 12, 16, 20, 28, 36], length, side="right")
    name = t.kind == 1
    charset = (digits > 0) + 2 * (lower > 0) + 4 * (upper > 0) + 8 * (high > 0) + 16 * (hexes == length)
    h = arrays.segment_hash(arrays.LOWER[t.data], t.start, t.end)
    place = np.minimum(np.searchsorted(_KEY_HASHES, h), len(_KEY_HASHES) - 1)
    keyword = _KEY_HASHES[place] == h
    mark = t.count(_ASSIGN_MARK) > 0
    odd = name & (digits > 0) & (lower + upper > 0)

    # What a neighbour is: nothing, keyword, assignment, quote or other sign, mixed, number, capitals, word.
    kind = np.select(
        [keyword, ~name & mark, ~name & np.isin(t.data[t.start], (34, 39)), ~name, odd, digits > 0, (upper > 1) & (lower == 0)],
        [1, 2, 3, 4, 5, 6, 7],
        8,
    )

    def at(k: int) -> np.ndarray:
        x = np.zeros(n, dtype=np.int64)
        if k < 0:
            x[-k:] = np.where(t.doc[-k:] == t.doc[:k], kind[:k], 0)
        else:
            x[:-k] = np.where(t.doc[:-k] == t.doc[k:], kind[k:], 0)
        return x

    before, before2, after = (at(k) if abs(k) < n else np.zeros(n, dtype=np.int64) for k in (-1, -2, 1))
    head = arrays.segment_hash(t.data, t.start, np.minimum(t.end, t.start + 4))
    has_key = np.bincount(t.doc[keyword], minlength=len(t.at) - 1) > 0
    has_mark = np.bincount(t.doc[mark & ~name], minlength=len(t.at) - 1) > 0
    has_odd = np.bincount(t.doc[odd], minlength=len(t.at) - 1) > 0
    file = has_key + 2 * has_mark + 4 * has_odd
    out[:, 0] = size * 4 + np.minimum((switches + 1) // 2, 3)
    out[:, 1] = np.where(name, charset, 32)
    out[:, 2] = np.where(name & (digits == 0), 0, 1 + (head % U64(511)).astype(np.int64))
    out[:, 3] = kind
    out[:, 4] = before
    out[:, 5] = before2
    out[:, 6] = after
    out[:, 7] = before * 27 + np.minimum(before2, 8) * 3 + np.where(~name, 0, np.where((size >= 3) & (digits > 0), 2, 1))
    out[:, 8] = file[t.doc] * 4 + np.where(~name, 0, np.where(size >= 4, 2, 1) + (digits > 0))
    return out + OFFSETS[:-1]


def labels(t: Tokens) -> np.ndarray:
    """Each token's tag by the base spans of its text."""
    tags = np.zeros(len(t.start), dtype=np.int64)
    for doc in range(len(t.at) - 1):
        base = int(t.at[doc])
        for _, _, end, secret in base_spans(t.data[base : t.at[doc + 1]].tobytes()):
            lo = int(np.searchsorted(t.end, base + secret, side="right"))
            hi = int(np.searchsorted(t.start, base + end))
            tags[lo:hi] = INSIDE
            tags[lo : min(lo + 1, hi)] = BEGIN
    return tags


ALPHABETS = (string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits)


def random_secret(rng: random.Random) -> str:
    """A string of one alphabet, sometimes in two parts or behind a short word."""
    made = "".join(rng.choices(rng.choice(ALPHABETS), k=rng.randint(18, 48)))
    if rng.random() < 0.3:
        made = "".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 5))) + "_" + made
    return made


def disguised(text: bytes, seed: int) -> bytes:
    """The text with other random characters in place of each secret that a keyword names."""
    rng, out, at = random.Random(seed), [], 0
    for kind, _, end, secret in sorted(base_spans(text), key=lambda x: x[3]):
        if kind == "assign" and secret >= at:
            out += [text[at:secret], random_secret(rng).encode()]
            at = end
    return b"".join([*out, text[at:]])


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's hash, and whether its text has a base span."""
    for batch in batches:
        for lo, hi, data, at in arrays.chunks(batch["text"]):
            held = [bool(base_spans(data[s:e].tobytes())) for s, e in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch["h"].slice(lo, hi - lo), pa.array(held, pa.bool_())], ["h", "held"])


def _windows(below_held: int, below_all: int):
    """Labelled windows of WINDOW tokens of the sampled rows: around secrets, around unusual tokens, and from the text's start.

    ``below_held`` and ``below_all`` bound the hashes of the rows that give
    windows with a secret and windows without one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch["h"].to_numpy()
            rows = np.flatnonzero(hashes < max(below_held, below_all))
            texts = batch["text"].take(pa.array(rows))
            for lo, hi, data, at in arrays.chunks(texts):
                h = hashes[rows[lo:hi]]
                # Rows beyond the common sample count only where they hold a secret.
                use = [i for i in range(hi - lo) if h[i] < below_all or base_spans(data[at[i] : at[i + 1]].tobytes())]
                given = [data[at[i] : at[i + 1]].tobytes() for i in use]
                # Disguised copies follow the texts, and give windows with a secret only.
                copies = [(i, disguised(x, int(h[i]))) for i, x in zip(use, given) if base_spans(x)]
                plain, use = len(given), use + [i for i, _ in copies]
                data, at = arrays.texts(pa.array(given + [x for _, x in copies], pa.binary()))
                t = Tokens(data, at)
                ids, tags = features(t), labels(t)
                begin = tags == BEGIN
                other = np.flatnonzero(~begin & (ids[:, 3] - OFFSETS[3] == 5) & (t.end - t.start >= 6))
                # At most PER_TEXT windows of either kind of a text: the sample is of documents, not of their repetitions.
                for secrets, centre in ((True, np.flatnonzero(begin)), (False, np.union1d(other, t.first[:-1][np.diff(t.first) > 0]))):
                    rank = np.arange(len(centre)) - np.searchsorted(t.doc[centre], t.doc[centre])
                    few = rank < PER_TEXT
                    rank += PER_TEXT * (t.doc[centre] >= plain)
                    out = {"ids": [], "tags": [], "secret": [], "h": [], "rank": []}
                    for c, r in zip(centre[few].tolist(), rank[few].tolist()):
                        lo_ = max(int(t.first[t.doc[c]]), c - AROUND)
                        hi_ = min(int(t.first[t.doc[c] + 1]), lo_ + WINDOW)
                        own = h[use[t.doc[c]]]
                        # A window beside a secret that shows it is one with a secret already.
                        if t.doc[c] >= plain and not secrets or (tags[lo_:hi_] > 0).any() != secrets or own >= (below_held if secrets else below_all):
                            continue
                        for name, x in zip(out, (ids[lo_:hi_].astype(np.int32).tobytes(), tags[lo_:hi_].astype(np.int32).tobytes(), secrets, int(own), r)):
                            out[name].append(x)
                    kinds = (pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out.values(), kinds)], list(out))

    return run


def hide(ids: np.ndarray, seed: int = 11) -> np.ndarray:
    """Windows without what surrounds a secret: three of five among words, the others at a text's edge, in
    files with and without keywords and assignments."""
    out, rng = ids.copy(), np.random.default_rng(seed)
    near = np.where(rng.random(len(ids)) < 0.6, 8, 0)[:, None]
    file = rng.integers(0, 4, len(ids))[:, None]
    for slot in (4, 5, 6):
        out[:, :, slot] = OFFSETS[slot] + near
    out[:, :, 7] = OFFSETS[7] + near * 30 + (ids[:, :, 7] - OFFSETS[7]) % 3
    own = ids[:, :, 8] - OFFSETS[8]
    out[:, :, 8] = OFFSETS[8] + own // 16 * 16 + 4 * file + own % 4
    return out


def train(documents: DataFrame, train_docs: int = TRAIN_DOCS) -> crf.Chain | None:
    """The CRF fitted to the base patterns' secrets of about ``train_docs`` documents that have some; None if none has."""
    ship_code(documents.sparkSession)
    keys = 1 << 30
    slim = documents.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(keys)).alias("h"), "text")
    marked = slim.mapInArrow(_marked, "h long, held boolean")
    total, held = marked.agg(F.count(F.lit(1)), F.count_if("held")).first()
    if not held:
        return None
    below_held, below_all = (int(min(1.0, train_docs / n) * keys) for n in (held, total))
    drawn = slim.where(F.col("h") < max(below_held, below_all)).mapInArrow(
        _windows(below_held, below_all), "ids binary, tags binary, secret boolean, h long, rank int"
    )
    # TRAIN_WINDOWS of either kind, those with the smallest hashes in whatever partition, stand for all.
    order = (F.xxhash64("h", "rank"), F.col("ids"), F.col("tags"))
    drawn = [drawn.where(F.col("secret") == flag).orderBy(*order).limit(TRAIN_WINDOWS).select("ids", "tags") for flag in (True, False)]
    rows = sorted((bytes(r["ids"]), bytes(r["tags"])) for r in drawn[0].union(drawn[1]).collect())
    n = len(rows)
    ids = np.broadcast_to(OFFSETS[:-1], (n, WINDOW, len(SIZES))).copy()
    tags, mask = np.zeros((n, WINDOW), dtype=np.int64), np.zeros((n, WINDOW), dtype=bool)
    for i, (x, y) in enumerate(rows):
        y = np.frombuffer(y, dtype=np.int32)
        ids[i, : len(y)] = np.frombuffer(x, dtype=np.int32).reshape(-1, len(SIZES))
        tags[i, : len(y)], mask[i, : len(y)] = y, True
    secret = (tags > 0).any(axis=1)
    if not secret.any():
        return None
    plain, held = np.flatnonzero(~secret), np.flatnonzero(secret)
    hidden = hide(ids[held])
    use = np.concatenate([held, plain])
    chain = crf.Chain(int(OFFSETS[-1]), 3)
    weight = np.concatenate([np.ones(len(use)), np.full(len(held), 0.5)])
    chain.train(np.concatenate([ids[use], hidden]), np.concatenate([tags[use], tags[held]]), np.concatenate([mask[use], mask[held]]), weight)
    return chain


def tagged(t: Tokens, chain: crf.Chain) -> Iterator[tuple[int, int, int]]:
    """(document, start, end) in bytes of each span of tokens tagged begin, inside, ..."""
    tags = crf.decode(chain, chain.scores(features(t)), t.doc, OUTSIDE)
    at = np.flatnonzero(tags)
    if not len(at):
        return
    new = np.ones(len(at), dtype=bool)
    glued = (at[1:] == at[:-1] + 1) & (t.doc[at[1:]] == t.doc[at[:-1]]) & (t.start[at[1:]] == t.end[at[:-1]])
    new[1:] = ~(glued & (tags[at[1:]] == INSIDE))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    for a, b in zip(at[first].tolist(), at[last].tolist()):
        doc = int(t.doc[a])
        yield doc, int(t.start[a] - t.at[doc]), int(t.end[b] - t.at[doc])


def scan(column: pa.Array, chain: crf.Chain | None) -> Iterator[list[dict]]:
    """The spans of each text, by start and kind, in code points."""
    for lo, hi, data, at in arrays.chunks(column):
        found: dict[int, list[tuple[str, int, int]]] = {}
        for doc in range(hi - lo):
            base = base_spans(data[at[doc] : at[doc + 1]].tobytes())
            if base:
                found[doc] = [x[:3] for x in base]
        if chain is not None:
            for doc, s, e in tagged(Tokens(data, at), chain):
                mine = found.setdefault(doc, [])
                if not any(x[1] <= s and e <= x[2] for x in mine if x[0] != "crf"):
                    mine.append(("crf", s, e))
        for doc in range(hi - lo):
            spans = found.get(doc)
            if not spans:
                yield []
                continue
            text = data[at[doc] : at[doc + 1]]
            points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
            out = [{"kind": k, "start": int(points[s]), "end": int(points[e])} for k, s, e in spans]
            yield sorted(out, key=lambda x: (x["start"], KINDS.index(x["kind"]), x["end"]))


def find_secrets(documents: DataFrame, chain: crf.Chain | None) -> DataFrame:
    """doc_id, spans: array of (kind, start, end)."""
    spark = documents.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(chain)
    kind = documents.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(scan(batch["text"], shared.value))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, span)], ["doc_id", "spans"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def op7_secret_scan(documents: DataFrame) -> DataFrame:
    """The contract's digest of the spans."""

    def of(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return find_secrets(documents, train(documents)).select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"] != "crf")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )

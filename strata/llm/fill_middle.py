"""Fill-in-middle transformation, with line cuts located by memoized chunk summaries.

A document's text is cut at two line ends, drawn by a hash of its id, into prefix,
middle and suffix, which are written in another order behind sentinels
(``<P>prefix<S>suffix<M>middle`` or ``<S>suffix<P>prefix<M>middle``). ``restore``
gives back the exact text.

Lines are counted by content-defined chunk memoization. A rolling hash over the last
``WINDOW`` bytes ends a chunk where it meets a pattern (or after ``LONGEST`` bytes),
so passages that documents share are cut into the same chunks wherever they stand. A
chunk's summary holds its line feeds' places, its code points, whether it
holds a sentinel, and its first and last two bytes, by which a sentinel across a
boundary is seen. A worker keeps summaries in a cache by the chunk's hash; one is
used only if the cached bytes equal the chunk's, so a collision costs time and
changes nothing. Sums of the chunks' line counts give a document's number of lines, and the
chunk that holds a cut's line feed is found by binary search in them.

How it scales: one narrow pass without shuffle. A task holds ``arrays.CHUNK_BYTES``
of texts, or the longest single text, and a cache of at most ``CACHE_BYTES``.

Defined cases: a null text is empty, and an empty text stays plain; so does one that
holds a sentinel; a null doc_id is hashed as an empty string; equal draws give an
empty middle; rows that share a doc_id are cut at the same draws of their own
lines; repeated rows are handled one by one; a very long text is handled whole; an
empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.session import ship_code

# The sentinels, three bytes each.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 7, 100, 50

WINDOW, AVERAGE, LONGEST = 16, 256, 4096
SLOTS = 17  # 2**17 cached summaries
CACHE_BYTES = 16 << 20


def chunk_ends(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the chunks of the texts data[at[i]:at[i+1]] end, each text's end among them."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n > WINDOW:
        end = np.arange(WINDOW, n + 1)
        hit = arrays.segment_hash(data, end - WINDOW, end) < np.uint64((1 << 64) // AVERAGE)
        hit[1:] &= ~hit[:-1]  # of neighbouring ends at most every other one
        cut[WINDOW:] = hit
        # A window that reaches back into another text says nothing of this one.
        inside = end - at[np.searchsorted(at, end, side="left") - 1] >= WINDOW
        cut[WINDOW:] &= inside
    cut[at[1:]] = True
    cut[0] = False
    ends = np.flatnonzero(cut)
    length = np.diff(ends, prepend=0)
    if (length > LONGEST).any():
        count = -(-length // LONGEST)
        start = np.repeat(ends - length, count)
        ends = np.minimum(start + (arrays.spread(count) + 1) * LONGEST, np.repeat(ends, count))
    return ends


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return data[np.repeat(start, length) + arrays.spread(length)]


def _sentinels(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Where three neighbouring bytes are a sentinel."""
    return (a == 60) & (c == 62) & ((b == 80) | (b == 83) | (b == 77))


class Summaries:
    """What is known of some chunks: per chunk lines, chars, holds, head, tail; its line feeds from ``at`` on in the store."""

    FIELDS = ("lines", "chars", "holds", "head", "tail", "at")

    def __init__(self, raw: np.ndarray, length: np.ndarray, store: LineStore):
        first = np.cumsum(length) - length
        chunk = np.repeat(np.arange(len(length)), length)
        feeds = np.flatnonzero(raw == 10)
        opens = (raw & 0xC0) != 0x80  # not the inside of a character
        before = np.concatenate([[0], np.cumsum(opens)])
        self.lines = np.bincount(chunk[feeds], minlength=len(length))
        self.chars = before[first + length] - before[first]
        mark = np.zeros(len(length), dtype=bool)
        if len(raw) > 2:
            three = np.flatnonzero(_sentinels(raw[:-2], raw[1:-1], raw[2:]) & (chunk[:-2] == chunk[2:]))
            mark[chunk[three]] = True
        self.holds = mark
        # First and last two bytes as numbers; zeros where the chunk is shorter.
        two = length > 1
        self.head = raw[first].astype(np.int64) << 8
        self.head[two] |= raw[first[two] + 1]
        self.tail = raw[first + length - 1].astype(np.int64)
        self.tail[two] |= raw[first[two] + length[two] - 2].astype(np.int64) << 8
        begin = store.keep(feeds - first[chunk[feeds]] + 1, before[feeds + 1] - before[first[chunk[feeds]]])
        self.at = begin + np.cumsum(self.lines) - self.lines


class LineStore:
    """The line feeds of chunks: the bytes and the code points up to the end of each, counted from its chunk's start."""

    def __init__(self):
        self.bytes = np.zeros(1 << 12, dtype=np.int32)
        self.chars = np.zeros(1 << 12, dtype=np.int32)
        self.used = 0

    def keep(self, in_bytes: np.ndarray, in_chars: np.ndarray) -> int:
        at, n = self.used, len(in_bytes)
        if at + n > len(self.bytes):
            more = np.zeros(max(len(self.bytes), n), dtype=np.int32)
            self.bytes, self.chars = np.concatenate([self.bytes, more]), np.concatenate([self.chars, more])
        self.bytes[at : at + n], self.chars[at : at + n] = in_bytes, in_chars
        self.used += n
        return at


class ChunkCache:
    """Summaries by chunk hash with the chunks' bytes; made once per worker process."""

    made: ChunkCache | None = None

    @classmethod
    def of_worker(cls) -> ChunkCache:
        cls.made = cls.made or cls()
        return cls.made

    def __init__(self, slots: int = SLOTS, limit: int = CACHE_BYTES):
        self.slots, self.limit = slots, limit
        self.reset()

    def reset(self) -> None:
        n = 1 << self.slots
        self.tag = np.zeros(n, dtype=np.uint64)
        self.place = np.zeros(n, dtype=np.int64)
        self.length = np.zeros(n, dtype=np.int64)
        self.known = {f: np.zeros(n, dtype=bool if f == "holds" else np.int64) for f in Summaries.FIELDS}
        self.store = LineStore()
        self.bytes = np.zeros(1 << 16, dtype=np.uint8)
        self.used = 0
        self.hits = self.misses = 0

    def _keep(self, raw: np.ndarray) -> int:
        at = self.used
        if at + len(raw) > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros(max(len(self.bytes), len(raw)), np.uint8)])
        self.bytes[at : at + len(raw)] = raw
        self.used += len(raw)
        return at

    def _verified(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, h: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Which chunks are in the cache, byte for byte."""
        same = (self.tag[slot] == h) & (self.length[slot] == length)
        some = np.flatnonzero(same)
        n = length[some]
        if len(some):
            differ = gathered(data, start[some], n) != gathered(self.bytes, self.place[slot[some]], n)
            same[some] = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
        return same

    def summaries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """The fields of Summaries for the chunks data[start:end] (none of them empty)."""
        if self.used + self.store.used * 8 > self.limit:
            self.reset()
        length = end - start
        h = (arrays.segment_hash(data, start, end) if h is None else h) | np.uint64(1)  # 0 marks an empty slot
        slot = (h >> np.uint64(64 - self.slots)).astype(np.int64)
        unknown = np.flatnonzero(self.tag[slot] != h)
        made_now = 0
        if len(unknown):
            # One chunk for each slot goes into the cache.
            slots, first = np.unique(slot[unknown], return_index=True)
            new = unknown[first]
            raw = gathered(data, start[new], length[new])
            made = Summaries(raw, length[new], self.store)
            made_now = len(new)
            self.tag[slots], self.length[slots] = h[new], length[new]
            self.place[slots] = self._keep(raw) + np.cumsum(length[new]) - length[new]
            for f in Summaries.FIELDS:
                self.known[f][slots] = getattr(made, f)
        good = self._verified(data, start, length, h, slot)
        out = {f: self.known[f][slot] for f in Summaries.FIELDS}
        other = np.flatnonzero(~good)
        if len(other):  # another chunk has its slot
            made = Summaries(gathered(data, start[other], length[other]), length[other], self.store)
            for f in Summaries.FIELDS:
                out[f][other] = getattr(made, f)
        made_now += len(other)
        self.hits, self.misses = self.hits + len(start) - made_now, self.misses + made_now
        return out


class Lines:
    """The lines of some texts from their chunks' summaries."""

    def __init__(self, data: np.ndarray, at: np.ndarray, cache: ChunkCache):
        self.at, self.store = at, cache.store
        self.end = chunk_ends(data, at)
        self.start = np.concatenate([[0], self.end[:-1]]) if len(self.end) else self.end
        # Empty texts end where the text before them does and have no chunk.
        self.first = np.searchsorted(self.start, at, side="left") if len(self.end) else np.zeros(len(at), np.int64)
        self.first[-1] = len(self.end)
        s = cache.summaries(data, self.start, self.end)
        self.store = cache.store
        self.feed_at = s["at"]
        self.lines = np.concatenate([[0], np.cumsum(s["lines"])])
        self.chars = np.concatenate([[0], np.cumsum(s["chars"])])
        some = np.diff(self.first) > 0
        last = s["tail"][self.first[1:][some] - 1] & 255
        self.feeds = np.diff(self.lines[self.first])
        self.count = self.feeds.copy()
        self.count[some] += last != 10
        self.length = np.diff(self.chars[self.first])
        # Sentinels in a chunk, or across the boundary of two chunks of a text.
        seen = np.concatenate([[0], np.cumsum(s["holds"])])
        self.marked = np.diff(seen[self.first]) > 0
        if len(self.end) > 1:
            a, b = s["tail"][:-1], s["head"][1:]
            a1, a2, b1, b2 = a >> 8, a & 255, b >> 8, b & 255
            across = np.flatnonzero(_sentinels(a1, a2, b1) | _sentinels(a2, b1, b2))
            owner = np.searchsorted(self.first, across, side="right") - 1
            same = across + 1 < self.first[owner + 1]
            self.marked[owner[same]] = True

    def cut(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, code points) of the first units[i] lines of each text."""
        size = np.diff(self.at)
        in_bytes = np.where(units >= self.count, size, 0)
        in_chars = np.where(units >= self.count, self.length, 0)
        some = np.flatnonzero((units > 0) & (units < self.count))
        if len(some):
            target = self.lines[self.first[some]] + units[some]
            chunk = np.searchsorted(self.lines, target, side="left") - 1
            feed = self.feed_at[chunk] + target - self.lines[chunk] - 1
            in_bytes[some] = self.start[chunk] - self.at[some] + self.store.bytes[feed]
            in_chars[some] = self.chars[chunk] - self.chars[self.first[some]] + self.store.chars[feed]
        return in_bytes, in_chars


def _transform(rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache.of_worker()
        for batch in batches:
            draws = [batch[c].to_numpy() for c in ("h1", "h2", "h3", "h4")]
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                lines = Lines(data, at, cache)
                h1, h2, h3, h4 = (x[lo:hi] for x in draws)
                a, b = h1 % (lines.count + 1), h2 % (lines.count + 1)
                cuts = [lines.cut(x) for x in (np.minimum(a, b), np.maximum(a, b))]
                plain = (np.diff(at) == 0) | lines.marked | (h3 % 100 >= rate)
                form = np.where(plain, "plain", np.where(h4 % 100 < spm, "spm", "psm"))
                out = []
                for f, s, e, p, m in zip(form.tolist(), at[:-1].tolist(), at[1:].tolist(), cuts[0][0].tolist(), cuts[1][0].tolist()):
                    text = data[s:e].tobytes()
                    if f != "plain":
                        prefix, middle, suffix = PREFIX.encode() + text[:p], MIDDLE.encode() + text[p:m], SUFFIX.encode() + text[m:]
                        text = (prefix + suffix if f == "psm" else suffix + prefix) + middle
                    out.append(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo),
                        pa.array(lines.count, pa.int64()),
                        pa.array(form.tolist(), pa.string()),
                        pa.array(cuts[0][1], pa.int64(), mask=plain),
                        pa.array(cuts[1][1] - cuts[0][1], pa.int64(), mask=plain),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(documents: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output.

    rate: of 100 documents so many are transformed; spm: of 100 of these so many
    have the suffix first. seed: goes into the hash that draws cuts and forms.
    """
    ship_code(documents.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draw = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
    slim = documents.select("doc_id", "text", *[draw(k) for k in range(4)])
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_transform(rate, spm), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The exact text, from the output and its form alone."""
    middle = F.substring_index(output, MIDDLE, -1)
    rest = F.substr(F.substring_index(output, MIDDLE, 1), F.lit(4))  # behind the first sentinel
    psm = F.concat(F.substring_index(rest, SUFFIX, 1), middle, F.substring_index(rest, SUFFIX, -1))
    spm = F.concat(F.substring_index(rest, PREFIX, -1), middle, F.substring_index(rest, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(documents: DataFrame) -> DataFrame:
    """The contract's digest of the outputs and of the texts restored from them."""
    return fill_in_middle(documents).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS parts, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
drawn AS (
  SELECT doc_id, t, parts, len(parts) - CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END AS n,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
),
units AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
),
cuts AS (
  SELECT *, CASE WHEN a = 0 THEN 0 WHEN a >= n THEN length(t) ELSE length(array_to_string(parts[1:a], chr(10))) + 1 END AS p,
            CASE WHEN b = 0 THEN 0 WHEN b >= n THEN length(t) ELSE length(array_to_string(parts[1:b], chr(10))) + 1 END AS m
  FROM units
),
made AS (
  SELECT *, CASE form WHEN 'psm' THEN '<P>' || substr(t, 1, p) || '<S>' || substr(t, m + 1) || '<M>' || substr(t, p + 1, m - p)
                      WHEN 'spm' THEN '<S>' || substr(t, m + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, m - p)
                      ELSE t END AS o
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN p END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN m - p END AS BIGINT) AS middle_chars, sha256(o) AS output_sha256, sha256(t) AS restored_sha256
FROM made
"""

"""Conversation structure repair: the lightest derivation of a well-formed conversation.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``: maybe a
system message, then user and assistant in turn. Its rows are repaired by Keep
(0), Rerole to user or assistant (3), Delete (4, the only edit of a blank or
duplicate row) and Insert of an empty message (3, anywhere); an undeleted
truncated row adds 3. The cheapest edits win, and of equally cheap ones those
whose initials are the least string.

The method is Knuth's: an item (rows read, state) states that so many rows can be
turned into an output that ends in that state; an edit is a weighted deduction
from one item to the next, two neighbouring spans of rows a deduction with two
premises. A derivation is worth (cost, audit), the audit being its edits' initials.
Items are popped from an agenda by (cost, rows read, audit) until the goal item is
final. That is right because edits are superior (an edit without cost reads a row)
and monotone: two equally cheap audits of one item read the same rows, so neither
is the beginning of the other, and what follows can't change their order. A
conversation of over ``SPAN`` rows is derived span by span, from each state to
each state, and the spans are joined in a balanced tree.

How it scales: rows are range-partitioned and sorted by (conversation, turn), so a
conversation that holds a third of all rows lies in many tasks. A task finishes
every conversation that lies in it whole; its first and last may go on elsewhere
and leave a summary (counts, first and last turn and role, a derivation from each
state to each state). Summaries, at most two a task, are joined per conversation.
Duplicates are found beforehand by hashes with partial counts; only repeated ones
are joined back. What remains sequential is what the contract makes so: one SHA-256
over a conversation's messages. The conversations at the tasks' ends are read once
more for it, in order, through a task that holds a batch of rows and the audit.

Defined cases: a null role, text or key part counts as one space; rows without turn
come first; rows of one turn are ordered by role, text hash and place in the input; a null
conv_id is a conversation of its own; a conversation without rows after damage, and
an empty table, give zeros and no rows; a long conversation or text is never cut;
ties are settled by the audit as above; other columns are ignored, whatever their names. The
input must be a stable source (a table): its rows are numbered as they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.session import checkpointed, ship_code

# Costs of the edits, white space, the well-formed roles.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)  # what the output ends with so far
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

SPAN = 64
# A row as one byte: its role's initial, or that it must go; upper case: truncated.
GONE, OTHER = ord("x"), ord("o")

Value = tuple[int, str]


def row_code(initial: str, gone: bool, truncated: bool) -> int:
    if gone:
        return GONE
    code = initial if initial in ("s", "u", "a") else chr(OTHER)
    return ord(code.upper() if truncated else code)


def deductions(row: int | None, state: int) -> Iterator[tuple[int, str, int, int]]:
    """(cost, edit, state after it, rows read) of each edit possible in ``state`` before ``row`` (None: no row left)."""
    yield INSERT, "I", FOLLOWS[state], 0
    if row is None:
        return
    yield DELETE, "D", state, 1
    if row == GONE:
        return
    code = chr(row)
    extra = TRUNCATED if code.isupper() else 0
    after = KEPT.get((state, code.lower()))
    if after is not None:
        yield extra, "K", after, 1
    yield REROLE + extra, "R", FOLLOWS[state], 1


def lightest(codes: bytes, entry: int, goals: frozenset[int], first_only: bool) -> dict[int, Value]:
    """The lightest derivations that read all rows, from ``entry`` to the goal states (or to the first one that is final)."""
    n = len(codes)
    agenda: list[tuple[int, int, str, int]] = [(0, 0, "", entry)]
    final: set[tuple[int, int]] = set()
    found: dict[int, Value] = {}
    while agenda:
        cost, i, audit, state = heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n and state in goals:
            found[state] = (cost, audit)
            if first_only or len(found) == len(goals):
                break
        for more, edit, after, read in deductions(codes[i] if i < n else None, state):
            if (i + read, after) not in final:
                heappush(agenda, (cost + more, i + read, audit + edit, after))
    return found


Span = tuple[tuple[Value | None, ...], ...]  # [entry state][exit state]


@lru_cache(maxsize=1 << 14)
def short_span(codes: bytes) -> Span:
    every = frozenset(range(4))
    made = [lightest(codes, entry, every, False) for entry in range(4)]
    return tuple(tuple(m.get(q) for q in range(4)) for m in made)


def joined(left: Span, right: Span) -> Span:
    """The deduction with two premises: a span from the two it consists of."""

    def best(p: int, q: int) -> Value | None:
        ways = [(left[p][r], right[r][q]) for r in range(4) if left[p][r] is not None and right[r][q] is not None]
        if not ways:
            return None
        cost = min(a[0] + b[0] for a, b in ways)
        return cost, min(a[1] + b[1] for a, b in ways if a[0] + b[0] == cost)

    return tuple(tuple(best(p, q) for q in range(4)) for p in range(4))


def span(codes: bytes) -> Span:
    if len(codes) <= SPAN:
        return short_span(codes)
    parts = [short_span(codes[i : i + SPAN]) for i in range(0, len(codes), SPAN)]
    return in_tree(parts)


def in_tree(parts: list[Span]) -> Span:
    while len(parts) > 1:
        parts = [joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


@lru_cache(maxsize=1 << 14)
def _short_repair(codes: bytes) -> Value:
    return min(lightest(codes, START, frozenset((START, ASSISTANT)), True).values())


def cheapest(codes: bytes) -> Value:
    """(cost, audit) of the best repair of the rows."""
    return _short_repair(codes) if len(codes) <= SPAN else whole(span(codes))


def whole(s: Span) -> Value:
    return min(x for x in (s[START][START], s[START][ASSISTANT]) if x is not None)


class Repair:
    """Applies an audit to rows that come in order; yields (role, text, edit) of each message."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = FOLLOWS[self.state]
            yield NAMES[self.state], "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, role[0]]
            yield role, text, edit
        elif edit == "R":
            self.state = FOLLOWS[self.state]
            yield NAMES[self.state], text, edit


class Run:
    """What is known of consecutive rows of one conversation."""

    COUNTS = ("rows", "turns", "blank", "duplicate", "truncated", "illegal")

    def __init__(self):
        self.codes = bytearray()
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        c, initial = self.counts, role[:1]
        end = text.rstrip(BLANKS)
        blank = not end
        duplicate = repeated and not blank
        truncated = not blank and not duplicate and end[-1] not in ".!?"
        c["rows"] += 1
        c["blank"] += blank
        c["duplicate"] += duplicate
        c["truncated"] += truncated
        if self.last_role is None:
            self.first_role = initial
        elif self.last_role + initial not in LEGAL:
            c["illegal"] += 1
        self.last_role = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            c["turns"] += turn != self.last_turn
            self.last_turn = turn
        self.codes.append(row_code(initial, blank or duplicate, truncated))

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.counts["turns"]


def _join_runs(runs: list[dict]) -> dict:
    """The counts, gaps and span of a conversation from its runs in order."""
    out = dict.fromkeys(Run.COUNTS, 0)
    first_turn = last_turn = last_role = None
    for r in runs:
        for name in Run.COUNTS:
            out[name] += r[name]
        if r["first_turn"] is not None:
            out["turns"] -= r["first_turn"] == last_turn
            first_turn = r["first_turn"] if first_turn is None else first_turn
            last_turn = r["last_turn"]
        if r["first_role"] is not None:
            out["illegal"] += last_role is not None and last_role + r["first_role"] not in LEGAL
            last_role = r["last_role"]
    out["gaps"] = 0 if first_turn is None else last_turn - first_turn + 1 - out["turns"]
    out["cost"], out["audit"] = whole(in_tree([r["span"] for r in runs]))
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, lost, row: the rows after damage; a dropped row stays as a mark (``lost``) of its conversation."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    numbered = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        part("role").alias("role"),
        part("text").alias("text"),
        (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).alias("kind"),
        F.monotonically_increasing_id().alias("at"),
    )
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return numbered.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("lost"),
        "at",
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def as_is(conversations: DataFrame) -> DataFrame:
    """The same columns without any damage, to repair real conversations."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        part("role").alias("role"),
        part("text").alias("text"),
        F.lit(False).alias("lost"),
        F.monotonically_increasing_id().alias("at"),
        F.lit(0).alias("copy"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``repeated``: whether role and text stand earlier in the conversation."""
    key = [F.col("conv_id").cast("string"), F.col("conv_id").isNull(), "role", "text"]
    keyed = rows.withColumns({"k1": F.xxhash64(*key), "k2": F.xxhash64(F.lit(1), *key)})
    place = F.struct(F.col("turn").isNotNull().alias("n"), "turn", "at", "copy")
    again = checkpointed(
        keyed.where("NOT lost")
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select("k1", "k2", "first")
    )
    repeated = F.coalesce(place > F.col("first"), F.lit(False)) & ~F.col("lost")
    return keyed.join(again, ["k1", "k2"], "left").withColumn("repeated", repeated).drop("first", "k2")


ORDER = ["conv_id", "turn", "role", "k1", "at", "copy"]
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REST = ("rows", "turns", "first_turn", "last_turn")


def _schema(kind: str) -> str:
    numbers = ", ".join(f"{c} long" for c in (*REPORT, *REST))
    return (
        f"conv_id {kind}, place long, role string, text string, edit string, part int, {numbers}, audit string, "
        "repaired_sha256 string, first_role string, last_role string, costs array<long>, audits array<string>"
    )


class _Out:
    """Rows of the schema above, in batches."""

    def __init__(self, id_type: pa.DataType):
        text, number = pa.string(), pa.int64()
        self.fields = [("conv_id", id_type), ("place", number), ("role", text), ("text", text), ("edit", text), ("part", pa.int32())]
        self.fields += [(c, number) for c in (*REPORT, *REST)]
        self.fields += [("audit", text), ("repaired_sha256", text), ("first_role", text), ("last_role", text)]
        self.fields += [("costs", pa.list_(number)), ("audits", pa.list_(text))]
        self.rows: list[dict] = []
        self.size = 0

    def add(self, **row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += 100 + len(row.get("text") or "") + len(row.get("audit") or "") + sum(len(x or "") for x in row.get("audits", ()))
        if self.size > 4 << 20:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        rows, self.rows, self.size = self.rows, [], 0
        return pa.RecordBatch.from_pylist(rows, pa.schema(self.fields))


class _Messages:
    """Numbers and hashes the messages of one conversation; passes them on if asked to."""

    def __init__(self, conv_id, out: _Out, keep: bool):
        self.conv_id, self.out, self.keep = conv_id, out, keep
        self.n, self.sha = 0, hashlib.sha256()

    def take(self, messages) -> Iterator[pa.RecordBatch]:
        for role, text, edit in messages:
            self.sha.update((("\n" if self.n else "") + role + ":" + text).encode())
            if self.keep:
                yield from self.out.add(conv_id=self.conv_id, place=self.n, role=role, text=text, edit=edit)
            self.n += 1


def _runs(with_messages: bool):
    """Finished conversations; the first and last of a task as summaries (``part`` is set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out = now = None
        conv_id, first, rows = None, True, []

        def summary() -> Iterator[pa.RecordBatch]:
            flat = [v for p in span(bytes(now.codes)) for v in p]
            yield from out.add(
                conv_id=conv_id, part=part, first_turn=now.first_turn, last_turn=now.last_turn, first_role=now.first_role, last_role=now.last_role,
                costs=[v and v[0] for v in flat], audits=[v and v[1] for v in flat], **now.counts,
            )

        def finished() -> Iterator[pa.RecordBatch]:
            cost, audit = cheapest(bytes(now.codes))
            repair, messages = Repair(audit), _Messages(conv_id, out, with_messages)
            for role, text in rows:
                yield from messages.take(repair.row(role, text))
            yield from messages.take(repair.inserts())
            counts = {c: now.counts[c] for c in REPORT if c in now.counts}
            yield from out.add(conv_id=conv_id, gaps=now.gaps(), cost=cost, audit=audit, repaired_sha256=messages.sha.hexdigest(), **counts)

        for batch in batches:
            out = out or _Out(batch.schema.field("conv_id").type)
            columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "lost", "repeated")]
            for c, turn, role, text, lost, repeated in zip(*columns):
                if now is None or c != conv_id:
                    if now is not None:
                        yield from summary() if first else finished()
                        first = False
                    conv_id, now, rows = c, Run(), []
                if lost:
                    continue
                now.add(turn, role, text, repeated)
                if not first:  # a first run is never finished here
                    rows.append((role, text))
        if now is not None:
            yield from summary()
        if out is not None and out.rows:
            yield out.batch()

    return run


def _join_group(group: pd.DataFrame) -> pd.DataFrame:
    none = lambda x: None if pd.isna(x) else x
    runs = []
    for r in group.sort_values("part").to_dict("records"):
        flat = [None if pd.isna(c) else (int(c), a) for c, a in zip(r["costs"], r["audits"])]
        r["span"] = tuple(tuple(flat[4 * p : 4 * p + 4]) for p in range(4))
        for c in ("first_turn", "last_turn"):
            r[c] = None if pd.isna(r[c]) else int(r[c])
        runs.append(r | {c: int(r[c]) for c in Run.COUNTS} | {c: none(r[c]) for c in ("first_role", "last_role")})
    made = _join_runs(runs)
    return pd.DataFrame({"conv_id": group["conv_id"].iloc[:1].to_numpy(), **{c: [made[c]] for c in (*REPORT, "audit")}})


def _spanning(with_messages: bool):
    """Conversations in order, each behind a row that holds its report: messages one by one, then the report."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = report = repair = messages = None

        def finished() -> Iterator[pa.RecordBatch]:
            yield from messages.take(repair.inserts())
            yield from out.add(conv_id=messages.conv_id, repaired_sha256=messages.sha.hexdigest(), **report)

        for batch in batches:
            out = out or _Out(batch.schema.field("conv_id").type)
            columns = [batch[c].to_pylist() for c in ("conv_id", "head", "role", "text", "lost", *REPORT, "audit")]
            for c, head, role, text, lost, *rest in zip(*columns):
                if head:
                    if report is not None:
                        yield from finished()
                    report = dict(zip((*REPORT, "audit"), rest))
                    repair, messages = Repair(report["audit"]), _Messages(c, out, with_messages)
                elif not lost:
                    yield from messages.take(repair.row(role, text))
        if report is not None:
            yield from finished()
        if out is not None and out.rows:
            yield out.batch()

    return run


def repair(rows: DataFrame, with_messages: bool = True) -> DataFrame:
    """Repairs the rows of ``damaged`` or ``as_is``.

    One row per conversation (``place`` is null): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256. With messages
    also one row per message of a repaired conversation: conv_id, place (from 0), role, text,
    edit (K, R or I).
    """
    ship_code(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = _marked(rows).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    made = checkpointed(dealt.select("conv_id", "turn", "role", "text", "lost", "repeated").mapInArrow(_runs(with_messages), _schema(kind)))
    done = made.where("part IS NULL")
    runs = made.where("part IS NOT NULL")
    numbers = ", ".join(f"{c} long" for c in REPORT)
    reports = checkpointed(runs.groupBy("conv_id").applyInPandas(_join_group, f"conv_id {kind}, {numbers}, audit string"))

    # The conversations at the tasks' ends (at most two a task), once more and in order.
    ids = reports.select(F.col("conv_id").alias("id"))
    open_ = rows.join(ids, rows["conv_id"].eqNullSafe(ids["id"]), "left_semi")
    columns = {c: F.lit(None).cast("long") for c in REPORT} | {"audit": F.lit(None).cast("string"), "head": F.lit(False)}
    body = _marked(open_).withColumns(columns)
    empty = {"turn": "long", "role": "string", "text": "string", "lost": "boolean", "at": "long", "copy": "int", "k1": "long"}
    heads = reports.withColumns({c: F.lit(None).cast(t) for c, t in empty.items()} | {"head": F.lit(True)})
    names = ["conv_id", "head", "turn", "role", "text", "lost", "at", "copy", "k1", *REPORT, "audit"]
    stream = (
        heads.select(names)
        .unionByName(body.select(names))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("head").desc(), *ORDER[1:])
    )
    rest = stream.select("conv_id", "head", "role", "text", "lost", *REPORT, "audit").mapInArrow(_spanning(with_messages), _schema(kind))
    names = ["conv_id", "place", "role", "text", "edit", *REPORT, "audit", "repaired_sha256"]
    return done.select(names).unionByName(rest.select(names))


def op13_conversation_repair(conversations: DataFrame) -> DataFrame:
    """The contract's digest of the damaged and repaired conversations."""
    return repair(damaged(conversations), with_messages=False).select("conv_id", *REPORT, "audit", "repaired_sha256")

"""Conversations repaired to alternating turns by the cheapest edits.

Rows of a conversation are kept, given another role, deleted, or joined by inserted
empty messages until their roles read ``system? (user assistant)+`` or nothing is left.
The cheapest edits are a shortest path through four states (nothing yet, system, user,
assistant) that one backward pass of costs finds: for every row, the cost from there to
the end for each state.

A conversation may hold any share of all rows, so that pass runs in parallel by rank
convergence. All rows lie in one order, cut into chunks of ``CHUNK`` rows. Only
differences between the four costs matter, and few vectors of differences exist
(``VECTORS``), so a chunk starts from all of them as speculative vectors at its end and
goes back row by row. Mostly they agree within a few rows: from there on the chunk's
costs do not depend on what follows. Where they do not agree up to the chunk's
beginning, fix-up passes run on into the next chunk, the next two, four and so on, until
they agree or the conversation ends. The least audit is traced forward the same way, from
every state a chunk may be entered in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from carestrata.runtime import discard, materialise

#: What the edits cost; a truncated row that stays costs its surcharge besides.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a chunk, as a power of two.
CHUNK = 12

#: States: nothing yet, system, user, assistant; the state after one more message by turns.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = (_USER, _USER, _ASSISTANT, _USER)
_FAR = 1 << 20
_BLANK = " \t\n\x0b\f\r"
#: Initials as in a row's kind: 0 must go, else 1 + 2 * place here + 1 if truncated.
_INITIALS = ("s", "u", "a")


def _kept_as(kind: int, state: int) -> int | None:
    """The state after keeping a row of that kind, if its role fits there."""
    place = (kind - 1) // 2
    if kind == 0 or place >= len(_INITIALS):
        return None
    if place == 0:
        return _SYSTEM if state == _START else None
    return _AFTER[state] if _AFTER[state] == (_USER, _ASSISTANT)[place - 1] else None


def _relaxed(costs: list[int]) -> list[int]:
    """Costs with insertions allowed."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[_AFTER[s]]) for s, c in enumerate(costs)]
    return costs


def _settled(costs: list[int]) -> tuple[int, ...]:
    """The same less the lowest of them."""
    costs = _relaxed(costs)
    return tuple(c - min(costs) for c in costs)


def _choices(kind: int, state: int, after: tuple[int, ...]) -> Iterator[tuple[str, int, int]]:
    """(edit, cost to the end, next state) of the edits of one row, in byte order."""
    yield "D", DELETE + after[state], state
    if kind:
        more = TRUNCATED if kind % 2 == 0 else 0
        kept = _kept_as(kind, state)
        if kept is not None:
            yield "K", more + after[kept], kept
        yield "R", RENAME + more + after[_AFTER[state]], _AFTER[state]


def _at_row(kind: int, after: tuple[int, ...]) -> list[int]:
    return _relaxed([min(c for _, c, _ in _choices(kind, s, after)) for s in range(4)])


#: Costs after the last row: nothing is left to pay before anything or after an assistant.
END = _settled([0, _FAR, _FAR, 0])


def _closed() -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All cost vectors that occur, and the vector before a row of each kind."""
    vectors, table = [END], []
    for v in vectors:
        table.append([])
        for kind in range(9):
            b = _settled(_at_row(kind, v))
            if b not in vectors:
                vectors.append(b)
            table[-1].append(vectors.index(b))
    return vectors, np.array(table).T.copy()


#: Cost vectors, the end's first, and ``BACK[kind][v]``, the vector before a row.
VECTORS, BACK = _closed()


def _steps() -> list[list[list[tuple[str, int]]]]:
    """The least edits at a row, insertions first, by vector after it, kind and state."""

    def least(kind: int, state: int, v: int) -> tuple[str, int]:
        edits, total = "", _at_row(kind, VECTORS[v])
        while True:
            best = {e: s for e, c, s in _choices(kind, state, VECTORS[v]) if c == total[state]}
            if "D" not in best and INSERT + total[_AFTER[state]] == total[state]:
                edits, state = edits + "I", _AFTER[state]
                continue
            edit = min(best)
            return edits + edit, best[edit]

    return [[[least(k, s, v) for s in range(4)] for k in range(9)] for v in range(len(VECTORS))]


STEPS = _steps()
#: What is inserted after the last row, by state.
_LAST = ("", "II", "I", "")


def initial_place(role: str) -> F.Column:
    """A row's place in the kinds by the initial of its role."""
    place = F.lit(len(_INITIALS))
    for at, letter in enumerate(_INITIALS):
        place = F.when(F.substring(role, 1, 1) == letter, at).otherwise(place)
    return place


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) damaged by crc32 of ``conv_id:turn`` modulo 20; for trials.

    0 drops a row, 1 empties its text, 2 removes ``. ! ?`` from it, 3 repeats the row, 4
    makes it the user's. A null counts as one space, but stays null in conv_id and turn.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    kind = F.crc32(name.cast("binary")) % 20
    changed = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    times = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return (
        rows.select("conv_id", "turn", role.alias("_role"), text.alias("_text"), kind.alias("_kind"))
        .where("_kind <> 0")
        .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("role"), changed.alias("text"),
                F.explode(F.array_repeat(F.lit(1), times)).alias("_time"))
        .drop("_time")
    )


def _plain(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    text = F.coalesce(F.col("text"), space)
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), space).alias("role"), text.alias("text"), F.unhex(F.md5(text)).alias("digest")
    )


#: The order of the rows of a conversation: turn, nulls first, then role and a digest of the text.
_ORDER = [F.asc_nulls_first, F.asc, F.asc]


def _in_order(*first: str) -> list:
    return [F.asc_nulls_first(c) for c in first] + [f(c) for f, c in zip(_ORDER, ("turn", "role", "digest"), strict=True)]


def kinds(rows: DataFrame) -> DataFrame:
    """(pos, conv_id, kind, duplicate): every row in one order over all conversations.

    Texts stay where they are: only their digests are sorted, in ranges that cut long
    conversations, and even equal rows, anywhere. A row is a duplicate if its role and
    text occur before it in its conversation.
    """
    end = F.expr(r"rtrim(' \t\n\u000b\f\r', text)")
    narrow = _plain(rows).select(
        "conv_id", "turn", "role", "digest", (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"), F.monotonically_increasing_id().alias("tie")
    )
    order = [*_in_order("conv_id"), F.asc("tie")]
    placed = materialise(narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()), "dialogue-order")
    first = placed.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    known = placed.join(first, "pos", "left")
    again = F.col("first").isNull() & ~F.col("blank")
    kind = F.when(F.col("blank") | again, 0).otherwise(1 + 2 * initial_place("role") + F.col("cut").cast("int"))
    out = materialise(known.select("pos", "conv_id", kind.cast("int").alias("kind"), again.cast("int").alias("duplicate")), "dialogue-kinds")
    discard(placed)
    return out


def _vectors_after(kind: list[int], end: int) -> list[int]:
    """The vector after each row of a piece, given the one after its last."""
    after = [end]
    for k in reversed(kind[1:]):
        after.append(int(BACK[k][after[-1]]))
    return after[::-1]


def _traced(kind: list[int], after: list[int], entry: int) -> tuple[str, int]:
    """The audit of a piece entered in a state, and the state it is left in."""
    edits, state = [], entry
    for k, v in zip(kind, after, strict=True):
        e, state = STEPS[v][k][state]
        edits.append(e)
    return "".join(edits), state


def _speculative(kind: list[int]) -> list[int]:
    """The vector before a piece for each vector that may follow it."""
    current = np.arange(len(VECTORS))
    for at in range(len(kind) - 1, -1, -1):
        current = BACK[kind[at]][current]
        if (current == current[0]).all():
            one = int(current[0])
            for k in reversed(kind[:at]):
                one = int(BACK[k][one])
            return [one] * len(VECTORS)
    return current.tolist()


def _pieces(table: pa.Table) -> Iterator[tuple[int, int, object]]:
    """(from, to, conv_id) of the runs of one conversation in a chunk."""
    ids, at = table["conv_id"].to_pylist(), 0
    for to in range(1, len(ids) + 1):
        if to == len(ids) or ids[to] != ids[at]:
            yield at, to, ids[at]
            at = to


def _with_ends(chunk: pa.Table) -> dict[str, list]:
    """One row per conversation in a chunk: its audit if it lies inside, else what may follow."""
    chunk = chunk.sort_by("pos")
    pos, kind, again = (chunk[c].to_pylist() for c in ("pos", "kind", "duplicate"))
    out: dict[str, list] = {c: [] for c in ("conv_id", "first", "duplicate", "truncated", "audit", "map")}
    for at, to, conv in _pieces(chunk):
        inside = at > 0 and to < len(pos)
        for name, value in (
            ("conv_id", conv), ("first", pos[at]), ("duplicate", sum(again[at:to])),
            ("truncated", sum(k > 0 and k % 2 == 0 for k in kind[at:to])),
            ("audit", _whole(kind[at:to]) if inside else None), ("map", None if inside else _speculative(kind[at:to])),
        ):
            out[name].append(value)
    return out


def _whole(kind: list[int]) -> str:
    edits, state = _traced(kind, _vectors_after(kind, 0), _START)
    return edits + _LAST[state]


def chased(pieces: DataFrame, link: str, origin: int) -> DataFrame:
    """(first, value) of the map of each piece applied to what the linked one gives.

    ``map`` has a value for every value of the piece that ``link`` names by its
    ``first``; a piece without one gets ``origin``. A map to one value needs nobody else.
    Each pass joins every open piece with the one it waits for and takes over its link, so
    the reach doubles: a conversation of n pieces takes log2(n) passes at most.
    """
    value = F.when(F.size(F.array_distinct("map")) == 1, F.element_at("map", 1)).when(F.col("link").isNull(), F.element_at("map", origin + 1))
    now = materialise(pieces.select("first", F.col(link).alias("link"), "map").withColumn("value", value), "dialogue-chase")
    while now.where("value is null").limit(1).count():
        other = now.select(F.col("first").alias("link"), F.col("link").alias("onward"), F.col("map").alias("there"), F.col("value").alias("given"))
        through = F.expr("transform(there, x -> element_at(map, x + 1))")
        met = now.where("value is null").join(other, "link").select(
            "first",
            F.when(F.col("given").isNull(), F.col("onward")).alias("link"),
            F.when(F.col("given").isNull(), through).otherwise(F.array_repeat(F.expr("element_at(map, given + 1)"), F.size("map"))).alias("map"),
        )
        then = materialise(now.where("value is not null").unionByName(met.withColumn("value", value)), "dialogue-chase")
        discard(now)
        now = then
    return now.select("first", "value")


def audits(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, first, duplicate, truncated, audit): the edits of each conversation, in pieces.

    ``first`` orders the pieces of a conversation; the numbers count faults.
    """
    sorted_rows = kinds(rows).withColumn("chunk", F.shiftright("pos", chunk))
    key = rows.schema["conv_id"].dataType.simpleString()
    head = f"conv_id {key}, first bigint, duplicate bigint, truncated bigint, audit string, map array<int>"

    def as_table(columns: dict[str, list], like: pa.Table) -> pa.Table:
        types = {"conv_id": like.schema.field("conv_id").type, "map": pa.list_(pa.int32()), "audit": pa.string(), "exits": pa.list_(pa.int32()), "traces": pa.list_(pa.string())}
        return pa.table({c: pa.array(v, type=types.get(c, pa.int64())) for c, v in columns.items()})

    ended = materialise(sorted_rows.groupBy("chunk").applyInArrow(lambda t: as_table(_with_ends(t), t), head), "dialogue-pieces")
    edges = ended.where("audit is null")
    by_conv = Window.partitionBy("conv_id").orderBy("first")
    edges = materialise(edges.select("conv_id", "first", "duplicate", "truncated", "map", F.lead("first").over(by_conv).alias("next"), F.lag("first").over(by_conv).alias("prev")), "dialogue-edges")
    starts = chased(edges, "next", 0)
    follows = edges.join(starts.select(F.col("first").alias("next"), F.col("value").alias("end")), "next", "left").select("first", F.coalesce("end", F.lit(0)).alias("end"))
    follows = follows.withColumn("chunk", F.shiftright("first", chunk))

    def trace(rows_of: pa.Table, ends: pa.Table) -> pa.Table:
        rows_of = rows_of.sort_by("pos")
        pos, kind = rows_of["pos"].to_pylist(), rows_of["kind"].to_pylist()
        end = dict(zip(ends["first"].to_pylist(), ends["end"].to_pylist(), strict=True))
        out: dict[str, list] = {"first": [], "map": [], "traces": []}
        for at, to, _ in _pieces(rows_of):
            if pos[at] in end:
                after = _vectors_after(kind[at:to], end[pos[at]])
                found = [_traced(kind[at:to], after, s) for s in range(4)]
                out["first"].append(pos[at])
                out["map"].append([s for _, s in found])
                out["traces"].append([e for e, _ in found])
        return as_table(out, rows_of)

    traced = sorted_rows.groupBy("chunk").cogroup(follows.groupBy("chunk")).applyInArrow(trace, "first bigint, map array<int>, traces array<string>")
    traced = materialise(traced.join(edges.select("first", "next", "prev", "conv_id", "duplicate", "truncated"), "first"), "dialogue-traces")
    exits = chased(traced, "prev", _START)
    entered = traced.join(exits.select(F.col("first").alias("prev"), F.col("value").alias("entry")), "prev", "left").join(exits, "first")
    last = F.when(F.col("next").isNull(), F.element_at(F.array(*map(F.lit, _LAST)), F.col("value") + 1)).otherwise("")
    audit = F.concat(F.element_at("traces", F.coalesce("entry", F.lit(_START)) + 1), last)
    inside = ended.where("audit is not null").drop("map")
    return inside.unionByName(entered.select("conv_id", "first", "duplicate", "truncated", audit.alias("audit")))


#: A row of a conversation as it is replayed: turn, role, text.
Message = tuple[int | None, str, str]


def replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, tuple[int, int], Iterator[tuple[str, Message | None]]]]:
    """(conv_id, (duplicates, truncated rows), edits) of each conversation in turn, an edit with the row it is done to.

    The batches hold, for each conversation, its pieces of audit and then its rows in
    order. Only the audit is held, no texts. The edits must be used up before the next.
    """
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "first", "duplicate", "truncated", "audit", "turn", "role", "text")), strict=True))
    ahead = next(rows, None)

    def edits(conv: object, audit: str) -> Iterator[tuple[str, Message | None]]:
        nonlocal ahead
        at = 0
        while ahead is not None and ahead[0] == conv:
            while audit[at] == "I":
                yield "I", None
                at += 1
            yield audit[at], ahead[5:]
            at += 1
            ahead = next(rows, None)
        for edit in audit[at:]:
            yield edit, None

    while ahead is not None:
        conv, again, cut, audit = ahead[0], 0, 0, []
        while ahead is not None and ahead[0] == conv and ahead[1] is not None:
            again, cut = again + ahead[2], cut + ahead[3]
            audit.append(ahead[4])
            ahead = next(rows, None)
        yield conv, (again, cut), edits(conv, "".join(audit))


def repaired_messages(edits: Iterator[tuple[str, Message | None]]) -> Iterator[tuple[str, Message | None, tuple[str, str] | None]]:
    """The edits with the (role, text) that each leaves."""
    state = _START
    for edit, row in edits:
        if edit == "D":
            yield edit, row, None
            continue
        turn_of = ("user", "assistant")[_AFTER[state] - _USER]
        if edit == "K":
            state = _SYSTEM if row[1][:1] == "s" else _AFTER[state]
            yield edit, row, row[1:]
        else:
            state = _AFTER[state]
            yield edit, row, (turn_of, row[2] if row else "")


def _streamed(rows: DataFrame, made: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, ids: DataFrame | None = None) -> DataFrame:
    """A table made from the conversations in order, each streamed through one task.

    ``ids`` adds conversations that may have no rows.
    """
    heads = audits(rows)
    if ids is not None:
        none = {"first": F.lit(-1).cast("long"), "duplicate": F.lit(0).cast("long"), "truncated": F.lit(0).cast("long"), "audit": F.lit("")}
        heads = heads.unionByName(ids.select("conv_id").distinct().withColumns(none))
    both = heads.unionByName(_plain(rows), allowMissingColumns=True)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_last("first"), *_in_order()]
    return both.repartition("conv_id").sortWithinPartitions(*order).drop("digest").mapInArrow(made, schema)


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Rows are taken by turn (nulls first), equal turns by role and a digest of the text. A
    row's first fault counts: ``blank`` (white space only), ``duplicate`` (role and text seen
    earlier), ``truncated`` (ends in another character than ``. ! ?``). ``gaps`` counts turns
    that are missing between the first and the last, ``illegal`` neighbours whose initials are
    not su, ua or au. ``audit`` lists the cheapest edits (``K`` keep, ``R`` give the other role,
    ``D`` delete, ``I`` insert an empty message), the least in ASCII order of equally cheap
    ones; ``repaired_sha256`` is that of the lines ``role:text`` left.

    Null roles and texts are one space; a null id is a conversation of its own; repeated
    rows count each; an empty table gives no rows. ``ids`` names conversations to
    report even if they have no rows (zeros, an empty audit and the hash of nothing).
    Gaps beyond 64 bits are given as the largest number. Other columns are not read. The
    rows of one conversation pass through one task at the end, text by text, because a
    hash of the whole is asked for: that is the only step a long conversation takes alone.
    """
    key = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for conv, (again, cut), edits in replayed(batches):
            turns, low, last, audit = 0, None, None, []
            blank = illegal = cost = 0
            before, digest, any_yet = None, hashlib.sha256(), False
            for edit, row, left in repaired_messages(edits):
                audit.append(edit)
                cost += {"K": 0, "R": RENAME, "D": DELETE, "I": INSERT}[edit]
                if row is not None:
                    turn, role, text = row
                    if turn is not None and turn != last:
                        turns, low, last = turns + 1, turn if low is None else low, turn
                    ends = text.rstrip(_BLANK)[-1:]
                    blank += ends == ""
                    open_end = ends not in ("", ".", "!", "?")
                    cost += TRUNCATED * (open_end and left is not None)
                    illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
                    before = role[:1]
                if left is not None:
                    digest.update(("\n" * any_yet + ":".join(left)).encode())
                    any_yet = True
            gaps = min(last - low + 1 - turns, (1 << 63) - 1) if turns else 0
            done.append((conv, gaps, blank, again, cut, illegal, cost, "".join(audit), digest.hexdigest()))
            if len(done) == 1000:
                yield batch(done)
                done = []
        if done:
            yield batch(done)

    def batch(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

    schema = f"conv_id {key}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    types = to_arrow_schema(StructType.fromDDL(schema)).types
    return _streamed(rows, report, schema, ids)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the messages left, numbered from 0.

    ``edit`` is K, R or I as in :func:`repair_report`; an inserted message has no turn.
    """
    key = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {key}, place bigint, edit string, turn bigint, role string, text string"
    types = to_arrow_schema(StructType.fromDDL(schema))

    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for conv, _, edits in replayed(batches):
            place = 0
            for edit, row, left in repaired_messages(edits):
                if left is None:
                    continue
                done.append((conv, place, edit, row[0] if row else None, *left))
                place += 1
                if len(done) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*done, strict=True), types.types, strict=True)], names=types.names)
                    done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*done, strict=True), types.types, strict=True)], names=types.names)

    return _streamed(rows, messages, schema)

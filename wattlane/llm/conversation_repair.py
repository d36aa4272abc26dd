"""Repair of a conversation's role structure at the least cost, with an audit of the edits.

A repaired conversation's role initials are ``(s?(ua)+)?``: nothing, or user and assistant in
turn, beginning with a user, ending with an assistant, after one system row at most. Edits:

    K  keep a row               0
    R  name it user/assistant   1
    D  delete it                2   the only edit of a blank or repeated row
    I  insert an empty row      5   anywhere, user or assistant

A truncated row that stays costs 5 more. Of the cheapest repairs the one whose edit initials,
in order, are least in ASCII is taken.

A row's first fault counts: blank (no visible character), duplicate (its role and text stood
earlier in the conversation), truncated (the last visible character is none of ``.!?``).

Method. A row is one of nine symbols by its initial and fault. Equal consecutive symbols
are one run. A symbol's step is a min-plus matrix over the four states of the pattern; a run
goes through its binary powers, which every worker keeps. From the costs to go the
choices are unrolled forward: from each state an edit's letter names the next state, so
the least letter that is on a cheapest path gives the least audit.

Scale. Rows that agree in conversation, turn, role and text are counted in an aggregate and
are one run from there on. Rows are ranged over the table by conversation and turn, so a
conversation with a third of all rows lies over many files, and are numbered in that
order. Blocks of them are worked on without their texts, ``BLOCK`` rows at most in a task
at a time. A conversation that lies in several blocks is stitched together by its blocks'
matrices: costs to go from its end back, then the states from its start on, a row a block.
The audit is one string for each conversation, as long as its rows are many: that much
is in the result. ``digests`` reads the repaired rows in order and keeps no text.

Defined cases: null roles and texts are one space, so such a text is blank; a null
conversation id is a conversation of its own; null turns come first; equal turns go by role,
then text; any role initials but s, u, a fit nowhere and are renamed or deleted; an empty
role has no initial; a conversation of which all rows go has an empty audit if it had none, else
its deletions; an empty table gives empty tables; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import written

SPACE = " \t\n\x0b\x0c\r"

KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Rows of a block; only symbols and counts of them meet in a task.
BLOCK = 1 << 16

# States: nothing yet, after the system row, after a user row, after an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FAR = 1 << 60

#: Role initials by number; the last stands for all others.
INITIALS = "sua"
DELETED = 9  # the symbol of a blank or repeated row; others are 2 * initial + truncated

#: The role that comes next, and where a row of it leads.
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_WRITTEN = {USER: "user", ASSISTANT: "assistant"}


def _moves(symbol: int) -> list[list[tuple[str, int, int]]]:
    """By state: letter, next state and cost of the edits that use the row up."""
    if symbol == DELETED:
        return [[("D", p, DELETE)] for p in STATES]
    initial, truncated = INITIALS[symbol // 2 : symbol // 2 + 1], TRUNCATED * (symbol % 2)
    moves = []
    for p in STATES:
        own = [("D", p, DELETE)]
        if initial == "s" and p == NOTHING:
            own.append(("K", SYSTEM, KEEP + truncated))
        elif initial == "ua"[_NEXT[p] - USER]:
            own.append(("K", _NEXT[p], KEEP + truncated))
        own.append(("R", _NEXT[p], RENAME + truncated))
        moves.append(own)
    return moves


MOVES = [_moves(symbol) for symbol in range(DELETED + 1)]


def _times(a: tuple, b: tuple) -> tuple:
    """The min-plus product."""
    return tuple(
        tuple(min(a[p][k] + b[k][q] for k in STATES) for q in STATES) for p in STATES
    )


def _insertions() -> tuple:
    """Least cost of getting from state to state by insertions alone."""
    one = [[0 if p == q else FAR for q in STATES] for p in STATES]
    for p in STATES:
        one[p][_NEXT[p]] = min(one[p][_NEXT[p]], INSERT)
    two = _times(tuple(map(tuple, one)), tuple(map(tuple, one)))
    return _times(two, two)


INSERTIONS = _insertions()
UNIT = tuple(tuple(0 if p == q else FAR for q in STATES) for p in STATES)
#: Cost of ending well from each state.
ENDING = tuple(min(INSERTIONS[p][NOTHING], INSERTIONS[p][ASSISTANT]) for p in STATES)


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> tuple:
    """The matrix of 2 ** k rows of one symbol, insertions before each of them included."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    step = [[FAR] * 4 for _ in STATES]
    for p in STATES:
        for _, q, cost in MOVES[symbol][p]:
            step[p][q] = min(step[p][q], cost)
    return _times(INSERTIONS, tuple(map(tuple, step)))


def _through(symbol: int, length: int, ahead: tuple) -> tuple:
    """Costs to go before a run, from those after it."""
    k = 0
    while length:
        if length & 1:
            m = power(symbol, k)
            ahead = tuple(min(m[p][q] + ahead[q] for q in STATES) for p in STATES)
        length >>= 1
        k += 1
    return ahead


def run_matrix(runs: Iterable[tuple[int, int]]) -> tuple:
    """The matrix of (symbol, length) runs in order."""
    whole = UNIT
    for symbol, length in runs:
        k = 0
        while length:
            if length & 1:
                whole = _times(whole, power(symbol, k))
            length >>= 1
            k += 1
    return whole


def run_lengths(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring pairs of one symbol as one."""
    return [
        (symbol, sum(n for _, n in same)) for symbol, same in groupby(pairs, key=lambda p: p[0])
    ]


def _forward(state: int, symbol: int, ahead: tuple, here: tuple) -> Iterator[tuple[str, int]]:
    """Letters and the states after them, up to the one that uses the row up."""
    while True:
        if symbol != DELETED and here[state] == DELETE + ahead[state]:
            yield "D", state
            return
        if symbol == DELETED:  # an insertion can wait, D comes before I
            yield "D", state
            return
        if here[state] == INSERT + here[_NEXT[state]]:
            state = _NEXT[state]
            yield "I", state
            continue
        for letter, after, cost in MOVES[symbol][state][1:]:
            if here[state] == cost + ahead[after]:
                yield letter, after
                return
        raise AssertionError("no edit leads on")


def unroll(
    units: list[tuple[int, int]], state: int, ending: tuple, last: bool
) -> tuple[list[str], list[str], int]:
    """Of units (symbol, length; only deleted ones are longer than 1) the letters and the
    roles written, and the state after them; ``ending`` has the costs to go after the last.

    Roles: ``u`` and ``a`` inserted, ``U`` and ``A`` renamed, ``k`` kept.
    """
    runs = run_lengths(units)
    after = [ending]
    for symbol, length in reversed(runs):
        after.append(_through(symbol, length, after[-1]))
    after.reverse()  # after[i]: before run i
    letters, roles, at = [], [], 0
    for i, (symbol, length) in enumerate(runs):
        if symbol == DELETED:
            done = 0
            while done < length:
                letters.append("D" * units[at][1])
                roles.append("")
                done += units[at][1]
                at += 1
            continue
        ahead = [after[i + 1]]
        for _ in range(length):
            ahead.append(_through(symbol, 1, ahead[-1]))
        for left in range(length, 0, -1):
            word, written_roles = "", ""
            for letter, state in _forward(state, symbol, ahead[left - 1], ahead[left]):
                word += letter
                if letter != "D":
                    written_roles += (
                        "k" if letter == "K" else "ua"[state - USER].upper() if letter == "R" else "ua"[state - USER]
                    )
            letters.append(word)
            roles.append(written_roles)
            at += 1
    if last and units:
        while state not in (NOTHING, ASSISTANT):
            state = _NEXT[state]
            letters[-1] += "I"
            roles[-1] += "ua"[state - USER]
    return letters, roles, state


# The rows in order, with their faults


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def counted_rows(messages: DataFrame) -> DataFrame:
    """One row for each ``conv_id``, ``turn``, ``role``, ``text``, with the number of ``copies``, whether
    it is the ``first`` of its role and text, and whether it is ``blank`` or ``truncated``."""
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    given = messages.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    name = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    named = given.withColumn("name", F.unhex(name))
    counted = named.groupBy("conv_id", "turn", "role", "text", "name").agg(F.count("*").alias("copies"))
    firsts = named.groupBy(F.col("conv_id").alias("c"), F.col("name").alias("m")).agg(
        F.min(F.struct("turn")).alias("first_turn")
    )
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    same = counted["conv_id"].eqNullSafe(firsts["c"]) & (counted["name"] == firsts["m"])
    return counted.join(firsts, same).select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        F.col("turn").eqNullSafe(F.col("first_turn.turn")).alias("first"),
        (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """``counted_rows`` with their ``place``: a number that rises with conversation, turn, role and
    text over the whole table. Written, so the places stay as they are.

    Ranges are cut by the first characters of a text; equal beginnings share a range, in the
    order of the whole texts.
    """
    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    return written(ranged.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))


def _with_symbols(placed: DataFrame, block: int) -> DataFrame:
    """No texts: what the blocks work on. ``single`` is the symbol of the first copy."""
    initial = _initial(F.col("role"))
    number = F.lit(len(INITIALS))
    for n, letter in enumerate(INITIALS):
        number = F.when(initial == letter, F.lit(n)).otherwise(number)
    stays = F.col("first") & ~F.col("blank")
    symbol = 2 * number + F.when(F.col("truncated"), 1).otherwise(0)
    return placed.select(
        "place",
        # A block never holds rows of two ranges: their numbers are 2 ** 33 apart.
        F.call_function("div", F.col("place"), F.lit(block)).alias("block"),
        "conv_id",
        "copies",
        initial.alias("initial"),
        F.when(stays, symbol).otherwise(DELETED).cast("int").alias("symbol"),
    )


def _units(symbols: list[int], copies: list[int]) -> list[list[tuple[int, int]]]:
    """By row: its first copy, and the others, which repeat it."""
    return [
        [(s, n)] if s == DELETED else [(s, 1), (DELETED, n - 1)] if n > 1 else [(s, 1)]
        for s, n in zip(symbols, copies, strict=True)
    ]


def _stretches(table: pa.Table) -> Iterator[tuple[object, pa.Table]]:
    """Conversations of a block, in order, each with its rows."""
    table = table.sort_by("place")
    ids = table.column("conv_id").to_pylist()
    at = 0
    for conv_id, same in groupby(ids):
        n = sum(1 for _ in same)
        yield conv_id, table.slice(at, n)
        at += n


# A conversation over several blocks


_MATRIX = "conv_id bigint, block bigint, matrix array<bigint>"
_AHEAD = "conv_id bigint, block bigint, ending array<bigint>, last boolean"
_EXITS = _AHEAD + ", exits array<int>"
_ENTRY = "conv_id bigint, block bigint, ending array<bigint>, last boolean, state int"


def _typed(schema: str, like: DataFrame) -> str:
    """The schema with the conversation id's own type."""
    return schema.replace("conv_id bigint", f"conv_id {like.schema['conv_id'].dataType.simpleString()}")


def _rows(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def _arrow(schema: str, ids: pa.DataType) -> pa.Schema:
    kinds = {
        "array<bigint>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
        "boolean": pa.bool_(),
        "int": pa.int32(),
        "bigint": pa.int64(),
        "string": pa.string(),
        "array<struct<place:bigint,roles:string>>": pa.list_(
            pa.struct([("place", pa.int64()), ("roles", pa.string())])
        ),
    }
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    return pa.schema([(n, ids if n == "conv_id" else kinds[k]) for n, k in fields])


def block_matrices(table: pa.Table) -> pa.Table:
    out = []
    for conv_id, rows in _stretches(table):
        units = _units(rows.column("symbol").to_pylist(), rows.column("copies").to_pylist())
        matrix = run_matrix(run_lengths(u for unit in units for u in unit))
        out.append(
            {"conv_id": conv_id, "block": rows.column("block")[0].as_py(), "matrix": sum(matrix, ())}
        )
    return _rows(out, _arrow(_MATRIX, table.schema.field("conv_id").type))


def costs_to_go(table: pa.Table) -> pa.Table:
    """Of one conversation: what the rest costs after each of its blocks, from the end back."""
    rows = table.sort_by([("block", "descending")])
    ending, out = ENDING, []
    for n, row in enumerate(rows.to_pylist()):
        m = row.pop("matrix")
        out.append(row | {"ending": ending, "last": n == 0})
        ending = tuple(min(m[4 * p + q] + ending[q] for q in STATES) for p in STATES)
    return _rows(out, _arrow(_AHEAD, table.schema.field("conv_id").type))


def block_exits(table: pa.Table) -> pa.Table:
    """Where the cheapest edits of a block lead from each state."""
    out = []
    for conv_id, rows in _stretches(table):
        head = rows.select(["block", "ending", "last"]).slice(0, 1).to_pylist()[0]
        units = _units(rows.column("symbol").to_pylist(), rows.column("copies").to_pylist())
        flat = [u for unit in units for u in unit]
        exits = [unroll(flat, p, tuple(head["ending"]), head["last"])[2] for p in STATES]
        out.append({"conv_id": conv_id, **head, "exits": exits})
    return _rows(out, _arrow(_EXITS, table.schema.field("conv_id").type))


def states_before(table: pa.Table) -> pa.Table:
    """Of one conversation: the state before each of its blocks, from the start on."""
    state, out = NOTHING, []
    for row in table.sort_by("block").to_pylist():
        exits = row.pop("exits")
        out.append(row | {"state": state})
        state = exits[state]
    return _rows(out, _arrow(_ENTRY, table.schema.field("conv_id").type))


def _same_block(left: DataFrame, right: DataFrame) -> Column:
    return (left["block"] == right["block"]) & left["conv_id"].eqNullSafe(right["conv_id"])


def _stitched(symbols: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, ``ending``, ``last`` and ``state`` of conversations in several blocks."""
    parts = symbols.groupBy("conv_id", "block").agg(F.lit(1).alias("one"))
    several = parts.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("n")).where("n > 1")
    spread = symbols.join(several, symbols["conv_id"].eqNullSafe(several["c"]), "left_semi")
    spread = spread.select("place", "block", "conv_id", "copies", "symbol")
    matrices = spread.groupBy("block").applyInArrow(block_matrices, _typed(_MATRIX, symbols))
    ahead = matrices.groupBy("conv_id").applyInArrow(costs_to_go, _typed(_AHEAD, symbols))
    joined = spread.join(ahead, _same_block(spread, ahead)).select(spread["*"], "ending", "last")
    exits = joined.groupBy("block").applyInArrow(block_exits, _typed(_EXITS, symbols))
    return exits.groupBy("conv_id").applyInArrow(states_before, _typed(_ENTRY, symbols))


# The edits


_EDITS = (
    "conv_id bigint, block bigint, letters string, cost bigint, "
    "written array<struct<place:bigint,roles:string>>"
)


def block_edits(table: pa.Table) -> pa.Table:
    """Each conversation's edits in a block: their letters, and by row the roles written."""
    out = []
    for conv_id, rows in _stretches(table):
        head = rows.select(["block", "ending", "last", "state"]).slice(0, 1).to_pylist()[0]
        alone = head["state"] is None  # the block holds the whole conversation
        symbols, copies = rows.column("symbol").to_pylist(), rows.column("copies").to_pylist()
        units = _units(symbols, copies)
        letters, roles, _ = unroll(
            [u for unit in units for u in unit],
            NOTHING if alone else head["state"],
            ENDING if alone else tuple(head["ending"]),
            alone or head["last"],
        )
        word = "".join(letters)
        cost = DELETE * word.count("D") + INSERT * word.count("I") + RENAME * word.count("R")
        by_row, at = [], 0
        for place, unit, symbol in zip(rows.column("place").to_pylist(), units, symbols, strict=True):
            text = "".join(roles[at : at + len(unit)])
            if symbol != DELETED and symbol % 2 and any(c in "KR" for c in letters[at]):
                cost += TRUNCATED
            if text:
                by_row.append({"place": place, "roles": text})
            at += len(unit)
        out.append(
            {"conv_id": conv_id, "block": head["block"], "letters": word, "cost": cost, "written": by_row}
        )
    return _rows(out, _arrow(_EDITS, table.schema.field("conv_id").type))


def _illegal(symbols: DataFrame) -> DataFrame:
    """``conv_id`` and the neighbours whose initials may not follow each other.

    Inside a block by a window over its rows, between blocks by one over a row a block.
    """
    legal = ("su", "ua", "au")
    inside = Window.partitionBy("block", "conv_id").orderBy("place")
    before = F.lag("initial").over(inside)
    odd = before.isNotNull() & ~F.concat(before, "initial").isin(*legal)
    # Copies stand side by side, and no initial may follow itself.
    rows = symbols.withColumn("odd", odd.cast("long") + F.col("copies") - 1)
    parts = rows.groupBy("conv_id", "block").agg(
        F.sum("odd").alias("odd"),
        F.min_by("initial", "place").alias("opens"),
        F.max_by("initial", "place").alias("closes"),
    )
    closed = F.lag("closes").over(Window.partitionBy("conv_id").orderBy("block"))
    between = closed.isNotNull() & ~F.concat(closed, "opens").isin(*legal)
    return (
        parts.withColumn("between", between.cast("long"))
        .groupBy("conv_id")
        .agg((F.sum("odd") + F.sum("between")).alias("illegal"))
    )


def repair(messages: DataFrame, *, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The audit of each conversation of ``messages`` (``conv_id``, ``turn``, ``role``, ``text``) and
    the repaired rows.

    Audit: ``conv_id``, ``gaps`` (turns missing between the first and the last), ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit``. Rows: ``conv_id``, ``place`` and ``part``,
    in whose order they stand, ``role`` and ``text``.
    """
    placed = in_order(counted_rows(messages))
    symbols = _with_symbols(placed, block)
    stitched = written(_stitched(symbols))
    bare = symbols.select("place", "block", "conv_id", "copies", "symbol")
    ready = bare.join(stitched, _same_block(bare, stitched), "left").select(
        bare["*"], "ending", "last", "state"
    )
    edits = written(ready.groupBy("block").applyInArrow(block_edits, _typed(_EDITS, messages)))

    lone = F.when(F.col("first"), F.col("copies") - 1).otherwise(F.col("copies"))
    turns = placed.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies"))).alias("blank"),
        F.sum(F.when(~F.col("blank"), lone)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & F.col("first") & F.col("truncated"), 1)).alias("truncated"),
    )
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)")
    gaps = (span + 1 - F.count("turn")).try_cast("bigint")
    faults = turns.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("blank", "duplicate", "truncated")),
    )
    pieces = F.array_sort(F.collect_list(F.struct("block", "letters")))
    told = edits.groupBy(F.col("conv_id").alias("c")).agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["letters"]), "").alias("audit"),
    )
    odd = _illegal(symbols).withColumnRenamed("conv_id", "o")
    audit = (
        faults.join(told, faults["conv_id"].eqNullSafe(told["c"]))
        .join(odd, faults["conv_id"].eqNullSafe(odd["o"]))
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )

    by_row = edits.select(F.inline("written"))
    kept = placed.select("conv_id", "place", F.col("role").alias("own"), F.col("text").alias("own_text"))
    letters = F.filter(F.split("roles", ""), lambda way: way != "")
    each = by_row.join(kept, "place").select("conv_id", "place", "own", "own_text", F.posexplode(letters).alias("part", "way"))
    inserted = F.col("way").isin("u", "a")
    rows = each.select(
        "conv_id",
        "place",
        "part",
        F.when(F.col("way") == "k", F.col("own"))
        .when(F.lower("way") == "u", "user")
        .otherwise("assistant")
        .alias("role"),
        F.when(inserted, "").otherwise(F.col("own_text")).alias("text"),
    )
    return audit, rows


# The digest of the repaired rows


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation; a running digest is all that is kept of one."""
    held, running, schema = None, None, None
    for batch in batches:
        if schema is None:
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("repaired_sha256", pa.string())])
        done = []
        for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if running is None or conv_id != held:
                if running is not None:
                    done.append((held, running.hexdigest()))
                held, running = conv_id, hashlib.sha256(line.encode())
            else:
                running.update(b"\n" + line.encode())
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema)
    if running is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": held, "repaired_sha256": running.hexdigest()}], schema)


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256`` over ``role:text`` of its rows, joined by newlines.

    A digest takes its bytes one after another, so a conversation's rows pass through one
    task, sorted by Spark; none of them stays there.
    """
    line = F.concat("role", F.lit(":"), "text").alias("line")
    ready = rows.select("conv_id", "place", "part", line).repartition("conv_id")
    ready = ready.sortWithinPartitions("conv_id", "place", "part").select("conv_id", "line")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return ready.mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")

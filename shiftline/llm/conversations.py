"""Conversations whose turns are edited, at the least cost, until their roles alternate.

A run-length dynamic program over role and fault symbols. The states are what the repaired roles end
with so far; a symbol's transition is a 4 x 4 matrix under (min, +). Equal consecutive symbols make
a run, which the cost to go crosses by binary powers of its matrix, kept per symbol. The choices are
then unrolled forwards, each run from the costs behind it.

Turns lie in ranges of one global order, so that a long conversation is spread over tasks. What
crosses the ends of ranges, a matrix and a state each, is put together on the driver: at most two
pieces per range. The texts stream through in order; no conversation is held as a whole. SHA-256
takes its input in sequence, so the digest of one conversation is one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm.workspace import Workspace, ship

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# What the repaired roles end with.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
_ROLES = "sua"  # roles by initial; others are class 3
FINE, CUT, GONE = range(3)  # a turn that stays free of cost, one that costs, one that must go
SYMBOLS = 4 * 3
FAULTS = ("", "blank", "duplicate", "truncated")
_BLANKS = r" \u0009\u000A\u000B\u000C\u000D"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above
_FAR = 1 << 50

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _next(state: int) -> int:
    """The state after a user or assistant turn, whichever may follow ``state``."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, role: int) -> int | None:
    """The state after keeping a turn, if it may follow."""
    if role == 0:
        return SYSTEM if state == START else None
    return role + 1 if role < 3 and role + 1 == _next(state) else None


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of what can become of a turn, in the order of the edits' initials."""
    role, fault = divmod(symbol, 3)
    found = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        after = _kept(state, role)
        if after is not None:
            found.append(("K", more, after))
        found.append(("R", REROLE + more, _next(state)))
    return found


def _with_inserts(ahead: list[int]) -> Vector:
    """Costs to go when turns may be inserted first. Two reach every state that inserts can help."""
    for _ in range(3):
        ahead = [min(ahead[i], INSERT + ahead[_next(i)]) for i in STATES]
    return tuple(min(a, _FAR) for a in ahead)


def _before(symbol: int, after: Vector) -> Vector:
    return _with_inserts(
        [min(cost + after[j] for _, cost, j in _choices(symbol, i)) for i in STATES]
    )


def times(left: Matrix, right: Matrix) -> Matrix:
    return tuple(
        tuple(min(_FAR, *(left[i][k] + right[k][j] for k in STATES)) for j in STATES)
        for i in STATES
    )


def applied(matrix: Matrix, ahead: Vector) -> Vector:
    return tuple(min(_FAR, *(row[j] + ahead[j] for j in STATES)) for row in matrix)


END = _with_inserts([0, _FAR, _FAR, 0])
IDENTITY: Matrix = tuple(tuple(0 if i == j else _FAR for j in STATES) for i in STATES)
_powers: dict[int, list[Matrix]] = {}


def powers(symbol: int, count: int) -> Iterator[Matrix]:
    """The binary powers of the symbol's matrix that make up ``count`` turns."""
    if symbol not in _powers:
        columns = [
            _before(symbol, tuple(0 if j == k else _FAR for k in STATES)) for j in STATES
        ]
        _powers[symbol] = [tuple(tuple(columns[j][i] for j in STATES) for i in STATES)]
    own = _powers[symbol]
    while len(own) < count.bit_length():
        own.append(times(own[-1], own[-1]))
    return (own[k] for k in range(count.bit_length()) if count >> k & 1)


def matrix_of(runs: list[tuple[int, int]]) -> Matrix:
    made = IDENTITY
    for symbol, count in runs:
        for power in powers(symbol, count):
            made = times(made, power)
    return made


def _ahead_of_runs(runs: list[tuple[int, int]], after: Vector) -> list[Vector]:
    """The costs to go in front of every run and, last, behind all."""
    found = [after]
    for symbol, count in reversed(runs):
        ahead = found[-1]
        for power in powers(symbol, count):
            ahead = applied(power, ahead)
        found.append(ahead)
    return found[::-1]


_steps: dict[tuple[int, Vector], tuple[list[tuple[str, int]], Vector]] = {}


def _step(symbol: int, after: Vector) -> tuple[list[tuple[str, int]], Vector]:
    """For every state the edits for one turn and the next state; the costs in front of it.

    Of the cheapest edits the least initial is taken: all strings that use up the same turns from
    the same state differ before either ends. ``after`` is relative to its least cost.
    """
    known = _steps.get((symbol, after))
    if known is None:
        before = _before(symbol, after)
        edits = []
        for state in STATES:
            letters = ""
            while True:
                offers = [(e, c + after[j], j) for e, c, j in _choices(symbol, state)]
                offers.append(("I", INSERT + before[_next(state)], _next(state)))
                edit, _, then = min(o for o in offers if o[1] == min(x[1] for x in offers))
                letters, state = letters + edit, then
                if edit != "I":
                    break
            edits.append((letters, state))
        if len(_steps) > 10_000:
            _steps.clear()
        known = _steps[symbol, after] = edits, before
    return known


def unroll(runs: list[tuple[int, int]], after: Vector, state: int) -> tuple[str, int]:
    """The least of the cheapest edits from ``state`` on, and the state that they lead to."""
    ahead, made = _ahead_of_runs(runs, after), []
    for (symbol, count), behind in zip(runs, ahead[1:], strict=True):
        levels = []
        for _ in range(count):
            low = min(behind)
            edits, behind = _step(symbol, tuple(c - low for c in behind))
            levels.append(edits)
            behind = tuple(c + low for c in behind)
        for edits in reversed(levels):
            letters, state = edits[state]
            made.append(letters)
    return "".join(made), state


def closing(state: int) -> str:
    """What is inserted behind the last turn."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


# The stages below hand these columns on.
_RUNS = [("symbols", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
_STATS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PIECE = pa.schema(
    [("range", pa.int64()), ("start", pa.int64()), ("conv_id", pa.int64())]
    + _RUNS
    + [(name, pa.int64()) for name in (*_STATS, "first_turn", "last_turn", "first_role", "last_role")]
    + [("matrix", pa.list_(pa.int64()))]
)
_PIECE_DDL = (
    "range long, start long, conv_id long, symbols array<int>, counts array<long>, blank long, "
    "duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, "
    "first_role long, last_role long, matrix array<long>"
)
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation in each range: its runs and what can be counted within.

    The first and the last piece of a range get their matrix, since they may go on outside.
    """
    piece, done = None, []

    def close(last: bool) -> None:
        if last or piece["edge"]:
            runs = list(zip(piece["symbols"], piece["counts"], strict=True))
            piece["matrix"] = [x for row in matrix_of(runs) for x in row]
        done.append(piece)

    for batch in batches:
        for own, at, conv, turn, role, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if piece is None or own != piece["range"] or conv != piece["conv_id"]:
                new_range = piece is None or own != piece["range"]
                if piece is not None:
                    close(new_range)
                piece = {"range": own, "start": at, "conv_id": conv, "symbols": [], "counts": []}
                piece |= dict.fromkeys(_STATS, 0)
                piece |= {"first_turn": None, "last_turn": None, "first_role": role}
                piece |= {"last_role": None, "edge": new_range, "matrix": None}
            if fault:
                piece[FAULTS[fault]] += 1
            if piece["last_role"] is not None:
                piece["illegal"] += (piece["last_role"], role) not in _LEGAL
            piece["last_role"] = role
            if turn is not None and turn != piece["last_turn"]:
                piece["turns"] += 1
                piece["last_turn"] = turn
                if piece["first_turn"] is None:
                    piece["first_turn"] = turn
            symbol = role * 3 + (FINE, GONE, GONE, CUT)[fault]
            if piece["symbols"] and piece["symbols"][-1] == symbol:
                piece["counts"][-1] += 1
            else:
                piece["symbols"].append(symbol)
                piece["counts"].append(1)
        yield pa.RecordBatch.from_pylist(done, schema=_PIECE)
        done.clear()
    if piece is not None:
        close(True)
        yield pa.RecordBatch.from_pylist(done, schema=_PIECE)


def _links(pieces: DataFrame) -> tuple[dict[int, Vector], list[list[int]]]:
    """Of conversations in several ranges: the costs behind each piece, and the pieces in order.

    Only the first and last piece of a range can go on outside, so this is bounded by the ranges.
    """
    edges = pieces.where("matrix IS NOT NULL").select("start", "conv_id", "matrix").collect()
    chains: list[list] = []
    for edge in sorted(edges, key=lambda e: e["start"]):
        if chains and chains[-1][-1]["conv_id"] == edge["conv_id"]:
            chains[-1].append(edge)
        else:
            chains.append([edge])
    behind, order = {}, []
    for chain in chains:
        if len(chain) > 1:
            ahead = END
            for edge in reversed(chain):
                behind[edge["start"]] = ahead
                flat = edge["matrix"]
                ahead = applied(tuple(tuple(flat[4 * i : 4 * i + 4]) for i in STATES), ahead)
            order.append([edge["start"] for edge in chain])
    return behind, order


def _unrolled(behind: dict[int, Vector], later: set[int]) -> Callable:
    """Adds to pieces the edits and the state behind them, from START or, for pieces that go on
    from another range, from every state; and the cost from START.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, exits, costs = [], [], []
            columns = (batch.column(n).to_pylist() for n in ("start", "symbols", "counts"))
            for start, symbols, counts in zip(*columns, strict=True):
                runs = list(zip(symbols, counts, strict=True))
                after = behind.get(start, END)
                found = [unroll(runs, after, s) for s in (STATES if start in later else (START,))]
                audits.append([letters for letters, _ in found])
                exits.append([state for _, state in found])
                costs.append(_ahead_of_runs(runs, after)[0][START])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(audits, pa.list_(pa.string())),
                    pa.array(exits, pa.list_(pa.int32())),
                    pa.array(costs, pa.int64()),
                ],
                names=[*batch.schema.names, "audits", "exits", "cost"],
            )

    return run


class _Conversation:
    """One conversation while its pieces and turns stream past in order."""

    def __init__(self, conv_id: int | None, entries: dict[int, int], tell: Callable):
        self.id, self.entries, self.tell = conv_id, entries, tell
        self.row = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.audit, self.letters, self.state = [], iter(""), START
        self.first = self.last = self.role = None
        self.turns = self.places = 0
        self.digest = hashlib.sha256()

    def piece(self, p: dict) -> None:
        self._drain()
        for name in ("blank", "duplicate", "truncated", "illegal"):
            self.row[name] += p[name]
        if self.role is not None and (self.role, p["first_role"]) not in _LEGAL:
            self.row["illegal"] += 1
        if not self.audit:
            self.row["cost"] = p["cost"]
        self.role = p["last_role"]
        if p["first_turn"] is not None:
            self.turns += p["turns"] - (p["first_turn"] == self.last)
            self.first = p["first_turn"] if self.first is None else self.first
            self.last = p["last_turn"]
        letters = p["audits"][self.entries.get(p["start"], 0)]
        self.audit.append(letters)
        self.letters = iter(letters)

    def turn(self, role: str, text: str) -> None:
        for edit in self.letters:
            if edit == "I":
                self._insert()
                continue
            if edit == "K":
                after = _kept(self.state, (_ROLES + role[:1]).index(role[0]) if role else 3)
                self._put(edit, role, text, after)
            elif edit == "R":
                self._put(edit, self._following(), text, _next(self.state))
            return

    def _following(self) -> str:
        return "assistant" if self.state == USER else "user"

    def _insert(self) -> None:
        self._put("I", self._following(), "", _next(self.state))

    def _put(self, edit: str, role: str, text: str, after: int) -> None:
        line = f"{role}:{text}".encode()
        self.digest.update(b"\n" + line if self.places else line)
        self.tell(self.id, self.places, role, text, edit)
        self.places += 1
        self.state = after

    def _drain(self) -> None:
        for _ in self.letters:
            self._insert()

    def close(self) -> dict:
        self._drain()
        if self.audit:
            self.audit.append(closing(self.state))
            for _ in self.audit[-1]:
                self._insert()
        if self.turns:
            self.row["gaps"] = self.last - self.first + 1 - self.turns
        return self.row | {
            "conv_id": self.id,
            "audit": "".join(self.audit),
            "repaired_sha256": self.digest.hexdigest(),
        }


_DIGEST = pa.schema(
    [("conv_id", pa.int64())]
    + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_DIGEST_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
_TURN = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64())]
    + [(n, pa.string()) for n in ("role", "text", "edit")]
)
_TURN_DDL = "conv_id long, place long, role string, text string, edit string"


def _streamed(entries: dict[int, int], digests: bool) -> Callable:
    """Conversations from their marker, pieces and turns in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows, turns = None, [], []

        def tell(*values) -> None:
            if not digests:
                turns.append(dict(zip(_TURN.names, values, strict=True)))

        for batch in batches:
            names = ("conv_id", "piece", "role", "text")
            for conv, piece, role, text in zip(*(batch.column(n).to_pylist() for n in names)):
                if own is None or conv != own.id:
                    if own is not None:
                        rows.append(own.close())
                    own = _Conversation(conv, entries, tell)
                if piece is not None:
                    own.piece(piece)
                elif role is not None:
                    own.turn(role, text)
            yield pa.RecordBatch.from_pylist(*((rows, _DIGEST) if digests else (turns, _TURN)))
            rows.clear()
            turns.clear()
        if own is not None:
            rows.append(own.close())
            yield pa.RecordBatch.from_pylist(*((rows, _DIGEST) if digests else (turns, _TURN)))

    return run


def _prepared(turns: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame, dict[int, int]]:
    """The turns in order, their pieces with edits, and the states in which pieces that go on from
    another range begin.
    """
    order = ["conv_id", "turn", "role", "text", "_arrival"]
    ordered = work.write(
        turns.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
            F.monotonically_increasing_id().alias("_arrival"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_arrival")
        .withColumn("_position", F.monotonically_increasing_id()),
        "turns",
    )
    ordered = ordered.withColumn(
        "_same", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    )
    firsts = ordered.groupBy("conv_id", "_same").agg(F.min("_position").alias("_position"))
    rest = F.expr(f"trim(TRAILING '{_BLANKS}' FROM text)")
    initial = F.expr(f"IF(role = '', 3, (instr('{_ROLES}', left(role, 1)) + 3) % 4)")
    marked = ordered.join(
        firsts.select("_position", F.lit(True).alias("_first")), "_position", "left"
    ).select(
        F.shiftright("_position", _ROW_BITS).alias("range"),
        "_position",
        "conv_id",
        "turn",
        initial.alias("role"),
        F.when(rest == "", 1)
        .when(F.col("_first").isNull(), 2)
        .when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), 3)
        .otherwise(0)
        .alias("fault"),
    )
    pieces = work.write(
        marked.repartition("range")
        .sortWithinPartitions("_position")
        .mapInArrow(_pieces, _PIECE_DDL),
        "pieces",
    )
    behind, chains = _links(pieces)
    later = {start for chain in chains for start in chain[1:]}
    unrolled = work.write(
        pieces.drop("matrix").mapInArrow(
            _unrolled(behind, later),
            _PIECE_DDL.removesuffix(", matrix array<long>")
            + ", audits array<string>, exits array<int>, cost long",
        ),
        "unrolled",
    )
    entries = {}
    if chains:
        inside = unrolled.where(F.col("start").isin(sorted(behind))).select("start", "exits")
        exits = {row["start"]: row["exits"] for row in inside.collect()}
        for chain in chains:
            state = exits[chain[0]][START]
            for start in chain[1:]:
                entries[start] = state
                state = exits[start][state]
    return ordered, unrolled, entries


def _repaired(original: DataFrame, turns: DataFrame, digests: bool) -> DataFrame:
    spark = turns.sparkSession
    ship(spark)
    ordered, pieces, entries = _prepared(turns, Workspace(spark, "conversations"))
    fields = [c for c in pieces.columns if c not in ("range", "conv_id", "symbols", "counts")]
    kind = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in pieces.schema if f.name in fields)
    none = F.lit(None).cast(f"struct<{kind}>").alias("piece")
    text = F.lit(None).cast("string")
    parts = (
        original.select(F.col("conv_id").cast("long"))
        .distinct()
        .select("conv_id", F.lit(-1).cast("long").alias("at"), none, text.alias("role"), text.alias("text"))
        .unionAll(
            pieces.select("conv_id", "start", F.struct(*fields), text, text)
        )
        .unionAll(ordered.select("conv_id", "_position", none, "role", "text"))
    )
    # A piece stands in front of the turn at which it starts.
    return (
        parts.repartition("conv_id")
        .sortWithinPartitions("conv_id", "at", F.col("piece").isNull())
        .mapInArrow(_streamed(entries, digests), _DIGEST_DDL if digests else _TURN_DDL)
    )


def repair_report(turns: DataFrame, original: DataFrame | None = None) -> DataFrame:
    """One row for every conversation of ``turns`` (conv_id, turn, role, text): its faults, the
    cheapest edits and a digest of what they give.

    A conversation's rows are taken by turn, nulls first, equal ones by role and text. A row's first
    fault counts: ``blank`` (nothing but blanks, tabs and line ends), ``duplicate`` (role and text
    seen earlier), ``truncated`` (its last other character is not ``.``, ``!`` or ``?``). Edits keep
    a row (free), give it the role user or assistant (3), delete it (4; blanks and duplicates must
    go) or insert an empty user or assistant turn (3); a truncated row that stays costs 3 more. They
    give role initials ``(s?(ua)+)?`` at the least cost. ``audit`` has the edits' initials in order,
    the least of equally cheap ones. ``gaps`` counts missing turn numbers, ``illegal`` adjacent role
    initials other than su, ua and au; ``repaired_sha256`` is of the repaired ``role:text`` lines.

    A null role or text counts as one blank; a null turn comes first and does not count in ``gaps``;
    a null conv_id names one conversation of its own. Repeated rows are duplicates. Conversations of
    ``original`` (default: ``turns``) that have no rows get zeros, an empty audit and the digest of
    nothing. Other columns are not read. An empty table gives an empty table. Texts may be of any
    length; one conversation's edits must fit into a value, and its digest is one task's work.
    """
    return _repaired(turns if original is None else original, turns, True)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), role, text and edit (K, R or
    I) of every turn that ``repair_report``'s edits leave. Conversations of which nothing stays have
    no rows; see there for nulls and odd rows.
    """
    return _repaired(turns, turns, False)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with faults, chosen by crc32 of ``conv_id:turn`` modulo
    20: 0 drops a row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes
    its role user. Nulls count as one blank, in the result also for role and text.
    """

    def said(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    return (
        turns.select(
            "conv_id",
            "turn",
            F.when(code == 4, "user").otherwise(said("role")).alias("role"),
            F.when(code == 1, "")
            .when(code == 2, F.translate(said("text"), ".!?", ""))
            .otherwise(said("text"))
            .alias("text"),
            code.alias("_code"),
        )
        .where("_code <> 0")
        .withColumn("_copy", F.explode(F.expr("sequence(1, IF(_code = 3, 2, 1))")))
        .drop("_code", "_copy")
    )

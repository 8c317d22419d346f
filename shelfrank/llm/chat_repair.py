"""Conversation repair: cheapest edits that give alternating roles.

A conversation's rows become symbols (role initial, fault). Keeping, rerolling,
deleting and inserting rows moves an automaton of four states over the wanted
form (s?(ua)+)?. The step over one symbol is a 4 x 4 matrix of least costs; a run
of n equal symbols is its n-th min-plus power, taken from cached binary powers.
Costs are carried back from the end over runs, then choices are unrolled from
the front, the ASCII-least letter among those that keep the least cost.

A conversation may hold a third of all rows, so none is gathered in a task:

1. `damaged` is columns alone. `_rows` collapses equal rows of a conversation
   and turn into one with a number (a group of copies never meets in a task), and
   marks the first of equal role and text.
2. Rows without their texts are sorted by range of (conversation, turn, ...). A
   partition holds whole conversations and at most two pieces of others.
3. `_ends` gives the matrix of each such piece. They are at most two a
   partition, so the driver chains them: the costs behind each piece.
4. `_turns` gives the state that each piece ends in, from each state it could
   start in; chained again, this gives its start.
5. `_unroll` writes each piece's letters and the rows that stay. Only these
   are joined with their texts and sorted by conversation, and each conversation
   is hashed as it streams by, row after row.

The hash of one conversation is sequential by its definition: a task reads the
rows of a long one in order, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import ship
from shelfrank.llm.ranges import default_parts
from shelfrank.session import scratch_path

ship(__name__)

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
NEVER = 1 << 60
#: A symbol is 3 x role (system, user, assistant, other) + (0 sound, 1 truncated);
#: a row that must go is GONE whatever its role.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
GONE = 2
#: States: nothing yet, after the system row, after a user row, after an assistant row.
STATES = range(4)
FINAL = (0, 3)
#: State after an added or rerolled row: the one role that may follow.
NEXT = (2, 2, 3, 2)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------- automaton


def _kept(state: int, symbol: int) -> int | None:
    """State after a row that keeps its role, None where that breaks the form."""
    role = symbol // 3
    if role == SYSTEM:
        return 1 if state == 0 else None
    if role == USER:
        return None if state == 2 else 2
    return 3 if role == ASSISTANT and state == 2 else None


def _choices(state: int, symbol: int) -> list[tuple[str, int, int | None]]:
    """(letter, cost, state) of the edits at a row, letters ascending. An insert
    leaves the row to come."""
    out = [("D", DELETE, state), ("I", INSERT, NEXT[state])]
    if symbol != GONE:
        more = UNFINISHED if symbol % 3 == 1 else 0
        after = _kept(state, symbol)
        if after is not None:
            out.append(("K", KEEP + more, after))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


def _times(a: list, b: list) -> list:
    return [[min(a[i][k] + b[k][j] for k in STATES) for j in STATES] for i in STATES]


def _ahead(matrix: list, costs: list) -> list:
    """Costs to go before a step, from those behind it."""
    return [min(row[k] + costs[k] for k in STATES) for row in matrix]


def _inserts() -> list:
    """Least cost of inserted rows between two states."""
    m = [[0 if i == j else NEVER for j in STATES] for i in STATES]
    for _ in STATES:
        for i in STATES:
            for j in STATES:
                m[i][NEXT[j]] = min(m[i][NEXT[j]], m[i][j] + INSERT)
    return m


INSERTS = _inserts()
#: Costs to go behind the last row.
END = _ahead(INSERTS, [0 if s in FINAL else NEVER for s in STATES])


class Powers(dict):
    """(symbol, j) -> min-plus power 2^j of the step over the symbol."""

    def __missing__(self, key: tuple[int, int]) -> list:
        symbol, j = key
        if j:
            half = self[symbol, j - 1]
            m = _times(half, half)
        else:
            row = [[NEVER] * 4 for _ in STATES]
            for state in STATES:
                for letter, cost, after in _choices(state, symbol):
                    if letter != "I":
                        row[state][after] = min(row[state][after], cost)
            m = _times(INSERTS, row)
        self[key] = m
        return m

    def over(self, symbol: int, n: int, costs: list) -> list:
        """Costs to go before a run of n, from those behind it."""
        j = 0
        while n:
            if n & 1:
                costs = _ahead(self[symbol, j], costs)
            n >>= 1
            j += 1
        return costs

    def before(self, runs: list, costs: list) -> list[list]:
        """Costs to go before each run and behind the last."""
        out = [costs]
        for symbol, n in reversed(runs):
            out.append(self.over(symbol, n, out[-1]))
        return out[::-1]

    def matrix(self, runs: list) -> list:
        """The step over all runs."""
        units = [[0 if i == j else NEVER for i in STATES] for j in STATES]
        columns = [self.before(runs, unit)[0] for unit in units]
        return [[min(columns[j][i], NEVER) for j in STATES] for i in STATES]

    def letters(self, state: int, symbol: int, n: int, costs: list) -> Iterator[tuple[str, int]]:
        """(letter, state after it) of a run of n, of least cost and then least
        letters. Costs inside the run come from the powers, so memory is log n."""
        todo = [(n, costs)]
        while todo:
            n, costs = todo.pop()
            if n > 1:
                j = (n - 1).bit_length() - 1
                todo += [(1 << j, costs), (n - (1 << j), _ahead(self[symbol, j], costs))]
                continue
            here = _ahead(self[symbol, 0], costs)
            while True:
                for letter, cost, after in _choices(state, symbol):
                    behind = here if letter == "I" else costs
                    if cost + behind[after] == here[state]:
                        break
                state = after
                yield letter, state
                if letter != "I":
                    break

    @staticmethod
    def last_inserts(state: int) -> Iterator[tuple[str, int]]:
        while state not in FINAL:
            state = NEXT[state]
            yield "I", state


def collapsed(symbols) -> list[tuple[int, int]]:
    """Runs (symbol, number) of (symbol, number) in order."""
    runs: list[tuple[int, int]] = []
    for symbol, n in symbols:
        if runs and runs[-1][0] == symbol:
            runs[-1] = (symbol, runs[-1][1] + n)
        else:
            runs.append((symbol, n))
    return runs


# ---------------------------------------------------------------------- damage


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, w) after damage, null role and text as one
    space. w is the number of equal rows that one stands for: 0 for a dropped
    row, 2 for a repeated one."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("w"),
    )


_BLANKS = r"\x20\x09-\x0D"


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with `lead` and `key` (MD5) in place of the text, which order rows of
    one turn and role, and with what the text's faults are."""
    return rows.withColumn("lead", F.substring("text", 1, 32)).withColumn("key", F.md5("text"))


def _rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, lead, key, w, fault, first): equal rows of a turn as
    one. fault: 0 sound, 1 truncated, 2 blank. first: no earlier row of the
    conversation has this role and text."""
    rows = _keyed(damaged(turns)).withColumn(
        "fault",
        F.when(~F.col("text").rlike(f"[^{_BLANKS}]"), 2)
        .when(F.col("text").rlike(f"[.!?][{_BLANKS}]*\\z"), 0)
        .otherwise(1),
    )
    path = scratch_path(turns.sparkSession, "turns")
    same = ["conv_id", "turn", "role", "lead", "key", "fault"]
    rows.groupBy(*same).agg(F.sum("w").alias("w")).write.parquet(path)
    rows = turns.sparkSession.read.parquet(path)
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = rows.where("w > 0").groupBy("conv_id", "role", "key").agg(F.min(at).alias("_at"))
    firsts = firsts.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("key").alias("_k"), "_at")
    same_text = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("key") == F.col("_k"))
    found = rows.join(firsts, same_text, "left")
    return found.withColumn("first", F.coalesce(at == F.col("_at"), F.lit(False))).drop("_c", "_r", "_k", "_at")


# ---------------------------------------------------------------------- pieces

_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


class _Piece:
    """Consecutive rows of one conversation in one partition."""

    def __init__(self, conv):
        self.conv = conv
        self.rows: list[tuple] = []  # turn, role, lead, key, symbol of the first, copies behind it
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.opens = self.closes = None  # (role, known turn) at both ends

    def add(self, turn, role, lead, key, w, fault, first) -> None:
        if not w:
            return
        kind = _INITIAL.get(role[:1], OTHER)
        if turn is not None:
            self.turns += self.closes is None or self.closes[1] != turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.closes is not None:
            self.illegal += not follows(self.closes[0], kind)
        self.illegal += w - 1  # a role never follows itself
        self.closes = (kind, turn)
        self.opens = self.opens or self.closes
        if fault == 2:
            self.blank += w
        else:
            self.duplicate += w - first
            self.truncated += bool(first and fault == 1)
        sound = first and fault != 2
        self.rows.append((turn, role, lead, key, 3 * kind + fault if sound else GONE, w - 1))

    def runs(self) -> list[tuple[int, int]]:
        return collapsed(x for r in self.rows for x in ((r[4], 1), (GONE, r[5])) if x[1])

    def counts(self) -> list:
        return [self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high]


def follows(role: int, after: int) -> bool:
    return (role, after) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


_COLUMNS = ["part", "conv_id", "turn", "role", "lead", "key", "w", "fault", "first"]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Piece, bool]]:
    """(partition, piece, whether it is the partition's first or last)."""
    last, part, n = None, None, 0
    for batch in batches:
        for part, conv, *row in zip(*(batch.column(c).to_pylist() for c in _COLUMNS)):
            if last is None or last.conv != conv:
                if last is not None:
                    yield part, last, n == 0
                    n += 1
                last = _Piece(conv)
            last.add(*row)
    if last is not None:
        yield part, last, True


_ENDS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("number", T.IntegerType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("matrix", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("opens", T.ArrayType(T.LongType())),
        T.StructField("closes", T.ArrayType(T.LongType())),
    ]
)


def _table(rows: list, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows) if rows else [[] for _ in arrow]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last piece of a partition: matrix, counts and both ends."""
    powers, out = Powers(), []
    for part, piece, outer in _pieces(batches):
        if outer:
            matrix = [x for row in powers.matrix(piece.runs()) for x in row]
            out.append((part, len(out), piece.conv, matrix, piece.counts(), piece.opens, piece.closes))
    yield from _table(out, _ENDS)


_TURNS = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("conv_id", T.LongType()), T.StructField("after", T.ArrayType(T.LongType()))]
)


def _turns(costs_behind: dict):
    """The state that each cut piece ends in, from each state it could start in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, out = Powers(), []
        for part, piece, outer in _pieces(batches):
            if outer and (part, piece.conv) in costs_behind:
                runs = piece.runs()
                costs = powers.before(runs, costs_behind[part, piece.conv])
                after = []
                for state in STATES:
                    if costs[0][state] >= NEVER:
                        after.append(None)
                        continue
                    for i, (symbol, n) in enumerate(runs):
                        for _, state in powers.letters(state, symbol, n, costs[i + 1]):
                            pass
                    after.append(state)
                out.append((part, piece.conv, after))
        yield from _table(out, _TURNS)

    return run


#: A row per piece (audit and counts) or per row that stays (turn to insert).
_UNROLLED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("audit", T.StringType()),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("cost", T.LongType()),
        T.StructField("cut", T.BooleanType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("lead", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("new_role", T.StringType()),
    ]
)
_ROLE_OF = {2: "user", 3: "assistant"}


def _unroll(cut: dict):
    """Letters of each piece and the rows that stay. cut: (part, conv) -> (start
    state, costs behind, counts, cost, whether it is the conversation's last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, out = Powers(), []
        for part, piece, outer in _pieces(batches):
            known = cut.get((part, piece.conv)) if outer else None
            state, behind, counts, cost, last = known or (0, END, piece.counts(), None, True)
            runs = piece.runs()
            costs = powers.before(runs, behind)
            cost = costs[0][0] if known is None else cost
            rows, letters, place = _expanded(piece), [], 0
            for i, (symbol, n) in enumerate(runs):
                for letter, state in powers.letters(state, symbol, n, costs[i + 1]):
                    letters.append(letter)
                    row = (None,) * 4 if letter == "I" else next(rows)
                    if letter != "D":
                        new = row[1] if letter == "K" else _ROLE_OF[state]
                        out.append((piece.conv, part, place, None, None, None, None, *row, new))
                        place += 1
            if last:
                for letter, state in powers.last_inserts(state):
                    letters.append(letter)
                    out.append((piece.conv, part, place, None, None, None, None, None, None, None, None, _ROLE_OF[state]))
                    place += 1
            out.append((piece.conv, part, None, "".join(letters), counts, cost, known is not None, *(None,) * 5))
            if len(out) > 10_000:
                yield from _table(out, _UNROLLED)
                out = []
        yield from _table(out, _UNROLLED)

    return run


def _expanded(piece: _Piece) -> Iterator[tuple]:
    for turn, role, lead, key, _, copies in piece.rows:
        yield turn, role, lead, key
        for _ in range(copies):
            yield turn, role, lead, key


# --------------------------------------------------------- chains on the driver


def _chains(ends: list) -> list[list]:
    """Pieces of one conversation that follow each other over partitions. There
    are at most two pieces a partition, whatever the data."""
    out: list[list] = []
    for piece in sorted(ends, key=lambda e: (e["part"], e["number"])):
        if out and out[-1][-1]["conv_id"] == piece["conv_id"] and out[-1][-1]["part"] != piece["part"]:
            out[-1].append(piece)
        else:
            out.append([piece])
    return [c for c in out if len(c) > 1]


def _merged(chain: list) -> list:
    """Counts of a conversation from those of its pieces."""
    pieces = [p for p in chain if p["opens"] is not None]
    total = [sum(p["counts"][i] for p in chain) for i in range(5)]
    for a, b in zip(pieces, pieces[1:]):
        total[3] += not follows(a["closes"][0], b["opens"][0])
        total[4] -= a["closes"][1] is not None and a["closes"][1] == b["opens"][1]
    low = [p["counts"][5] for p in pieces if p["counts"][5] is not None]
    high = [p["counts"][6] for p in pieces if p["counts"][6] is not None]
    return [*total, min(low, default=None), max(high, default=None)]


def _cut_pieces(rows: DataFrame) -> dict:
    """What `_unroll` needs to know about pieces of cut conversations."""
    chains = _chains(rows.mapInArrow(_ends, _ENDS).collect())
    if not chains:
        return {}
    behind, cost = {}, {}
    for chain in chains:
        costs = END
        for piece in reversed(chain):
            behind[piece["part"], piece["conv_id"]] = costs
            m = piece["matrix"]
            costs = [min(x, NEVER) for x in _ahead([m[4 * s : 4 * s + 4] for s in STATES], costs)]
        cost[chain[0]["part"], chain[0]["conv_id"]] = costs[0]
    after = {(r["part"], r["conv_id"]): r["after"] for r in rows.mapInArrow(_turns(behind), _TURNS).collect()}
    cut = {}
    for chain in chains:
        state, first = 0, (chain[0]["part"], chain[0]["conv_id"])
        for i, piece in enumerate(chain):
            key = piece["part"], piece["conv_id"]
            counts = _merged(chain) if i == 0 else [0, 0, 0, 0, 0, None, None]
            cut[key] = (state, behind[key], counts, cost[first] if i == 0 else 0, i == len(chain) - 1)
            state = after[key][state]
    return cut


# --------------------------------------------------------------------- results

_HASHED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("sha", T.StringType())])


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come in order."""
    conv, running, out = None, None, []
    for batch in batches:
        for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "new_role", "text"))):
            if running is None or c != conv:
                if running is not None:
                    out.append((conv, running.hexdigest()))
                conv, running = c, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(f"{role}:{text or ''}".encode())
    if running is not None:
        out.append((conv, running.hexdigest()))
    yield from _table(out, _HASHED)


def repaired(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows) of turns (conv_id, turn, role, text) after damage.

    conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit. rows: what stays, in the order of (part, place): conv_id, new_role,
    text (null for an inserted row).

    Rows of one turn come by role, then by the first 32 characters of the text,
    then by its MD5; equal rows are repetitions of the first, whose turn all of
    them have. A null turn comes first. Rows of null conv_id make one
    conversation. An empty role, or one that starts with another letter, cannot
    be kept. A conversation without rows after damage has zeros and an empty
    audit. An empty table gives no rows. Further columns are not read."""
    spark = turns.sparkSession
    order = ["conv_id", "turn", "role", "lead", "key"]
    rows = _rows(turns).repartitionByRange(default_parts(turns), *order).sortWithinPartitions(*order)
    rows = rows.withColumn("part", F.spark_partition_id()).select(*_COLUMNS).checkpoint()
    path = scratch_path(spark, "repair")
    rows.mapInArrow(_unroll(_cut_pieces(rows)), _UNROLLED).write.parquet(path)
    done = spark.read.schema(_UNROLLED).parquet(path)
    whole = done.where(F.col("audit").isNotNull())
    joined = (
        whole.where("cut")
        .groupBy("conv_id")
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "").alias("audit"),
            F.min_by("counts", "part").alias("counts"),
            F.sum("cost").alias("cost"),
        )
    )
    pieces = whole.where("not cut").select("conv_id", "audit", "counts", "cost").unionByName(joined)
    at = lambda i: F.col("counts")[i]
    conversations = pieces.select(
        "conv_id",
        F.coalesce(at(6) - at(5) + 1 - at(4), F.lit(0)).alias("gaps"),
        *(at(i).alias(name) for i, name in enumerate(("blank", "duplicate", "truncated", "illegal"))),
        "cost",
        "audit",
    )
    texts = _keyed(damaged(turns).where("w > 0")).groupBy("conv_id", "turn", "role", "lead", "key").agg(F.first("text").alias("text"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order]
    texts = texts.select("text", *(F.col(c).alias(f"_{c}") for c in order))
    kept = done.where(F.col("audit").isNull()).join(texts, same, "left")
    return conversations, kept.select("conv_id", "part", "place", "new_role", "text")


def repair(turns: DataFrame) -> DataFrame:
    """The conversations of `repaired` with the hash of their repaired rows."""
    conversations, rows = repaired(turns)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    hashes = ordered.select("conv_id", "new_role", "text").mapInArrow(_hash, _HASHED)
    hashes = hashes.select(F.col("conv_id").alias("_c"), "sha")
    out = conversations.join(hashes, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    return out.select(*conversations.columns, F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))

"""Repair of conversations whose turns do not alternate, by generalised LR parsing.

The role grammar C -> empty | T | s T, T -> u a | T u a (system, user, assistant) gives an LR automaton. Its
stacks are linked lists that share what lies below, and after each row one stack is kept for each top
state: equal tops go on alike, so the least (cost, edits) of them is the only one that can win. A row is
kept (K, free), gets the role the parser waits for (R, 2) or is deleted (D, 3); before and after each row an
empty turn may be inserted (I, 2). Blank and repeated rows must go; a truncated one that stays adds 1.
Edits of equal cost and rows cannot be one the beginning of the other, so least prefixes stay least.

Rows are sorted by conversation over all tasks and cut into chunks of equally many rows, whatever their
conversations. Conversations that lie in one chunk are repaired in it. A conversation over several chunks,
be it a third of the table, is parsed in each of them from every stack that can come in; the edits are
then chosen along the chunks, one record for each, and applied in the chunks again. Only that choice, and
the digest of all its text, go through one task in order.

Null role or text: one space. An empty or unknown role cannot be kept. Rows go by turn, nulls first, then
by role and a hash of the text; repeated rows follow each other. A null conversation id is a conversation.
Very long texts are taken whole. No rows, no conversations. Other columns are not read.
"""

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.tables import numbered
from roadpulse.session import ship_package

RULES = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "ua"), ("T", "Tua"))
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The role that an inserted or changed turn gets.
NAMES = {"u": "user", "a": "assistant"}
#: Rows of a chunk.
CHUNK = 512
_WHITE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}


class Automaton:
    """LR states of the grammar. A stack is (state, stack below); complete turns are reduced at once."""

    def __init__(self):
        states = [self._closed({(k, 0) for k, (left, _) in enumerate(RULES) if left == "C"})]
        self.moves: dict[tuple[int, str], int] = {}
        for state in states:  # grows meanwhile
            at = states.index(state)
            for symbol in "sTua":
                moved = self._closed({(k, dot + 1) for k, dot in state if RULES[k][1][dot : dot + 1] == symbol})
                if moved:
                    if moved not in states:
                        states.append(moved)
                    self.moves[at, symbol] = states.index(moved)
        done = [{k for k, dot in state if dot == len(RULES[k][1])} for state in states]
        self.accepts = {at for at, rules in enumerate(done) if any(RULES[k][0] == "C" for k in rules)}
        self.reduces = {at: k for at, rules in enumerate(done) for k in rules if RULES[k][0] == "T"}
        self.bottom = (0, None)
        stacks = [self.bottom]
        for stack in stacks:
            for role in "sua":
                pushed = self.push(stack, role)
                if pushed and pushed not in stacks:
                    stacks.append(pushed)
        #: All stacks there are, by name.
        self.stacks = {name(stack): stack for stack in stacks}

    @staticmethod
    def _closed(items: set) -> frozenset:
        items = set(items)
        while more := {(k, 0) for r, dot in items for k, (left, _) in enumerate(RULES) if RULES[r][1][dot : dot + 1] == left} - items:
            items |= more
        return frozenset(items)

    def push(self, stack: tuple, role: str) -> tuple | None:
        """The stack after one more turn, None if the grammar has no such turn here."""
        if (stack[0], role) not in self.moves:
            return None
        stack = (self.moves[stack[0], role], stack)
        while stack[0] in self.reduces:
            left, right = RULES[self.reduces[stack[0]]]
            for _ in right:
                stack = stack[1]
            stack = (self.moves[stack[0], left], stack)
        return stack

    def waits_for(self, stack: tuple) -> str:
        return next(role for role in NAMES if (stack[0], role) in self.moves)


def name(stack: tuple | None) -> str:
    return f"{name(stack[1])}.{stack[0]}" if stack else ""


LR = Automaton()


def _offer(front: dict, cost: int, edits: str, stack: tuple) -> bool:
    """Merge a stack into those of equal top; whether it is now the least of them."""
    held = front.get(stack[0])
    if held and held[:2] <= (cost, edits):
        return False
    front[stack[0]] = (cost, edits, stack)
    return True


def _with_inserts(front: dict) -> dict:
    todo = list(front.values())
    while todo:
        cost, edits, stack = todo.pop()
        more = (cost + INSERT, edits + "I", LR.push(stack, LR.waits_for(stack)))
        if _offer(front, *more):
            todo.append(more)
    return front


def parse(signs: str, entry: tuple = LR.bottom) -> dict[int, tuple[int, str, tuple]]:
    """(cost, edits, stack) by top state after rows with these signs.

    A sign is the initial of a row's role, "o" for one the grammar does not know, in upper case if the row
    is truncated; "x" is a row that must go.
    """
    front = _with_inserts({entry[0]: (0, "", entry)})
    for sign in signs:
        new: dict = {}
        late, role = TRUNCATED * sign.isupper(), sign.lower()
        for cost, edits, stack in front.values():
            _offer(new, cost + DELETE, edits + "D", stack)
            if sign != "x":
                if kept := LR.push(stack, role):
                    _offer(new, cost + late, edits + "K", kept)
                _offer(new, cost + REROLE + late, edits + "R", LR.push(stack, LR.waits_for(stack)))
        front = _with_inserts(new)
    return front


def best(front: dict) -> tuple[int, str, tuple]:
    return min(v for top, v in front.items() if top in LR.accepts)


@functools.lru_cache(maxsize=100_000)
def _repaired(signs: str) -> tuple[int, str]:
    return best(parse(signs))[:2]


def _applied(edits: str, roles: list[str], texts: list[str], stack: tuple) -> list[dict]:
    """The turns that the edits leave, from a stack on."""
    rows, out = zip(roles, texts), []
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit != "D":
            wanted = role[:1] if edit == "K" else LR.waits_for(stack)
            out.append({"edit": edit, "role": role if edit == "K" else NAMES[wanted], "text": text})
            stack = LR.push(stack, wanted)
    return out


def _faults(roles: list[str], texts: list[str], repeated) -> list[str]:
    """The first fault of each row, or "". `repeated` tells for each row whether an earlier one is its like."""
    out = []
    for text, again in zip(texts, repeated):
        dark = text.rstrip(_WHITE)
        out.append("blank" if not dark else "duplicate" if again else "" if dark[-1] in ".!?" else "truncated")
    return out


def _signs(roles: list[str], faults: list[str]) -> str:
    signs = []
    for role, fault in zip(roles, faults):
        known = role[:1] if role[:1] in ("s", "u", "a") else "o"
        signs.append("x" if fault in ("blank", "duplicate") else known.upper() if fault else known)
    return "".join(signs)


def _repeated(roles: list[str], texts: list[str]) -> list[bool]:
    seen, out = set(), []
    for row in zip(roles, texts):
        out.append(row in seen)
        seen.add(row)
    return out


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _part_schema(id: T.StructField) -> T.StructType:
    turn = T.StructType().add("edit", "string").add("role", "string").add("text", "string")
    schema = T.StructType([id]).add("part", "long").add("whole", "boolean")
    for count in _COUNTS:
        schema = schema.add(count, "long")
    return schema.add("audit", "string").add("repaired", T.ArrayType(turn))


_ARROW_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _part(id, part: int, whole: bool, roles: list[str], faults: list[str], before: str | None, cost: int, edits: str, repaired: list[dict]) -> tuple:
    """A record of the rows of one conversation in one chunk; `before` is the role of the row before them."""
    initials = [r[:1] for r in ([] if before is None else [before]) + roles]
    illegal = sum(a + b not in _LEGAL for a, b in itertools.pairwise(initials))
    return (id, part, whole, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, edits, repaired)


def _as_table(records: list[tuple], schema: T.StructType, id_type: pa.DataType) -> pa.Table:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    types = [id_type, *(kinds.get(f.dataType.simpleString(), _ARROW_TURNS) for f in schema.fields[1:])]
    columns = zip(*records) if records else [()] * len(types)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)


def _sorted(table: pa.Table) -> tuple[pa.Table, list[str], list[str]]:
    table = table.sort_by("row")
    return table, table.column("role").to_pylist(), table.column("text").to_pylist()


def repair(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk_rows: int = CHUNK) -> DataFrame:
    """Parts of repaired conversations: a conversation is one part, or one for each chunk it lies in.

    Columns: `id`, `part`, which orders them, `whole` for a conversation of one part, the counts of `blank`,
    `duplicate`, `truncated` rows and `illegal` neighbours, `cost`, `audit`, the edits, and `repaired`, the turns
    that are left, at most twice the rows of a chunk and a few.
    """
    spark = turns.sparkSession
    ship_package(spark)
    space = F.lit(" ")
    rows = turns.select(F.col(id).alias("id"), F.col(turn).alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"))
    rows = rows.withColumn("__hash", F.xxhash64("text")).withColumn("__n", F.monotonically_increasing_id())
    order = ["id", "turn", "role", "__hash", "__n"]
    rows = numbered(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__hash", "__n"), "repair-rows")
    rows = rows.withColumn("chunk", F.floor(F.col("row") / chunk_rows))
    ends = rows.groupBy("chunk").agg(F.min_by(F.struct("id"), "row").alias("first"), F.max_by(F.struct("id", "role"), "row").alias("last"))
    earlier = ends.select((F.col("chunk") + 1).alias("chunk"), F.col("last").alias("earlier"))
    later = ends.select((F.col("chunk") - 1).alias("chunk"), F.col("first").alias("later"))
    both = ends.join(earlier, "chunk", "left").join(later, "chunk", "left")
    flags = both.select("chunk", F.when(F.col("earlier").isNotNull() & F.col("earlier.id").eqNullSafe(F.col("first.id")), F.col("earlier.role")).alias("before"),
                        (F.col("later").isNotNull() & F.col("later.id").eqNullSafe(F.col("last.id"))).alias("after"), "first", "last")
    at_start = F.col("before").isNotNull() & F.col("id").eqNullSafe(F.col("first.id"))
    at_end = F.col("after") & F.col("id").eqNullSafe(F.col("last.id"))
    side = F.when(at_start, F.lit(0)).when(at_end, F.lit(1))
    placed = rows.join(flags, "chunk").select("chunk", side.alias("side"), "row", "id", "role", "text", F.when(at_start, F.col("before")).alias("before"))
    schema = _part_schema(placed.schema["id"])

    def whole(table: pa.Table) -> pa.Table:
        table, roles, texts = _sorted(table)
        ids, chunk, records = table.column("id").to_pylist(), table.column("chunk")[0].as_py(), []
        start = 0
        for own, run in itertools.groupby(ids):
            stop = start + sum(1 for _ in run)
            mine, said = roles[start:stop], texts[start:stop]
            faults = _faults(mine, said, _repeated(mine, said))
            cost, edits = _repaired(_signs(mine, faults))
            records.append(_part(own, chunk, True, mine, faults, None, cost, edits, _applied(edits, mine, said, LR.bottom)))
            start = stop
        return _as_table(records, schema, table.column("id").type)

    here = placed.filter("side is null").groupBy("chunk").applyInArrow(whole, schema)
    return here.unionByName(_over_chunks(placed.filter("side is not null"), schema))


def _over_chunks(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Parts of the conversations that lie in several chunks."""
    # a row is new if it is the first of its like; the number of a row is no hot key
    firsts = rows.groupBy("id", "role", F.sha2("text", 256)).agg(F.min("row").alias("row")).select("row", F.lit(True).alias("new"))
    rows = rows.join(firsts, "row", "left").withColumn("again", F.col("new").isNull()).drop("new")
    keys = ("chunk", "side")
    step = T.StructType([schema["id"]]).add("chunk", "long").add("side", "integer").add("entry", "string").add("exit", "string").add("cost", "long").add("audit", "string")

    def steps(table: pa.Table) -> pa.Table:
        table, roles, texts = _sorted(table)
        signs = _signs(roles, _faults(roles, texts, table.column("again").to_pylist()))
        id, chunk, side = (table.column(c)[0].as_py() for c in ("id", "chunk", "side"))
        found = [(id, chunk, side, entry, name(stack), cost, edits) for entry in LR.stacks for cost, edits, stack in parse(signs, LR.stacks[entry]).values()]
        return _as_table(found, step, table.column("id").type)

    choice = T.StructType([schema["id"]]).add("chunk", "long").add("side", "integer").add("entry", "string").add("cost", "long").add("audit", "string")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id, own in itertools.groupby(_records(batches), lambda r: r[0]):
            # by top state: cost, edits, name of the stack, and the choices so far as a linked list
            front = {0: (0, "", name(LR.bottom), None)}
            for (chunk, side), found in itertools.groupby(own, lambda r: r[1:3]):
                exits = [r[3:] for r in found]
                new: dict = {}
                for cost, edits, stack, chosen in front.values():
                    for entry, end, more, edit in exits:
                        held = new.get(top := LR.stacks[end][0])
                        if entry == stack and (not held or (cost + more, edits + edit) < held[:2]):
                            new[top] = (cost + more, edits + edit, end, ((chunk, side, entry, more, edit), chosen))
                front = new
            chosen, out = min(v for top, v in front.items() if top in LR.accepts)[3], []
            while chosen:
                out.append((id, *chosen[0]))
                chosen = chosen[1]
            yield from _as_table(out, choice, id_type).to_batches()

    id_type = pa.int64() if schema["id"].dataType == T.LongType() else pa.string()
    ways = rows.groupBy(*keys).applyInArrow(steps, step)
    chosen = ways.repartition("id").sortWithinPartitions("id", "chunk", "side").mapInArrow(choose, choice).drop("id")

    def applied(left: pa.Table, right: pa.Table) -> pa.Table:
        table, roles, texts = _sorted(left)
        id, chunk, before = (table.column(c)[0].as_py() for c in ("id", "chunk", "before"))
        entry, cost, edits = (right.column(c)[0].as_py() for c in ("entry", "cost", "audit"))
        faults = _faults(roles, texts, table.column("again").to_pylist())
        record = _part(id, chunk, False, roles, faults, before, cost, edits, _applied(edits, roles, texts, LR.stacks[entry]))
        return _as_table([record], schema, table.column("id").type)

    return rows.groupBy(*keys).cogroup(chosen.groupBy(*keys)).applyInArrow(applied, schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _transcript(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def digests(parts: DataFrame) -> DataFrame:
    """One row for each conversation: sums of the counts, the whole audit, and the digest of the repaired transcript."""
    told = parts.select("id", "part", "whole", *_COUNTS, "audit", _transcript(F.col("repaired")).alias("said"), (F.size("repaired") > 0).alias("says"))
    whole = told.filter("whole").select("id", *_COUNTS, "audit", F.sha2("said", 256).alias("repaired_sha256"))
    schema, id_type = whole.schema, pa.int64() if parts.schema["id"].dataType == T.LongType() else pa.string()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id, own in itertools.groupby(_records(batches), lambda r: r[0]):
            sums, audit, digest, begun = [0] * len(_COUNTS), [], hashlib.sha256(), False
            for _, _, _, *counts, edits, said, says in own:
                sums = [a + b for a, b in zip(sums, counts)]
                audit.append(edits)
                if says:
                    digest.update((("\n" if begun else "") + said).encode())
                    begun = True
            yield from _as_table([(id, *sums, "".join(audit), digest.hexdigest())], schema, id_type).to_batches()

    split = told.filter("not whole").repartition("id").sortWithinPartitions("id", "part").mapInArrow(joined, schema)
    return whole.unionByName(split)


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults, the same in each run: `conv_id`, `turn`, `role`, `text` and `lost` for a row that is to go."""
    space = F.lit(" ")
    case = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), case.alias("__case"))
    text = F.when(F.col("__case") == 1, "").when(F.col("__case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("__case") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("__case") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("__case") == 0).alias("lost"), F.explode(F.array_repeat(F.lit(0), copies))).drop("col")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation of the damaged table, its faults, and its cheapest repair."""
    rows = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    left = F.when(~F.col("lost"), F.col("turn"))
    turns = rows.groupBy("conv_id").agg(F.min(left).alias("least"), F.max(left).alias("most"), F.count_distinct(left).alias("n"))
    wide = (F.col("most").cast("decimal(20,0)") - F.col("least") + 1 - F.col("n")).try_cast("long")
    every = turns.select("conv_id", F.when(F.col("least").isNull(), 0).otherwise(wide).alias("gaps"))
    found = digests(repair(rows.filter("not lost")))
    counts = [F.coalesce(found[c], F.lit(0)).alias(c) for c in _COUNTS]
    return every.join(found, every["conv_id"].eqNullSafe(found["id"]), "left").select(
        "conv_id", "gaps", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

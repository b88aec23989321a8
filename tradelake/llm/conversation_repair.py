"""Repair of conversation structure by a Viterbi search over edits.

Edits of a row: Keep (0), Rerole to user or assistant (2), Delete (3, the only
one for blank or duplicate rows); an empty row of either role can be Inserted
anywhere (2).  A truncated row that stays costs 1 more.  The repaired roles, by
initials, are ``(s?(ua)+)?``; of the cheapest edit scripts the one whose letters
come first in ASCII is taken.

The search keeps one survivor for each of four states (nothing yet, after the
system row, after a user, after an assistant).  Survivors are leaves of a tree of
backpointers whose nodes count their references; a node that no survivor needs
is dropped with its branch, and as soon as all survivors have one ancestor in
common the edits up to it are final and are emitted.  So memory holds only the
unresolved part (a survivor that no future can make best is dropped as well).
Equal costs are decided by comparing the whole unresolved
parts from the last common ancestor on; neither can be a prefix of the other, as
both hold the same number of rows and inserts cost something.

Rows are range-partitioned by conversation and turn, so a conversation with a
third of all rows is cut into many pieces.  For pieces of cut conversations a
first pass gives the cost of every (entry, exit) pair and the order of their
scripts; a scan over these few numbers picks the states at the cuts, and the
last pass emits the edits of all pieces at the same time.

Defined results: a null conv_id is a conversation of its own; null turns come
first and count for no gap; null or empty roles and null texts are one space.
Rows with the same turn are ordered by role, then SHA-256 of the text.  Repeated
rows after the first are duplicates.  No rows: zeros, no edits.  Extra columns
change nothing.
"""

from __future__ import annotations

from functools import cmp_to_key
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import crc32_sql, stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
END = 4                     # exit of a piece that ends its conversation
ROLE = {USER: "user", ASSISTANT: "assistant"}


# ---- the search --------------------------------------------------------------------

class Node:
    """An edit of a script; ``refs`` counts its children and the survivors that end here."""
    __slots__ = ("parent", "edit", "role", "row", "cost", "depth", "kids", "refs")

    def __init__(self, parent, edit="", role=None, row=None, cost=0):
        self.parent, self.edit, self.role, self.row, self.cost = parent, edit, role, row, cost
        self.kids, self.refs, self.depth = [], 0, 0
        if parent is not None:
            self.depth = parent.depth + 1
            parent.kids.append(self)
            parent.refs += 1


class Survivors:
    """Best scripts to each state; ``take`` returns the edits that became final."""

    def __init__(self, entry: int = START):
        self.root = Node(None)
        self.root.refs = 1
        self.front = {entry: (0, self.root)}
        self.made: list[Node] = []

    def step(self, initial: str, must_delete: bool, truncated: bool, row=None) -> None:
        front = self._inserted()
        extra = TRUNCATED if truncated else 0
        options: dict[int, list] = {s: [(c + COST[DELETE], n, DELETE, None, COST[DELETE])] for s, (c, n) in front.items()}

        def add(to, state, edit, role):
            if state in front:
                c, n = front[state]
                options.setdefault(to, []).append((c + COST[edit] + extra, n, edit, role, COST[edit] + extra))
        if not must_delete:
            if initial == "s":
                add(SYSTEM, START, KEEP, None)
            for to, letter, states in ((USER, "u", (START, SYSTEM, ASSISTANT)), (ASSISTANT, "a", (USER,))):
                for s in states:
                    if initial == letter:
                        add(to, s, KEEP, None)
                    else:
                        add(to, s, REROLE, ROLE[to])
        best = {s: self._best(o, row) for s, o in options.items()}
        self._hold({s: v for s, v in best.items() if not self._hopeless(s, best)})

    @staticmethod
    def _hopeless(state: int, front) -> bool:
        """Whether a survivor is worse than another one by more than any future can give
        back: what follows "nothing yet" can follow an assistant row too, with the system
        row deleted (3), and what follows the system row as it is; after a user row it
        takes an assistant row first.  Without this the script that deletes all rows
        would be held, and with it every row, to the end."""
        if state not in (START, SYSTEM):
            return False
        gain = COST[DELETE] if state == START else 0
        return any(s in front and front[state][0] > front[s][0] + more + gain
                   for s, more in ((ASSISTANT, 0), (USER, COST[INSERT])))

    def finish(self) -> None:
        """Only the best complete script survives (under END)."""
        front = self._inserted()
        done = [(c, n, None, None, 0) for s, (c, n) in front.items() if s in (START, ASSISTANT)]
        self._hold({END: self._best(done, None)})

    def settle(self, state: int) -> None:
        """Only the script to ``state`` survives."""
        self._hold({state: self.front[state]})

    def take(self) -> list[Node]:
        out, root = [], self.root
        while root.refs == 1 and root.kids:     # one child and no survivor
            root = root.kids[0]
            root.parent = None
            out.append(root)
        self.root = root
        return out

    def ranks(self) -> dict[int, tuple[int, int]]:
        """state -> (cost, place of its script among the survivors')."""
        line = sorted(self.front, key=cmp_to_key(lambda x, y: -1 if self._before(self.front[x][1], self.front[y][1]) else 1))
        return {s: (self.front[s][0], line.index(s)) for s in self.front}

    def _inserted(self) -> dict[int, tuple[int, Node]]:
        """The front after inserts: none, one or two (a third never pays)."""
        front, made = dict(self.front), {}

        def insert(state, to):
            if (state, to) not in made:
                made[state, to] = (front[state][0] + COST[INSERT], self._new(front[state][1], INSERT, ROLE[to], None, COST[INSERT]))
            return made[state, to]
        to_user = [insert(s, USER) for s in (START, SYSTEM, ASSISTANT) if s in front]
        after = dict(front)
        user = [(c, n, None, None, 0) for c, n in ([front[USER]] if USER in front else []) + to_user]
        if user:
            after[USER] = self._best(user, None)
            cost, node = after[USER]
            both = (cost + COST[INSERT], self._new(node, INSERT, ROLE[ASSISTANT], None, COST[INSERT]))
            there = ([front[ASSISTANT]] if ASSISTANT in front else []) + [both]
            after[ASSISTANT] = self._best([(c, n, None, None, 0) for c, n in there], None)
        return after

    def _new(self, parent, edit, role, row, cost) -> Node:
        node = Node(parent, edit, role, row, cost)
        self.made.append(node)
        return node

    def _best(self, options, row) -> tuple[int, Node]:
        least = min(o[0] for o in options)
        tied = [o for o in options if o[0] == least]
        best = tied[0]
        for o in tied[1:]:
            if self._before(o[1], best[1], o[2] or "", best[2] or ""):
                best = o
        cost, node, edit, role, own = best
        return cost, node if edit is None else self._new(node, edit, role, row, own)

    @staticmethod
    def _before(a: Node, b: Node, more_a: str = "", more_b: str = "") -> bool:
        """Whether script ``a`` comes before ``b``: their letters since the common ancestor."""
        left, right = [more_a], [more_b]
        while a is not b:
            if a.depth >= b.depth:
                left.append(a.edit)
                a = a.parent
            else:
                right.append(b.edit)
                b = b.parent
        return "".join(reversed(left)) < "".join(reversed(right))

    def _hold(self, front: dict[int, tuple[int, Node]]) -> None:
        old, self.front = self.front, front
        for _, node in front.values():
            node.refs += 1
        for _, node in old.values():
            node.refs -= 1
        for node in [*(n for _, n in old.values()), *self.made]:
            while node.refs == 0 and node.parent is not None:       # no survivor comes by here
                parent, node.parent = node.parent, None
                parent.kids.remove(node)
                parent.refs -= 1
                node = parent
        self.made.clear()

    def unresolved(self) -> int:
        """Nodes that are held at present."""
        wait, n = [self.root], 0
        while wait:
            wait.extend(wait.pop().kids)
            n += 1
        return n - 1


def transfer(rows, last: bool) -> list[tuple[int, int, int, int]]:
    """(entry, exit, cost, rank) of a piece, from its (initial, must_delete, truncated)."""
    fronts = {s: Survivors(s) for s in STATES}
    for initial, must, cut in rows:
        for f in fronts.values():
            f.step(initial, must, cut)
            f.take()
    out = []
    for entry, f in fronts.items():
        if last:
            f.finish()
        out.extend((entry, to, cost, rank) for to, (cost, rank) in f.ranks().items())
    return out


def cuts(tables: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """(entry, exit) of every piece of one conversation.  Between scripts with
    different states at a cut the order is decided before the cut, so costs and
    ranks are all that has to be carried on."""
    front, back = {START: (0, 0)}, []
    for table in tables:
        best = {}
        for entry, to, cost, rank in table:
            if entry in front:
                best[to] = min(best.get(to, (float("inf"),)), (front[entry][0] + cost, front[entry][1], rank, entry))
        line = sorted(best, key=lambda to: best[to][1:3])
        front = {to: (best[to][0], line.index(to)) for to in best}
        back.append({to: best[to][3] for to in best})
    out, to = [], END
    for came in reversed(back):
        out.append((came[to], to))
        to = came[to]
    return out[::-1]


# ---- the jobs -----------------------------------------------------------------------

OK, BLANK, DUPLICATE, CUT_OFF = range(4)
EDITS = ("turn long, was string, fault int, edit string, role string, text string, cost long, seq long")


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, uid and fault (the first that applies)."""
    blank_if = lambda c: F.when(F.col(c).isNull() | ((F.lit(c) == "role") & (F.col(c) == "")), " ").otherwise(F.col(c))
    src = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank_if("role").alias("role"),
                      blank_if("text").alias("text"))
    src = stored(src.withColumn("digest", F.sha2("text", 256)).withColumn("uid", F.monotonically_increasing_id()), "turns")
    repeated = (src.groupBy("conv_id", "role", "digest")
                .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn", "uid")).alias("first")).where("n > 1")
                .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                        F.col("first.uid").alias("first")))
    seen = src.join(repeated, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                    & (F.col("digest") == F.col("d")), "left")
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
             .when(F.col("uid") != F.col("first"), DUPLICATE)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF).otherwise(OK))
    return seen.select("conv_id", "turn", "role", "text", "digest", "uid", fault.alias("fault"))


def in_pieces(rows: DataFrame) -> DataFrame:
    """``with_faults`` in order: piece (range partition) and seq, stored."""
    by = ["conv_id", "turn", "role", "digest", "uid"]
    return (stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("digest", "uid")
                   .withColumn("seq", F.monotonically_increasing_id()), "ordered")
            .withColumn("piece", F.shiftright("seq", 33)))


def grouped(batches, keys):
    """(key, rows) for consecutive rows with equal ``keys``; rows are tuples, streamed."""
    from itertools import groupby

    def rows():
        for batch in batches:
            at = [batch.schema.get_field_index(k) for k in keys]
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                yield tuple(row[i] for i in at), row
    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, (row for _, row in group)


def batched(rows, schema: pa.Schema, step: int = 2048):
    """Record batches of ``schema`` from a stream of tuples."""
    wait = []

    def batch():
        cols = list(zip(*wait)) if wait else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
    for row in rows:
        wait.append(row)
        if len(wait) >= step:
            yield batch()
            wait.clear()
    if wait:
        yield batch()


def arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(df.schema)


def states_at_cuts(ordered: DataFrame) -> DataFrame:
    """conv_id, piece, entry, exit for the pieces of conversations that lie in several."""
    spark, key = ordered.sparkSession, ordered.schema["conv_id"].dataType.simpleString()
    ends = ordered.groupBy("conv_id").agg(F.min("piece").alias("low"), F.max("piece").alias("last")).where("low < last")
    ends = stored(ends.select(F.col("conv_id").alias("c"), "last"), "cut")   # two for each partition at most
    if ends.isEmpty():
        return spark.createDataFrame([], f"conv_id {key}, piece long, entry int, exit int")
    part = (ordered.select("conv_id", "piece", "seq", F.substring("role", 1, 1).alias("initial"), "fault")
            .join(ends, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "piece", "last", "seq", "initial", "fault")
            .repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "seq"))
    name = arrow_schema(part).field("conv_id")
    four = pa.schema([name, ("piece", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                      ("rank", pa.int32())])

    def tables(batches):
        def rows():
            for (conv, piece, last), group in grouped(batches, ["conv_id", "piece", "last"]):
                letters = ((r[4], r[5] in (BLANK, DUPLICATE), r[5] == CUT_OFF) for r in group)
                for line in transfer(letters, piece == last):
                    yield (conv, piece, *line)
        yield from batched(rows(), four)
    found = part.mapInArrow(tables, f"conv_id {key}, piece long, entry int, exit int, cost long, rank int")
    found = stored(found, "transfers")

    def chosen(batches):
        def rows():
            for (conv,), group in grouped(batches, ["conv_id"]):
                pieces: dict[int, list] = {}        # 16 small numbers for each piece
                for r in group:
                    pieces.setdefault(r[1], []).append(r[2:6])
                for piece, (entry, to) in zip(pieces, cuts(list(pieces.values()))):
                    yield conv, piece, entry, to
        yield from batched(rows(), pa.schema([name, ("piece", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32())]))
    line = found.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return line.mapInArrow(chosen, f"conv_id {key}, piece long, entry int, exit int")


def repair(rows: DataFrame) -> DataFrame:
    """Edits of all conversations (conv_id, turn, role, text): one row for each edit, in
    the order of (piece, seq).  role and text are those of the repaired row (of the
    deleted one for D); was is the initial before, null for inserts."""
    ordered = in_pieces(with_faults(rows))
    states = stored(states_at_cuts(ordered), "states").withColumnsRenamed({"conv_id": "c", "piece": "p"})
    key = ordered.schema["conv_id"].dataType.simpleString()
    work = (ordered.join(states, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p")), "left")
            .select("conv_id", "piece", "seq", "turn", "role", "text", "fault", F.coalesce("entry", F.lit(START)).alias("entry"),
                    F.coalesce("exit", F.lit(END)).alias("exit"))
            .repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "seq"))
    out = pa.schema([arrow_schema(work).field("conv_id"), ("piece", pa.int64()), ("turn", pa.int64()), ("was", pa.string()),
                     ("fault", pa.int32()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
                     ("cost", pa.int64()), ("seq", pa.int64())])

    def edits(batches):
        def scripts():
            for (conv, piece, entry, to), group in grouped(batches, ["conv_id", "piece", "entry", "exit"]):
                search = Survivors(entry)
                for r in group:
                    search.step(r[4][:1], r[6] in (BLANK, DUPLICATE), r[6] == CUT_OFF, r[3:7])
                    yield from ((conv, piece, n) for n in search.take())
                search.finish() if to == END else search.settle(to)
                yield from ((conv, piece, n) for n in search.take())

        def rows():
            at, last = 0, None
            for conv, piece, n in scripts():
                at, last = (at + 1, last) if last == (conv, piece) else (0, (conv, piece))
                turn, role, text, fault = n.row or (None, n.role, "", OK)
                yield (conv, piece, turn, None if n.row is None else role[:1], fault, n.edit, n.role or role, text, n.cost, at)
        yield from batched(rows(), out)
    return stored(work.mapInArrow(edits, f"conv_id {key}, piece long, {EDITS}"), "edits")


def repaired(edits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, piece, seq (their order), role, text."""
    return edits.where(F.col("edit") != DELETE).select("conv_id", "piece", "seq", "role", "text")


def report(edits: DataFrame) -> DataFrame:
    """One row for each conversation with edits: faults, cost, audit and the hash of the
    repaired text, streamed in order (the hash has to see one conversation in sequence)."""
    key = edits.schema["conv_id"].dataType.simpleString()
    line = (edits.select("conv_id", "piece", "seq", "turn", "was", "fault", "edit", "role", "text", "cost")
            .repartition("conv_id").sortWithinPartitions("conv_id", "piece", "seq"))
    out = pa.schema([arrow_schema(line).field("conv_id"), *[(n, pa.int64()) for n in COUNTS], ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])

    def fold(batches):
        def rows():
            for (conv,), group in grouped(batches, ["conv_id"]):
                faults, illegal, cost, audit, text = [0] * 4, 0, 0, [], sha256()
                low = high = before = None
                turns = lines = 0
                for _, _, _, turn, was, fault, edit, role, words, own in group:
                    audit.append(edit)
                    cost += own
                    if edit != DELETE:
                        text.update(f"{chr(10) * (lines > 0)}{role}:{words}".encode())
                        lines += 1
                    if edit != INSERT:
                        faults[fault] += 1
                        illegal += before is not None and before + was not in ("su", "ua", "au")
                        before = was
                        if turn is not None and turn != high:
                            low, high, turns = turn if low is None else low, turn, turns + 1
                gaps = 0 if low is None else high - low + 1 - turns
                yield (conv, gaps, faults[BLANK], faults[DUPLICATE], faults[CUT_OFF], illegal, cost, "".join(audit), text.hexdigest())
        yield from batched(rows(), out)
    return line.mapInArrow(fold, f"conv_id {key}, {', '.join(f'{n} long' for n in COUNTS)}, audit string, repaired_sha256 string")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with known faults, by a hash of conv_id and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return (rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
            .where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def damage_report(conversations: DataFrame) -> DataFrame:
    """Every conv_id with what ``repair`` finds and does after ``damaged``."""
    found = report(repair(damaged(conversations))).withColumnRenamed("conv_id", "c")
    ids = conversations.select("conv_id").distinct()
    zero = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in COUNTS]
    return (ids.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256")))


def report_sql() -> str:
    """The search as a recursive query: four (cost, script) pairs, one row at a time."""
    add = lambda s, cost, letter: f"case when {s} is not null then {{'c': {s}.c + {cost}, 'e': {s}.e || '{letter}'}} end"
    ins = lambda s: add(s, 2, "I")
    drop = lambda s: add(s, 3, "D")
    to = lambda s, letter: f"case when not must then case when ini = '{letter}' then {add(s, 'extra', 'K')} else {add(s, '2 + extra', 'R')} end end"
    closed = lambda rows: f"""(select *, list_min([s3, {ins('i2')}]) as i3 from
                  (select *, list_min([s2, {ins('s0')}, {ins('s1')}, {ins('s3')}]) as i2 from {rows}))"""  # noqa: E731
    return f"""
    with recursive src as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations),
    hurt as (
        select conv_id, turn, case kind when 4 then 'user' else role end as role,
               case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
               unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy from src),
    marked as (
        select conv_id, turn, case when role = '' then ' ' else role end as role, text,
               row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as pos,
               case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 1
                    when row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 then 2
                    when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 3 else 0 end as fault from hurt),
    turns as (select *, left(role, 1) as ini, fault in (1, 2) as must, case when fault = 3 then 1 else 0 end as extra from marked),
    walk(conv_id, pos, s0, s1, s2, s3) as (
        select distinct conv_id, 0::bigint, {{'c': 0, 'e': ''}}, null::struct(c integer, e varchar), null::struct(c integer, e varchar),
               null::struct(c integer, e varchar) from turns
        union all
        select conv_id, pos, {drop('s0')}, list_min([{drop('s1')}, case when not must and ini = 's' then {add('s0', 'extra', 'K')} end]),
               list_min([{drop('i2')}, {to('s0', 'u')}, {to('s1', 'u')}, {to('i3', 'u')}]), list_min([{drop('i3')}, {to('i2', 'a')}])
        from {closed("(select w.conv_id, t.pos, s0, s1, s2, s3, ini, must, extra from walk w join turns t on t.conv_id is not distinct from w.conv_id and t.pos = w.pos + 1)")}),
    done as (
        select conv_id, list_min([s0, i3]) as best from
        {closed("(select * from walk w where pos = (select max(pos) from turns t where t.conv_id is not distinct from w.conv_id))")}),
    letters as (
        select conv_id, i, best.e[i] as ch from (select conv_id, best, unnest(range(1, length(best.e) + 1)) as i from done)),
    edits as (
        select l.conv_id, l.i, l.ch, t.role, t.text, t.ini,
               sum((l.ch <> 'D')::int) over (partition by l.conv_id order by l.i) as o
        from (select *, sum((ch <> 'I')::int) over (partition by conv_id order by i) as pos from letters) l
             left join turns t on t.conv_id is not distinct from l.conv_id and t.pos = l.pos and l.ch <> 'I'),
    system as (select conv_id, max((ini = 's')::int) as s from edits where ch = 'K' and o = 1 group by conv_id),
    texts as (
        select e.conv_id, sha256(string_agg(case when ch = 'K' then e.role when (o - coalesce(s, 0)) % 2 = 1 then 'user' else 'assistant' end
                                            || ':' || coalesce(e.text, ''), chr(10) order by i)) as h
        from edits e left join system y on y.conv_id is not distinct from e.conv_id where ch <> 'D' group by e.conv_id),
    facts as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank,
               count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
               count(*) filter (before || ini not in ('su', 'ua', 'au')) as illegal
        from (select *, lag(ini) over (partition by conv_id order by pos) as before from turns) group by conv_id)
    select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.c, 0)::bigint as cost,
           coalesce(best.e, '') as audit, coalesce(h, sha256('')) as repaired_sha256
    from (select distinct conv_id from conversations) i
         left join facts f on f.conv_id is not distinct from i.conv_id
         left join done d on d.conv_id is not distinct from i.conv_id
         left join texts t on t.conv_id is not distinct from i.conv_id
    """

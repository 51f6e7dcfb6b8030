"""Repair of conversations by a generalised LR parser over the roles.

The role grammar gives LR tables. The parser follows every cheap way to read a
conversation at once: its stacks form a graph whose tops, after each row, are the
LR states reached, with links back to the tops before the row. A row is kept,
deleted, or given another role, and empty turns are inserted, each at its cost;
stacks that reach equal tops merge into the one of least (cost, audit).

A conversation may be of any length. Rows are dealt by range, so a long one lies
in several tasks. Those inside one task are parsed there. The others are cut into
blocks; a block is parsed from every top it may be entered with, costs of blocks
are added in order, and the way chosen is read back block by block. A digest of
the repaired text has to read that one text in order, which goes past as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import stored

#: Rows of a block, and of a conversation that is parsed in one go.
BLOCK_ROWS = 4096

# What edits cost, by their initials, and a cut-off row that stays.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
CUT_OFF = 5
#: Roles that edits give, by their initials.
GIVEN = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Neighbours that are in order.
ORDERLY = ("su", "ua", "au")

#: An opening system turn if any, then a question and an answer in turn, or nothing.
GRAMMAR = (
    ("talk", ()),
    ("talk", ("answered",)),
    ("opened", ("s",)),
    ("asked", ("u",)),
    ("asked", ("opened", "u")),
    ("asked", ("answered", "u")),
    ("answered", ("asked", "a")),
)
GOAL = "talk"


class Parser:
    """LR states of a role grammar, and the stack tops that edits lead to.

    A shift is followed by all reductions it allows, so between rows a stack is
    known by what is left on it. ``after[top][role]`` is the top after a row of
    that role, None where the grammar does not allow it.
    """

    def __init__(self, grammar: Sequence[tuple[str, tuple[str, ...]]] = GRAMMAR):
        self.grammar = grammar
        self.names = {left for left, _ in grammar}
        first = self._closed({(i, 0) for i, (left, _) in enumerate(grammar) if left == GOAL})
        stacks, self.after, at = [(first,)], [], 0
        roles = {s for _, right in grammar for s in right if s not in self.names}
        while at < len(stacks):
            moves = {}
            for role in sorted(roles):
                stack = self._shifted(stacks[at], role)
                if stack and stack not in stacks:
                    stacks.append(stack)
                moves[role] = stacks.index(stack) if stack else None
            self.after.append(moves)
            at += 1
        self.accepts = [self._accepts(stack[-1]) for stack in stacks]
        self.tops = range(len(stacks))
        self.steps: dict = {}

    def _closed(self, items: set) -> frozenset:
        """Items with all productions that may begin where they stand."""
        todo, known = list(items), set(items)
        while todo:
            rule, dot = todo.pop()
            right = self.grammar[rule][1]
            if dot < len(right) and right[dot] in self.names:
                new = {(i, 0) for i, (left, _) in enumerate(self.grammar) if left == right[dot]}
                todo += new - known
                known |= new
        return frozenset(known)

    def _goto(self, state: frozenset, symbol: str) -> frozenset:
        moved = {
            (rule, dot + 1)
            for rule, dot in state
            if self.grammar[rule][1][dot : dot + 1] == (symbol,)
        }
        return self._closed(moved)

    def _shifted(self, stack: tuple, role: str) -> tuple | None:
        state = self._goto(stack[-1], role)
        if not state:
            return None
        stack = (*stack, state)
        while True:
            done = [
                self.grammar[rule]
                for rule, dot in stack[-1]
                if dot == len(self.grammar[rule][1]) and self.grammar[rule][0] != GOAL
            ]
            if not done:
                return stack
            left, right = done[0]
            stack = stack[: len(stack) - len(right)]
            stack = (*stack, self._goto(stack[-1], left))

    def _accepts(self, state: frozenset) -> bool:
        return any(
            self.grammar[rule][0] == GOAL and dot == len(self.grammar[rule][1])
            for rule, dot in state
        )

    def inserts(self, top: int) -> tuple[tuple[int, str], ...]:
        """Tops reached from this one by inserted turns alone, with their roles."""
        out, todo = {top: ""}, [top]
        for at in todo:
            for role in GIVEN:
                to = self.after[at][role]
                if to is not None and to not in out:
                    out[to] = out[at] + role
                    todo.append(to)
        return tuple(out.items())

    def edits(self, top: int, kind: tuple[str, str]) -> tuple[tuple[int, int, str], ...]:
        """(top, cost, audit) of every way past one row of this initial and fault."""
        initial, fault = kind
        out = []
        for to, inserted in self.inserts(top):
            cost, audit = COSTS[INSERT] * len(inserted), INSERT * len(inserted)
            out.append((to, cost + COSTS[DELETE], audit + DELETE))
            if fault not in ("blank", "duplicate"):
                stays = cost + (CUT_OFF if fault == "truncated" else 0)
                ways = [(KEEP, initial)] + [(REROLE, role) for role in GIVEN]
                for edit, role in ways:
                    after = self.after[to].get(role)
                    if after is not None:
                        out.append((after, stays + COSTS[edit], audit + edit))
        return tuple(out)

    def step(self, front: tuple, kind: tuple[str, str]) -> tuple[int, tuple, tuple]:
        """The tops after a row: (cost added to all, tops, links back).

        ``front`` has (cost, place) or None for each top, places by ascending audit.
        Audits that end in a row's own edit are never the beginning of each other, so
        the order of two audits settles that of all that begins with them.
        """
        known = self.steps.get((front, kind))
        if known is not None:
            return known
        best: list = [None] * len(self.tops)
        for top, held in enumerate(front):
            if held is None:
                continue
            for to, cost, audit in self.edits(top, kind):
                way = (held[0] + cost, held[1], audit, top)
                if best[to] is None or way < best[to]:
                    best[to] = way
        order = sorted((b[1], b[2], to) for to, b in enumerate(best) if b)
        place = {to: k for k, (_, _, to) in enumerate(order)}
        least = min(b[0] for b in best if b)
        tops = tuple((b[0] - least, place[to]) if b else None for to, b in enumerate(best))
        found = least, tops, tuple((b[3], b[2]) if b else None for b in best)
        self.steps[front, kind] = found
        return found

    def start(self, top: int = 0) -> tuple:
        return tuple((0, 0) if t == top else None for t in self.tops)

    def read(self, kinds, front: tuple) -> tuple[int, tuple, list]:
        """All rows from given tops on: the cost that all ways share, tops, links."""
        total, links = 0, []
        for kind in kinds:
            least, front, back = self.step(front, kind)
            total += least
            links.append(back)
        return total, front, links

    def end(self, front: tuple) -> tuple[int, int, str]:
        """(cost, top, inserted roles) of the cheapest way to a whole conversation."""
        ways = [
            (held[0] + COSTS[INSERT] * len(inserted), held[1], top, inserted)
            for top, held in enumerate(front)
            if held
            for to, inserted in self.inserts(top)
            if self.accepts[to]
        ]
        cost, _, top, inserted = min(ways)
        return cost, top, inserted

    def audits(self, links: list, top: int) -> list[str]:
        """The edits of each row on the way to ``top``."""
        out = []
        for back in reversed(links):
            top, audit = back[top]
            out.append(audit)
        return out[::-1]

    def lines(self, top: int, audit: str, role: str, text: str) -> tuple[int, list[str]]:
        """Repaired lines that the edits around one row give, and the top after it."""
        out = []
        for edit in audit:
            if edit == DELETE:
                continue
            to = role[:1] if edit == KEEP else next(r for r in GIVEN if self.after[top].get(r) is not None)
            if edit == KEEP:
                out.append(f"{role}:{text}")
            else:
                out.append(f"{GIVEN[to]}:{text if edit == REROLE else ''}")
            top = self.after[top][to]
        return top, out


def kind_of(role: str, text: str, seen: bool) -> tuple[str, str]:
    """A row's initial and its first fault."""
    bare = text.rstrip(BLANKS)
    if not bare:
        fault = "blank"
    elif seen:
        fault = "duplicate"
    else:
        fault = "" if bare[-1] in ENDS else "truncated"
    return role[:1], fault


FAULTS = ("blank", "duplicate", "truncated")
RESULT = ["gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256"]


def repair(parser: Parser, rows: list[tuple[int | None, str, str]]) -> tuple:
    """All results for the (turn, role, text) rows of one conversation, in order."""
    seen: set = set()
    kinds = []
    for _, role, text in rows:
        kinds.append(kind_of(role, text, (role, text) in seen))
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    total, front, links = parser.read(kinds, parser.start())
    cost, top, inserted = parser.end(front)
    audits = parser.audits(links, top)
    at, lines = 0, []
    for audit, (_, role, text) in zip(audits, rows):
        at, new = parser.lines(at, audit, role, text)
        lines += new
    lines += [f"{GIVEN[r]}:" for r in inserted]
    digest = hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(sum(k[1] == fault for k in kinds) for fault in FAULTS),
        sum(a[0] + b[0] not in ORDERLY for a, b in zip(kinds, kinds[1:])),
        total + cost,
        "".join(audits) + INSERT * len(inserted),
        digest,
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv, no_conv, turn, no_turn, role, text, copies, tie)`` after damage.

    A dropped row has no copies and stays, to tell of its conversation. Rows of a
    conversation and turn go by their digests.
    """
    blank = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    key = F.concat_ws(
        ":", F.coalesce(conv.cast("string"), blank), F.coalesce(turn.cast("string"), blank)
    )
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    hit = F.crc32(key.cast("binary")) % 20
    none = F.lit("")
    return rows.select(
        F.coalesce(conv, F.lit(0)).alias("conv"),
        conv.isNull().alias("no_conv"),
        F.coalesce(turn, F.lit(0)).alias("turn"),
        turn.isNull().alias("no_turn"),
        F.when(hit == 0, none).when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit <= 1, none).when(hit == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    ).withColumn("tie", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")))


CONV = ["no_conv", "conv"]
OPEN = (
    "no_conv boolean, conv long, part long, seq long, turn long, no_turn boolean, tie string, "
    "role string, text string, here boolean"
)
DONE = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _parse_whole(block: int):
    """Results of conversations that lie in one task, the rows of all others.

    The first and the last conversation of a task may go on in another, and so are
    passed on row by row, as is one that is longer than a block.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        parser, part = Parser(), TaskContext.get().partitionId()
        at, held, through, first = None, [], True, True
        seq = 0
        done: list[tuple] = []
        rows: list[tuple] = []

        def opened(r) -> None:
            nonlocal seq
            for _ in range(max(r.copies, 1)):
                rows.append(
                    (r.no_conv, r.conv, part, seq, r.turn, r.no_turn, r.tie, r.role, r.text, r.copies > 0)
                )
                seq += 1

        def finish() -> None:
            whole = [
                (None if r.no_turn else int(r.turn), r.role, r.text)
                for r in held
                for _ in range(r.copies)
            ]
            done.append((*at, *repair(parser, whole)))

        def out() -> Iterator[pd.DataFrame]:
            names = [c.split()[0] for c in f"{OPEN}, {DONE}, open".split(", ")]
            nothing = (None,) * 8
            found = [(*r, *nothing, True) for r in rows]
            found += [(*r[:2], *nothing, *r[2:], False) for r in done]
            if found:
                yield pd.DataFrame(found, columns=names, dtype=object)
            rows.clear()
            done.clear()

        for batch in batches:
            for r in batch.itertuples(index=False):
                if (r.no_conv, r.conv) != at:
                    if at is not None and not through:
                        finish()
                    first, at, held = at is None, (r.no_conv, r.conv), []
                    through = first
                if not through and len(held) >= block:
                    for x in held:
                        opened(x)
                    held, through = [], True
                if through:
                    opened(r)
                else:
                    held.append(r)
            yield from out()
        for x in held:
            opened(x)
        yield from out()

    return run


def _parse_blocks(block: int):
    """Each block parsed from every top, in one row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser()
        at, kinds = None, []

        def summary() -> pd.DataFrame:
            costs, places = [], []
            for top in parser.tops:
                total, front, _ = parser.read(kinds, parser.start(top))
                costs += [-1 if held is None else total + held[0] for held in front]
                places += [-1 if held is None else held[1] for held in front]
            row = dict(zip([*CONV, "part", "block"], at))
            row |= {f: sum(k[1] == f for k in kinds) for f in FAULTS}
            row["illegal"] = sum(a[0] + b[0] not in ORDERLY for a, b in zip(kinds, kinds[1:]))
            row |= {"head": kinds[0][0], "tail": kinds[-1][0], "costs": costs, "places": places}
            row |= {"initials": [k[0] for k in kinds], "faults": [k[1] for k in kinds]}
            return pd.DataFrame([row])

        for batch in batches:
            for r in batch.itertuples(index=False):
                key = (r.no_conv, r.conv, r.part, r.block)
                if key != at:
                    if at is not None:
                        yield summary()
                    at, kinds = key, []
                kinds.append((r.initial, r.fault))
        if at is not None:
            yield summary()

    return run


BLOCKS = (
    "no_conv boolean, conv long, part long, block long, blank long, duplicate long, "
    "truncated long, illegal long, head string, tail string, costs array<long>, "
    "places array<long>, initials array<string>, faults array<string>"
)


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The way through the blocks of each conversation: tops at both ends of each."""
    parser = Parser()
    n = len(parser.tops)
    at, front, total, links, counts, tail = None, (), 0, [], [0] * 4, ""

    def chosen() -> pd.DataFrame:
        cost, top, inserted = parser.end(front)
        rows = []
        for k, (part, block, back) in enumerate(reversed(links)):
            last = k == 0
            rows.append(
                (*at, part, block, back[top], top, *counts, total + cost, inserted if last else "")
            )
            top = back[top]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in CHOSEN.split(", ")])

    for batch in batches:
        for r in batch.itertuples(index=False):
            if (r.no_conv, r.conv) != at:
                if at is not None:
                    yield chosen()
                at, front, total = (r.no_conv, r.conv), parser.start(), 0
                links, counts, tail = [], [0] * 4, ""
            best: list = [None] * n
            for top, held in enumerate(front):
                for to in range(n) if held else ():
                    cost, place = r.costs[top * n + to], r.places[top * n + to]
                    way = (held[0] + int(cost), held[1], int(place), top)
                    if cost >= 0 and (best[to] is None or way < best[to]):
                        best[to] = way
            order = sorted((b[1], b[2], to) for to, b in enumerate(best) if b)
            rank = {to: k for k, (_, _, to) in enumerate(order)}
            least = min(b[0] for b in best if b)
            total += least
            front = tuple((b[0] - least, rank[to]) if b else None for to, b in enumerate(best))
            links.append((r.part, r.block, tuple(b[3] if b else None for b in best)))
            odd = r.illegal + bool(len(links) > 1 and tail + r.head not in ORDERLY)
            own = (r.blank, r.duplicate, r.truncated, odd)
            counts, tail = [a + int(b) for a, b in zip(counts, own)], r.tail
    if at is not None:
        yield chosen()


CHOSEN = (
    "no_conv boolean, conv long, part long, block long, enter int, leave int, blank long, "
    "duplicate long, truncated long, illegal long, cost long, inserted string"
)


def _write_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit and digest of each conversation: blocks and their rows go past in order."""
    parser = Parser()
    at, digest, empty, pieces, known, top, edits, rest = None, None, True, [], (), 0, [], ""

    def write(lines: list[str]) -> None:
        nonlocal empty
        for line in lines:
            digest.update(("" if empty else "\n").encode() + line.encode("utf-8", "surrogatepass"))
            empty = False

    def finished() -> pd.DataFrame:
        write([f"{GIVEN[r]}:" for r in rest])
        row = (*at, *known, "".join(pieces) + INSERT * len(rest), digest.hexdigest())
        return pd.DataFrame(
            [row], columns=[*CONV, *FAULTS, "illegal", "cost", "audit", "repaired_sha256"]
        )

    for batch in batches:
        for r in batch.itertuples(index=False):
            if (r.no_conv, r.conv) != at:
                if at is not None:
                    yield finished()
                at, digest, empty = (r.no_conv, r.conv), hashlib.sha256(), True
                pieces, top, rest = [], 0, ""
            if r.seq < 0:
                kinds = list(zip(r.initials, r.faults))
                _, _, links = parser.read(kinds, parser.start(r.enter))
                edits = iter(parser.audits(links, r.leave))
                top, rest = r.enter, rest + r.inserted
                known = (r.blank, r.duplicate, r.truncated, r.illegal, r.cost)
                continue
            audit = next(edits)
            pieces.append(audit)
            top, lines = parser.lines(top, audit, r.role, r.text)
            write(lines)
    if at is not None:
        yield finished()


WRITTEN = (
    "no_conv boolean, conv long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def _bare(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def _repair_open(rows: DataFrame, block: int) -> DataFrame:
    """Results of conversations whose rows lie in several tasks or blocks."""
    here = rows.where("here").withColumn("block", F.expr(f"seq div {block}"))
    place = F.struct("part", "seq")
    again = (
        here.groupBy(*CONV, "tie")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select(*CONV, "tie", "first")
    )
    bare = _bare(F.col("text"))
    fault = (
        F.when(bare == "", "blank")
        .when(place > F.col("first"), "duplicate")
        .when(F.substring(bare, -1, 1).isin(*ENDS), "")
        .otherwise("truncated")
    )
    # Texts stay behind: a row is told by its initial, its end and its digest.
    narrow = here.select(
        *CONV, "part", "block", "seq", "tie", F.substring("role", 1, 1).alias("initial"),
        F.substring(bare, -1, 1).alias("text"),
    )
    keys = [*CONV, "part", "block"]
    kinds = narrow.join(again, [*CONV, "tie"], "left").select(
        *keys, "seq", "initial", fault.alias("fault")
    )
    blocks = stored(
        kinds.repartition(*keys)
        .sortWithinPartitions(*keys, "seq")
        .mapInPandas(_parse_blocks(block), BLOCKS),
        "blocks",
    )
    ways = (
        blocks.drop("initials", "faults")
        .repartition(*CONV)
        .sortWithinPartitions(*keys)
        .mapInPandas(_choose, CHOSEN)
    )
    plans = ways.join(blocks.select(*keys, "initials", "faults"), keys).withColumns(
        {"seq": F.lit(-1).cast("long"), "role": F.lit(""), "text": F.lit("")}
    )
    none = F.lit(0).cast("long")
    blanks = {c: none for c in (*FAULTS, "illegal", "cost")}
    texts = here.select(*keys, "seq", "role", "text").withColumns(
        blanks
        | {"enter": F.lit(0), "leave": F.lit(0), "inserted": F.lit("")}
        | {"initials": F.array().cast("array<string>"), "faults": F.array().cast("array<string>")}
    )
    written = (
        plans.unionByName(texts)
        .repartition(*CONV)
        .sortWithinPartitions(*keys, "seq")
        .mapInPandas(_write_out, WRITTEN)
    )
    turns = (
        here.where("NOT no_turn")
        .groupBy(*CONV)
        .agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    )
    nothing = hashlib.sha256(b"").hexdigest()
    found = rows.select(*CONV).distinct().join(written, CONV, "left").join(turns, CONV, "left")
    return found.na.fill(0, ["gaps", *FAULTS, "illegal", "cost"]).na.fill(
        {"audit": "", "repaired_sha256": nothing}
    )


def repair_conversations(rows: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """One row for every ``conv_id``: faults, cheapest edits and the repaired digest.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are left
    aside whatever their names. Rows are damaged first, see :func:`damaged`. Nulls
    count as one space: a null id is a conversation of its own, a null turn comes
    first and leaves no gap, a null role is none and a null text is blank. Rows of
    the same turn go by the digest of role and text; rows alike in all are
    duplicates of the first. Turns repeated by damage leave no gap. Empty tables
    give no rows, conversations that lose all rows zeros. Texts are read whole
    whatever their length. The audit of a conversation is one value, a letter or a
    few for each row.
    """
    keys = [*CONV, F.col("no_turn").desc(), "turn", "tie", "row"]
    held = stored(damaged(rows).withColumn("row", F.monotonically_increasing_id()), "damaged")
    # By row last, so that rows alike in all else part as well.
    parsed = stored(
        held.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(_parse_whole(block), f"{OPEN}, {DONE}, open boolean"),
        "parsed",
    )
    whole = parsed.where("NOT open").select(*CONV, *RESULT)
    opened = parsed.where("open").select(*(c.split()[0] for c in OPEN.split(", ")))
    found = whole.unionByName(_repair_open(opened, block))
    return found.select(F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), *RESULT)


def oracle_sql() -> str:
    """The same rows in DuckDB's SQL: a row at a time, the best way to each state."""
    blanks = "[\\x20\\x09-\\x0D]"
    struct = "{{'c': {c}, 'a': {a}, 's': {s}, 't': {t}}}"

    def way(cost, edit, state, lines):
        return struct.format(c=f"x.c + {cost}", a=f"x.a || '{edit}'", s=state, t=lines)

    insert = "lambda x: " + way(
        5, "I", "CASE x.s WHEN 2 THEN 3 ELSE 2 END",
        "list_append(x.t, CASE x.s WHEN 2 THEN 'assistant:' ELSE 'user:' END)",
    )
    keeps = """(r.i = 's' AND x.s = 0) OR (r.i = 'u' AND x.s IN (0, 1, 3)) OR (r.i = 'a' AND x.s = 2)"""
    deleted = f"list_transform(reach, lambda x: {way(2, 'D', 'x.s', 'x.t')})"
    kept = (
        f"list_transform(list_filter(reach, lambda x: NOT r.gone AND ({keeps})), lambda x: "
        + way(
            "r.extra", "K", "CASE r.i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END",
            "list_append(x.t, r.role || ':' || r.text)",
        )
        + ")"
    )
    changed = (
        "list_transform(list_filter(reach, lambda x: NOT r.gone), lambda x: "
        + way(
            "1 + r.extra", "R", "CASE x.s WHEN 2 THEN 3 ELSE 2 END",
            "list_append(x.t, CASE x.s WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text)",
        )
        + ")"
    )
    best = ", ".join(f"list_sort(list_filter(ways, lambda x: x.s = {s}))[1]" for s in range(4))
    return f"""
    WITH RECURSIVE hit AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
               lambda c: ascii(c)::BIGINT)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                 lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 20 AS d
      FROM conversations),
    damaged AS (
      SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
             CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
               AS text,
             unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM hit),
    told AS (
      SELECT *, md5(length(role) || ':' || role || ':' || text) AS tie FROM damaged),
    numbered AS (
      SELECT *, left(role, 1) AS i,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, copy) AS k,
             row_number() OVER (PARTITION BY conv_id, role, text
               ORDER BY turn NULLS FIRST, tie, copy) > 1 AS seen,
             NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
             NOT regexp_matches(text, '[.!?]{blanks}*\\z') AS cut
      FROM told),
    faults AS (
      SELECT *, seen AND NOT blank AS dup, cut AND NOT blank AND NOT seen AS truncated,
             blank OR seen AS gone, CASE WHEN cut AND NOT blank AND NOT seen THEN 5 ELSE 0 END AS extra,
             lag(i) OVER (PARTITION BY conv_id ORDER BY k) || i AS pair
      FROM numbered),
    paths(conv_id, k, tops) AS (
      SELECT DISTINCT conv_id, 0::BIGINT,
             [{struct.format(c="0", a="''", s="0", t="[]::VARCHAR[]")}]
      FROM conversations
      UNION ALL
      SELECT conv_id, k, list_filter([{best}], lambda x: x IS NOT NULL)
      FROM (SELECT conv_id, r.k AS k, {deleted} || {kept} || {changed} AS ways
            FROM (SELECT p.conv_id, r,
                    p.tops || list_transform(p.tops, {insert})
                      || list_transform(list_transform(p.tops, {insert}), {insert}) AS reach
                  FROM paths p JOIN faults r
                    ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.k = p.k + 1))),
    ended AS (
      SELECT conv_id, list_sort(list_filter(
               tops || list_transform(tops, {insert})
                 || list_transform(list_transform(tops, {insert}), {insert}),
               lambda x: x.s IN (0, 3)))[1] AS won
      FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1),
    counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count_if(blank) AS blank, count_if(dup) AS duplicate,
             count_if(truncated) AS truncated,
             count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM faults GROUP BY conv_id)
    SELECT e.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps,
           CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
           CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate,
           CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
           CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal,
           CAST(won.c AS BIGINT) AS cost, won.a AS audit,
           sha256(array_to_string(won.t, chr(10))) AS repaired_sha256
    FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    """

"""Conversation structure repair: turns aligned to the alternating grammar, with the audit of the cheapest edits."""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a cut-off turn that is not deleted.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
FULL = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Turns aligned at once; longer conversations are aligned piece by piece, from the last one.
PIECE = 512
NEVER = 1 << 29
#: What still has to come: nothing, an even number of turns (user first, at least two) or an odd one.
NONE, EVEN, ODD = 0, 1, 2


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) after the damage that crc32(``conv_id:turn``) % 20 tells.

    0 drops the row (it is returned as dropped), 1 empties the text, 2 takes its ``.!?`` out, 3 repeats
    the row, 4 makes it the user's. Null values count as one blank, but a null turn stays null.
    """
    blank = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(place.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return (
        conversations.select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            (kind == 0).alias("dropped"),
            F.when(kind == 3, 2).otherwise(1).alias("times"),
        )
        .select("*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
        .drop("times", "time")
    )


def _greedy(codes: bytes, odd: bool) -> int:
    """The cost of one repair: where a role does not fit, the missing turn is put in."""
    cost = 0
    for c in codes:
        role, state = c >> 2, c & 3
        if state == 2:
            cost += DELETE
            continue
        cost += CUT_OFF * state
        if role == (ord("a") if odd else ord("u")) - 96:
            odd = not odd
        elif role in (1, 21):
            cost += INSERT
        else:
            cost += REROLE
            odd = not odd
    return cost


class _Table:
    """Costs of aligning the last turns of a piece to the last characters of ...uaua (or ...auau).

    ``cost[i][c]`` belongs to the turns from i and to l = live[i] - below + c characters, for which
    live[i] counts the turns from i that need not be deleted. The alternating targets of all lengths
    end alike, so one table holds the alignments to every length. Only the band is filled in that
    Ukkonen's bound leaves: with a repair of cost ``most`` at hand, none that is as cheap has more than
    so many deletions or insertions beyond those it must have.
    """

    def __init__(self, codes: bytes, last: str):
        n = len(codes)
        c = np.frombuffer(codes, np.uint8)
        self.n, self.role, self.state = n, c >> 2, c & 3
        self.live = np.concatenate([np.cumsum((self.state != 2)[::-1])[::-1], [0]]).astype(np.int64)
        gone, cut = int((self.state == 2).sum()), int((self.state == 1).sum())
        # From any phase to any other: at most three turns put in besides.
        spare = max(_greedy(codes, False), _greedy(codes, True)) + 3 * INSERT - DELETE * gone
        beyond = spare - CUT_OFF * cut
        # A whole turn deleted costs DELETE, a cut-off one as much less CUT_OFF.
        self.below = min(beyond // (DELETE - CUT_OFF), spare // DELETE, n)
        self.width = self.below + beyond // INSERT + 1
        self.ends = [ord(last) - 96, 22 - (ord(last) - 96)]  # the character of an odd l, of an even l
        self.cost = np.full((n + 1, self.width), NEVER, np.int64)
        column = np.arange(self.width)
        at_end = column - self.below
        self.cost[n] = np.where(at_end >= 0, INSERT * at_end, NEVER)
        slope = INSERT * column
        for i in range(n - 1, -1, -1):
            after_i, row = self.cost[i + 1], self.cost[i]
            if self.state[i] == 2:
                row[:] = after_i + DELETE
            else:
                # One turn less is live after i: the same l is one column further there.
                row[:-1] = after_i[1:] + DELETE
                l = self.live[i] - self.below + column
                fits = np.where(l % 2 == 1, self.ends[0], self.ends[1]) == self.role[i]
                np.minimum(row, after_i + np.where(fits, 0, REROLE) + CUT_OFF * int(self.state[i]), out=row, where=l > 0)
            l = self.live[i] - self.below + column
            row[l < 0] = NEVER
            np.minimum(row, np.minimum.accumulate(row - slope) + slope, out=row)
            row[l < 0] = NEVER
            np.minimum(row, NEVER, out=row)

    def lengths(self, i: int) -> np.ndarray:
        return self.live[i] - self.below + np.arange(self.width)

    def at(self, i: int, l: int) -> int:
        c = l - self.live[i] + self.below
        return int(self.cost[i][c]) if l >= 0 and 0 <= c < self.width else NEVER

    def audit(self, i: int, lengths: list[int]) -> str:
        """The ASCII-least audit of the turns from i over targets of these lengths, which cost the same.

        The backtraces are compared letter by letter while they are made: those with the least letter go on.
        """
        letters = []
        while i < self.n or 0 not in lengths:
            now = self.at(i, lengths[0])
            if i < self.n:
                kept = [l for l in lengths if self.at(i + 1, l) + DELETE == now]
                if kept:
                    letters.append("D")
                    lengths, i = kept, i + 1
                    continue
            kept = [l - 1 for l in lengths if l and self.at(i, l - 1) + INSERT == now]
            if kept:
                letters.append("I")
                lengths = kept
                continue
            extra = CUT_OFF * int(self.state[i])
            fits = lambda l: self.ends[0 if l % 2 else 1] == self.role[i]  # noqa: B023, E731
            kept = [l - 1 for l in lengths if l and fits(l) and self.at(i + 1, l - 1) + extra == now]
            letters.append("K" if kept else "R")
            lengths = kept or [l - 1 for l in lengths if l and self.at(i + 1, l - 1) + extra + REROLE == now]
            i += 1
        return "".join(letters)


def _aligned(codes: bytes, piece: int = PIECE) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; of equally cheap ones the ASCII-least audit.

    A turn is a byte: its role's letter (1 for a, 21 for u, 19 for s, 0 for any other) times 4, plus
    0 if it is whole, 1 if it is cut off, 2 if it must be deleted.

    Pieces are aligned from the last to the first. What follows a piece matters only by what still
    has to come there (NONE, EVEN, ODD), so a piece keeps the cheapest cost and its least audit for each.
    Audits of one piece that cost the same never begin one another, for a longer one would hold more
    insertions; so the least audit of a piece is part of the least audit of the whole.
    """
    n = len(codes)
    rest = {NONE: (0, "")}
    opened = (NEVER, "")  # begun with a system turn
    limit = _greedy(codes, False) + INSERT + 1
    for first in range(((n - 1) // piece) * piece if n else 0, -1, -piece):
        part = codes[first : first + piece]
        m = len(part)
        tables = {last: _Table(part, last) for last in ("au" if ODD in rest else "a")}

        def ways(i, phase, tables=tables, rest=rest):
            """(cost, what comes after the piece, lengths) of the cheapest ways on from turn i with ``phase`` to come."""
            found = []
            for o, (after, _) in rest.items():
                table = tables["u" if o == ODD else "a"]
                l = table.lengths(i)
                ok = (l > 0 if o == NONE else l >= 0) & (np.where(l % 2 == (0 if o == ODD else 1), ODD, EVEN) == phase)
                cost = np.where(ok, table.cost[i], NEVER)
                found.append((int(cost.min()) + after, o, l[cost == cost.min()].tolist()))
            least = min(found)[0]
            return [x for x in found if x[0] == least]

        def least(i, phase, tables=tables, rest=rest):
            told = [(cost, tables["u" if o == ODD else "a"].audit(i, lengths) + rest[o][1]) for cost, o, lengths in ways(i, phase) if cost < NEVER]
            return min(told, default=(NEVER, ""))

        # Of system turns that cost the same, the last leaves the most deletions in front and the least audit.
        heads = [(DELETE * (first + i) + CUT_OFF * (part[i] & 3), i) for i in range(m) if part[i] >> 2 == 19 and part[i] & 3 != 2]
        heads = [(before + ways(i + 1, EVEN)[0][0], -i) for before, i in heads if before < min(limit, opened[0])]
        if heads and min(heads)[0] < opened[0]:
            cost, i = min(heads)
            opened = (cost, "D" * (first - i) + "K" + least(1 - i, EVEN)[1])
        rest = {NONE: (DELETE * m + rest[NONE][0], "D" * m + rest[NONE][1]), EVEN: least(0, EVEN), ODD: least(0, ODD)}
    return min(rest[NONE], rest.get(EVEN, rest[NONE]), opened)


@lru_cache(maxsize=50_000)
def _aligned_short(codes: bytes) -> tuple[int, str]:
    return _aligned(codes)


def aligned(codes: bytes) -> tuple[int, str]:
    return _aligned_short(codes) if len(codes) <= 64 else _aligned(codes)


def edits(audit: str) -> Iterator[tuple[str, str | None]]:
    """(letter, role it gives) of each edit; a kept turn has its own role, a deleted one none."""
    length = sum(x != "D" for x in audit)
    at = length % 2  # with a system turn first, the alternation begins one later
    place = 0
    for x in audit:
        if x == "D":
            yield x, None
            continue
        yield x, None if x == "K" else FULL["ua"[(place - at) % 2]]
        place += 1


class _Conversation:
    """What is told of one conversation: its rows come in order, first as codes, then with their texts."""

    def __init__(self, name):
        self.name = name
        self.codes = bytearray()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.turn = None
        self.turns = 0
        self.initial = None
        self.audit = None

    def add(self, turn, initial, fault):
        if turn is not None:
            if self.turns == 0 or turn != self.turn:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.initial = initial
        if fault:
            self.counts[fault] += 1
        role = ord(initial) - 96 if initial in ("u", "a", "s") else 0
        self.codes.append(4 * role + {None: 0, "truncated": 1}.get(fault, 2))

    def align(self):
        self.cost, self.audit = aligned(bytes(self.codes))
        self.codes = None
        self.open = edits(self.audit)
        self.hash = hashlib.sha256()
        self.written = 0

    def turn_rows(self, role, text):
        """The repaired turns up to and with this one of the damaged rows; at the end without a row."""
        for letter, given in self.open:
            if letter == "I":
                yield letter, given, ""
                continue
            if letter != "D":
                yield letter, given or role, text
            return

    def hashed(self, rows):
        for _, role, text in rows:
            self.hash.update(b"\n" * (self.written > 0) + f"{role}:{text}".encode())
            self.written += 1


def _streamed(emit_turns: bool):
    """Rows sorted by conversation, then codes before texts; nothing of a conversation is held but its codes and audit."""

    def finish(c, out):
        if c.audit is None:
            c.align()
        rest = c.turn_rows(None, None)
        if emit_turns:
            push(c, rest, out)
        else:
            c.hashed(rest)
            gaps = c.high - c.low + 1 - c.turns if c.turns else 0
            out.append((c.name, gaps, c.counts["blank"], c.counts["duplicate"], c.counts["truncated"], c.counts["illegal"], c.cost, c.audit, c.hash.hexdigest()))

    def push(c, rows, out):
        for letter, role, text in rows:
            out.append((c.name, c.written, role, text, letter))
            c.written += 1

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, schema = None, None
        for batch in batches:
            schema = _schema(batch.schema.field("conv_id").type, emit_turns)
            out = []
            for name, kind, turn, initial, fault, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "kind", "turn", "initial", "fault", "role", "text")), strict=True):
                if now is None or name != now.name:
                    if now is not None:
                        finish(now, out)
                    now = _Conversation(name)
                if kind == 1:
                    now.add(turn, initial, fault)
                elif kind == 2:
                    if now.audit is None:
                        now.align()
                    (push(now, now.turn_rows(role, text), out) if emit_turns else now.hashed(now.turn_rows(role, text)))
            if out:
                yield _batch(out, schema)
        if now is not None:
            out = []
            finish(now, out)
            if out:
                yield _batch(out, schema)

    return stream


def _schema(conv_type, emit_turns):
    if emit_turns:
        names = [("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
    else:
        names = [(x, pa.int64()) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    return pa.schema([("conv_id", conv_type), *names])


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _repair(turns: DataFrame, emit_turns: bool) -> DataFrame:
    conv = turns.schema["conv_id"].dataType.simpleString()
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    ends = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    rows = turns.select("conv_id", "turn", "role", "text", "dropped", sha.alias("sha"), ends.alias("end"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "sha").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(F.col("end") == "", "blank").when(seen, "duplicate").when(~F.col("end").isin(".", "!", "?"), "truncated")
    none = F.lit(None).cast("string")
    codes = rows.select("conv_id", "turn", "role", "sha", "end", "dropped").select(
        "conv_id", F.when(F.col("dropped"), 0).otherwise(1).alias("kind"), "turn", "role", "sha", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), none.alias("text")
    )
    texts = rows.where(~F.col("dropped")).select("conv_id", F.lit(2).alias("kind"), "turn", "role", "sha", none.alias("initial"), none.alias("fault"), "text")
    place = ["conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "sha"]
    sent = codes.unionByName(texts).repartition("conv_id").sortWithinPartitions(*place)
    result = "position long, role string, text string, edit string" if emit_turns else (
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    return stored(sent.mapInArrow(_streamed(emit_turns), f"conv_id {conv}, {result}"), "repairs")


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text, dropped): faults, cost, audit and digest.

    A conversation's rows are taken by turn (nulls first); rows of one turn by role, then by the text's
    SHA-256, equal ones next to each other. Each row's first fault counts: blank, duplicate (role and text
    seen earlier), truncated (its last character is none of ``.!?``). Edits keep a turn, give it the role
    user or assistant, delete it (blank and duplicate ones must go) or put an empty one in; the cheapest
    ones that leave an optional system turn and then user and assistant in turn, or nothing, are told
    by their letters K, R, D and I, of equally cheap ones the ASCII-least.

    Rows of a conversation are sorted by Spark and pass one task in order, first as roles and faults, then
    with their texts, which a running hash takes in. Held at once are one byte per turn, the audit (which
    the result holds anyway) and the table of a piece of PIECE turns. Duplicates are found before, by a
    window over (conversation, role, digest) without texts.

    ``dropped`` rows only tell that there is such a conversation. Without other rows all counts and the
    cost are 0, the audit is empty and the digest that of no text. Null conversation ids are one
    conversation. A role that is empty or begins with another letter fits nowhere. Other columns are not
    looked at. Texts and roles must not be null (``damaged`` makes them blanks).
    """
    return _repair(turns, False)


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit) of the turns after the cheapest edits; see ``audits``."""
    return _repair(turns, True)

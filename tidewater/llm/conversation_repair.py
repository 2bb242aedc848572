"""Repair of conversation structure by a grammar-compressed dynamic program.

A conversation should be ``(system? (user assistant)+)?``. Its rows are turned into symbols
of role initial and fault, and the cheapest edits that give such a structure are found: keep a
row (0), give it the other role (2), delete it (3; blank rows and duplicates must go) or
insert an empty turn (2); a truncated row that stays costs 1 more. Of equally cheap repairs the one with the
least audit (the edits' initials in order, ASCII) is taken.

The method: the symbol strings of many conversations are compressed together by Re-Pair (the most frequent
pair of neighbours becomes a rule, until none comes twice). Every symbol and every rule gets one
min-plus transfer matrix over the four states of the structure: the cost of getting from state to state
across its rows, with the audit as a rope of the two parts' audits. Matrices are worked out bottom-up, a rule's once for all
conversations it occurs in, and a conversation is a short product of them. Inserts go before a row's own edit, so audits of
the same rows are never prefixes of each other and the least audit of a product comes from the least audits of its parts;
ropes are compared by length and hash, descending only into the part that differs.

Plan: the symbols (no texts) are shuffled to their conversation in order and give the audits; then audits and
texts meet in one more shuffle, in order, and the repaired text is hashed row by row. A conversation is one
task there (its digest runs over all of it, in order), but never held whole: what is kept are its audit and one
batch of rows. Long symbol strings are cut into segments that carry the state costs over.

Defined results: rows go by turn (nulls first), then role, then the SHA-256 of role and text; a null role or text
is one space; a null conv_id is a conversation of its own. Repeated rows are duplicates. A role that starts with neither s, u nor a
can only be re-roled or deleted. A conversation without rows has zeros, an empty audit and the digest of the empty
string; an empty table gives an empty one. Only the four named columns are read. No limit on texts or turns.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Edit costs, and what ends a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ENDS = ".!?"
BLANKS = " \t\n\x0b\x0c\r"
# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# Inserted turns that end the structure from each state.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
# Fault codes of a row; a row's symbol is 4 * role + fault with role 0 s, 1 u, 2 a, 3 other.
FINE, CUT_OFF, BLANK, DUPLICATE = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}
GONE = 8  # the symbol of a row that must be deleted; others are 2 * role + truncated
# Symbols that one grammar is built over; bounds memory only, longer strings go on in the next one.
GRAMMAR_SYMBOLS = 400_000


# ---------------------------------------------------------------- audit ropes

_MOD, _BASE = (1 << 61) - 1, 911_382_323


class Rope:
    """A string as a tree of parts, with length and hash."""

    __slots__ = ("hash", "left", "right", "size", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            h = 0
            for c in text.encode():
                h = (h * _BASE + c) % _MOD
            self.size, self.hash = len(text), h
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * pow(_BASE, right.size, _MOD) + right.hash) % _MOD

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.text is not None:
                out.append(r.text)
            else:
                todo += (r.right, r.left)
        return "".join(out)


def joined(a: Rope, b: Rope) -> Rope:
    if not a.size or not b.size:
        return a if a.size else b
    if a.size + b.size <= 48 and a.text is not None and b.text is not None:
        return Rope(a.text + b.text)
    return Rope(None, a, b)


def less(a: Rope, b: Rope) -> bool:
    x, y = [a], [b]
    while x and y:
        u, v = x.pop(), y.pop()
        if u.size == v.size and u.hash == v.hash:
            continue
        if u.text is not None and v.text is not None:
            n = min(u.size, v.size)
            if u.text[:n] != v.text[:n]:
                return u.text[:n] < v.text[:n]
            if u.size > n:
                x.append(Rope(u.text[n:]))
            elif v.size > n:
                y.append(Rope(v.text[n:]))
        elif v.text is not None or (u.text is None and u.size >= v.size):
            x += (u.right, u.left)
            y.append(v)
        else:
            y += (v.right, v.left)
            x.append(u)
    return bool(y)


# ---------------------------------------------------------------- transfer matrices

def _better(cost: int, rope: Rope, best: tuple[int, Rope] | None) -> bool:
    return best is None or cost < best[0] or (cost == best[0] and less(rope, best[1]))


def product(x: list, y: list) -> list:
    """Rows of ``x`` (one per starting state) carried on through ``y``."""
    out = []
    for row in x:
        done = [None] * 4
        for j in range(4):
            best = via = None
            for k in range(4):
                if row[k] is not None and y[k][j] is not None:
                    cost = row[k][0] + y[k][j][0]
                    # equally cheap ways differ in their left parts, and those decide
                    if _better(cost, row[k][1], None if best is None else (best, row[via][1])):
                        best, via = cost, k
            if best is not None:
                done[j] = (best, joined(row[via][1], y[via][j][1]))
        out.append(done)
    return out


def symbol_matrix(symbol: int) -> list:
    """Any inserts, then the row's own edit."""
    edits = [[None] * 4 for _ in range(4)]
    for i in range(4):
        if symbol == GONE:
            edits[i][i] = (DELETE, Rope("D"))
            continue
        role, more = divmod(symbol, 2)
        ways = [(DELETE, "D", i), (REROLE + more * TRUNCATED, "R", NEXT[i])]
        if role == 0 and i == START:
            ways.append((more * TRUNCATED, "K", SYSTEM))
        elif role in (1, 2) and NEXT[i] == (USER if role == 1 else ASSISTANT):
            ways.append((more * TRUNCATED, "K", NEXT[i]))
        for cost, letter, j in ways:
            if _better(cost, Rope(letter), edits[i][j]):
                edits[i][j] = (cost, Rope(letter))
    inserts = [[None] * 4 for _ in range(4)]
    for i in range(4):
        j, n = i, 0
        while inserts[i][j] is None:
            inserts[i][j] = (n * INSERT, Rope("I" * n))
            j, n = NEXT[j], n + 1
    return product(inserts, edits)


# ---------------------------------------------------------------- Re-Pair

def re_pair(strings: list[bytes], first: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules (pairs of symbols, numbered from ``first``) and the compressed strings."""
    seq: list[int] = []
    for s in strings:
        seq.extend(s)
        seq.append(-1)
    n = len(seq)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[tuple[int, int], list[int]] = {}
    for i in range(n - 1):
        if seq[i] >= 0 and seq[i + 1] >= 0:
            where.setdefault((seq[i], seq[i + 1]), []).append(i)
    count = {pair: len(at) for pair, at in where.items()}
    heap = [(-c, pair) for pair, c in count.items() if c > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        c, pair = heapq.heappop(heap)
        if count.get(pair, 0) < 2:
            continue
        if -c != count[pair]:
            heapq.heappush(heap, (-count[pair], pair))
            continue
        a, b = pair
        at = [i for i in where.pop(pair) if seq[i] == a and after[i] < n and seq[after[i]] == b]
        del count[pair]
        if len(at) < 2:
            continue
        new = first + len(rules)
        rules.append(pair)
        touched = set()
        for i in at:
            j = after[i]
            if seq[i] != a or j >= n or seq[j] != b:  # taken by the one before (a run of equal symbols)
                continue
            left, right = before[i], after[j]
            seq[i], seq[j] = new, -2
            after[i] = right
            if right < n:
                before[right] = i
            for x, gone, made in ((left, (seq[left], a) if left >= 0 else None, (seq[left], new) if left >= 0 else None),
                                  (i, (b, seq[right]) if right < n else None, (new, seq[right]) if right < n else None)):
                if made is None or min(made) < 0:
                    continue
                if gone in count:
                    count[gone] -= 1
                where.setdefault(made, []).append(x)
                count[made] = count.get(made, 0) + 1
                touched.add(made)
        for made in touched:
            if count[made] > 1:
                heapq.heappush(heap, (-count[made], made))
    out: list[list[int]] = [[]]
    i = 0
    while i < n:
        if seq[i] == -1:
            out.append([])
        else:
            out[-1].append(seq[i])
        i = after[i]
    return rules, out[:-1]


# A conversation's costs before its first row.
def opening() -> list:
    return [(0, Rope("")), None, None, None]


class Grammar:
    """The rules over a set of symbol strings, with a matrix each."""

    def __init__(self, strings: list[bytes]):
        self.matrices = [symbol_matrix(s) for s in range(GONE + 1)]
        rules, compressed = re_pair(strings, len(self.matrices))
        for a, b in rules:
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        self.compressed = dict(zip(strings, compressed, strict=True))

    def carry(self, costs: list, string: bytes) -> list:
        rows = [costs]
        for symbol in self.compressed[string]:
            rows = product(rows, self.matrices[symbol])
        return rows[0]


def cheapest(costs: list) -> tuple[int, str]:
    best = None
    for state, found in enumerate(costs):
        if found is not None:
            n = CLOSING[state]
            end = (found[0] + n * INSERT, joined(found[1], Rope("I" * n)))
            if _better(*end, best):
                best = end
    return best[0], str(best[1])


# ---------------------------------------------------------------- rows

def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the trial damage by crc32(conv_id:turn) % 20; ``copies`` 0 marks a dropped one."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                       F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _with_mark(rows: DataFrame) -> DataFrame:
    return rows.withColumn("mark", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, copies, code, copy_code): what each row's first and further copies are."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = _with_mark(rows).select("conv_id", "turn", "role", "mark", "copies", role.alias("r"), (trimmed == "").alias("blank"),
                                     (~F.right(trimmed, F.lit(1)).isin(*ENDS)).alias("cut"))
    place = F.row_number().over(Window.partitionBy("conv_id", "mark", F.col("copies") > 0).orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("blank"), BLANK).when(F.col("place") > 1, DUPLICATE).when(F.col("cut"), CUT_OFF).otherwise(FINE)
    return marked.withColumn("place", place).select(
        "conv_id", "turn", "role", "mark", "copies", (4 * F.col("r") + fault).alias("code"),
        (4 * F.col("r") + F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)).alias("copy_code"))


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Conversation:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, conv):
        self.conv, self.costs, self.last, self.faults, self.illegal = conv, opening(), None, [0, 0, 0, 0], 0
        self.low = self.high = None
        self.turns, self.waiting, self.closed = 0, bytearray(), False

    def add(self, turn, codes: tuple[int, ...]) -> None:
        for code in codes:
            role, fault = divmod(code, 4)
            self.faults[fault] += 1
            if self.last is not None and (self.last, role) not in LEGAL:
                self.illegal += 1
            self.last = role
            self.waiting.append(GONE if fault >= BLANK else 2 * role + fault)
        if codes and turn is not None and turn != self.high:  # rows come by turn
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self) -> tuple:
        cost, audit = cheapest(self.costs)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT_OFF], self.illegal, cost, audit)


def audits(marked: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost and audit."""
    schema = f"conv_id {marked.schema['conv_id'].dataType.simpleString()}, {AUDIT}"
    ordered = (marked.repartition("conv_id").sortWithinPartitions("conv_id", *_order())
               .select("conv_id", F.col("turn").cast("long").alias("turn"), "copies", "code", "copy_code"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ones: list[Conversation] = []
        held, id_type = 0, pa.int64()

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            """Carry all waiting symbols through one grammar; the conversation still being read stays."""
            nonlocal held
            grammar = Grammar(sorted({bytes(c.waiting) for c in open_ones}))
            ends: dict[bytes, list] = {}
            for c in open_ones:
                string = bytes(c.waiting)
                if c.costs[0] is not None and c.costs[0][0] == 0 and not any(c.costs[1:]):  # nothing before: shared
                    if string not in ends:
                        ends[string] = grammar.carry(c.costs, string)
                    c.costs = ends[string]
                else:
                    c.costs = grammar.carry(c.costs, string)
                c.waiting.clear()
            done = open_ones if last else open_ones[:-1]
            if done:
                columns = list(zip(*(c.row() for c in done), strict=True))
                kinds = [id_type, *[pa.int64()] * 6, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)],
                                                 ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])
            del open_ones[:len(done)]
            for c in open_ones:  # let the grammar go
                c.costs = [None if f is None else (f[0], Rope(str(f[1]))) for f in c.costs]
            held = 0

        for batch in batches:
            id_type = batch.column(0).type
            for conv, turn, copies, code, copy in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if not open_ones or open_ones[-1].conv != conv:
                    open_ones.append(Conversation(conv))
                    held += 1
                open_ones[-1].add(turn, (code, *[copy] * (copies - 1)) if copies else ())
                held += copies
                if held >= GRAMMAR_SYMBOLS:
                    yield from settle(False)
        if open_ones:
            yield from settle(True)

    return ordered.mapInArrow(run, schema)


class Repair:
    """Applies an audit to the rows of a conversation as they pass by."""

    def __init__(self, head: tuple, audit: str):
        self.head, self.audit, self.at, self.state, self.first = head, audit, 0, START, True
        self.digest = hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        if not self.first:
            self.digest.update(b"\n")
        self.first = False
        self.digest.update(role.encode() + b":" + text.encode())

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = NEXT[self.state]
            self._line(ROLE_OF[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        self.state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[self.state]
        self._line(ROLE_OF[self.state] if edit == "R" else role, text)

    def row(self) -> tuple:
        self._inserts()
        return (*self.head, self.digest.hexdigest())


def repair_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", damage: bool = False) -> DataFrame:
    """conv_id, the counts and cost, ``audit`` and ``repaired_sha256`` of every conversation.

    ``damage`` puts the rows through the trial damage first.
    """
    named = rows.select(F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                        F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if damage:
        ready = damaged(named)
    else:
        ready = named.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                             F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))
    id_type = ready.schema["conv_id"].dataType.simpleString()
    turn_type = ready.schema["turn"].dataType.simpleString()
    counts = [c.split(" ")[0] for c in AUDIT.split(", ")]
    heads = audits(symbols(ready)).select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(turn_type).alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("mark"),
        F.col("audit").alias("text"), F.lit(1).alias("copies"), *counts[:-1])
    texts = _with_mark(ready).filter("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "mark", "text", "copies", *(F.lit(None).cast("long").alias(c) for c in counts[:-1]))
    ordered = (heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_order())
               .select("conv_id", "kind", "role", "text", "copies", *counts[:-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, kind_of_id = None, pa.int64()
        for batch in batches:
            kind_of_id, done = batch.column(0).type, []
            for conv, kind, role, text, copies, *numbers in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if kind == 0:
                    if current:
                        done.append(current.row())
                    current = Repair((conv, *numbers, text), text)
                else:
                    for _ in range(copies):
                        current.add(role, text)
            if done:
                yield _batch(done, kind_of_id)
        if current:
            yield _batch([current.row()], kind_of_id)

    def _batch(done: list[tuple], kind_of_id: pa.DataType) -> pa.RecordBatch:
        kinds = [kind_of_id, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = ["conv_id", *counts, "repaired_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    return ordered.mapInArrow(run, f"conv_id {id_type}, {AUDIT}, repaired_sha256 string")

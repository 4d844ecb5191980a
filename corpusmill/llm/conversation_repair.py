"""Repair of conversation structure by an audited edit search.

A conversation's roles should read ``(s?(ua)+)?`` (an optional system turn, then
user and assistant in turn, or nothing). Rows may be blank, repeat an earlier one or
break off; the cheapest edits that give the form are searched by dynamic programming
over the four states of that form, and of equally cheap edits the ASCII-least
sequence is taken:

- ``K`` keep a row (0), ``R`` make it user or assistant (3), ``D`` delete it (4, the
  only choice for a blank or repeated row), ``I`` insert an empty user or assistant
  turn (3); a truncated row that is not deleted adds 3.

The best edits to each state share their beginnings: a sequence is a node of a
trie (``Edits``) with its last letter, its ancestors at distances of powers of two
and a rolling hash of all its letters. Two sequences of equal cost are compared
where they first differ, found by lifting both to the longest prefix whose hashes
agree; nodes are interned, so that an agreement by chance is seen and the search is
done again on the nodes themselves.

At scale: rows are reduced to what the search looks at (role, faults, the SHA-256 of
the text; equal rows to one with a count) and range-partitioned by conversation and
turn, so that a conversation of any length is spread over tasks. Each stretch of
at most ``BLOCK`` rows gives its best edits from every state to every other; the
stretches of a conversation are then put together in order, keeping only what the
states' edits do not share. What stays whole is the answer itself: one string of a
letter for each row. Texts are shuffled once, to be replayed against the edits as a
stream. A conversation's digest is one hash over its repaired rows in order, so that
stream is one task's; nothing of it is held but the row at hand.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 4096  # rows searched as one stretch
SLACK = 10  # a state this much dearer than the best one cannot win: all others are reached with 7
REMEMBERED = 50_000
SPACE = " \t\n\x0b\f\r"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant (0 and 3 may end).
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FINAL = (0, 3)
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
MOD = (1 << 61) - 1
RADIX = 0x1E3779B97F4A7C15 % MOD


class Edits:
    """Edit sequences as nodes of a trie; node 0 is the empty one."""

    def __init__(self, modulus: int = MOD):
        self.modulus = modulus
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]
        self.child: dict[tuple[int, str], int] = {}

    def add(self, node: int, letter: str) -> int:
        key = (node, letter)
        new = self.child.get(key)
        if new is None:
            new = self.child[key] = len(self.letter)
            up = [node]
            while len(self.up[up[-1]]) >= len(up):
                up.append(self.up[up[-1]][len(up) - 1])
            self.letter.append(letter)
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * RADIX + ord(letter)) % self.modulus)
            self.up.append(up)
        return new

    def ancestor(self, node: int, depth: int) -> int:
        while (far := self.depth[node] - depth) > 0:
            node = self.up[node][far.bit_length() - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the sequence of ``a`` comes before that of ``b``."""
        if a == b:
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        p, q = self._part(x, y, self.hash)
        if p == q or self.up[p][0] != self.up[q][0]:  # hashes agreed where the letters do not
            p, q = self._part(x, y, range(len(self.letter)))
        return self.letter[p] < self.letter[q]

    def _part(self, x: int, y: int, name) -> tuple[int, int]:
        """The first nodes on the ways to ``x`` and ``y`` whose names differ."""
        if name[x] == name[y]:
            return x, x
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and name[self.up[x][k]] != name[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        return x, y

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def search(codes: str, start: int, modulus: int = MOD) -> dict[int, tuple[int, str]]:
    """For each state that rows can lead to from ``start``: the least cost and, of
    its edits, the ASCII-least. A row's code is ``d`` (must go), or the initial
    ``s``, ``u``, ``a`` (else ``x``), in upper case where the row is truncated.

    Of two sequences with equal cost to the same state neither begins the other:
    both take in the same rows, and more insertions cost more. So the least
    sequence to a state begins with the least one to a state before."""
    edits = Edits(modulus)

    def offer(best: dict, state: int, cost: int, node: int) -> bool:
        had = best.get(state)
        if had is None or cost < had[0] or (cost == had[0] and edits.less(node, had[1])):
            best[state] = (cost, node)
            return True
        return False

    def inserted(best: dict) -> dict:
        changed = True
        while changed:
            changed = False
            for role in "ua":
                for state, to in NEXT[role].items():
                    if state in best:
                        cost, node = best[state]
                        had = best.get(to)
                        if had is None or cost + INSERT <= had[0]:
                            changed |= offer(best, to, cost + INSERT, edits.add(node, "I"))
        least = min(c for c, _ in best.values())
        return {s: b for s, b in best.items() if b[0] <= least + SLACK}

    best = inserted({start: (0, 0)})
    for code in codes:
        now: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in best.items():
            offer(now, state, cost + DELETE, edits.add(node, "D"))
            if code == "d":
                continue
            role = code.lower()
            kept = cost + (TRUNCATED if code != role else 0)
            to = NEXT.get(role, {}).get(state)
            if to is not None:
                offer(now, to, kept + KEEP, edits.add(node, "K"))
            for other in "ua":
                to = NEXT[other].get(state)
                if to is not None:
                    offer(now, to, kept + REROLE, edits.add(node, "R"))
        best = inserted(now)
    return {state: (cost, edits.text(node)) for state, (cost, node) in best.items()}


class Chain:
    """The best edits of a conversation's stretches so far."""

    def __init__(self):
        self.shared: list[str] = []
        self.best = {0: (0, "")}

    def add(self, ways: list[tuple[int, int, int, str]]) -> None:
        now: dict[int, tuple[int, str]] = {}
        for start, end, cost, edits in ways:
            if start in self.best:
                before, tail = self.best[start]
                got = (before + cost, tail + edits)
                if end not in now or got < now[end]:
                    now[end] = got
        least = min(c for c, _ in now.values())
        now = {s: b for s, b in now.items() if b[0] <= least + SLACK}
        common = os.path.commonprefix([t for _, t in now.values()])
        self.shared.append(common)
        self.best = {s: (c, t[len(common) :]) for s, (c, t) in now.items()}

    def delete(self, n: int) -> None:
        """``n`` rows that must go."""
        self.add([(p, q, cost + n * DELETE, "D" * n + edits) for p in range(4) for q, (cost, edits) in search("", p).items()])

    def result(self) -> tuple[int, str]:
        cost, tail = min(self.best[s] for s in FINAL if s in self.best)
        return cost, "".join(self.shared) + tail


def replay(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) pairs of a conversation's rows."""
    at, state = 0, 0

    def put(role: str) -> int:
        return NEXT[role].get(state, -1)

    def inserts() -> Iterator[tuple[str, str]]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            role = "a" if state == 2 else "u"
            state, at = put(role), at + 1
            yield ROLES[role], ""

    for role, text in rows:
        yield from inserts()
        edit, at = audit[at], at + 1
        if edit == "K":
            state = put(role[:1])
            yield role, text
        elif edit == "R":
            to = "a" if state == 2 else "u"
            state = put(to)
            yield ROLES[to], text
    yield from inserts()


def damage(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``turns`` with faults, chosen by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a
    user's. Nulls count as one space (ids and turns in that key only). Gives the four
    columns alone; repeated rows are damaged alike."""
    said = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    spoken = F.coalesce(F.col(text), F.lit(" "))
    rows = turns.select(F.col(conv_id), F.col(turn), F.col(role), spoken.alias("_spoken"), (F.crc32(said.cast("binary")) % 20).alias("_fault")).filter("_fault <> 0")
    new_text = F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.translate("_spoken", ".!?", "")).otherwise(F.col("_spoken"))
    new_role = F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.coalesce(F.col(role), F.lit(" ")))
    twice = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1)))
    return rows.select(F.col(conv_id), F.col(turn), new_role.alias(role), new_text.alias(text), twice.alias("_")).drop("_")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
ORDER = ("_id", "_turn", "_role", "_sha")


def _rows(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    out = turns.select(
        F.col(conv_id).alias("_id"), F.col(turn).cast("long").alias("_turn"), F.coalesce(F.col(role), F.lit(" ")).alias("_role"), F.coalesce(F.col(text), F.lit(" ")).alias("_text")
    )
    return out.withColumn("_sha", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _stretches(id_type: T.DataType) -> tuple[T.StructType, Callable]:
    """Schema and mapper: sorted rows in, a stretch of a conversation out."""
    way = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("edits", T.StringType())])
    longs = ("blank", "duplicate", "truncated", "illegal", "tail", "turns", "low", "high", "first_turn", "last_turn")
    schema = T.StructType([
        T.StructField("_id", id_type), T.StructField("_turn", T.LongType()), T.StructField("_role", T.StringType()), T.StructField("_sha", T.BinaryType()), T.StructField("real", T.BooleanType()),
        *[T.StructField(n, T.LongType()) for n in longs], T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("ways", T.ArrayType(way)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, tuple], list] = {}

        def ways(codes: str, starts: tuple) -> list:
            got = known.get((codes, starts))
            if got is None:
                got = [dict(start=p, end=q, cost=c, edits=e) for p in starts for q, (c, e) in search(codes, p).items()]
                if len(codes) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[codes, starts] = got
            return got

        def closed(s: dict) -> dict:
            s["ways"] = ways("".join(s.pop("codes")), s.pop("starts"))
            return s

        held, now, begun = [], None, False
        for batch in batches:
            for r in batch.to_pylist():
                fresh = now is None or now["_id"] != r["_id"]
                if fresh or len(now["codes"]) >= BLOCK or now["tail"]:
                    if now is not None:
                        held.append(closed(now))
                    # only the first conversation of a partition can have begun before it
                    starts = (0,) if fresh and begun else (0, 1, 2, 3)
                    now = {n: r[n] for n in ORDER} | dict.fromkeys(longs, 0) | dict(real=True, low=None, high=None, first_turn=r["_turn"], last_turn=None, first=r["_role"][:1], last=None, codes=[], starts=starts)
                    begun = True
                n, initial = r["n"], r["_role"][:1]
                if r["blank"]:
                    now["blank"] += n
                elif not r["earliest"]:
                    now["duplicate"] += n
                else:
                    now["duplicate"] += n - 1
                    now["truncated"] += r["truncated"]
                code = "d" if r["blank"] or not r["earliest"] else (initial if initial in ("s", "u", "a") else "x")
                now["codes"].append(code.upper() if r["truncated"] and code != "d" else code)
                now["tail"] = n - 1
                now["illegal"] += n - 1 + (now["last"] is not None and now["last"] + initial not in LEGAL)
                if r["_turn"] is not None:
                    now["turns"] += r["_turn"] != now["last_turn"]
                    now["low"] = r["_turn"] if now["low"] is None else now["low"]
                    now["high"] = r["_turn"]
                now["last_turn"], now["last"] = r["_turn"], initial
            if len(held) >= 1024:
                yield pa.RecordBatch.from_pylist(held, schema=out_schema)
                held = []
        if now is not None:
            held.append(closed(now))
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=out_schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(schema)
    return schema, run


def audits(turns: DataFrame, all_ids: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each conversation of ``turns`` (and each id of ``all_ids``): its id,
    ``gaps``, the faults ``blank``, ``duplicate``, ``truncated`` (each row's first one
    counts), ``illegal`` pairs of neighbouring roles, ``cost`` and ``audit``, the edits.

    Rows go by turn, nulls first; rows of one turn by role and then by the SHA-256 of
    the text. A null role or text counts as one space, rows with a null id are one
    conversation, and equal rows are rows of their own (all but the first are
    duplicates). Other columns are not looked at. Gaps are the numbers missing between
    the least and the greatest turn. A conversation without rows has zeros and an empty
    audit; an empty table gives an empty result."""
    rows = _rows(turns, conv_id, turn, role, text)
    bare = F.btrim("_text", F.lit(SPACE))
    light = rows.select(*ORDER, (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    light = light.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    # the earliest row of each (role, text): nulls sort first in a struct's order
    first = light.groupBy(F.col("_id").alias("i"), F.col("_role").alias("r"), F.col("_sha").alias("s")).agg(F.min(F.struct("_turn")).alias("t"))
    first = first.select("i", F.col("t._turn").alias("t"), "r", "s", F.lit(True).alias("earliest"))
    light = light.join(first, _same("_id", "i") & _same("_turn", "t") & (F.col("_role") == F.col("r")) & (F.col("_sha") == F.col("s")), "left")
    light = light.select(*ORDER, "n", "blank", "truncated", F.coalesce("earliest", F.lit(False)).alias("earliest"))
    id_type = rows.schema["_id"].dataType
    schema, stretches = _stretches(id_type)
    parts = light.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(stretches, schema)
    if all_ids is not None:
        ids = all_ids.select(F.col(conv_id).cast(id_type).alias("_id")).distinct()
        parts = parts.unionByName(ids.withColumn("real", F.lit(False)), allowMissingColumns=True)
    out = T.StructType([T.StructField("_id", id_type), *[T.StructField(n, T.LongType()) for n in COUNTS], T.StructField("audit", T.StringType())])
    placed = parts.repartition("_id").sortWithinPartitions("_id", "real", "_turn", "_role", "_sha")
    return placed.mapInArrow(_joined(out), out).withColumnRenamed("_id", conv_id)


def _joined(schema: T.StructType) -> Callable:
    """Mapper: the stretches of conversations in order, a conversation out."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        now = None

        def closed(c: dict) -> dict:
            cost, audit = c["chain"].result()
            gaps = c["high"] - c["low"] + 1 - c["turns"] if c["turns"] else 0
            return {"_id": c["_id"], "gaps": gaps, "cost": cost, "audit": audit} | {n: c[n] for n in COUNTS[1:-1]}

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for s in batch.slice(a, 256).to_pylist():
                    if now is None or now["_id"] != s["_id"]:
                        if now is not None:
                            held.append(closed(now))
                        now = {"_id": s["_id"], "chain": Chain(), "low": None, "high": None, "turns": 0, "last": None, "last_turn": None} | dict.fromkeys(COUNTS[1:-1], 0)
                    if not s["real"]:
                        continue
                    for n in ("blank", "duplicate", "truncated", "illegal"):
                        now[n] += s[n]
                    now["illegal"] += now["last"] is not None and now["last"] + s["first"] not in LEGAL
                    now["turns"] += s["turns"] - (s["first_turn"] is not None and s["first_turn"] == now["last_turn"])
                    now["low"] = s["low"] if now["low"] is None else now["low"]
                    now["high"] = now["high"] if s["high"] is None else s["high"]
                    now["last"], now["last_turn"] = s["last"], s["last_turn"]
                    now["chain"].add([(w["start"], w["end"], w["cost"], w["edits"]) for w in s["ways"]])
                    if s["tail"]:
                        now["chain"].delete(s["tail"])
                if len(held) >= 1024:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)
                    held = []
        if now is not None:
            held.append(closed(now))
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return run


def _replayed(turns: DataFrame, found: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Audits and rows together: a conversation's audit, then its rows in order."""
    rows = _rows(turns, conv_id, turn, role, text).withColumn("row", F.lit(True))
    heads = found.withColumnRenamed(conv_id, "_id").withColumn("row", F.lit(False))
    both = heads.unionByName(rows, allowMissingColumns=True)
    return both.repartition("_id").sortWithinPartitions("_id", "row", "_turn", "_role", "_sha")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """(audit, rows) for each conversation of sorted batches; the rows are a stream."""
    stream = (r for b in batches for a in range(0, b.num_rows, 256) for r in b.slice(a, 256).to_pylist())
    head = next(stream, None)
    while head is not None:
        after = None

        def rows(head=head):
            nonlocal after
            for r in stream:
                if not r["row"]:
                    after = r
                    return
                yield r["_role"], r["_text"]

        mine = rows()
        yield head, mine
        for _ in mine:  # whatever the caller left
            pass
        head = after


def repaired_turns(turns: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows: id, ``position`` from 0, role and text, by ``audits``'s result."""
    side = _replayed(turns, found.select(conv_id, "audit"), conv_id, turn, role, text)
    id_type = side.schema["_id"].dataType
    out = T.StructType([T.StructField(conv_id, id_type), T.StructField("position", T.LongType()), T.StructField(role, T.StringType()), T.StructField(text, T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for head, rows in _conversations(batches):
            for k, (r, t) in enumerate(replay(head["audit"], rows)):
                held.append((head["_id"], k, r, t))
                if len(held) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return side.mapInArrow(run, out)


def with_digests(turns: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``audits``'s result plus ``repaired_sha256``: lowercase hex of the repaired
    conversation's ``role:text`` joined by line feeds (of nothing when it is empty)."""
    side = _replayed(turns, found, conv_id, turn, role, text)
    id_type = side.schema["_id"].dataType
    out = T.StructType([T.StructField("_id", id_type), *[T.StructField(n, T.LongType()) for n in COUNTS], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for head, rows in _conversations(batches):
            sha = hashlib.sha256()
            for k, (r, t) in enumerate(replay(head["audit"], rows)):
                sha.update(("\n" * (k > 0) + f"{r}:{t}").encode("utf-8"))
            held.append({n: head[n] for n in arrow.names[:-1]} | {"repaired_sha256": sha.hexdigest()})
            if len(held) >= 1024:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return side.mapInArrow(run, out).withColumnRenamed("_id", conv_id)

"""Conversation structure repair: square-root checkpointed dynamic programming.

Rows of a conversation are put in order by range, so a conversation of any
length spreads over many tasks, and cut into blocks whose length is the square
root of the longest conversation (``BLOCK`` at least).  A block is one byte a
row.  The cheapest repair needs, for every row, the costs of finishing from the
four states of the role pattern ``(s?(ua)+)?``.  These backward vectors are kept
at block ends only: each block gives a 4 x 4 cost matrix, the matrices of a
conversation are multiplied from its end, and every block then computes its own
vectors again while it walks forward and emits the least tight edit of each row.
All blocks walk at once, for each state they may be entered in; the states are
chained afterwards.  Differences of a vector take few values, so a step is a
lookup.

Results that the data leave open: rows of one turn sort by role and text (their
first ``KEY`` characters, then a SHA-256 of both).  A null role or text is one
space and so breaks the pattern or is blank; null turns come first; rows with a
null conv_id are one conversation.  Repeated rows are duplicates.  Other columns
stay behind.  An empty table gives no rows.  A conversation's audit and digest are
single values: its audit is held whole, its texts stream through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import map_batches, store

BLOCK = 4096
KEY = 32

_SPACE = r"\x20\x09-\x0D"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state after the role that may be inserted, or given to a row, in each state.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
#: The state after a kept row with the initial s, u, a or another one; None: not allowed.
_KEEP = (
    (_SYSTEM, None, None, None),
    (_USER, _USER, None, _USER),
    (None, None, _ASSISTANT, None),
    (None, None, None, None),
)
_FAR = 10**15
_DELETE, _INSERT, _REROLE = 3, 2, 2
_LAST = (0, 2 * _INSERT, _INSERT, 0)
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[0, 1] = _LEGAL[1, 2] = _LEGAL[2, 1] = True

_PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Steps:
    """Backward steps and tight edits, remembered by (vector, row code).

    A code is 0 for a row that must go, otherwise 1 + 2 * initial + truncated.
    A vector is stored less its minimum.
    """

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.ids: dict[tuple[int, ...], int] = {}
        self.back: dict[tuple[int, int], tuple[int, int]] = {}
        self.pick: dict[tuple[int, int, int], tuple[str, int]] = {}

    def of(self, vector) -> tuple[int, int]:
        """(id, minimum) of a vector."""
        least = min(vector)
        key = tuple(_FAR if x >= _FAR // 2 else x - least for x in vector)
        if key not in self.ids:
            self.ids[key] = len(self.vectors)
            self.vectors.append(key)
        return self.ids[key], least

    def closed(self, after: tuple[int, ...], code: int) -> list[int]:
        """Costs before a row from those after it, with the inserts before the row."""
        costs = [_DELETE + after[q] for q in range(4)]
        if code:
            initial, cut = divmod(code - 1, 2)
            for q in range(4):
                costs[q] = min(costs[q], _REROLE + cut + after[_NEXT[q]])
                if (kept := _KEEP[initial][q]) is not None:
                    costs[q] = min(costs[q], cut + after[kept])
        for _ in range(3):
            costs = [min(c, _INSERT + costs[_NEXT[q]]) for q, c in enumerate(costs)]
        return costs

    def before(self, at: int, code: int) -> tuple[int, int]:
        found = self.back.get((at, code))
        if found is None:
            found = self.back[at, code] = self.of(self.closed(self.vectors[at], code))
        return found

    def edit(self, at: int, code: int, state: int) -> tuple[str, int]:
        """Letters of the least tight edits up to and with this row, and the state after it."""
        found = self.pick.get((at, code, state))
        if found is None:
            after = self.vectors[at]
            costs = self.closed(after, code)
            initial, cut = divmod(code - 1, 2)
            if _DELETE + after[state] == costs[state]:
                found = "D", state
            elif _INSERT + costs[_NEXT[state]] == costs[state]:
                letters, end = self.edit(at, code, _NEXT[state])
                found = "I" + letters, end
            elif (kept := _KEEP[initial][state]) is not None and cut + after[kept] == costs[state]:
                found = "K", kept
            else:
                found = "R", _NEXT[state]
            self.pick[at, code, state] = found
        return found

    def vector(self, codes: bytes, end) -> list[int]:
        """Costs at the start of a block from those at its end."""
        at, total = self.of(end)
        for code in reversed(codes):
            at, more = self.before(at, code)
            total += more
        return [x + total for x in self.vectors[at]]

    def matrix(self, codes: bytes) -> list[int]:
        """Costs from each state at the start (rows) to each state at the end of a block."""
        ends = [self.vector(codes, [0 if q == r else _FAR for q in range(4)]) for r in range(4)]
        return [ends[r][q] if ends[r][q] < _FAR // 2 else -1 for q in range(4) for r in range(4)]

    def walk(self, codes: bytes, end) -> list[tuple[str, int]]:
        """(letters, state at the end) of a block for each state at its start."""
        at, _ = self.of(end)
        after = []
        for code in reversed(codes):
            after.append(at)
            at, _ = self.before(at, code)
        after.reverse()
        walks = []
        for state in range(4):
            letters = []
            for v, code in zip(after, codes, strict=True):
                text, state = self.edit(v, code, state)
                letters.append(text)
            walks.append(("".join(letters), state))
        return walks


def damage(rows: DataFrame) -> DataFrame:
    """Faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes its role user.  Nulls of role, text and the key are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"),
                    blank("text").alias("text"), fault.alias("f"))
        .where("f != 0")
        .select("conv_id", "turn", F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"),
                text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("f") == 3, 2).otherwise(1))))
        .drop("col")
    )


def _keyed(rows: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text")).select(
        "*",
        F.substring("role", 1, KEY).alias("role_key"),
        F.substring("text", 1, KEY).alias("text_key"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
    )


def _placed(keyed: DataFrame) -> DataFrame:
    """Small rows in order: pos grows within a conversation; kind is 4 * initial + 2 * truncated + blank."""
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    kind = (
        4 * initial
        + 2 * F.col("text").rlike(rf"[^{_SPACE}.!?][{_SPACE}]*\z").cast("int")
        + (~F.col("text").rlike(rf"[^{_SPACE}]")).cast("int")
    )
    order = ["conv_id", "turn", "role_key", "text_key", "digest"]
    return store(
        keyed.select(*order, kind.alias("kind"))
        .withColumn("salt", F.monotonically_increasing_id())  # equal rows may fill many tasks
        .repartitionByRange(*order, "salt")
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "digest", "kind", F.monotonically_increasing_id().alias("pos"))
    )


def _blocks(placed: DataFrame, least: int) -> DataFrame:
    longest = placed.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    size = max(least, isqrt(longest) + 1)
    first = placed.where("kind % 2 = 0").groupBy("conv_id", "digest").agg(F.min("pos").alias("pos"))
    mark = first.select("conv_id", "pos", F.lit(-1).alias("kind"), F.lit(None).cast("long").alias("turn"))
    lists = (
        placed.select("conv_id", "pos", "kind", "turn")
        .unionAll(mark)
        .groupBy("conv_id", F.floor(F.col("pos") / size).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "kind", "turn"))).alias("rows"))
    )
    names = ["codes", "matrix", "blank", "duplicate", "truncated", "illegal", "head", "tail", "turns", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        matrices: dict[bytes, list[int]] = {}  # most conversations are short and alike
        for batch in batches:
            lists = batch.column("rows")
            rows = lists.flatten()
            kind = rows.field("kind").to_numpy()
            turn = rows.field("turn")
            known = turn.is_valid().to_numpy(zero_copy_only=False)
            turn = turn.fill_null(0).to_numpy()
            marked = np.r_[False, kind[:-1] == -1] if len(kind) else kind == -1
            ends = np.cumsum([len(x) for x in lists])
            out: dict[str, list] = {n: [] for n in names}
            for lo, hi in zip(np.r_[0, ends[:-1]], ends, strict=True):
                real = np.flatnonzero(kind[lo:hi] >= 0) + lo
                k = kind[real]
                blank, copy = k % 2 == 1, ~marked[real]
                initial, cut = k // 4, (k // 2) % 2
                gone = blank | copy
                codes = np.where(gone, 0, 1 + 2 * initial + cut).astype(np.uint8).tobytes()
                if len(codes) > 64 or codes not in matrices:
                    found = steps.matrix(codes)
                    if len(codes) <= 64 and len(matrices) < 100_000:
                        matrices[codes] = found
                else:
                    found = matrices[codes]
                at = turn[real][known[real]]
                row = (
                    codes, found, blank.sum(), (copy & ~blank).sum(), (~gone & (cut == 1)).sum(),
                    (~_LEGAL[initial[:-1], initial[1:]]).sum(), initial[0], initial[-1],
                    len(at) and 1 + (at[1:] != at[:-1]).sum(), at[0] if len(at) else None, at[-1] if len(at) else None,
                )
                for n, v in zip(names, row, strict=True):
                    out[n].append(v if v is None or isinstance(v, (bytes, list)) else int(v))
            kinds = {"codes": pa.binary(), "matrix": pa.list_(pa.int64())}
            yield pa.record_batch(
                [batch.column("conv_id"), batch.column("block"), *(pa.array(out[n], kinds.get(n, pa.int64())) for n in names)],
                ["conv_id", "block", *names],
            )

    kind = placed.schema["conv_id"].dataType.simpleString()
    columns = ", ".join(f"{n} long" for n in names[2:])
    return map_batches(lists, run, f"conv_id {kind}, block long, codes binary, matrix array<long>, {columns}")


def _ends(blocks: DataFrame) -> DataFrame:
    """Adds the vector at the end of each block: the checkpoints, matrices multiplied from the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, vector = object(), list(_LAST)
        for batch in batches:
            ends = []
            for conv, matrix in zip(batch.column("conv_id").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
                if conv != conversation:
                    conversation, vector = conv, list(_LAST)
                ends.append(vector)
                vector = [
                    min(matrix[4 * q + r] + vector[r] for r in range(4) if matrix[4 * q + r] >= 0) for q in range(4)
                ]
            yield batch.drop_columns(["matrix"]).append_column("end", pa.array(ends, pa.list_(pa.int64())))

    schema = ", ".join(f"{c} {t}" for c, t in blocks.drop("matrix").dtypes)
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    return map_batches(ordered, run, f"{schema}, end array<long>")


def _walks(blocks: DataFrame) -> DataFrame:
    """Walks every block forward from each state: letters and states at the end, and the cost from the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            walks, costs = [], []
            for codes, end in zip(batch.column("codes").to_pylist(), batch.column("end").to_pylist(), strict=True):
                walks.append([{"letters": a, "state": s} for a, s in steps.walk(codes, end)])
                costs.append(steps.vector(codes, end)[_START])
            kind = pa.list_(pa.struct([("letters", pa.string()), ("state", pa.int64())]))
            yield (
                batch.drop_columns(["codes", "end"])
                .append_column("walks", pa.array(walks, kind))
                .append_column("cost", pa.array(costs, pa.int64()))
            )

    schema = ", ".join(f"{c} {t}" for c, t in blocks.drop("codes", "end").dtypes)
    spread = blocks.repartition("conv_id", "block")
    return map_batches(spread, run, f"{schema}, walks array<struct<letters:string,state:long>>, cost long")


def _plans(walks: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost and the audit, chained over its blocks."""
    adds = ["blank", "duplicate", "truncated", "illegal", "turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PLAN.split(", ")]
        types = [pa.int64()] * 6 + [pa.string()]
        now: dict | None = None

        def done() -> list:
            letters, state = now["letters"], now["state"]
            while state not in (_START, _ASSISTANT):
                letters.append("I")
                state = _NEXT[state]
            span = now["high"] - now["low"] + 1 - now["turns"] if now["low"] is not None else 0
            return [now["conv_id"], min(span, 2**63 - 1), *(now[n] for n in adds[:4]), now["cost"], "".join(letters)]

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now["conv_id"]:
                    if now:
                        out.append(done())
                    now = row | {"letters": [], "state": _START}
                else:
                    for n in adds:
                        now[n] += row[n]
                    now["illegal"] += int(not _LEGAL[now["tail"], row["head"]])
                    now["turns"] -= row["low"] is not None and row["low"] == now["high"]
                    now["low"] = row["low"] if now["low"] is None else now["low"]
                    now["high"] = now["high"] if row["high"] is None else row["high"]
                    now["tail"] = row["tail"]
                walk = row["walks"][now["state"]]
                now["letters"].append(walk["letters"])
                now["state"] = walk["state"]
            yield table(out, batch.schema.field("conv_id").type)
        if now:
            yield table([done()], kind)

    def table(out: list, conv) -> pa.RecordBatch:
        nonlocal kind
        kind = conv
        names = ["conv_id", *(x.split()[0] for x in _PLAN.split(", "))]
        types = [conv, *[pa.int64()] * 6, pa.string()]
        cells = list(zip(*out, strict=True)) or [[]] * len(names)
        return pa.record_batch([pa.array(c, t) for c, t in zip(cells, types, strict=True)], names)

    kind = None
    conv = walks.schema["conv_id"].dataType.simpleString()
    ordered = walks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return map_batches(ordered, run, f"conv_id {conv}, {_PLAN}")


def plans(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` -> one row per conversation: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost and audit, the ASCII-least string of the cheapest edits."""
    return _plans(_walks(_ends(_blocks(_placed(_keyed(rows)), block))))


def _repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of each conversation in order behind its plan, in one stream."""
    names = [x.split()[0] for x in _PLAN.split(", ")]
    keyed = _keyed(rows)
    empty = [F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in _PLAN.split(", ")]
    keys = ["turn", "role_key", "text_key", "digest"]
    none = [F.lit(None).cast(keyed.schema[c].dataType).alias(c) for c in [*keys, "role", "text"]]
    return (
        keyed.select("conv_id", F.lit(1).alias("part"), *keys, "role", "text", *empty)
        .unionAll(found.select("conv_id", F.lit(0).alias("part"), *none, *names))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", *keys)
        .select("conv_id", "part", "turn", "role", "text", *names)
    )


def _follow(audit: str) -> Iterator[tuple[str, str]]:
    """(letter, role) of each edit; the role is that of the pattern, empty for a deleted row."""
    shift = (len(audit) - audit.count("D")) % 2
    at = 0
    for letter in audit:
        if letter == "D":
            yield letter, ""
            continue
        at += 1
        yield letter, "assistant" if (at - shift) % 2 == 0 else "user"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict | None, list]]:
    """(batch number, plan that begins or None, edits (letter, turn, role, text) of one row or of the end)."""
    edits: Iterator = iter(())
    for n, batch in enumerate(batches):
        for row in batch.to_pylist():
            if row["part"] == 0:
                yield n, None, [(a, None, r, "") for a, r in edits]
                edits = _follow(row["audit"])
                yield n, row, []
                continue
            out = []
            for letter, role in edits:
                if letter == "I":
                    out.append((letter, None, role, ""))
                    continue
                out.append((letter, row["turn"], row["role"] if letter in "DK" else role, row["text"]))
                break
            yield n, None, out
        yield n, None, []
    yield -1, None, [(a, None, r, "") for a, r in edits]


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, position, edit, turn, role, text): the repaired conversations, from position 0.

    Deleted rows have no position; inserted rows have no turn and an empty text.
    """
    keyed = _repaired(rows, plans(rows, block))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "position", "edit", "turn", "role", "text"]
        types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        conv, at, held, out = None, 0, 0, []

        def table() -> pa.RecordBatch:
            cells = list(zip(*out, strict=True)) or [[]] * len(names)
            return pa.record_batch([pa.array(c, t) for c, t in zip(cells, types, strict=True)], names)

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                types[0] = batch.schema.field("conv_id").type
                yield batch

        for n, plan, edits in _edited(typed(batches)):
            if n != held and out:
                yield table()
                out = []
            held = n
            for letter, turn, role, text in edits:
                out.append((conv, None if letter == "D" else at, letter, turn, role, text))
                at += letter != "D"
            if plan:
                conv, at = plan["conv_id"], 0
        if out:
            yield table()

    return map_batches(keyed, run, f"conv_id {kind}, position long, edit string, turn long, role string, text string")


def report(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``plans`` with repaired_sha256, the hash of the repaired ``role:text`` joined by newlines."""
    found = store(plans(rows, block))
    names = [x.split()[0] for x in _PLAN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [None, *[pa.int64()] * 6, pa.string(), pa.string()]
        now, digest, held, out = None, hashlib.sha256(), 0, []

        def table() -> pa.RecordBatch:
            cells = list(zip(*out, strict=True)) or [[]] * len(types)
            columns = ["conv_id", *names, "repaired_sha256"]
            return pa.record_batch([pa.array(c, t) for c, t in zip(cells, types, strict=True)], columns)

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                types[0] = batch.schema.field("conv_id").type
                yield batch

        started = False
        for n, plan, edits in _edited(typed(batches)):
            for letter, _, role, text in edits:
                if letter != "D":
                    digest.update(f"{chr(10) if started else ''}{role}:{text}".encode())
                    started = True
            if plan or n < 0:
                if now:
                    out.append((now["conv_id"], *(now[c] for c in names), digest.hexdigest()))
                now, digest, started = plan, hashlib.sha256(), False
            if n != held and out:
                yield table()
                out = []
            held = n
        if out:
            yield table()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return map_batches(_repaired(rows, found), run, f"conv_id {kind}, {_PLAN}, repaired_sha256 string")


def damaged_report(rows: DataFrame) -> DataFrame:
    """``report`` of the damaged rows for every conv_id of ``rows``; one with no rows left has zeros."""
    found = report(damage(rows)).withColumnRenamed("conv_id", "id")
    every = rows.select("conv_id").distinct()
    zero = [F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id",
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b"").cast("binary"), 256)).alias("repaired_sha256"),
    )

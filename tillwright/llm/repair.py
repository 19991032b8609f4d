"""Repair of the turn structure of conversations at least cost.

A conversation is to read ``(s?(ua)+)?`` in the initials of its roles: nothing, or an optional
system turn and then user and assistant in turn. Each row is kept, given another role or deleted,
and empty turns may be inserted; what costs least is done, and among equals what gives the least
audit, the initials of the edits in order.

The search is the shortest path through the graph of (rows done, place in the pattern), with one
whole number as weight: its high digits are the cost, its low digits spell the audit from the
left, one digit a letter, and what follows the last letter is zero. So a shorter audit comes
before one that it begins, and the least number is both cheapest and first; its digits are the
edits. No two paths of equal cost to one place begin with each other, since both hold one
letter for each row, and an insertion more is a higher cost; so the least number at a place stays
the least whatever follows. Rows stream by in order: every ``SETTLE`` rows the digits that all paths
still open share are given out, so a conversation of any length needs little memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.ranks import stored

# Costs of the edits, and letters in order of their digits.
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
LETTERS = "\0DIKR"
BITS = 3
CUT_OFF = 1

#: Places in the pattern: nothing yet, after the system turn, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Places reached by a turn of each initial.
AFTER = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ENDS = (EMPTY, ASSISTANT)
#: A path dearer than the cheapest by more than this never wins: from any place but a turn's
#: insertion or deletion leads wherever another path may go (see ``Search.settle``).
BEHIND = 12
SETTLE = 256
#: Two insertions in a row are as many as can ever pay: a pair inside the pattern may be left out.
INSERTS = 2

SILENT = " \t\n\x0b\f\r"
SAYS = r"[^\x20\x09-\x0D]"
BATCH_ROWS = 4096


class Search:
    """Shortest path of one conversation; letters that are sure are given out as they become so."""

    def __init__(self) -> None:
        self.width = INSERTS + (INSERTS + 1) * SETTLE
        self.best = {EMPTY: (0, 0)}  # place: weight, letters in it
        self.rows = 0

    def _edge(self, paths: dict, to: int, weight: int, n: int, letter: str, cost: int) -> None:
        """The path goes on by a letter; the lesser number stays."""
        digit = LETTERS.index(letter) << BITS * (self.width - 1 - n)
        weight += (cost << BITS * self.width) + digit
        if to not in paths or weight < paths[to][0]:
            paths[to] = (weight, n + 1)

    def _insert(self) -> None:
        for _ in range(INSERTS):
            paths = dict(self.best)
            for place, (weight, n) in self.best.items():
                for initial in "ua":
                    if place in AFTER[initial]:
                        self._edge(paths, AFTER[initial][place], weight, n, "I", COST["I"])
            self.best = paths

    def row(self, initial: str, must_go: bool, cut_off: bool) -> None:
        self._insert()
        paths: dict = {}
        more = CUT_OFF if cut_off else 0
        for place, (weight, n) in self.best.items():
            self._edge(paths, place, weight, n, "D", COST["D"])
            if not must_go:
                if place in AFTER.get(initial, {}):
                    self._edge(paths, AFTER[initial][place], weight, n, "K", COST["K"] + more)
                for other in "ua":
                    if place in AFTER[other]:
                        self._edge(paths, AFTER[other][place], weight, n, "R", COST["R"] + more)
        self.best = paths
        self.rows += 1

    def _letters(self, weight: int, n: int) -> str:
        return "".join(LETTERS[weight >> BITS * (self.width - 1 - i) & (1 << BITS) - 1] for i in range(n))

    def settle(self) -> str:
        """Letters that all open paths begin with; their weights then hold the rest of the letters.

        Paths that can no longer win are dropped first. Whatever a path from another place does
        next, one from the cheapest place can do after at most two insertions or a deletion, and
        end after at most two more.
        """
        least = min(weight for weight, _ in self.best.values()) >> BITS * self.width
        kept = {p: (w, n) for p, (w, n) in self.best.items() if (w >> BITS * self.width) <= least + BEHIND}
        spelled = {p: self._letters(w, n) for p, (w, n) in kept.items()}
        shortest = min(spelled.values(), key=len)
        sure = next((i for i in range(len(shortest)) if len({s[i] for s in spelled.values()}) > 1), len(shortest))
        width = INSERTS + (INSERTS + 1) * SETTLE + max(len(s) for s in spelled.values()) - sure
        for place, letters in spelled.items():
            rest = letters[sure:]
            digits = sum(LETTERS.index(c) << BITS * (width - 1 - i) for i, c in enumerate(rest))
            kept[place] = (((kept[place][0] >> BITS * self.width) - least << BITS * width) + digits, len(rest))
        self.best, self.width = kept, width
        return shortest[:sure]

    def end(self) -> str:
        """The rest of the letters of the least path that ends the pattern."""
        self._insert()
        return self._letters(*min(self.best[p] for p in ENDS if p in self.best))


class Script:
    """Turns letters into edits (step, edit, row, role): the roles follow from the pattern."""

    def __init__(self) -> None:
        self.place, self.step, self.next_row = EMPTY, 0, 0

    def play(self, letters: str, initials: dict[int, str]) -> Iterator[tuple[int, str, int | None, str | None]]:
        for letter in letters:
            row, role = None, None
            if letter != "I":
                row, self.next_row = self.next_row, self.next_row + 1
            if letter == "K":
                self.place = AFTER[initials[row]][self.place]
            elif letter in "IR":
                said = "a" if self.place in AFTER["a"] else "u"
                self.place, role = AFTER[said][self.place], {"u": "user", "a": "assistant"}[said]
            initials.pop(row, None)
            yield self.step, letter, row, role
            self.step += 1


def diagnose(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Rows (conv, turn, role, text) with ``row`` (from 0 in the conversation), ``fault`` and ``illegal``.

    Rows go by turn, nulls first, then by role and text. A null role or text is one space. The
    first fault counts: ``blank`` (no visible character), ``duplicate`` (role and text stand in an
    earlier row), ``truncated`` (the last visible character ends no sentence); null if there is
    none. ``illegal`` marks a row that may not follow the one before: the initials of both are
    neither su nor ua nor au. One exchange, by conversation; windows hold a row at a time.
    """
    said = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    dealt = rows.select(F.col(conv).alias("conv_id"), F.col("turn").cast("long").alias("turn"), *said).withColumn(
        "said", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).repartition("conv_id")
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv_id").orderBy(*order)
    first = F.row_number().over(Window.partitionBy("conv_id", "said").orderBy(*order))
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(inside), initial)
    last = F.right(F.rtrim("text", F.lit(SILENT)), F.lit(1))
    fault = (F.when(~F.col("text").rlike(SAYS), "blank").when(F.col("earlier") > 1, "duplicate")
             .when(~last.isin(".", "!", "?"), "truncated"))
    return dealt.withColumn("earlier", first).withColumns({
        "row": (F.row_number().over(inside) - 1).cast("long"),
        "illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)), "fault": fault,
    }).select("conv_id", "row", "turn", "role", "text", "fault", "illegal")


def plan_edits(diagnosed: DataFrame) -> DataFrame:
    """The cheapest edits (conv_id, step, edit, row, role) of ``diagnose``'s rows.

    ``edit`` is D, I, K or R; ``row`` is null for an insertion, ``role`` for rows kept or deleted.
    Only initials and faults reach the search, not the texts.
    """
    lined = diagnosed.select("conv_id", "row", F.substring("role", 1, 1).alias("initial"), F.col("fault").isin("blank", "duplicate").alias("must_go"),
                             (F.col("fault") == "truncated").alias("cut_off"))
    lined = lined.repartition("conv_id").sortWithinPartitions("conv_id", "row")
    kind = diagnosed.schema["conv_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        path = script = None
        open_conv, initials = None, {}

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(
                [dict(zip(("conv_id", "step", "edit", "row", "role"), x)) for x in out],
                pa.schema([("conv_id", conv_type), ("step", pa.int64()), ("edit", pa.string()), ("row", pa.int64()), ("role", pa.string())]))
            out.clear()
            return made

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, row, initial, must_go, cut_off in zip(*(c.to_pylist() for c in batch.columns)):
                if row == 0:  # each conversation begins with its row 0
                    if path is not None:
                        out += [(open_conv, *e) for e in script.play(path.end(), initials)]
                    path, script, open_conv, initials = Search(), Script(), conv, {}
                initials[row] = initial
                path.row(initial, bool(must_go), bool(cut_off))
                if path.rows % SETTLE == 0:
                    out += [(open_conv, *e) for e in script.play(path.settle(), initials)]
                if len(out) >= BATCH_ROWS:
                    yield flush()
        if path is not None:
            out += [(open_conv, *e) for e in script.play(path.end(), initials)]
        if out:
            yield flush()

    return lined.mapInArrow(search, f"conv_id {kind}, step long, edit string, row long, role string")


def repair(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Edit script (conv_id, step, edit, turn, role, text, fault) of conversations (conv, turn, role, text).

    Steps without the deleted ones, in order, are the repaired conversation. An insertion has an
    empty text and no turn; a row given another role has the new one. Nulls and order are as in
    ``diagnose``; a null conversation is one too. A role without a letter fits nowhere. No rows
    give none, other columns are ignored.
    """
    diagnosed = diagnose(rows, conv)
    return scripts(diagnosed, plan_edits(diagnosed))


def scripts(diagnosed: DataFrame, edits: DataFrame) -> DataFrame:
    known = diagnosed.select(F.col("conv_id").alias("_conv"), F.col("row").alias("_row"), "turn", F.col("role").alias("_role"), "text", "fault")
    return edits.join(known, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("row") == F.col("_row")), "left").select(
        "conv_id", "step", "edit", "turn", F.coalesce("role", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"), "fault")


def cost(edit: Column, fault: Column) -> Column:
    base = F.element_at(F.create_map(*[F.lit(x) for pair in COST.items() for x in pair]), edit)
    return base + F.when((fault == "truncated") & (edit != "D"), CUT_OFF).otherwise(0)


def rendered(script: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of edit scripts: SHA-256 of the lines ``role:text``.

    A hash goes through a conversation from its first line to its last, so one task does; it
    holds a batch of lines and the audit so far.
    """
    lined = script.select("conv_id", "step", "edit", F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text")).alias("line"))
    lined = lined.repartition("conv_id").sortWithinPartitions("conv_id", "step")
    kind = script.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mark, audit, lines = None, None, [], 0
        for batch in batches:
            done = []
            for conv, step, edit, line in zip(*(c.to_pylist() for c in batch.columns)):
                if step == 0:
                    if mark is not None:
                        done.append({"conv_id": held, "audit": "".join(audit), "repaired_sha256": mark.hexdigest()})
                    held, mark, audit, lines = conv, hashlib.sha256(), [], 0
                audit.append(edit)
                if line is not None:
                    mark.update(("\n" if lines else "").encode() + line.encode("utf-8", "surrogatepass"))
                    lines += 1
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("audit", pa.string()), ("repaired_sha256", pa.string())])
            yield pa.RecordBatch.from_pylist(done, schema)
        if mark is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": held, "audit": "".join(audit), "repaired_sha256": mark.hexdigest()}], schema)

    return lined.mapInArrow(hashed, f"conv_id {kind}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in, by a checksum of ``conv_id:turn`` (null: one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a
    user's; a null role or text becomes one space.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", shown[2].alias("role"), shown[3].alias("text"), kind.alias("kind")).filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def report(original: DataFrame, rows: DataFrame) -> DataFrame:
    """A row a conversation of ``original``: counts of faults in ``rows``, cost, audit and hash of the repair.

    ``gaps`` counts turn numbers missing between the least and the greatest. A conversation of
    which no row is left has zeros, an empty audit and the hash of nothing.
    """
    diagnosed = stored(diagnose(rows), "diagnosed")
    counts = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    per_conv = diagnosed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"), *counts,
        F.count(F.when(F.col("illegal"), 1)).alias("illegal"))
    script = stored(scripts(diagnosed, plan_edits(diagnosed)), "scripts")
    costs = script.groupBy("conv_id").agg(F.sum(cost(F.col("edit"), F.col("fault"))).alias("cost"))
    found = original.select("conv_id").distinct().withColumnRenamed("conv_id", "_id")
    for part in (per_conv, costs, rendered(script)):
        found = found.join(part, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                        *[F.coalesce(c, F.lit(v)).alias(c) for c, v in empty.items()])

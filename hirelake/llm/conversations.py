"""Repair of the structure of conversations: `(system? (user assistant)+)?` at the least cost of edits.

A row is one symbol: the initial of its role, and its fault. Conversations are cut into stretches of at most STRETCH rows; equal stretches
of all conversations go on as one. Their symbols are compressed by Re-Pair into one grammar shared by all conversations, each rule gets one
min-plus transfer matrix with the ropes of its edits (`transfer`), made bottom-up, and a stretch is the product of the few matrices that are
left. Stretches of one conversation are multiplied in order, and states are handed down again for their edits. So neither a long
conversation nor a much repeated one is ever one task's work; only its digest reads a conversation's rows in order, as a stream.

Rows are ordered by turn (nulls first), then role and text by their first 64 characters, then by a digest of both. A row's first fault counts:
blank, duplicate (role and text stand earlier in the conversation), truncated (the last character is no end of a sentence).
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common, grammar, transfer

#: Rows of a stretch at most.
STRETCH = 4096
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Characters of role and text that rows are ordered by; a digest of both orders the rest.
HEAD = 64
KEY = ("turn", "role_head", "text_head", "digest")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by the CRC-32 of `conv_id:turn`, modulo 20; nulls count as one space.

    0 drops a row, 1 empties its text, 2 takes its ends of sentences away, 3 repeats it, 4 makes it the user's.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1)))
    return rows.where("code <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_")).drop("_")


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id, the key of the order, role and text (nulls as one space) of rows; other columns go."""
    plain = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    both = F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text"))
    return plain.select("conv_id", "turn", F.left("role", F.lit(HEAD)).alias("role_head"), F.left("text", F.lit(HEAD)).alias("text_head"), F.sha2(both, 256).alias("digest"), "role", "text")


def classified(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role_head, text_head, digest, initial, blank, cut, n, first of each different row: n equal ones, `first` if none stands earlier.

    Equal rows are added up within tasks before any of them is sent, and no text is sent at all.
    """
    ending = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    opening, known = F.substring("role", 1, 1), transfer.INITIALS[:-1]
    initial = F.coalesce(*[F.when(opening == c, i) for i, c in enumerate(known)], F.lit(len(known)))
    marked = _keyed(rows).select(
        "conv_id", *KEY, initial.cast("int").alias("initial"), (ending == "").alias("blank"), (~ending.isin(*ENDS)).alias("cut")
    )
    same = ["conv_id", *KEY[1:], "initial", "blank", "cut"]
    counts = common.stored(marked.groupBy("turn", *same).agg(F.count(F.lit(1)).alias("n")), "rows")
    earliest = counts.groupBy(*same).agg(F.min(F.struct(F.col("turn").isNotNull().alias("late"), F.col("turn"))).alias("at"))
    earliest = earliest.select(F.col("at.turn").alias("turn"), *same, F.lit(0).cast("long").alias("n"), F.lit(1).alias("first"))
    both = counts.withColumn("first", F.lit(0)).select(*earliest.columns).unionByName(earliest)
    return both.groupBy("turn", *same).agg(F.sum("n").alias("n"), (F.max("first") == 1).alias("first"))


def _stretches(ordered: DataFrame, schema: str, stretch: int):
    """conv_id, place, whole, key of the first row, codes: at most `stretch` rows of one conversation; `whole` says that it has no others."""

    def run(batches):
        part = TaskContext.get().partitionId()
        made, held, conv, key, number, begun = [], bytearray(), None, None, 0, False
        opening = True  # the partition's first conversation may have begun in the one before

        def close(whole):
            nonlocal held, number
            made.append((conv, part << 40 | number, whole, *key, bytes(held)))
            held, number = bytearray(), number + 1

        def table():
            columns = list(zip(*made))
            types = [conv_type, pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            names = ["conv_id", "place", "whole", *KEY, "codes"]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
            made.clear()
            return out

        conv_type, split = None, False
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", *KEY, "initial", "blank", "cut", "first", "n")))
            for own, turn, role, text, digest, initial, blank, cut, first, n in rows:
                if not begun or own != conv:
                    if begun:
                        close(whole=not split and not opening)
                        opening = False
                    conv, begun, split = own, True, False
                fault = transfer.DELETED if blank or not first else transfer.CUT if cut else transfer.FINE
                code, left = transfer.symbol(initial, fault), n
                while left:
                    if len(held) == stretch:
                        close(whole=False)
                        split = True
                    if not held:
                        key = (turn, role, text, digest)
                    some = min(left, 1 if left == n else left, stretch - len(held))
                    held += bytes([code]) * some
                    left -= some
                    code = transfer.symbol(initial, transfer.DELETED)
            if made:
                yield table()
        if begun:
            close(whole=False)
            yield table()

    return ordered.mapInArrow(common.handing_back(run), schema)


def _matrix_columns(m: transfer.Matrices) -> dict:
    flat = lambda x: pa.array(list(x.reshape(len(x), 16)), pa.list_(pa.int64()))
    return {"cost": flat(m.cost), "rank": flat(m.rank)}


def _multiplied(rows: DataFrame, rules: list) -> DataFrame:
    """seq, symbols, cost, rank, clashes, ends, own_cost, audit of distinct stretches; the last two as if each were a whole conversation."""

    def run(batch: pa.RecordBatch) -> dict:
        shared = transfer.Grammar(rules)
        sequences = [np.array(s, dtype=np.int64) for s in batch.column("symbols").to_pylist()]
        m = shared.products(sequences)
        cost, state = transfer.last_state(m)
        return {
            "codes": batch.column("codes"), "symbols": batch.column("symbols"), **_matrix_columns(m),
            "clashes": pa.array([shared.clashes_of(s) for s in sequences], pa.int64()),
            "ends": pa.array([[int(shared.first[s[0]]), int(shared.last[s[-1]])] for s in sequences], pa.list_(pa.int64())),
            "own_cost": pa.array(cost),
            "audit": pa.array([shared.edits(s, transfer.START, int(q)) + transfer.ENDING[int(q)] for s, q in zip(sequences, state)], pa.string()),
        }

    return common.per_batch(rows, run, "codes binary, symbols array<int>, cost array<bigint>, rank array<bigint>, clashes bigint, ends array<bigint>, own_cost bigint, audit string")


def _matrices_of(table: pa.Table) -> transfer.Matrices:
    cost, rank = (np.array(table.column(c).to_pylist(), dtype=np.int64).reshape(-1, 4, 4) for c in ("cost", "rank"))
    return transfer.Matrices(cost, rank, np.zeros_like(rank))


def _product(m: transfer.Matrices) -> transfer.Matrices:
    """Of all stretches in order, neighbours by neighbours."""
    while len(m.cost) > 1:
        n = len(m.cost) // 2 * 2
        made = transfer.compose(m[0:n:2], m[1:n:2])
        m = transfer.stack([made, m[n:]]) if n < len(m.cost) else made
    return m


def _long_conversations(stretches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, cost, clashes; conv_id, place, codes, symbols, before, after) of conversations of several stretches, by (conv_id, part) and then conv_id.

    The first groups hold the matrices of one task's rows, the second one matrix for each of them.
    """
    matrix = "cost array<bigint>, rank array<bigint>, clashes bigint, ends array<bigint>"
    conv = f"conv_id {stretches.schema['conv_id'].dataType.simpleString()}"

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        m = _product(_matrices_of(table))
        ends = table.column("ends").to_pylist()
        clashes = sum(table.column("clashes").to_pylist()) + sum(transfer.clash(a[1], b[0]) for a, b in zip(ends, ends[1:]))
        made = {"clashes": pa.array([clashes], pa.int64()), "ends": pa.array([[ends[0][0], ends[-1][1]]], pa.list_(pa.int64())), **_matrix_columns(m)}
        return pa.table({"conv_id": table.column("conv_id")[:1], "place": table.column("place")[:1], **{c: made[c] for c in ("cost", "rank", "clashes", "ends")}})

    def handed_down(table: pa.Table, p: int, q: int) -> tuple[list[int], list[int]]:
        states = transfer.chosen_states(_matrices_of(table), p, q)
        return states[:-1], states[1:]

    numbered = stretches.withColumn("part", F.shiftright("place", 40))
    parts = numbered.groupBy("conv_id", "part").applyInArrow(joined, f"{conv}, place bigint, {matrix}")
    parts = common.stored(parts.withColumn("part", F.shiftright("place", 40)), "conversation-parts")

    def ended(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        whole = joined(table)
        cost, state = transfer.last_state(_matrices_of(whole))
        before, after = handed_down(table, transfer.START, int(state[0]))
        n = len(before)
        told = {"part": table.column("part"), "before": pa.array(before, pa.int64()), "after": pa.array(after, pa.int64()),
                "last": pa.array([i == n - 1 for i in range(n)]),
                "total": pa.array(cost[[0] * n]), "clashes": pa.array(whole.column("clashes").to_pylist() * n, pa.int64())}
        return pa.table({"conv_id": table.column("conv_id"), **told})

    of_part = parts.groupBy("conv_id").applyInArrow(ended, f"{conv}, part bigint, before bigint, after bigint, last boolean, total bigint, clashes bigint")
    of_part = common.stored(of_part, "part-states")
    totals = of_part.where("last").select("conv_id", F.col("total").alias("cost"), "clashes")

    def within(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("place")
        before, after = handed_down(left, right.column("before")[0].as_py(), right.column("after")[0].as_py())
        last = [False] * (len(before) - 1) + [right.column("last")[0].as_py()]
        told = {"before": pa.array(before, pa.int64()), "after": pa.array(after, pa.int64()), "last": pa.array(last)}
        return pa.table({**{c: left.column(c) for c in ("conv_id", "place", "codes", "symbols")}, **told})

    # conv_id may be null, and a group's key must meet its equal: so by a digest of it
    named = lambda df: df.withColumn("own", F.sha2(F.concat_ws(":", F.col("conv_id").isNull().cast("string"), F.col("conv_id").cast("string")), 256))
    met = named(numbered).groupBy("own", "part").cogroup(named(of_part).groupBy("own", "part"))
    states = met.applyInArrow(within, f"{conv}, place bigint, codes binary, symbols array<int>, before bigint, after bigint, last boolean")
    return totals, states


def edits(ordered_rows: DataFrame, stretch: int = STRETCH) -> tuple[DataFrame, DataFrame]:
    """(conv_id, illegal, cost of each conversation; conv_id, place, audit and the key of the first row of each stretch) of `classified` rows."""
    by = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), *KEY[1:]]
    ordered = ordered_rows.repartitionByRange(*by).sortWithinPartitions(*by)
    conv = f"conv_id {ordered_rows.schema['conv_id'].dataType.simpleString()}"
    key = "turn bigint, role_head string, text_head string, digest string"
    stretches = common.stored(_stretches(ordered, f"{conv}, place bigint, whole boolean, {key}, codes binary", stretch), "stretches")

    def spelled(batch: pa.RecordBatch) -> dict:
        codes = batch.column("codes").to_pylist()
        return {"codes": batch.column("codes"), "symbols": pa.array([np.frombuffer(c, np.uint8).astype(np.int32) for c in codes], pa.list_(pa.int32()))}

    different = stretches.select("codes").distinct()
    packed, rules = grammar.compress(common.per_batch(different, spelled, "codes binary, symbols array<int>"), "symbols", transfer.TERMINALS)
    matrices = common.stored(_multiplied(packed, rules), "matrices")

    joined = stretches.join(matrices, "codes")
    whole = joined.where("whole").select("conv_id", F.col("clashes").alias("illegal"), F.col("own_cost").alias("cost"), "place", *KEY, "audit")
    whole = common.stored(whole, "whole-conversations")
    several = common.stored(joined.where("NOT whole").drop("own_cost", "audit"), "long-conversations")
    totals, states = _long_conversations(several)
    asked = common.stored(states, "stretch-states")

    def looked_up(batch: pa.RecordBatch) -> dict:
        shared = transfer.Grammar(rules)
        rows = zip(*(batch.column(c).to_pylist() for c in ("symbols", "before", "after")))
        return {**{c: batch.column(c) for c in ("codes", "before", "after")}, "audit": pa.array([shared.edits(np.array(s), p, q) for s, p, q in rows], pa.string())}

    ways = asked.groupBy("codes", "before", "after").agg(F.any_value("symbols").alias("symbols"))
    ways = common.per_batch(ways, looked_up, "codes binary, before bigint, after bigint, audit string")
    ending = F.when(F.col("last"), F.element_at(F.array(*[F.lit(transfer.ENDING[q]) for q in range(4)]), (F.col("after") + 1).cast("int"))).otherwise("")
    long_audits = asked.join(ways, ["codes", "before", "after"]).select("place", F.concat("audit", ending).alias("audit"))
    long_audits = several.join(long_audits, "place").select("conv_id", "place", *KEY, "audit")
    costs = whole.select("conv_id", "illegal", "cost").unionByName(totals.select("conv_id", F.col("clashes").alias("illegal"), "cost"))
    return costs, common.stored(whole.select("conv_id", "place", *KEY, "audit").unionByName(long_audits), "audits")


def _in_order(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows and edits of each conversation in one task, edits of a stretch before its rows."""
    texts = _keyed(rows).withColumn("place", F.lit(None).cast("long")).withColumn("audit", F.lit(None).cast("string"))
    letters = audits.withColumn("role", F.lit(None).cast("string")).withColumn("text", F.lit(None).cast("string"))
    both = texts.unionByName(letters.select(*texts.columns))
    by = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), *KEY[1:], F.asc_nulls_last("place")]
    return both.repartition("conv_id").sortWithinPartitions(*by)


class _Editor:
    """Applies letters to the rows of one conversation as they come; gives (role, text) of each row that stays or is put in."""

    def __init__(self):
        self.letters, self.at, self.state = "", 0, transfer.START

    def more(self, letters: str) -> None:
        self.letters, self.at = self.letters[self.at :] + letters, 0

    def inserted(self):
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = transfer.NEXT[self.state]
            yield "I", transfer.ROLES[self.state], ""

    def row(self, role: str, text: str):
        yield from self.inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = transfer.kept_state(self.state, role[:1])
            yield letter, role, text
        elif letter == "R":
            self.state = transfer.NEXT[self.state]
            yield letter, transfer.ROLES[self.state], text


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, position, edit, role, text of every row of the repaired conversations, in their order (position from 0)."""
    kind = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"

    def run(batches):
        conv, editor, position = None, None, 0
        for batch in batches:
            made = []
            for own, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit"))):
                if editor is None or own != conv:
                    if editor is not None:
                        made += [(conv, *x) for x in editor.inserted()]
                    conv, editor = own, _Editor()
                if audit is not None:
                    editor.more(audit)
                else:
                    made += [(conv, *x) for x in editor.row(role, text)]
            if made:
                yield numbered(made, batch.schema.field("conv_id").type)
        if editor is not None:
            made = [(conv, *x) for x in editor.inserted()]
            if made:
                yield numbered(made, batch.schema.field("conv_id").type)

    state = {}

    def numbered(made, conv_type):
        positions = []
        for row in made:
            if state.get("conv", ()) != (row[0],):
                state["conv"], state["next"] = (row[0],), 0
            positions.append(state["next"])
            state["next"] += 1
        conv, edit, role, text = zip(*made)
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, conv_type), pa.array(positions, pa.int64()), pa.array(edit), pa.array(role), pa.array(text, pa.string())],
            ["conv_id", "position", "edit", "role", "text"],
        )

    return _in_order(rows, audits).mapInArrow(common.handing_back(run), f"{kind}, position bigint, edit string, role string, text string")


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of `role:text` of the repaired rows, joined by newlines. Rows stream by; only the digest's state is held."""

    def run(batches):
        conv, editor, digest, empty = None, None, None, True

        def add(parts):
            nonlocal empty
            for _, role, text in parts:
                digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False

        for batch in batches:
            done = []
            for own, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit"))):
                if editor is None or own != conv:
                    if editor is not None:
                        add(editor.inserted())
                        done.append((conv, digest.hexdigest()))
                    conv, editor, digest, empty = own, _Editor(), hashlib.sha256(), True
                if audit is not None:
                    editor.more(audit)
                else:
                    add(editor.row(role, text))
            kind = batch.schema.field("conv_id").type
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (kind, pa.string()))], ["conv_id", "repaired_sha256"])
        if editor is not None:
            add(editor.inserted())
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return _in_order(rows, audits).mapInArrow(common.handing_back(run), f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def repair(rows: DataFrame, ids: DataFrame | None = None, stretch: int = STRETCH) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of `rows` (conv_id, turn, role, text).

    `ids` (conv_id) names conversations that are told of even without rows: zeros, no edits, the digest of nothing. gaps are the turns missing
    between the first and the last one; a conversation without turns has none. illegal counts neighbouring roles that may not follow each other.
    Edits are letters in order: D deletes a row (cost 2; blank and duplicate rows must go), I inserts a user or assistant row without text (5),
    K keeps a row, R renames its role (1); a truncated row that stays adds 5. Of equally cheap edits the ASCII-least stand. Null roles and
    texts count as one space, a null conv_id is a conversation, null turns come first; equal rows are told from repeated ones by nothing, so the
    first stays. Other columns are ignored. An empty table gives an empty table.
    """
    marked = common.stored(classified(rows), "classified-rows")
    costs, audits = edits(marked, stretch)
    good = F.col("first") & ~F.col("blank")
    many = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    faults = marked.groupBy("conv_id").agg(
        many(F.col("blank")).alias("blank"), F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.col("first").cast("int"))).alias("duplicate"),
        F.sum((good & F.col("cut")).cast("long")).alias("truncated"), (F.max("turn") - F.min("turn") + 1).alias("span"),
    )
    turns = marked.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(0)).groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    texts = audits.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    tables = [faults, turns, costs, texts, digests(rows, audits)]
    if ids is not None:
        tables.append(ids.select("conv_id").distinct())
    every = tables[0]
    for other in tables[1:]:
        every = every.unionByName(other, allowMissingColumns=True)
    told = every.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in every.columns if c != "conv_id"])
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return told.select(
        "conv_id", F.coalesce(F.col("span") - F.col("turns"), F.lit(0)).cast("long").alias("gaps"), number("blank"), number("duplicate"), number("truncated"),
        number("illegal"), number("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )

"""Conversation structure repair over a suffix-shared automaton.

Each turn has a fault (blank, duplicate, truncated or none) and a role; together they are
one letter, and a conversation is a word of such letters. Kept, relabelled, deleted and
inserted turns must give the roles `(s?(ua)+)?`; the cheapest edits are wanted, of equal
ones the audit string that comes first in ASCII order.

What remains to be paid from a turn on depends only on the letters from there to the end and
on the state of the role grammar. So words are kept once each, sorted by their reversed
letters, and walked in that order: neighbours share their longest common suffix, whose nodes
are on a stack already. This is the acyclic automaton minimised from the end, one node for
each distinct suffix of all conversations; each node gets its cost-to-go and its first edit
for each grammar state once. In every state an edit leads to one state and each edit has its
own initial, so the least audit suffix begins with the least initial among the cheapest
edits, and is followed from node to node.

A word holds a byte a turn, as the audit string that is asked for does; the turns with their
texts are only ever streamed, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import stored

#: Grammar states: nothing yet, or the initial of the last role.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an empty or relabelled turn leads to, and its role.
_FORCED = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
RELABEL_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: Letters of a word: role initial in lower case, in upper case when truncated; o, O for any other; x for a turn to delete.
_KEEPS = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
_NEVER = 1 << 60
#: What a node says of each state: (cost above the node's least, first edit, state after it, 1 if that edit uses up the turn).
Shape = tuple[tuple[int, str, int, int], ...]


def settled(options: list[list[tuple[int, str, int, int]]]) -> tuple[int, Shape]:
    """Least cost and shape from the edits of each state, empty turns put in where that is cheaper.
    No state needs more than two of them to any other, so two rounds settle them."""
    best = [min(x) for x in options]
    for _ in range(2):
        best = [min([*x, (best[_FORCED[q]][0] + INSERT_COST, "I", _FORCED[q], 0)]) for q, x in enumerate(options)]
    least = min(x[0] for x in best)
    return least, tuple((cost - least, *rest) for cost, *rest in best)


#: After the last turn: nothing is left to pay at a legal end.
END = settled([[(0, "", q, 0)] if q in (START, ASSISTANT) else [(_NEVER, "", q, 0)] for q in range(4)])


@lru_cache(maxsize=None)  # costs of two states differ by two empty turns at most: there are few shapes
def node_before(letter: str, after: Shape) -> tuple[int, Shape]:
    """Added cost and shape of the suffix that begins with `letter`, from the shape of the one behind it."""
    options = [[(after[q][0] + DELETE_COST, "D", q, 1)] for q in range(4)]
    if letter != "x":
        more = TRUNCATED_COST if letter.isupper() else 0
        for q in range(4):
            options[q].append((after[_FORCED[q]][0] + RELABEL_COST + more, "R", _FORCED[q], 1))
        for q, to in _KEEPS.get(letter.lower(), ()):
            options[q].append((after[to][0] + more, "K", to, 1))
    return settled(options)


def followed(shapes: list[Shape]) -> str:
    """The audit string from the first turn in the state START; `shapes` lie from the end to the front."""
    out, at, state = [], len(shapes) - 1, START
    while True:
        _, edit, to, used = shapes[at][state]
        if not edit:
            return "".join(out)
        out.append(edit)
        state, at = to, at - used


def automaton(words: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """(word, cost, audit) of reversed words in order; a node shared with the word before is not made again."""
    costs, shapes, before = [END[0]], [END[1]], ""
    for word in words:
        shared = len(commonprefix([before, word]))
        del costs[shared + 1 :], shapes[shared + 1 :]
        for letter in word[shared:]:
            added, shape = node_before(letter, shapes[-1])
            costs.append(costs[-1] + added)
            shapes.append(shape)
        before = word
        yield word, costs[-1] + shapes[-1][START][0], followed(shapes)


def blank_as_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text), damaged by crc32(`conversation:turn`) % 20: dropped (0),
    emptied (1), without `[.!?]` (2), repeated (3), spoken by the user (4). Nulls of role and
    text, and in the hash those of conversation and turn, are one space; conv and turn keep
    theirs. Other columns are left out."""
    fault = F.crc32(F.concat(blank_as_space(conversation), F.lit(":"), blank_as_space(turn)).cast("binary")) % 20
    rows = df.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(fault == 4, "user").otherwise(blank_as_space(role)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(blank_as_space(text), ".!?", "")).otherwise(blank_as_space(text)).alias("text"),
        F.when(fault == 3, 2).when(fault == 0, 0).otherwise(1).alias("times"),
    )
    return rows.where("times > 0").withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def faulted(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, n, fault): equal rows of a turn are one row with their
    number; `fault` is that of the first of them, any further ones are duplicates.

    Turns are read by number (nulls first), then role, then text. Null texts and roles are
    one space; a null conversation is one of its own. The first place of a text is found by
    sums that start in each task, and joined back by the text's hash, so neither a long
    conversation nor a text repeated through it is a group in one task.
    """
    rows = df.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), blank_as_space(role).alias("role"), blank_as_space(text).alias("text")
    )
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n"))
    rows = rows.withColumn("same", F.md5(F.concat_ws("\0", "role", "text")))
    # the least struct has the null turn first, as the order of turns does
    firsts = rows.groupBy(F.col("conv").alias("c"), F.col("same").alias("s")).agg(F.min(F.struct("turn")).alias("first"))
    rows = rows.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")))
    ends = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(ends == "", "blank")
        .when(~F.col("turn").eqNullSafe(F.col("first.turn")), "duplicate")
        .when(~ends.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return stored(rows.select("conv", "turn", "role", "text", "n", fault.alias("fault")), "structure_faults")


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def words_of_turns(faults: DataFrame) -> DataFrame:
    """One row for each conversation: word, blank, duplicate, truncated, illegal, gaps. Rows of a
    conversation are streamed in order through one task, which holds a byte for each."""
    kind = faults.schema["conv"].dataType.simpleString()
    number = F.col("turn").cast("long")
    rows = faults.select("conv", "turn", "role", "text", "n", "fault", number.alias("number"))
    rows = _ordered(rows).select("conv", "number", F.substring("role", 1, 1).alias("initial"), "n", "fault")
    names = ["conv", "word", "blank", "duplicate", "truncated", "illegal", "gaps"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: list = []

        def close() -> None:
            conv, word, blank, duplicate, truncated, illegal, _, first, last, seen = now
            gaps = last - first + 1 - seen if seen else 0
            out.append((conv, word.decode(), blank, duplicate, truncated, illegal, gaps))

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = pa.schema([("conv", batch.schema.field("conv").type), ("word", pa.string()), *((x, pa.int64()) for x in names[2:])])
            for conv, number, initial, n, fault in zip(*(batch[c].to_pylist() for c in batch.schema.names), strict=True):
                if not now or now[0] != conv:
                    if now:
                        close()
                    now = [conv, bytearray(), 0, 0, 0, 0, None, None, None, 0]
                letter = initial if initial in ("s", "u", "a") else "o"
                now[1] += (b"x" if fault in ("blank", "duplicate") else (letter.upper() if fault else letter).encode()) + b"x" * (n - 1)
                if fault == "blank":
                    now[2] += n
                else:
                    now[3] += n - 1 + (fault == "duplicate")
                    now[4] += fault == "truncated"
                if now[6] is not None and now[6] + initial not in ("su", "ua", "au"):
                    now[5] += 1
                now[5] += n - 1  # a role beside itself
                now[6] = initial
                if number is not None:
                    now[7] = number if now[7] is None else now[7]
                    now[9] += number != now[8]
                    now[8] = number
            if len(out) >= 2000:
                yield pa.record_batch(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema)
                out.clear()
        if now:
            close()
            yield pa.record_batch(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema)

    return rows.mapInArrow(read, f"conv {kind}, word string, " + ", ".join(f"{x} long" for x in names[2:]))


def repair_costs(words: DataFrame) -> DataFrame:
    """Rows (word, cost, audit) of the distinct words of a column `word`.

    Reversed words are range-partitioned, so a task walks words that share suffixes; only a
    suffix at the seam of two tasks gets its nodes twice.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(w for batch in batches for w in batch["back"].to_pylist())
        rows, held = [], 0
        for back, cost, audit in found:
            rows.append((back[::-1], cost, audit))
            held += len(back)
            if len(rows) == 2000 or held > 1 << 22:
                yield pa.record_batch(list(map(list, zip(*rows, strict=True))), names=["word", "cost", "audit"])
                rows, held = [], 0
        if rows:
            yield pa.record_batch(list(map(list, zip(*rows, strict=True))), names=["word", "cost", "audit"])

    back = words.select(F.reverse("word").alias("back")).distinct()
    return back.repartitionByRange("back").sortWithinPartitions("back").mapInArrow(walk, "word string, cost long, audit string")


def repair_plans(faults: DataFrame) -> DataFrame:
    """One row for each conversation of `faults`: conv, cost, audit and the counts of its faults."""
    told = stored(words_of_turns(faults), "structure_words")
    costs = stored(repair_costs(told), "structure_costs").withColumnRenamed("word", "w")
    return stored(told.join(costs, F.col("word") == F.col("w")).drop("word", "w"), "structure_plans")


def repaired_turns(faults: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows (conv, seq, role, text, edit): the repaired turns, by the audit strings of `plans`.
    The rows of a conversation lie in one partition, in order; deleted turns are left out."""
    kind = faults.schema["conv"].dataType.simpleString()
    turns = faults.select("conv", F.lit(1).alias("part"), "turn", "role", "text", "n")
    none = F.lit(None).cast(faults.schema["turn"].dataType)
    heads = plans.select("conv", F.lit(0).alias("part"), none.alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).alias("n"))
    rows = heads.unionByName(turns).repartition("conv").sortWithinPartitions("conv", "part", "turn", "role", "text")
    names = ["conv", "seq", "role", "text", "edit"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, seq, state = None, "", 0, 0, START
        for batch in batches:
            out: list[tuple] = []

            def inserted() -> None:
                nonlocal at, seq, state
                while at < len(audit) and audit[at] == "I":
                    state = _FORCED[state]
                    out.append((conv, seq, _ROLE[state], "", "I"))
                    at, seq = at + 1, seq + 1

            for name, part, role, text, n in zip(*(batch[c].to_pylist() for c in ("conv", "part", "role", "text", "n")), strict=True):
                if not part:
                    conv, audit, at, seq, state = name, text, 0, 0, START
                else:
                    for _ in range(n):
                        edit, at = audit[at], at + 1
                        if edit != "D":
                            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]] if edit == "K" else _FORCED[state]
                            out.append((conv, seq, role if edit == "K" else _ROLE[state], text, edit))
                            seq += 1
                        inserted()
                    continue
                inserted()
            if out:
                types = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
                columns = [pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.record_batch(columns, names=names)

    return rows.mapInArrow(apply, f"conv {kind}, seq long, role string, text string, edit string")


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's `role:text` joined by line ends, from rows that lie
    together and in order, as `repaired_turns` gives them; no text is held."""
    kind = turns.schema["conv"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, out, schema = None, None, [], None
        for batch in batches:
            schema = pa.schema([("conv", batch.schema.field("conv").type), ("sha256", pa.string())])
            for name, seq, role, text in zip(*(batch[c].to_pylist() for c in ("conv", "seq", "role", "text")), strict=True):
                if seq == 0:
                    if digest:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = name, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if len(out) >= 5000:
                yield pa.record_batch([pa.array([x[i] for x in out], schema.field(i).type) for i in range(2)], schema=schema)
                out = []
        if digest:
            out.append((conv, digest.hexdigest()))
        if out:
            yield pa.record_batch([pa.array([x[i] for x in out], schema.field(i).type) for i in range(2)], schema=schema)

    return turns.select("conv", "seq", "role", "text").mapInArrow(read, f"conv {kind}, sha256 string")


def structure_digest(df: DataFrame, faults: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row for each conversation of `df` with its faults, cost, audit string and the hash of
    its repaired turns; one without any row in `faults` has zeros and empty strings. An empty
    table gives none."""
    plans = repair_plans(faults)
    digests = turn_digests(repaired_turns(faults, plans)).withColumnRenamed("conv", "d")
    every = df.select(F.col(conversation).alias("conv_id")).distinct()
    out = every.join(plans, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    zero = [F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))

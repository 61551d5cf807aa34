"""Repair of conversation structure by iterative-deepening A*.

A conversation is right when its roles read (system? (user assistant)+)?. Rows may be kept,
given another role or deleted, and empty messages may be inserted, each at a price. The cheapest
edits are found by depth-first search under a cost bound that rises from the heuristic's estimate
to the least cost by which the last search failed. Edits are tried in ASCII order of their
initials, so the first accepting path is the least one. A table keeps for each place and state
the best lower bound that a failed search below it has shown, and no search enters a state again
that the bound rules out. The heuristic sums exact costs of blocks of rows, each with free
choice of the state it begins and ends in.

How a conversation that holds a large part of all rows is handled: a row's code (role and fault,
one byte) is made without its conversation at hand; codes are put in order by ranges, so such a
conversation is spread over tasks, and only its string of codes comes together for the search.
Repaired texts are streamed in order, so no task holds a conversation's texts.

Defined results
* nulls count as one space, in roles, texts and keys of the damage; a null conv_id is a
  conversation of its own;
* rows go by turn, nulls first, then by role, then by the SHA-256 of the text; of equal rows the
  first by this order is not a duplicate;
* roles other than those that begin with s, u or a can only be deleted or changed, and are never
  a legal neighbour;
* a conversation without rows after the damage has zeros, an empty audit and the hash of nothing;
* other columns, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import BATCH_ROWS, Batches, prepare, tidy
from millrace.session import scratch

# Prices of edits, white space, ends of sentences.
DELETE, INSERT, KEEP, REROLE = 2, 5, 0, 1
CUT_OFF = 5  # for a truncated row that stays
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# States of the accepted roles: nothing yet, after system, after user, after assistant.
EMPTY, OPENED, ASKED, ANSWERED = range(4)
ACCEPTED = (True, False, False, True)
EXPECTED = "uuau"  # the role that comes next in each state
AFTER = (ASKED, ASKED, ANSWERED, ASKED)  # the state it leads to

# Codes: faults times initials, a character for each.
INITIALS = "sua?"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
FIRST_CODE = 65

BLOCK = 48  # rows that the heuristic takes exactly
SEGMENT = 1 << 20  # codes that a task hands on at once


def code(initial: str, fault: int) -> str:
    """The character for a row."""
    return chr(FIRST_CODE + 4 * fault + INITIALS.index(initial))


def decode(codes: str) -> list[tuple[str, int]]:
    return [(INITIALS[(ord(c) - FIRST_CODE) % 4], (ord(c) - FIRST_CODE) // 4) for c in codes]


def edits_of(rows: list[tuple[str, int]], place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits in ASCII order of their initials: initial, price, next place and state."""
    more = place < len(rows)
    if more:
        yield "D", DELETE, place + 1, state
    yield "I", INSERT, place, AFTER[state]
    if more:
        initial, fault = rows[place]
        if fault in (OK, TRUNCATED):
            price = CUT_OFF if fault == TRUNCATED else 0
            if initial == EXPECTED[state]:
                yield "K", KEEP + price, place + 1, AFTER[state]
            else:
                if initial == "s" and state == EMPTY:
                    yield "K", KEEP + price, place + 1, OPENED
                yield "R", REROLE + price, place + 1, AFTER[state]


def estimates(rows: list[tuple[str, int]]) -> list[int]:
    """A lower bound of the cost from each place and state on, four states to a place.

    Exact up to the end of the place's block; of further blocks the cheapest way through.
    """
    n = len(rows)
    bound = [0] * (4 * (n + 1))
    bound[4 * n :] = [0, 2 * INSERT, INSERT, 0]
    beyond = bound[4 * n :]
    for place in range(n - 1, -1, -1):
        if place + 1 < n and (place + 1) % BLOCK == 0:
            beyond = [min(beyond)] * 4
        best = [
            min(
                (price + beyond[to] for edit, price, _, to in edits_of(rows, place, state) if edit != "I")
            )
            for state in range(4)
        ]
        for _ in range(2):  # up to two inserted messages
            best = [min(own, INSERT + best[AFTER[state]]) for state, own in enumerate(best)]
        beyond = bound[4 * place : 4 * place + 4] = best
    return bound


@functools.lru_cache(maxsize=1 << 14)
def repair(codes: str) -> tuple[int, str]:
    """Least cost and the least audit of that cost."""
    rows = decode(codes)
    learned = estimates(rows)
    goal = {4 * len(rows) + state for state in range(4) if ACCEPTED[state]}
    if 0 in goal:
        return 0, ""
    while True:
        bound = learned[0]
        found = _search(rows, bound, learned, goal)
        if found is not None:
            return bound, found


def _search(rows: list, bound: int, learned: list[int], goal: set[int]) -> str | None:
    """The first accepting path in ASCII order that costs at most the bound; else raise bounds."""
    infinite = bound + 1 << 30
    # Frames: node, price of the edit that led here, spent so far, edits left, least cost below.
    stack = [[0, 0, 0, edits_of(rows, 0, EMPTY), infinite]]
    path: list[str] = []
    while stack:
        frame = stack[-1]
        node, led, spent, edits, least = frame
        for edit, price, place, state in edits:
            to = 4 * place + state
            if spent + price + learned[to] <= bound:
                path.append(edit)
                if to in goal:
                    return "".join(path)
                frame[4] = least
                stack.append([to, price, spent + price, edits_of(rows, place, state), infinite])
                break
            least = min(least, price + learned[to])
        else:
            learned[node] = max(learned[node], least)  # the failed state's entry
            stack.pop()
            if stack:
                path.pop()
                stack[-1][4] = min(stack[-1][4], led + learned[node])
    return None


def damage(conversations: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text, copies after damage by a hash of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key) % 20).alias("draw"),
    )
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ENDS, ""))
    return rows.where("draw <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("draw") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256)).alias("digest")


def _coded(rows: DataFrame) -> DataFrame:
    """One row per distinct row: its order (conv_id, turn, role, digest) and codes of its copies."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    number = F.when(initial.isin(*INITIALS[:3]), F.instr(F.lit(INITIALS), initial) - 1).otherwise(3)
    light = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest(),
        "copies",
        number.cast("int").alias("initial"),
        F.when(trimmed == "", BLANK)
        .when(F.right(trimmed, F.lit(1)).isin(*ENDS), OK)
        .otherwise(TRUNCATED)
        .alias("fault"),
    )
    light = light.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"),
        F.any_value("initial").alias("initial"),
        F.any_value("fault").alias("fault"),
    )
    light = _kept(light, "conversation-rows")
    # The first of equal rows, by an aggregate that combines before the exchange and a join that
    # stands apart from it, so that Spark splits it where one message fills a conversation.
    given = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    first = light.where(F.col("fault") != BLANK).groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")
    )
    first = _kept(first.agg(F.min(given).alias("first")), "conversation-firsts")
    joined = light.join(first, F.expr("conv_id <=> c AND role = r AND digest = d"), "left")

    def char(fault: Column) -> Column:
        return F.chr(FIRST_CODE + 4 * fault + F.col("initial"))

    copies = F.col("copies").cast("int")
    again = char(F.lit(DUPLICATE))
    codes = (
        F.when(F.col("fault") == BLANK, F.repeat(char(F.lit(BLANK)), copies))
        .when(
            F.col("turn").eqNullSafe(F.col("first.turn")),
            F.concat(char(F.col("fault")), F.repeat(again, copies - 1)),
        )
        .otherwise(F.repeat(again, copies))
    )
    return joined.select("conv_id", "turn", "role", "digest", codes.alias("codes"))


PIECES = "part int, number int, first long, last long, turns long, codes string"


def _segments(batches: Batches) -> Batches:
    """Runs of one conversation's rows, which come in order: its turns and codes."""

    def hand_on(done: list[tuple]) -> pa.RecordBatch:
        kinds = (conv_kind, pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.string())
        names = ("conv_id", "part", "number", "first", "last", "turns", "codes")
        columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    done, now, conv_kind = [], None, pa.null()

    def close() -> None:
        conv_id, part, number, first, last, turns, codes, _ = now
        done.append((conv_id, part, number, first, last, turns, "".join(codes)))

    for batch in batches:
        conv_kind = batch.schema.field("conv_id").type
        for part, conv_id, turn, codes in zip(
            *(column.to_pylist() for column in batch.columns), strict=True
        ):
            if now is None or now[0] != conv_id or now[7] >= SEGMENT:
                number = 0
                if now is not None:
                    close()
                    number = now[2] + 1 if now[0] == conv_id else 0
                now = [conv_id, part, number, None, None, 0, [], 0]
            if turn is not None and turn != now[4]:
                now[3] = turn if now[3] is None else now[3]
                now[4] = turn
                now[5] += 1
            now[6].append(codes)
            now[7] += len(codes)
        if done:
            yield hand_on(done)
            done.clear()
    if now is not None:
        close()
        yield hand_on(done)


AUDIT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
COUNTED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def examine(pieces: list[dict]) -> tuple:
    """The figures and the audit of a conversation from its pieces in order."""
    first = last = None
    turns, codes = 0, "".join(piece["codes"] for piece in pieces)
    for piece in pieces:
        if piece["turns"]:
            turns += piece["turns"] - (last is not None and last == piece["first"])
            first = piece["first"] if first is None else first
            last = piece["last"]
    gaps = last - first + 1 - turns if turns else 0
    rows = decode(codes)
    faults = [fault for _, fault in rows]
    beside = zip(rows, rows[1:], strict=False)
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in beside)
    cost, audit = repair(codes)
    counts = (faults.count(fault) for fault in (BLANK, DUPLICATE, TRUNCATED))
    return gaps, *counts, illegal, cost, audit


def _audit(batches: Batches) -> Batches:
    for batch in batches:
        found = [examine(pieces) for pieces in batch.column(1).to_pylist()]
        kinds = [*[pa.int64()] * 6, pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns], names=["conv_id", *COUNTED, "audit"]
        )


def audits(conversations: DataFrame) -> DataFrame:
    """One row per conversation of rows conv_id, turn, role, text, copies: figures and audit.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    prepare(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    order = ("conv_id", "turn", "role", "digest")
    coded = _coded(conversations).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = coded.select(
        F.spark_partition_id().alias("part"), "conv_id", F.col("turn").cast("long"), "codes"
    ).mapInArrow(tidy(_segments), f"conv_id {kind}, {PIECES}")
    piece = F.struct("part", "number", "first", "last", "turns", "codes")
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return whole.mapInArrow(tidy(_audit), f"conv_id {kind}, {AUDIT}")


def _replayed(batches: Batches) -> Iterator[tuple]:
    """(conversation, role, text) of repaired messages, in order; (conversation, None, None) first.

    Rows come in order, the audit of a conversation before its rows.
    """
    names = {"u": "user", "a": "assistant"}
    conv_id, audit, place, state = None, "", 0, EMPTY

    def inserted() -> Iterator[tuple]:
        nonlocal place, state
        while audit[place : place + 1] == "I":
            yield conv_id, names[EXPECTED[state]], ""
            place, state = place + 1, AFTER[state]

    for batch in batches:
        columns = (column.to_pylist() for column in batch.columns)
        for own_id, own_audit, role, text, copies in zip(*columns, strict=True):
            if own_audit is not None:
                yield from inserted()
                conv_id, audit, place, state = own_id, own_audit, 0, EMPTY
                yield conv_id, None, None
                continue
            for _ in range(copies):
                yield from inserted()
                edit = audit[place]
                place += 1
                if edit == "D":
                    continue
                system = edit == "K" and role[:1] == "s"
                yield conv_id, role if edit == "K" else names[EXPECTED[state]], text
                state = OPENED if system else AFTER[state]
    yield from inserted()


def _in_order(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Audits and rows of conversations as _replayed() takes them."""
    rows = conversations.select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", _digest(),
        F.lit(None).cast("string").alias("audit"), "text", "copies",
    )
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), *(F.lit(None).alias(n) for n in ("turn", "role", "digest")),
        "audit", F.lit(None).alias("text"), F.lit(0).cast("long").alias("copies"),
    )
    both = heads.unionByName(rows).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return both.select("conv_id", "audit", "role", "text", "copies")


def repaired(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The messages of repaired conversations: conv_id, place, role, text."""
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def replay(batches: Batches) -> Batches:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        conv_kind = first.schema.field("conv_id").type
        held, place = [], 0

        def hand_on() -> pa.RecordBatch:
            kinds = (conv_kind, pa.int64(), pa.string(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "role", "text"])

        for conv_id, role, text in _replayed(itertools.chain([first], batches)):
            if role is None:
                place = 0
                continue
            held.append((conv_id, place, role, text))
            place += 1
            if len(held) == BATCH_ROWS:
                yield hand_on()
                held.clear()
        if held:
            yield hand_on()

    ordered = _in_order(conversations, found)
    return ordered.mapInArrow(
        tidy(replay), f"conv_id {kind}, place long, role string, text string"
    )


def repaired_digests(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256: the SHA-256 of lines `role:text`, streamed in order."""
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def replay(batches: Batches) -> Batches:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        conv_kind = first.schema.field("conv_id").type
        done, total, lines = [], None, 0

        def hand_on() -> pa.RecordBatch:
            ids, digests = zip(*((conv_id, h.hexdigest()) for conv_id, h in done), strict=True)
            columns = [pa.array(ids, conv_kind), pa.array(digests, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "repaired_sha256"])

        for conv_id, role, text in _replayed(itertools.chain([first], batches)):
            if role is None:
                if len(done) == BATCH_ROWS:  # all of them are complete
                    yield hand_on()
                    done.clear()
                total, lines = hashlib.sha256(), 0
                done.append((conv_id, total))
                continue
            total.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
            lines += 1
        if done:
            yield hand_on()

    return _in_order(conversations, found).mapInArrow(
        tidy(replay), f"conv_id {kind}, repaired_sha256 string"
    )


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after the damage: figures, audit, repaired_sha256."""
    spark = conversations.sparkSession
    prepare(spark)
    damaged = damage(conversations)
    found = _kept(audits(damaged), "conversation-audits")
    names = conversations.select("conv_id").distinct()
    # Whole without rows: nothing to find, nothing to hash.
    named = names.join(found.withColumnRenamed("conv_id", "own"), F.expr("conv_id <=> own"), "left")
    filled = named.drop("own").fillna(0, list(COUNTED)).fillna("", ["audit"])
    hashes = repaired_digests(damaged, filled).withColumnRenamed("conv_id", "own")
    joined = filled.join(hashes, F.expr("conv_id <=> own"))
    return joined.select("conv_id", *COUNTED, "audit", "repaired_sha256")

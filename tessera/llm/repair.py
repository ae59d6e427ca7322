"""Repair of conversations whose turns are damaged, with the fewest and then ASCII-least edits.

A conversation should be ``(s?(ua)+)?`` by its roles' initials.  Its rows are
gone through in order; each is kept, given the role that is due, or deleted,
and turns without text may be inserted.  The search is iterative-deepening A*:
depth first in ASCII order of the edits under a cost bound that rises to the
least cost that it was exceeded by.  A table holds, for each row and state of
the pattern, the cost that failed searches have shown to be needed from there;
what a state needs beyond the bound is not entered again.  So the first path
that is accepted has the least cost and is ASCII-least among those.

A search covers ``BLOCK`` rows.  Longer stretches are a chain of blocks: from
the last one back, a search from each of the four states gives what is needed
from there on, which is the cost of ending the block before in that state; a
path of one block ends with the edit of its last row, so none is the beginning
of another and the least paths of the blocks make the least path of all.
Stretches of ``SEGMENT`` rows are rows of a table, so a conversation of any
length is dealt over tasks, of which each sees its own rows; what joins the
segments (16 costs each) is gone through by conversation.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import running_total, stored

DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5        # costs; CUT_OFF is added for a truncated row that stays
BLOCK, SEGMENT = 64, 4096
NEVER = 1 << 40

SPACE = " \t\n\x0b\x0c\r"
_CONV = ["known", "conv"]

# States of the pattern: 0 nothing yet, 1 after the system turn, 2 after a user's, 3 after an assistant's.
_DUE = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_FINAL = [0, NEVER, NEVER, 0]


def _search(codes: str, start: int, ends: list[int], last: bool) -> tuple[int, str]:
    """Least cost and ASCII-least edits of a block from state ``start``; ``ends`` are the costs of ending in each state.

    A code is the role's initial (``o``: any other), in capitals if truncated;
    ``x`` must be deleted.  After the ``last`` block turns may be inserted too.
    """
    n, floor = len(codes), min(ends)
    least = [0] * (n + 1)                               # at least this is needed from a row on
    least[n] = min(floor, NEVER)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE if codes[i] == "x" or codes[i].isupper() else 0)
    needed: dict[tuple[int, int], int] = {}             # failed states: the cost known to be needed from there
    path: list[str] = []

    def deepen(i: int, state: int, left: int) -> int | None:
        """None if accepted, else a cost that is needed at least and exceeds ``left``."""
        known = max(least[i], needed.get((i, state), 0))
        if known > left:
            return known
        best = NEVER
        due, _ = _DUE[state]
        if i == n:
            if ends[state] <= left:
                return None
            best, moves = ends[state], [("I", INSERT, i, due)] if last else []
        else:
            code = codes[i]
            moves = [("D", DELETE, i + 1, state), ("I", INSERT, i, due)]
            if code != "x":
                extra = CUT_OFF if code.isupper() else 0
                kept = _KEEP.get((state, code.lower()))
                if kept is not None:
                    moves.append(("K", extra, i + 1, kept))
                moves.append(("R", REROLE + extra, i + 1, due))
        for letter, cost, row, then in moves:
            over = deepen(row, then, left - cost)
            if over is None:
                path.append(letter)
                return None
            best = min(best, cost + over)
        needed[i, state] = best
        return best

    bound, most = max(0, least[0]), (DELETE + CUT_OFF) * n + 4 * INSERT + max([e for e in ends if e < NEVER], default=0)
    while bound <= most:
        over = deepen(0, start, bound)
        if over is None:
            return bound, "".join(reversed(path))
        bound = over
    return NEVER, ""


def _replay(codes: str, state: int, edits: str) -> tuple[list[tuple[str, str]], int, int]:
    """By row: its edits and the initials that they put in; the state afterwards, and the cost."""
    rows, edit, to, cost, i = [], "", "", 0, 0
    for letter in edits:
        edit += letter
        cost += {"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[letter]
        if letter in "IR":
            state, initial = _DUE[state]
            to += initial
        else:
            to += "-"
        if letter == "I":
            continue
        if letter == "K":
            state = _KEEP[state, codes[i].lower()]
        if letter != "D" and codes[i].isupper():
            cost += CUT_OFF
        rows.append((edit, to))
        edit, to, i = "", "", i + 1
    if edit:                                            # after the last row
        rows[-1] = (rows[-1][0] + edit, rows[-1][1] + to)
    return rows, state, cost


def _chain(codes: str, ends: list[int], last: bool) -> list[list[tuple[int, str]]]:
    """For each block, from each state: the cost from there to the end, and the block's edits."""
    blocks, found = [codes[i:i + BLOCK] for i in range(0, len(codes), BLOCK)], []
    for k in reversed(range(len(blocks))):
        found.append([_search(blocks[k], state, ends, last and k == len(blocks) - 1) for state in range(4)])
        ends = [cost for cost, _ in found[-1]]
    return found[::-1]


def _solve(codes: str, start: int, ends: list[int], last: bool) -> tuple[list[tuple[str, str]], int, int] | None:
    """Edits by row, last state and cost of the least path from ``start``; None if there is none."""
    if len(codes) <= BLOCK:
        cost, edits = _search(codes, start, ends, last)
        return None if cost >= NEVER else _replay(codes, start, edits)
    chain, rows, total, state = _chain(codes, ends, last), [], 0, start
    if chain[0][start][0] >= NEVER:
        return None
    for k, block in enumerate(chain):
        some, state, cost = _replay(codes[k * BLOCK:(k + 1) * BLOCK], state, block[state][1])
        rows, total = rows + some, total + cost
    return rows, state, total


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with some rows damaged, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes its ``.``, ``!`` and ``?``, 3
    repeats it, 4 makes its role user.  A null conv_id or turn is one space in
    that key and stays null; a null role or text becomes one space.  Other
    columns are left out; an empty table stays empty.
    """
    null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(null("conv_id"), F.lit(":"), null("turn")).cast("binary")) % 20
    times = F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1)
    text = F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(null("text"), ".!?", "")).otherwise(null("text"))
    return rows.select("conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(null("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(1), times)).alias("_")).drop("_")


def _placed(rows: DataFrame) -> DataFrame:
    """The rows by conversation and place in it, with their faults; stored."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    body = F.rtrim(text, F.lit(SPACE))
    rows = rows.select(F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
                       F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       F.substring(text, 1, 64).alias("head"), F.sha2(text.cast("binary"), 256).alias("sha"),
                       (F.length(body) == 0).alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    rows = stored(running_total(rows, ["turn", "role", "head", "sha"], F.lit(1), "pos", by=_CONV), "turns")
    same = rows.groupBy(*_CONV, "role", "sha").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    same = stored(same.where("n > 1").drop("n"), "same-turns")
    slim = rows.select(*_CONV, "pos", "turn", "role", "sha", "blank", "cut").join(same, [*_CONV, "role", "sha"], "left")
    fault = (F.when(F.col("blank"), F.lit("blank")).when(F.col("pos") > F.col("first"), F.lit("duplicate"))
             .when(F.col("cut"), F.lit("truncated")).otherwise(F.lit("")))
    return rows, slim.select(*_CONV, "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def _segments(slim: DataFrame) -> DataFrame:
    """Codes of ``SEGMENT`` rows of a conversation at a time, and how many pairs of neighbours are illegal; stored."""
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("o"))
    code = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit("x"))
            .when(F.col("fault") == "truncated", F.upper(known)).otherwise(known))
    at = F.floor(F.col("pos") / SEGMENT)
    shared = F.array(at, at + 1)                        # the last row of a segment is the neighbour of the next one's first
    rows = slim.select(*_CONV, "pos", code.alias("code"), known.alias("initial"), F.explode(
        F.when(F.col("pos") % SEGMENT == SEGMENT - 1, shared).otherwise(F.array(at))).alias("seg"))
    rows = rows.groupBy(*_CONV, "seg").agg(F.sort_array(F.collect_list(F.struct("pos", "code", "initial"))).alias("r"))
    own = F.filter("r", lambda x: x["pos"] >= F.col("seg") * SEGMENT)
    initials = F.array_join(F.transform("r", lambda x: x["initial"]), "")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("r") - 1, F.lit(1))), lambda i: F.substring(initials, i, 2))
    illegal = F.size(F.filter(pairs, lambda p: (F.length(p) == 2) & ~p.isin("su", "ua", "au")))
    rows = rows.select(*_CONV, "seg", F.array_join(F.transform(own, lambda x: x["code"]), "").alias("codes"), illegal.alias("illegal"))
    return stored(rows.where("codes <> ''"), "segments")


def _ends(segments: DataFrame) -> DataFrame:
    """For every segment but the last of a conversation: the costs from its end on, by state."""
    def costs(batches):
        for batch in batches:
            for row in batch.to_pylist():
                by_end = [[c for c, _ in _chain(row["codes"], [0 if e == end else NEVER for e in range(4)], False)[0]] for end in range(4)]
                closing = [c for c, _ in _chain(row["codes"], _FINAL, True)[0]] if row["seg"] == row["last"] else [NEVER] * 4
                yield pa.RecordBatch.from_pylist([{"known": row["known"], "conv": row["conv"], "seg": row["seg"],
                                                   "costs": [by_end[e][s] for s in range(4) for e in range(4)], "closing": closing}],
                                                 schema=pa.schema([("known", pa.bool_()), ("conv", pa.int64()), ("seg", pa.int64()),
                                                                   ("costs", pa.list_(pa.int64())), ("closing", pa.list_(pa.int64()))]))

    def back(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seg", ascending=False)
        found, after = [], None
        for seg, cost, closing in zip(rows["seg"], rows["costs"], rows["closing"]):
            if after is not None:
                found.append((bool(rows["known"].iloc[0]), int(rows["conv"].iloc[0]), int(seg), after))
            after = [int(min(NEVER, min(cost[4 * s + e] + after[e] for e in range(4)))) for s in range(4)] if after else list(map(int, closing))
        return pd.DataFrame(found, columns=["known", "conv", "seg", "ends"])
    return (segments.where("last > 0").mapInArrow(costs, "known boolean, conv long, seg long, costs array<long>, closing array<long>")
            .groupBy(*_CONV).applyInPandas(back, "known boolean, conv long, seg long, ends array<long>"))


def _edits(segments: DataFrame) -> DataFrame:
    """The segments' edits on the least path: ``seg, rows (edit, to), cost``; stored."""
    segments = segments.join(segments.groupBy(*_CONV).agg(F.max("seg").alias("last")), _CONV)
    segments = segments.join(_ends(segments), [*_CONV, "seg"], "left")
    kind = "known boolean, conv long, seg long, start int, end int, cost long, last long, edits array<struct<edit: string, to: string>>"

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                closing = row["seg"] == row["last"]
                for start in range(4) if row["seg"] else (0,):
                    found = _solve(row["codes"], start, _FINAL if closing else row["ends"], closing)
                    if found:
                        edits, end, cost = found
                        out.append((row["known"], row["conv"], row["seg"], start, end, cost, row["last"],
                                    [{"edit": e, "to": t} for e, t in edits]))
            kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
                     pa.list_(pa.struct([("edit", pa.string()), ("to", pa.string())])))
            columns = list(zip(*out)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["known", "conv", "seg", "start", "end", "cost", "last", "edits"])
    found = stored(segments.select(*_CONV, "seg", "last", "codes", "ends").mapInArrow(run, kind), "edits")

    def forward(rows: pd.DataFrame) -> pd.DataFrame:
        ends = {(seg, start): end for seg, start, end in zip(rows["seg"], rows["start"], rows["end"])}
        taken, state = [], 0
        for seg in range(int(rows["seg"].max()) + 1):
            taken.append((bool(rows["known"].iloc[0]), int(rows["conv"].iloc[0]), seg, state))
            state = int(ends[seg, state])
        return pd.DataFrame(taken, columns=["known", "conv", "seg", "start"])
    taken = (found.where("last > 0").select(*_CONV, "seg", "start", "end").groupBy(*_CONV)
             .applyInPandas(forward, "known boolean, conv long, seg long, start int"))
    columns = [*_CONV, "seg", "cost", "edits"]
    return found.where("last = 0").select(*columns).unionByName(found.where("last > 0").join(taken, [*_CONV, "seg", "start"]).select(*columns))


def _lines(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired turns: ``known, conv, pos, k, role, text``."""
    by_row = edits.select(*_CONV, "seg", F.posexplode("edits").alias("i", "e"))
    by_row = by_row.select(*_CONV, (F.col("seg") * SEGMENT + F.col("i")).alias("pos"), "e.edit", "e.to")
    rows = turns.select(*_CONV, "pos", "role", "text").join(by_row, [*_CONV, "pos"])
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.length("edit"))))
    rows = rows.withColumn("edit", F.substring("edit", F.col("k"), F.lit(1))).withColumn("to", F.substring("to", F.col("k"), F.lit(1)))
    role = F.when(F.col("to") == "u", F.lit("user")).when(F.col("to") == "a", F.lit("assistant")).otherwise(F.col("role"))
    text = F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text"))
    return rows.where("edit <> 'D'").select(*_CONV, "pos", "k", role.alias("role"), text.alias("text"))


def _hashed(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines; a line passes through once, in order, and none is gathered."""
    def run(batches):
        at, digest = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([digest.hexdigest()])],
                                                 names=["known", "conv", "repaired_sha256"])
        for batch in batches:
            for known, conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("known", "conv", "role", "text"))):
                if (known, conv) != at:
                    if at is not None:
                        yield row()
                    at, digest = (known, conv), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if at is not None:
            yield row()
    lines = lines.repartition(*_CONV).sortWithinPartitions(*_CONV, "pos", "k")
    return lines.mapInArrow(run, "known boolean, conv long, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place (from 0), role, text``, in the order of ``rows`` and inserted turns.

    Rows of a conversation go by turn (null first), equal turns by role, first
    64 characters and SHA-256 of the text; see ``audit``.
    """
    turns, slim = _placed(rows)
    lines = _lines(turns, _edits(_segments(slim)))
    lines = running_total(lines, ["pos", "k"], F.lit(1), "place", by=_CONV)
    return lines.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), "place", "role", "text")


def audit(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: its gaps and faults, the cheapest repair, its cost and the hash of what it gives.

    ``rows`` has ``conv_id, turn, role, text``; a null role or text is one
    space; all rows with a null conv_id are one conversation.  Of a row counts
    the first fault: ``blank`` (nothing but white space), ``duplicate`` (role
    and text occurred before in the conversation), ``truncated`` (the last
    character that is not white space is none of ``.!?``).  ``gaps`` are the
    turns missing between the least and the greatest one (null turns left
    out), ``illegal`` the neighbours whose initials are not su, ua or au.
    ``audit`` has the edits' initials in order (Delete, Insert, Keep, Rerole);
    a row whose role is empty or begins otherwise cannot be kept.
    ``conversations`` may name more conversations (``conv_id``): without rows
    they have zeros, no edits and the hash of the empty string.  An empty
    table gives no rows.  The hash of a conversation is sequential: its
    repaired turns pass through one task, in sorted order, without being held.
    """
    turns, slim = _placed(rows)
    slim = stored(slim, "faults")
    segments = _segments(slim)
    edits = _edits(segments)
    count = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    faults = slim.groupBy(*_CONV).agg(
        (F.max("turn") - F.min("turn") + 1).alias("span"), count("blank"), count("duplicate"), count("truncated"))
    distinct = slim.where("turn is not null").select(*_CONV, "turn").distinct().groupBy(*_CONV).agg(F.count("*").alias("turns"))
    illegal = segments.groupBy(*_CONV).agg(F.sum("illegal").alias("illegal"))
    letters = F.array_join(F.transform("edits", lambda e: e["edit"]), "")
    paths = edits.select(*_CONV, "seg", "cost", letters.alias("a")).groupBy(*_CONV).agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "a"))), lambda x: x["a"]), "").alias("audit"))
    named = [slim.select(*_CONV)]
    if conversations is not None:
        named.append(conversations.select(F.col("conv_id").isNotNull().alias("known"),
                                          F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")))
    found = named[0].union(named[-1]).distinct()
    for part in (faults, distinct, illegal, paths, _hashed(_lines(turns, edits))):
        found = found.join(part, _CONV, "left")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c)
    return found.select(
        F.when(F.col("known"), F.col("conv")).alias("conv_id"), F.coalesce(F.col("span") - F.col("turns"), F.lit(0)).alias("gaps"),
        zero("blank"), zero("duplicate"), zero("truncated"), zero("illegal"), zero("cost"),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def damaged_audit(rows: DataFrame) -> DataFrame:
    """``audit`` of the damaged rows, for every conversation of ``rows``."""
    return audit(damage(rows), rows.select("conv_id"))

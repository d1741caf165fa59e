"""Repair of conversation structure as a lightest derivation, found by an agenda."""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hashed, plain, stored

BLANKS = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()
#: What an edit costs; a truncated row that isn't deleted costs TRUNCATED more.
KEEP, INSERT, REROLE, DELETE, TRUNCATED = 0, 2, 2, 3, 1
#: States of a reader of `(s?(ua)+)?`: begun, after a first s, after u, after ua. What each may read, and where it then is.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: The turn that an inserted row, or one of another role, takes in each state: the one way on that needs no system row.
WANTED = ["user", "user", "assistant", "user"]
FINAL = (0, 3)
#: Rows of a piece that is derived at once.
PIECE = 256
Row = tuple[str, str, str]
Table = dict[tuple[int, int], tuple[int, str]]


def edits(initial: str, fault: str) -> list[tuple[int, str]]:
    """What may be done to a row, with its cost: blank and duplicate rows can only go."""
    if fault in ("blank", "duplicate"):
        return [(DELETE, "D")]
    more = TRUNCATED if fault == "truncated" else 0
    return [(DELETE, "D"), (KEEP + more, "K"), (REROLE + more, "R")]


def derive(rows: list[tuple[str, str]], entries: tuple[int, ...] = (0, 1, 2, 3)) -> Table:
    """Lightest (cost, audit) by which a piece of rows (initial, fault) leads the reader from one state to another.

    A weighted deduction system: axioms edit(i, e), one for each edit of row i, and span(q, 0, q); rules
    span(q, i, r) edit(i, e) -> span(q, i + 1, r') and span(q, i, r) -> span(q, i, r') by an insertion. The cost and audit of a conclusion
    never come before those of its premises, so an item is final when it is popped. (Of two audits of equal cost for one item neither
    begins the other, as both hold an edit for each row and insertions cost; so what is appended keeps their order.)
    """
    n = len(rows)
    agenda: list[tuple[int, str, tuple]] = [(0, "", ("span", q, 0, q)) for q in entries]
    for i, row in enumerate(rows):
        agenda += [(cost, letter, ("edit", i, letter)) for cost, letter in edits(*row)]
    heapq.heapify(agenda)
    final: dict[tuple, tuple[int, str]] = {}
    known_edits: list[list[tuple[int, str]]] = [[] for _ in rows]
    known_spans: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]

    def apply(q: int, i: int, r: int, cost: int, letter: str) -> None:
        role = "" if letter == "D" else rows[i][0] if letter == "K" else WANTED[r][0]
        to = r if letter == "D" else NEXT[r].get(role)
        if to is not None and ("span", q, i + 1, to) not in final:
            c, audit = final["span", q, i, r]
            heapq.heappush(agenda, (c + cost, audit + letter, ("span", q, i + 1, to)))

    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if item[0] == "edit":
            i = item[1]
            known_edits[i].append((cost, audit))
            for q, r in known_spans[i]:
                apply(q, i, r, cost, audit)
            continue
        _, q, i, r = item
        known_spans[i].append((q, r))
        to = NEXT[r][WANTED[r][0]]
        if ("span", q, i, to) not in final:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", ("span", q, i, to)))
        for c, letter in known_edits[i] if i < n else ():
            apply(q, i, r, c, letter)
    return {(item[1], item[3]): found for item, found in final.items() if item[0] == "span" and item[2] == n}


def joined(left: Table, right: Table) -> Table:
    """Lightest ways through one piece and then the next: the same rule, with a whole piece as its second premise."""
    out: Table = {}
    for (q, r), (c1, a1) in left.items():
        for (s, t), (c2, a2) in right.items():
            if r == s and ((q, t) not in out or (c1 + c2, a1 + a2) < out[q, t]):
                out[q, t] = c1 + c2, a1 + a2
    return out


def lightest(tables: list[Table]) -> tuple[int, str]:
    whole = tables[0] if tables else {(0, 0): (0, "")}
    for t in tables[1:]:
        whole = joined(whole, t)
    return min(whole[0, q] for q in FINAL if (0, q) in whole)


def fault_of(text: str, seen: bool) -> str:
    """A row's first fault."""
    kept = text.strip(BLANKS)
    return "blank" if not kept else "duplicate" if seen else "truncated" if kept[-1] not in ".!?" else ""


def repaired(rows: list[tuple[str, str]], audit: str, state: int = 0):
    """The lines `role:text` that an audit makes of rows (role, text), and the state of the reader after each."""
    at = 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        role, text = (WANTED[state], "") if letter == "I" else rows[at]
        role = WANTED[state] if letter == "R" else role
        at += letter != "I"
        state = NEXT[state][role[0]]
        yield f"{role}:{text}", state


def legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, by crc32 of `conv_id:turn` modulo 20: 0 gone, 1 empty, 2 without `[.!?]`, 3 twice, 4 a user's.

    Nulls become one space, but in conv_id and turn themselves. A row that goes stays with `gone` set, so that its conversation is known.
    """
    rows = plain(conversations, conv_id="long", turn="long", role="string", text="string")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(name("text"), ".!?", "")).when(kind != 0, name("text"))
    out = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(name("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
    return out.select("*", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "col")


OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    """All conversations of a pack."""
    table = table.sort_by([(c, "ascending") for c in ("conv_id", "turn", "role", "text")])
    held: dict = {}
    for conv, turn, role, text, gone in zip(*(table.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")), strict=True):
        rows = held.setdefault(conv, [])
        if not gone:
            rows.append((turn, role, text))
    out: list[tuple] = []
    for conv, rows in held.items():
        # Arrow sorts nulls last
        rows.sort(key=lambda r: r[0] is not None)
        seen, faults = set(), []
        for _, role, text in rows:
            faults.append(fault_of(text, (role, text) in seen))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        marked = [(role[:1], fault) for (_, role, _), fault in zip(rows, faults, strict=True)]
        cost, audit = lightest([derive(marked[a : a + PIECE], (0,) if a == 0 else (0, 1, 2, 3)) for a in range(0, len(rows), PIECE)])
        whole = "\n".join(line for line, _ in repaired([r[1:] for r in rows], audit))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(not legal(a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False))
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()))
    return _table(out)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], [c.split()[0] for c in OUT.split(", ")])


def repair(rows: DataFrame, pack_bytes: int = 6 << 20, most: int = 20_000, most_bytes: int = 4 << 20) -> DataFrame:
    """rows: conv_id, turn, role, text, gone. Returns for each conversation what is wrong, and its cheapest repair.

    gaps, blank, duplicate, truncated, illegal, cost; audit (the edits' initials in order: of the cheapest that give the roles
    `(s?(ua)+)?` the least string); repaired_sha256 of the repaired `role:text` lines.

    Rows go by turn (nulls first), those of one turn by role and text. Conversations of at most `most` rows and `most_bytes` of text
    are dealt in packs and derived whole; longer ones are cut in pieces, each derived from every state by a task of its own, and only
    the pieces' tables are brought together (see _long). A null conv_id is one conversation. An empty table gives no rows.
    """
    size = stored(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b")))
    total = size.agg(F.sum("b"), F.sum("n")).first()
    long = size.filter((F.col("n") > most) | (F.col("b") > most_bytes)).select("conv_id")
    packs = max(1, -(-((total[0] or 0) + 64 * (total[1] or 0)) // pack_bytes))
    small = rows
    if not (none := long.isEmpty()):
        small = rows.join(long, rows["conv_id"].eqNullSafe(long["conv_id"]), "left_anti")
    out = small.withColumn("pack", hashed(packs, "conv_id")).groupBy("pack").applyInArrow(_packed, OUT)
    return out if none else out.unionByName(_long(rows.join(long, rows["conv_id"].eqNullSafe(long["conv_id"]), "left_semi")))


def _pieces(batches):
    """Sorted rows of long conversations cut in pieces: each row with its piece and the piece's ways; kept in this order."""
    held: list[tuple] = []
    piece = 0

    def flush():
        nonlocal held, piece
        table = derive([(role[:1], fault_of(text, seen)) for _, _, role, text, seen in held])
        faults = [fault_of(text, seen) for _, _, _, text, seen in held]
        ways = [(q, t, c, a) for (q, t), (c, a) in table.items()]
        first, last = held[0], held[-1]
        turns = [h[1] for h in held if h[1] is not None]
        out = {
            "conv_id": first[0], "piece": piece, "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}, "illegal": sum(not legal(a[2], b[2]) for a, b in zip(held, held[1:], strict=False)),
            "head": first[2][:1], "tail": last[2][:1], "ways": [dict(zip(("q", "t", "cost", "audit"), w, strict=True)) for w in ways],
            "roles": [h[2] for h in held], "texts": [h[3] for h in held],
        }
        held, piece = [], piece + 1
        return pa.RecordBatch.from_pylist([out], PIECES)

    size = 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "seen")), strict=True):
            if held and (row[0] != held[0][0] or len(held) == PIECE or size > 4 << 20):
                yield flush()
                size = 0
            held.append(row)
            size += len(row[3])
    if held:
        yield flush()


PIECES = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), *[(f, pa.int64()) for f in ("blank", "duplicate", "truncated", "illegal")], ("head", pa.string()), ("tail", pa.string()), ("ways", pa.list_(pa.struct([("q", pa.int64()), ("t", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
PIECES_SQL = "conv_id long, piece long, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, head string, tail string, ways array<struct<q: long, t: long, cost: long, audit: string>>, roles array<string>, texts array<string>"


def _chosen(key: tuple, table: pa.Table) -> pa.Table:
    """The ways of all pieces of a conversation brought together: its counts, and the state and audit with which each piece begins.

    Only ways come here, a few letters for each row. Halves are joined before they are joined with others, as in a tree.
    """
    table = table.sort_by([("part", "ascending"), ("piece", "ascending")])
    rows = table.to_pylist()
    tables: list[Table] = [{(w["q"], w["t"]): (w["cost"], w["audit"]) for w in r["ways"]} for r in rows]
    level = [tables]
    while len(level[-1]) > 1:
        t = level[-1]
        level.append([joined(t[i], t[i + 1]) if i + 1 < len(t) else t[i] for i in range(0, len(t), 2)])
    cost, audit = lightest(level[-1])
    gaps, last, turns = 0, None, 0
    for r in rows:
        if r["first_turn"] is not None:
            turns += r["turns"] - (r["first_turn"] == last)
            last = r["last_turn"]
    known = [r["first_turn"] for r in rows if r["first_turn"] is not None]
    gaps = last - known[0] + 1 - turns if known else 0
    illegal = sum(r["illegal"] for r in rows) + sum(not legal(a["tail"], b["head"]) for a, b in zip(rows, rows[1:], strict=False))
    # the audit is cut where a piece's rows are used up; insertions between two pieces go with the later
    out, at, state = [], 0, 0
    for r in rows:
        need, end = r["n_rows"], at
        while need:
            need -= audit[end] != "I"
            end += 1
        if r is rows[-1]:
            end = len(audit)
        out.append({"conv_id": r["conv_id"], "part": r["part"], "piece": r["piece"], "state": state, "edits": audit[at:end]})
        for letter, initial in _letters(audit[at:end], r["initials"]):
            if letter != "D":
                state = NEXT[state][initial if letter == "K" else WANTED[state][0]]
        at = end
    counts = {f: sum(r[f] for r in rows) for f in ("blank", "duplicate", "truncated")}
    whole = {"gaps": gaps, **counts, "illegal": illegal, "cost": cost, "audit": audit}
    return pa.Table.from_pylist([{**o, "order": i, "whole": whole if i == 0 else None} for i, o in enumerate(out)], CHOSEN)


def _letters(audit: str, initials: str):
    at = 0
    for letter in audit:
        yield letter, "" if letter == "I" else initials[at]
        at += letter != "I"


CHOSEN = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("state", pa.int64()), ("edits", pa.string()), ("order", pa.int64()), ("whole", pa.struct([*[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())]))])
CHOSEN_SQL = "conv_id long, part long, piece long, state long, edits string, order long, whole struct<gaps: long, blank: long, duplicate: long, truncated: long, illegal: long, cost: long, audit: string>"


def _hash(batches):
    """SHA-256 of each conversation from its pieces' lines, which come in order; nothing but the state of the hash is held."""
    now, digest, some, whole = None, None, False, None
    for b in batches:
        for r in b.to_pylist():
            if digest is None or r["conv_id"] != now:
                if digest is not None:
                    yield _row(now, whole, digest)
                now, digest, some = r["conv_id"], hashlib.sha256(), False
            whole = whole if r["order"] else r["whole"]
            if r["lines"] is not None:
                digest.update((b"\n" if some else b"") + r["lines"])
                some = True
    if digest is not None:
        yield _row(now, whole, digest)


def _row(conv, whole: dict, digest) -> pa.RecordBatch:
    return _table([(conv, *(whole[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")), digest.hexdigest())]).to_batches()[0]


def _lines(batches):
    for b in batches:
        for r in b.to_pylist():
            lines = [line for line, _ in repaired(list(zip(r["roles"], r["texts"], strict=True)), r["edits"], r["state"])]
            yield pa.RecordBatch.from_pylist([{**{c: r[c] for c in ("conv_id", "order", "whole")}, "lines": "\n".join(lines).encode() if lines else None}], LINES)


LINES = pa.schema([("conv_id", pa.int64()), ("order", pa.int64()), ("whole", CHOSEN.field("whole").type), ("lines", pa.binary())])


def _long(rows: DataFrame) -> DataFrame:
    """Conversations that are too long for one task.

    Rows are sorted over all tasks by range, so a conversation lies in many of them; each task derives its pieces from every state.
    The pieces' ways, without texts, meet by conversation; the audit goes back to the pieces, which make their lines. SHA-256 takes
    a conversation's lines one after another: one task streams them and holds only the hash.
    """
    digest = F.sha2(F.concat_ws(":", "role", "text").cast("binary"), 256)
    there = rows.filter(~F.col("gone")).withColumn("seen", F.row_number().over(Window.partitionBy("conv_id", "role", digest).orderBy(F.col("turn").asc_nulls_first())) > 1)
    dealt = there.withColumn("head", F.left("text", F.lit(32))).repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "role", "head")
    ordered = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen").select("conv_id", "turn", "role", "text", "seen")
    pieces = stored(ordered.mapInArrow(_pieces, PIECES_SQL).withColumn("part", F.spark_partition_id().cast("long")))
    ways = pieces.select("*", F.size("roles").cast("long").alias("n_rows"), F.array_join(F.transform("roles", lambda r: F.coalesce(F.nullif(F.left(r, F.lit(1)), F.lit("")), F.lit(" "))), "").alias("initials")).drop("roles", "texts")
    chosen = stored(ways.groupBy("conv_id").applyInArrow(_chosen, CHOSEN_SQL))
    # part and piece alone name a piece, so that a null conversation joins as well
    lines = pieces.select("part", "piece", "roles", "texts").join(chosen, ["part", "piece"]).mapInArrow(_lines, "conv_id long, order long, whole " + CHOSEN_SQL.split("whole ")[1] + ", lines binary")
    streamed = lines.repartition("conv_id").sortWithinPartitions("conv_id", "order").mapInArrow(_hash, OUT)
    nothing = rows.groupBy("conv_id").agg(F.min("gone").alias("gone")).filter("gone").select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.lit("").alias("audit"), F.lit(EMPTY).alias("repaired_sha256"))
    return streamed.unionByName(nothing)


def op12_conversation_repair(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations))

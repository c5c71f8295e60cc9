"""Operator 12: repair of conversations, by rank-convergence parallel Viterbi.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.  The
cheapest edits that make it so are found from backward costs: for each row and each
of the four states of that expression, what the rest costs.

Rows are put in one global order (conversation, turn) by ranges and cut into blocks
of ``BLOCK`` rows, whatever conversations those hold, so a conversation of any length
is dealt over many tasks.  Parts of conversations inside a block are solved at once.
A part that goes on in the next block starts from a speculative cost vector; then
passes hand each part the vector that its right neighbour came to, and those with
another one than they used are run again, from the right, until the vector differs
from the earlier run's only by a constant: from there on both runs choose alike.  When no part
is run again, the costs are exact up to constants, which add up.  Tracing runs the other
way in the same manner: a part guesses the state in which it is entered, and is traced again if
its left neighbour leaves in another one.

Only sums, vectors and edits pass between blocks.  The digest of a repaired
conversation is one SHA-256, which can only be taken in order: its rows stream through a
task, of which that task holds one block's edits, the hash and the audit.

Defined results: a null role or text is one space, as is a null id or turn in
the damage's key; null ids are one conversation; null turns come first and count
for no gap; rows of one turn go by role, then by the first code points of the text, then by its
hash; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut, small_batches

BLOCK = 1024
SPACE = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a row that stays cut off.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: States are 0 (nothing yet), 1 (s), 2 (..u) and 3 (..ua): where a kept row of a class
#: leads, and where an inserted or renamed one does.
LEADS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT, MADE = (2, 2, 3, 2), {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}
CLASSES, FAULTS, FIRST = "suax", ".bdt", 64
#: What is left at the end, as cost and as edits; the vector and the state guessed at a border.
END, LAST = bytes((0, 2 * INSERT, INSERT, 0)), ("", "II", "I", "")
GUESS, ENTERED = bytes(4), 3


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by the hash of conversation and turn."""
    filled = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    chosen = filled.withColumn("kind", F.crc32(named.cast("binary")) % 20).where("kind <> 0")
    return chosen.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """conv (the id as text), turn, role, text and pos, the place in the order of all
    rows, without gaps.  Of the order only the number of rows in each partition is collected."""
    keyed = rows.select(
        "*", F.substring("text", 1, 16).alias("head"), F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("copy")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "head", "hash", "copy"))]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut(ranged.select(F.col("conv_id").cast("string").alias("conv"), "turn", "role", "text", F.monotonically_increasing_id().alias("id")))
    part = F.shiftright("id", 33).cast("int")
    sizes = sorted((r["part"], r["n"]) for r in ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for k, n in sizes:
        starts.append((k, before))
        before += n
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "part int, before long"))
    whole = ranged.withColumn("part", part).join(starts, "part")
    return whole.select("conv", "turn", "role", "text", (F.col("before") + F.col("id").bitwiseAND((1 << 33) - 1)).alias("pos"))


def row_code(kind: Column, fault: Column) -> Column:
    """Class of the role and fault of a row, in one character."""
    return F.char(F.lit(FIRST - 1) + 4 * (F.instr(F.lit(CLASSES), kind) - 1) + F.instr(F.lit(FAULTS), fault))


def of_code(code: str) -> tuple[str, str]:
    return CLASSES[(ord(code) - FIRST) // 4], FAULTS[(ord(code) - FIRST) % 4]


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """block, convs, codes: conversation and code of each of ``size`` rows in order.
    Texts stay behind; equal rows of a conversation are found by their digest."""
    body, initial = F.rtrim("text", F.lit(SPACE)), F.substring("role", 1, 1)
    content = F.concat(F.coalesce("conv", F.lit("-")), F.lit("|"), F.length("role").cast("string"), F.lit(":"), "role", "text")
    # A blank row equals none: its place is its key.
    key = F.when(body == "", F.col("pos").cast("string").cast("binary")).otherwise(F.unhex(F.sha2(content, 256)))
    narrow = rows.select(
        "pos", "conv", key.alias("key"), F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("kind"),
        F.when(body == "", "b").when(F.right(body, F.lit(1)).isin(".", "!", "?"), ".").otherwise("t").alias("fault"),
    )
    first = narrow.groupBy("key").agg(F.min("pos").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    fault = F.when((F.col("pos") > F.col("first")) & (F.col("fault") != "b"), "d").otherwise(F.col("fault"))
    coded = narrow.join(first, "key", "left").select("pos", "conv", row_code(F.col("kind"), fault).alias("code"))
    inside = F.array_sort(F.collect_list(F.struct("pos", "conv", "code"))).alias("of")
    return coded.groupBy(F.floor(F.col("pos") / size).cast("long").alias("block")).agg(inside).select("block", F.col("of.conv").alias("convs"), F.col("of.code").alias("codes"))


class Steps:
    """One row's step of the costs and of the trace.  Vectors are kept with least cost
    0 (four bytes); there are few of them, so each step is worked out once."""

    def __init__(self):
        self.costs: dict = {}
        self.moves: dict = {}

    @staticmethod
    def _options(after: bytes, code: str, q: int) -> list[tuple[int, str, int]]:
        (kind, fault), found = of_code(code), [(DELETE + after[q], "D", q)]
        if fault not in "bd":
            more = CUT_OFF * (fault == "t")
            if (to := LEADS.get((q, kind))) is not None:
                found.append((more + after[to], "K", to))
            found.append((REROLE + more + after[NEXT[q]], "R", NEXT[q]))
        return found

    def back(self, after: bytes, code: str) -> tuple[bytes, int]:
        """The vector before a row, and the constant taken off."""
        if (found := self.costs.get((after, code))) is None:
            here = [min(self._options(after, code, q))[0] for q in range(4)]
            for _ in range(2):
                here = [min(here[q], INSERT + here[NEXT[q]]) for q in range(4)]
            found = self.costs[after, code] = bytes(x - min(here) for x in here), min(here)
        return found

    def forth(self, after: bytes, code: str, q: int) -> tuple[str, int]:
        """The least edits, of the cheapest, up to and with a row, and the state then."""
        if (found := self.moves.get((after, code, q))) is None:
            vector, off = self.back(after, code)
            ways = {edit: ("", to) for cost, edit, to in self._options(after, code, q) if cost == vector[q] + off}
            if vector[q] == INSERT + vector[NEXT[q]]:
                ways["I"] = self.forth(after, code, NEXT[q])
            edit = min(ways)
            found = self.moves[after, code, q] = edit + ways[edit][0], ways[edit][1]
        return found


def costs(steps: Steps, codes: str, right: bytes, earlier: bytes | None = None) -> bytes:
    """The vectors before each row, and ``right`` at the end.  Where an earlier run had the
    same vector (its costs differ by a constant), the rest is taken from it."""
    out = [right]
    for at in range(len(codes) - 1, -1, -1):
        right = steps.back(right, codes[at])[0]
        if earlier is not None and right == earlier[4 * at : 4 * at + 4]:
            out.append(earlier[: 4 * at + 4])
            break
        out.append(right)
    return b"".join(reversed(out))


def trace(steps: Steps, codes: str, vectors: bytes, q: int, ends: bool) -> tuple[str, int]:
    """Edits from state ``q`` and the state at the end; at the end of the conversation the rest is inserted."""
    made = []
    for at, code in enumerate(codes):
        edits, q = steps.forth(vectors[4 * at + 4 : 4 * at + 8], code, q)
        made.append(edits)
    return "".join(made) + (LAST[q] if ends else ""), q


def total(steps: Steps, codes: str, vectors: bytes, begins: bool) -> int:
    """What a part adds to the cost of its conversation."""
    return sum(steps.back(vectors[4 * at + 4 : 4 * at + 8], code)[1] for at, code in enumerate(codes)) + (vectors[0] if begins else 0)


COUNTS = ("blank", "duplicate", "truncated", "illegal")
PART = "conv string, block long, open_left boolean, open_right boolean, codes string, vectors binary, entered int, left_in int, edits string, cost long, " + ", ".join(f"{c} long" for c in COUNTS)
COLUMNS = [c.split()[0] for c in PART.split(", ")]


def _parts(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks to parts of conversations; those that lie in one block are solved."""
    steps = Steps()
    for frame in blocks:
        out = []
        for b in frame.itertuples(index=False):
            convs, start = list(b.convs), 0
            for end in range(1, len(convs) + 1):
                if end < len(convs) and convs[end] == convs[start]:
                    continue
                codes = "".join(b.codes[start:end])
                open_left = start == 0 and b.has_prev is True and b.prev_conv == convs[0]
                open_right = end == len(convs) and b.has_next is True and b.next_conv == convs[start]
                kinds = [of_code(c)[0] for c in ([b.prev_code] if open_left else []) + list(codes)]
                faults = [of_code(c)[1] for c in codes]
                counts = [faults.count(f) for f in "bdt"] + [sum(x + y not in LEGAL for x, y in zip(kinds, kinds[1:], strict=False))]
                vectors = costs(steps, codes, GUESS if open_right else END)
                q = ENTERED if open_left else 0
                edits, left_in = ("", -1) if open_left or open_right else trace(steps, codes, vectors, 0, True)
                out.append((convs[start], b.block, open_left, open_right, codes, vectors, q, left_in, edits, total(steps, codes, vectors, not open_left), *counts))
                start = end
        yield pd.DataFrame(out, columns=COLUMNS)


def _again_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    steps = Steps()
    for frame in frames:
        changed = []
        for i, (codes, vectors, given) in enumerate(zip(frame["codes"], frame["vectors"], frame["given"], strict=True)):
            changed.append(given is not None and bytes(given) != bytes(vectors[-4:]))
            if changed[-1]:
                frame.at[i, "vectors"] = costs(steps, codes, bytes(given), bytes(vectors))
        yield frame[COLUMNS].assign(changed=changed)


def _again_forth(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    steps = Steps()
    for frame in frames:
        out = []
        for p in frame.itertuples(index=False):
            given = p.entered if pd.isna(p.given) else int(p.given)
            if changed := p.left_in < 0 or given != p.entered:
                vectors = bytes(p.vectors)
                edits, left_in = trace(steps, p.codes, vectors, given, not p.open_right)
                p = p._replace(entered=given, left_in=left_in, edits=edits, cost=total(steps, p.codes, vectors, not p.open_left))
            out.append((*p[: len(COLUMNS)], changed))
        yield pd.DataFrame(out, columns=[*COLUMNS, "changed"])


def _passes(parts: DataFrame, mine: str, theirs: str, step: int, handed: Column, again) -> DataFrame:
    """Hand each part what the part in the next block (``step``) came to, and run those
    again that had used another, until none had."""
    while True:
        given = parts.where(theirs).select((F.col("block") - step).alias("block"), F.lit(True).alias(mine), handed.alias("given"))
        parts = cut(parts.join(given, ["block", mine], "left").select(*COLUMNS, "given").mapInPandas(again, f"{PART}, changed boolean"))
        if parts.where("changed").isEmpty():
            return parts.drop("changed")
        parts = parts.drop("changed")


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A stream of each conversation's parts and rows in order to its result."""
    now: dict = {}

    def put(role: str, text: str) -> None:
        now["hash"].update(f"{chr(10) if now['any'] else ''}{role}:{text}".encode())
        now["any"] = True

    def inserts() -> None:
        while now["at"] < len(now["edits"]) and now["edits"][now["at"]] == "I":
            now["at"] += 1
            now["q"] = NEXT[now["q"]]
            put(MADE[now["q"]], "")

    def done() -> tuple:
        inserts()
        least, most, distinct = now["turns"]
        gaps = most - least + 1 - distinct if distinct else 0
        return now["conv"], gaps, *now["sums"], "".join(now["audit"]), now["hash"].hexdigest()

    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            if not now or now["conv"] != r.conv:
                if now:
                    out.append(done())
                now.update(conv=r.conv, hash=hashlib.sha256(), any=False, q=0, audit=[], sums=[0] * 5, edits="", at=0, turns=(0, 0, 0))
            if r.row == 0:
                inserts()
                now.update(edits=r.edits, at=0, sums=[a + int(b) for a, b in zip(now["sums"], r[7:12], strict=True)])
                now["audit"].append(r.edits)
                continue
            inserts()
            edit = now["edits"][now["at"]]
            now["at"] += 1
            if edit == "K":
                now["q"] = LEADS[now["q"], r.role[:1]]
                put(r.role, r.text)
            elif edit == "R":
                now["q"] = NEXT[now["q"]]
                put(MADE[now["q"]], r.text)
            if r.turn is not None:
                turn, (least, most, distinct) = int(r.turn), now["turns"]
                now["turns"] = (least if distinct else turn, turn, distinct + (not distinct or turn != most))
        yield pd.DataFrame(out, columns=["conv", "gaps", *COUNTS, "cost", "audit", "repaired_sha256"])
    if now:
        yield pd.DataFrame([done()], columns=["conv", "gaps", *COUNTS, "cost", "audit", "repaired_sha256"])


def repaired(conversations: DataFrame, damage: bool = True, size: int = BLOCK) -> DataFrame:
    """One row for each conversation of ``conversations`` (conv_id, turn, role, text): its
    faults, the cheapest repair's cost, its edits and the digest of what it gives."""
    small_batches(conversations.sparkSession)
    plain = conversations.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = placed(damaged(conversations) if damage else plain)
    inside = cut(blocks(rows, size))
    before = inside.select((F.col("block") + 1).alias("block"), F.lit(True).alias("has_prev"), F.element_at("convs", -1).alias("prev_conv"), F.element_at("codes", -1).alias("prev_code"))
    behind = inside.select((F.col("block") - 1).alias("block"), F.lit(True).alias("has_next"), F.element_at("convs", 1).alias("next_conv"))
    parts = cut(inside.join(before, "block", "left").join(behind, "block", "left").mapInPandas(_parts, PART))
    across = parts.where("open_left or open_right")
    across = _passes(across, "open_right", "open_left", 1, F.substring("vectors", 1, 4), _again_back)
    across = _passes(across, "open_left", "open_right and left_in >= 0", -1, F.col("left_in"), _again_forth)
    solved = parts.where("not (open_left or open_right)").unionByName(across)
    head = ("conv", "block", "row", "pos")
    edits = solved.select("conv", "block", F.lit(0).alias("row"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), *COUNTS, "cost", "edits")
    none = [F.lit(0).cast("long").alias(c) for c in (*COUNTS, "cost")]
    texts = rows.select("conv", F.floor(F.col("pos") / size).cast("long").alias("block"), F.lit(1).alias("row"), "pos", F.col("turn").cast("string").alias("turn"), "role", "text", *none, F.lit("").alias("edits"))
    stream = edits.unionByName(texts).repartition("conv").sortWithinPartitions(*head)
    found = stream.mapInPandas(_finish, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].cast("string").eqNullSafe(found["conv"]), "left")
    empty = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS, "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )

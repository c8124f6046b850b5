"""Conversation structure repair on a suffix-shared automaton (DAWG) of role/fault signatures.

1. ``faults`` marks every row's first fault (blank, duplicate, truncated); ``signatures`` writes each
   conversation as one sign per row, in turn order, with its counts. Only keys, digests and signs are
   shuffled, no text; the duplicate marks are found per (conversation, digest of role and text).
2. ``audits`` deals conversations by ranges of the signature read from its end. Inside a range,
   signatures with a common ending follow each other, so the automaton grows by the rows in which a
   signature differs from the one before: a node is a suffix, and its cost-to-go and best next edit
   are computed once for each of the grammar's four states. A frequent signature is spread over
   ranges by the conversation's id.
3. ``repaired`` streams rows by conversation, with the audit first, and applies the edits: as rows,
   or as a digest fed row by row.

Edits are Keep (0), Rerole to user or assistant (3), Delete (4; the only one for blank and duplicate
rows) and Insert of an empty user or assistant row (3); a truncated row that stays costs 3 more. The
cheapest edits give role initials ``(s?(ua)+)?``. In each state only one role can be inserted or
assigned, so an audit (the edits' initials) has one result, and equal costs are told apart by the
next initial (D < I < K < R): the audit is the least of the cheapest.

Cases: a null role or text is one space; null turns come first and count in no gap; rows of one turn
are ordered by a digest of role and text; repeated rows are duplicates; a null conv_id is a
conversation of its own; a conversation without rows (all dropped) has zeros and an empty audit;
an empty table gives an empty result; extra columns are ignored. A conversation's signature and audit
take one byte a row; its texts are streamed through one task, which a digest of the whole needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or assigned role leads to, and the role that it is.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: (state, initial of a kept row) -> state
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, live: the rows after the damage that a checksum of ``conv_id:turn``
    selects. A dropped row stays as one that is not ``live``, so its conversation is not lost."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn)).cast("binary")) % 20
    own = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), plain(role).alias("role"), plain(text).alias("text"), kind.alias("kind"))
    worse = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.col("kind") != 0)))
    return own.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), worse.alias("text"), copies.alias("live"))


def _digest() -> F.Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, k (digest of role and text), live, initial, fault (blank, duplicate, truncated or
    null) of ``damage``d rows."""
    body = F.btrim("text", F.lit(C.WS))
    own = rows.select("conv_id", "turn", "live", _digest().alias("k"), F.substring("role", 1, 1).alias("initial"),
                      (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(*ENDS)).alias("cut"))
    same = Window.partitionBy("conv_id", "live", "k").orderBy(F.asc_nulls_first("turn"))
    fault = F.when(F.col("blank"), "blank").when(F.row_number().over(same) > 1, "duplicate").when(F.col("cut"), "truncated")
    return own.select("conv_id", "turn", "k", "live", "initial", fault.alias("fault"))


def signatures(marked: DataFrame) -> DataFrame:
    """conv_id, signature, gaps, blank, duplicate, truncated, illegal of every conversation.

    Signs: d for a row that has to go, else the role's initial (s, u, a, or o for any other), as a
    capital where the row is truncated.
    """
    base = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    sign = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(base)).otherwise(base)
    one = F.when(F.col("live"), F.struct("turn", "k", F.col("fault").eqNullSafe("duplicate"), F.col("initial").alias("i"), sign.alias("s")))
    count = lambda name: F.count_if(F.col("live") & (F.col("fault") == name)).alias(name)
    rows = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("rows"), count("blank"), count("duplicate"), count("truncated"))
    own = rows.select("conv_id", F.transform("rows", lambda r: r["s"]).alias("signs"), F.transform("rows", lambda r: r["i"]).alias("initials"),
                      F.array_compact(F.array_distinct(F.transform("rows", lambda r: r["turn"]))).alias("turns"), "blank", "duplicate", "truncated")
    gaps = F.when(F.size("turns") > 0, F.array_max("turns") - F.array_min("turns") + 1 - F.size("turns")).otherwise(0).cast("long")
    pairs = F.zip_with(F.slice("initials", 1, F.greatest(F.size("initials") - 1, F.lit(0))), F.slice("initials", 2, F.greatest(F.size("initials") - 1, F.lit(0))), lambda x, y: F.concat(x, y))
    illegal = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long")
    return own.select("conv_id", F.array_join("signs", "").alias("signature"), gaps.alias("gaps"), "blank", "duplicate", "truncated", illegal.alias("illegal"))


class Node:
    """A suffix of signatures: for each grammar state its cost-to-go, the best next edit, and where
    that leads (node and state)."""

    __slots__ = ("cost", "edit", "then")

    def __init__(self, sign: str | None = None, rest: Node | None = None):
        options: list[list[tuple]] = []
        for state in range(4):
            if rest is None:
                own = [(0, "", None, state)] if state in (START, ASSISTANT) else []
            else:
                own = [(DELETE + rest.cost[state], "D", rest, state)]
                if sign != "d":
                    more = CUT if sign.isupper() else 0
                    if (kept := KEPT.get((state, sign.lower()))) is not None:
                        own.append((KEEP + more + rest.cost[kept], "K", rest, kept))
                    own.append((REROLE + more + rest.cost[NEXT[state]], "R", rest, NEXT[state]))
            options.append(own)
        best = [min(own, key=lambda o: o[:2]) if own else None for own in options]
        for state in (USER, ASSISTANT, USER, START, SYSTEM):  # an inserted row leads to a state of the same node
            after = best[NEXT[state]]
            if after is not None:
                insert = (INSERT + after[0], "I", self, NEXT[state])
                if best[state] is None or insert[:2] < best[state][:2]:
                    best[state] = insert
        self.cost, self.edit = [b[0] for b in best], [b[1] for b in best]
        self.then = [b[2:] for b in best]


END = Node()


class Suffixes:
    """The automaton's nodes along the last signature; shared endings are kept."""

    def __init__(self):
        self.signature, self.nodes = "", [END]  # nodes[i] stands for the last i signs

    def audit(self, signature: str) -> tuple[int, str]:
        backwards, before = signature[::-1], self.signature[::-1]
        shared = next((i for i, (x, y) in enumerate(zip(backwards, before)) if x != y), min(len(backwards), len(before)))
        del self.nodes[shared + 1:]
        for sign in backwards[shared:]:
            self.nodes.append(Node(sign, self.nodes[-1]))
        self.signature = signature
        node, state, out = self.nodes[-1], START, []
        cost = node.cost[state]
        while node is not None:
            out.append(node.edit[state])
            node, state = node.then[state]
        return cost, "".join(out)


def audits(signed: DataFrame) -> DataFrame:
    """``signatures`` rows with cost and audit in place of the signature."""
    backwards = F.reverse("signature")
    dealt = signed.repartitionByRange(backwards, "conv_id").sortWithinPartitions(backwards, "conv_id").select("conv_id", *COUNTS, "signature")
    schema = T.StructType(dealt.schema.fields[:-1]).add("cost", "long").add("audit", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Suffixes()
        for b in batches:
            found = [known.audit(s) for s in b.column(len(COUNTS) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], schema.names)

    return dealt.mapInArrow(run, schema)


class Repair:
    """Applies one conversation's audit to its rows, given in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _insert(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at: self.at + 1] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, role[0]]
            yield role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield ROLE[self.state], text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._insert()


def _streamed(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """All rows by conversation: the one with the audit first, then the conversation's in order."""
    empty = lambda names, schema: [F.lit(None).cast(schema[n].dataType).alias(n) for n in names]
    live = rows.filter("live").select("conv_id", "turn", _digest().alias("k"), "role", "text")
    told = [*COUNTS, "cost", "audit"]
    first = audited.select("conv_id", F.lit(0).alias("kind"), *empty(["turn", "k", "role", "text"], live.schema), *told)
    both = first.union(live.select("conv_id", F.lit(1).alias("kind"), "turn", "k", "role", "text", *empty(told, audited.schema)))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "k").drop("turn", "k")


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text of the repaired conversations."""
    streamed = _streamed(rows, audited).select("conv_id", "kind", "role", "text", "audit")
    schema = T.StructType([streamed.schema["conv_id"]]).add("position", "long").add("role", "string").add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, place = None, None, 0

        def packed(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], schema.names)

        for b in batches:
            types, out = [b.schema.field(0).type, pa.int64(), pa.string(), pa.string()], []
            for conv, kind, role, text, audit in zip(*(c.to_pylist() for c in b.columns)):
                ended = now.end() if kind == 0 and now is not None else ()
                for x in ended:
                    out.append((key, place, *x))
                    place += 1
                if kind == 0:
                    now, key, place = Repair(audit), conv, 0
                    continue
                for x in now.row(role, text):
                    out.append((key, place, *x))
                    place += 1
            yield packed(out)
        if now is not None:
            yield packed([(key, place + i, *x) for i, x in enumerate(now.end())])

    return streamed.mapInArrow(run, schema)


def digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with repaired_sha256: the digest of the repaired ``role:text`` rows, joined by
    newlines, fed row by row."""
    told = [*COUNTS, "cost", "audit"]
    streamed = _streamed(rows, audited).select("conv_id", *told, "kind", "role", "text")
    schema = T.StructType([streamed.schema["conv_id"], *(audited.schema[c] for c in told)]).add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, total, started = None, None, None, False

        def feed(rows: Iterator[tuple[str, str]]) -> None:
            nonlocal started
            for role, text in rows:
                total.update((f"\n{role}:{text}" if started else f"{role}:{text}").encode())
                started = True

        def packed(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], schema.names)

        for b in batches:
            types, out = [*(f.type for f in list(b.schema)[: len(told) + 1]), pa.string()], []
            for *own, kind, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    if now is not None:
                        feed(now.end())
                        out.append((*head, total.hexdigest()))
                    now, head, total, started = Repair(own[-1]), own, hashlib.sha256(), False
                else:
                    feed(now.row(role, text))
            yield packed(out)
        if now is not None:
            feed(now.end())
            yield packed([(*head, total.hexdigest())])

    return streamed.mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation of ``damage``d rows."""
    audited = C.stored(audits(signatures(faults(rows))), "audits")
    return digests(rows, audited)

"""Repair of conversation structure over a suffix-shared automaton.

A conversation's rows, by turn (nulls first; then role, then digest of the
text), become a signature of one symbol a row: the class of its role initial
(s, u, a or other) and its first fault.  Faults are *blank* (nothing but white
space), *duplicate* (role and text seen earlier) and *truncated* (the last
character that is no white space is none of ``.!?``).

Edits turn the roles into ``(s?(ua)+)?`` at the least cost: Keep 0, Rerole (to
user or assistant) 1, Delete 2 (the only edit of blank and duplicate rows),
Insert an empty user or assistant turn 5; a truncated row that stays adds 5.
Of equally cheap repairs the one whose edit initials are least in ASCII
counts.

Signatures are read from their end into one automaton: a node is a symbol and
the node after it, so equal suffixes of any two conversations are one node.
Cost-to-go and the first edit of the best audit suffix are computed once per
node and grammar state (nothing yet, after s, after u, after a).  Options of a
node and state differ in their initial, so that initial alone decides ties and
a suffix is never stored twice: it is the edit and a link.  Different
signatures are made distinct first and dealt by ranges of their reversed form,
so that those with common ends meet in one task.

A conversation of more than ``BLOCK`` turns is cut into blocks.  Blocks are
solved from the last to the first, each starting at the cost-to-go of the one
after it; this passes one byte a row through the conversation's task, as a
sorted stream.  So does the digest, which is defined over all its text in
order.  Neither holds a conversation in memory.

Defined cases: a null in any column is one space (a null text is blank, a null
role is of another class); ids that are null are one conversation; equal rows
of one turn are ties and read one after the other; empty tables give empty
results; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.llm.common import checked_broadcast, cut

BLOCK = 1024
# an automaton that has grown to this many nodes starts anew (same results)
NODES = 1_000_000
SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, TRUNCATED, REROLE = 2, 5, 5, 1
CLASSES = "sua"
NEVER = 1 << 40
# grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a;
# per state the role that a new or reroled turn takes and the state after it
TURN = {0: (1, 2), 1: (1, 2), 2: (2, 3), 3: (1, 2)}


def symbol(cls: Column, fault: Column) -> Column:
    """One letter of a class (0 to 3) and a fault (0 none, 1 truncated, 2 blank, 3 duplicate)."""
    return F.char(F.lit(65) + cls * 4 + fault)


def _letters(fault: int) -> str:
    return "[" + "".join(chr(65 + 4 * c + fault) for c in range(4)) + "]"


class Automaton:
    """Suffix-shared nodes over one end: ``end`` holds the cost-to-go per state
    after the last symbol; with None the conversation ends there."""

    def __init__(self, end: tuple[int, ...] | None):
        self.links: dict[tuple[int, int], int] = {}
        self.after: list[int] = [-1]
        self.best: list[list[tuple[int, str, int]]] = [self._closed([[(c, "", g)] for g, c in enumerate(end or (0, NEVER, NEVER, 0))], end is None)]

    @staticmethod
    def _closed(options: list[list[tuple[int, str, int]]], inserts: bool = True) -> list[tuple[int, str, int]]:
        """The best (cost, edit, next state) per state, with inserted turns."""
        cost = [min(o)[0] for o in options]
        if inserts:
            for _ in range(3):
                cost = [min(c, INSERT + cost[TURN[g][1]]) for g, c in enumerate(cost)]
            options = [[*o, (INSERT + cost[TURN[g][1]], "I", TURN[g][1])] for g, o in enumerate(options)]
        return [min(o) for o in options]

    def _node(self, code: int, after: int) -> int:
        cls, fault = divmod(code, 4)
        key = (code if fault < 2 else -1, after)
        node = self.links.get(key)
        if node is None:
            rest = self.best[after]
            options = []
            for g in range(4):
                o = [(DELETE + rest[g][0], "D", g)]
                if fault < 2:
                    extra = TRUNCATED * fault
                    role, to = TURN[g]
                    if cls == role:
                        o.append((extra + rest[to][0], "K", to))
                    else:
                        o.append((extra + REROLE + rest[to][0], "R", to))
                    if cls == 0 and g == 0:
                        o.append((extra + rest[1][0], "K", 1))
                options.append(o)
            node = self.links[key] = len(self.best)
            self.best.append(self._closed(options))
            self.after.append(after)
        return node

    def add(self, signature: str) -> int:
        node = 0
        for s in reversed(signature):
            node = self._node(ord(s) - 65, node)
        return node

    def costs(self, node: int) -> tuple[int, ...]:
        return tuple(b[0] for b in self.best[node])

    def audit(self, node: int, state: int) -> tuple[str, int]:
        """Edit initials from ``node`` and ``state`` to the end, and the state there."""
        out = []
        while True:
            _, edit, state = self.best[node][state]
            if not edit:
                return "".join(out), state
            out.append(edit)
            if edit != "I":
                node = self.after[node]


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with planted faults: crc32 of
    ``conv_id:turn`` modulo 20 drops a row (0), empties its text (1), removes
    its ``[.!?]`` (2), repeats it (3) or makes it a user's (4)."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    code = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", said[2].alias("role"), said[3].alias("text"), code.alias("_code")).where("_code <> 0")
    role = F.when(F.col("_code") == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(F.col("_code") == 1, F.lit("")).when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times)).drop("col")


def _filled(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", F.floor(F.col("turn") / BLOCK).alias("block"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]).withColumn("digest", F.md5("text"))


def _pieces(rows: DataFrame) -> DataFrame:
    """One row a conversation and block: its signature and turn figures."""
    ends = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(ends == "", 2).when(F.substring(ends, -1, 1).isin(*".!?"), 0).otherwise(1)
    first = F.substring("role", 1, 1)
    cls = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    # texts stay behind: a row is its digest; equal rows of a turn are one with a count
    seen = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    narrow = (_filled(rows).select("conv_id", "turn", "block", "role", "digest", cls.alias("cls"), fault.alias("fault"))
              .groupBy("conv_id", "turn", "block", "role", "digest", "cls", "fault").agg(F.count(F.lit(1)).cast("int").alias("m")))
    narrow = cut(narrow, "turns")
    again = (narrow.where("fault <> 2").groupBy("conv_id", "role", "digest").agg(F.min(seen).alias("first"), F.count(F.lit(1)).alias("k"))
             .where("k > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "first"))
    again = cut(again, "again")
    marked = narrow.join(checked_broadcast(again, 4 * again.count()),
                         F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")), "left")
    repeat = F.when(F.col("fault") == 2, 2).otherwise(3)
    own = F.when(seen > F.col("first"), 3).otherwise(F.col("fault"))
    chunk = F.concat(symbol(F.col("cls"), own), F.repeat(symbol(F.col("cls"), repeat), F.col("m") - 1))
    parts = marked.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct(seen.alias("at"), "role", "digest", chunk.alias("chunk")))).alias("p"),
        F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    return parts.select("conv_id", "block", F.array_join(F.col("p.chunk"), "").alias("sig"), "lo", "hi",
                        F.size(F.array_distinct(F.filter(F.transform("p", lambda x: x["at"]["turn"]), lambda t: t.isNotNull()))).alias("turns"))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map over different signatures: cost and audit of each."""
    net = Automaton(None)
    for batch in batches:
        sigs = batch.column(0).to_pylist()
        cost, audit = [], []
        for s in sigs:
            if len(net.best) > NODES:
                net = Automaton(None)
            node = net.add(s)
            cost.append(net.costs(node)[0])
            audit.append(net.audit(node, 0)[0])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cost, pa.int64()), pa.array(audit, pa.string())], names=["sig", "cost", "audit"])


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map over blocks (conversation, block, signature), each conversation's
    last block first: cost, audits and end states of a block per state at its start."""
    nets: dict[tuple[int, ...] | None, Automaton] = {}
    conv, end = object(), None
    for batch in batches:
        costs, audits, ends = [], [], []
        for c, sig in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if c != conv:
                conv, end, base = c, None, 0
            if sum(len(n.best) for n in nets.values()) > NODES:
                nets = {}
            if end not in nets:
                nets[end] = Automaton(end)
            net = nets[end]
            node = net.add(sig)
            cost = net.costs(node)
            both = [net.audit(node, g) for g in range(4)]
            costs.append([x + base for x in cost])
            audits.append([a for a, _ in both])
            ends.append([g for _, g in both])
            # costs-to-go differ by a few units, so few different ends occur
            base += min(cost)
            end = tuple(x - min(cost) for x in cost)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())),
                                          pa.array(ends, pa.list_(pa.int64()))], names=["conv_id", "block", "costs", "audits", "ends"])


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map over solved blocks in order: each one's own audit, and the
    conversation's cost at its first block (0 at the others)."""
    conv, state = object(), 0
    for batch in batches:
        cost, audit = [], []
        for c, costs, audits, ends in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
            new = c != conv
            if new:
                conv, state = c, 0
            cost.append(costs[0] if new else 0)
            audit.append(audits[state])
            state = ends[state]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                                         names=["conv_id", "block", "cost", "audit"])


def _audits(pieces: DataFrame) -> DataFrame:
    """(conv_id, block, cost, audit) of every block; costs of a conversation add up."""
    conv = f"conv_id {pieces.schema['conv_id'].dataType.simpleString()}, block long"
    many = cut(pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("_c")), "long")
    n = many.count()
    alone = pieces
    out = None
    if n:
        many = checked_broadcast(many, n)
        alone = pieces.join(many, F.col("conv_id").eqNullSafe(F.col("_c")), "left_anti")
        blocks = pieces.join(many, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi").select("conv_id", "block", "sig")
        order = [F.col("conv_id"), F.col("block").desc_nulls_last()]
        solved = cut(blocks.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
            _backwards, f"{conv}, costs array<long>, audits array<string>, ends array<long>"), "blocks")
        out = (solved.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").asc_nulls_first())
               .mapInArrow(_forwards, f"{conv}, cost long, audit string"))
    sigs = alone.select("sig").distinct().withColumn("_end", F.reverse("sig"))
    solved = cut(sigs.repartitionByRange("_end").sortWithinPartitions("_end").select("sig").mapInArrow(_solve, "sig string, cost long, audit string"), "signatures")
    weight = solved.agg(F.sum(F.length("sig") + F.length("audit") + 32)).first()[0] or 0
    done = alone.select("conv_id", "block", "sig").join(checked_broadcast(solved, weight // 16), "sig").select("conv_id", "block", "cost", "audit")
    return done if out is None else done.unionByName(out)


class _Repair:
    """Edits applied to a stream of rows; a conversation's audits precede the
    rows of their blocks."""

    def __init__(self, digest: bool):
        self.digest = digest

    def _turn(self, role: str, text: str, edit: str) -> None:
        if self.digest:
            self.hash.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        else:
            self.out.append((self.conv, self.place, role, text, edit))
        self.place += 1

    def _inserts(self, whole: bool = False) -> None:
        while self.at < len(self.audit) and (whole or self.audit[self.at] == "I"):
            role, self.state = TURN[self.state]
            self._turn(("system", "user", "assistant")[role], "", "I")
            self.at += 1

    def _finish(self) -> None:
        if self.open:
            self._inserts()
            if self.digest:
                self.out.append((self.conv, self.hash.hexdigest()))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.out, self.open, self.conv, self.audit, self.at = [], False, None, "", 0
        schema = None
        for batch in batches:
            kinds = [batch.schema.field(0).type] + ([pa.string()] if self.digest else [pa.int64(), pa.string(), pa.string(), pa.string()])
            names = ["conv_id", "repaired_sha256"] if self.digest else ["conv_id", "place", "role", "text", "edit"]
            schema = pa.schema(list(zip(names, kinds, strict=True)))
            for c, audit, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if not self.open or c != self.conv:
                    self._finish()
                    self.open, self.conv, self.state, self.place, self.audit, self.at = True, c, 0, 0, "", 0
                    self.hash = hashlib.sha256()
                if audit is not None:
                    # inserts at the end of the block before come first
                    self._inserts()
                    self.audit, self.at = audit, 0
                    continue
                self._inserts()
                edit = self.audit[self.at]
                self.at += 1
                if edit == "K":
                    self.state = 1 if role[:1] == "s" else TURN[self.state][1]
                    self._turn(role, text, edit)
                elif edit == "R":
                    to, self.state = TURN[self.state]
                    self._turn(("system", "user", "assistant")[to], text, edit)
            yield self._batch(schema)
        self._finish()
        if schema is not None:
            yield self._batch(schema)

    def _batch(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = zip(*self.out, strict=True) if self.out else [[] for _ in schema]
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        self.out = []
        return batch


def _applied(rows: DataFrame, audits: DataFrame, digest: bool) -> DataFrame:
    heads = audits.select("conv_id", "block", "audit")
    stream = _filled(rows).unionByName(heads, allowMissingColumns=True)
    stream = (stream.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("block").asc_nulls_first(), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest")
        .select("conv_id", "audit", "role", "text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    fields = f"conv_id {kind}, repaired_sha256 string" if digest else f"conv_id {kind}, place long, role string, text string, edit string"
    return stream.mapInArrow(_Repair(digest), fields)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit) of every turn that the repaired
    conversations of ``rows`` (conv_id, turn, role, text) hold."""
    return _applied(rows, _audits(cut(_pieces(rows), "pieces")), digest=False)


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation of ``rows``, and of ``ids`` (conv_id) where given: its
    faults, the cost and initials of the cheapest edits, and the repaired
    conversation's digest."""
    pieces = cut(_pieces(rows), "pieces")
    audits = cut(_audits(pieces), "audits")
    count = lambda pattern: F.sum(F.regexp_count("sig", F.lit(pattern)))
    legal = lambda sig: sum((F.regexp_count(sig, F.lit(a + b)) for a, b in ("su", "ua", "au")), F.lit(0))
    classes = F.translate(F.col("sig"), "".join(map(chr, range(65, 81))), "".join(c * 4 for c in "suao"))
    # a pair across two blocks is a pair of the row that holds both ends
    per = pieces.select("*", (F.length("sig") - 1 - legal(classes)).alias("bad"), F.struct("block", F.substring(classes, 1, 1).alias("c")).alias("head"),
                        F.struct("block", F.substring(classes, -1, 1).alias("c")).alias("tail"))
    gap = F.max("hi") - F.min("lo") + 1 - F.sum("turns")
    out = per.groupBy("conv_id").agg(
        F.coalesce(gap, F.lit(0)).alias("gaps"), count(_letters(2)).alias("blank"), count(_letters(3)).alias("duplicate"),
        count(_letters(1)).alias("truncated"), F.sum("bad").alias("bad"), F.sort_array(F.collect_list("head")).alias("heads"),
        F.sort_array(F.collect_list("tail")).alias("tails"))
    # blocks hold one row each per BLOCK turns: their ends alone are gathered
    seams = F.zip_with(F.slice("heads", 2, F.size("heads")), F.slice("tails", 1, F.size("tails") - 1),
                       lambda h, t: F.when(F.concat(t["c"], h["c"]).isin("su", "ua", "au"), 0).otherwise(1))
    across = F.when(F.size("heads") > 1, F.aggregate(seams, F.lit(0), lambda a, x: a + x)).otherwise(0)
    out = out.select("conv_id", *["gaps", "blank", "duplicate", "truncated"], (F.col("bad") + across).alias("illegal"))
    cost = audits.groupBy(F.col("conv_id").alias("_a")).agg(
        F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("p")).select("_a", "cost", F.array_join(F.col("p.audit"), "").alias("audit"))
    digests = _applied(rows, audits, digest=True).withColumnRenamed("conv_id", "_d")
    out = out.join(cost, F.col("conv_id").eqNullSafe(F.col("_a"))).join(digests, F.col("conv_id").eqNullSafe(F.col("_d"))).drop("_a", "_d")
    if ids is not None:
        out = ids.select(F.col("conv_id").alias("_i")).distinct().join(out, F.col("_i").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("_i", "conv_id")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
                                   for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))

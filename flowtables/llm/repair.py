"""Conversations made to alternate again, at the least cost: a dynamic program over a shared grammar.

What a row can become depends on its role's initial and its fault alone, so a conversation is a
sequence of few symbols, and many conversations have the same one.  Re-Pair names what these
sequences have in common.  Each symbol of its grammar gets one min-plus matrix: from the state of
the roles so far (none, ``s``, ``..u``, ``..a``) to the state after it, the least cost and the rope of
edits that has it.  Rules are evaluated once, bottom-up; a conversation is a product of few of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.llm import grammar
from flowtables.llm.ropes import Rope, join, leaf, less, text_of
from flowtables.plans.ordered import CHUNK, arrange
from flowtables.plans.sizes import broadcast_if_small, written

#: Rows of a conversation that are one sequence, about; a longer one is cut.
CHUNK_ROWS = 1 << 17
#: Costs of edits; an undeleted truncated row costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows that must go; then roles by initial (``o``: another), in capitals if the text is truncated.
SYMBOLS = "dsuaoSUAO"
SPACE = " \t\n\x0b\x0c\r"

Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]

_STATES = range(4)
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def _better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def _then(a: Entry, b: Entry) -> Entry:
    return None if a is None or b is None else (a[0] + b[0], join(a[1], b[1]))


def _row_times(row: list[Entry], m: Matrix) -> list[Entry]:
    out: list[Entry] = [None] * len(_STATES)
    for k in _STATES:
        if row[k] is not None:
            for j in _STATES:
                if m[k][j] is not None:
                    out[j] = _better(out[j], _then(row[k], m[k][j]))
    return out


def _times(a: Matrix, b: Matrix) -> Matrix:
    return [_row_times(row, b) for row in a]


def _inserts() -> Matrix:
    """Nothing, or insertions by the shortest way."""
    m: Matrix = [[(0, leaf("")) if i == j else None for j in _STATES] for i in _STATES]
    for i in _STATES:
        at, n = i, 0
        while (at := _NEXT["u"].get(at, _NEXT["a"].get(at))) != i and n < 2:
            n += 1
            m[i][at] = (INSERT * n, leaf("I" * n))
    return m


def _edits(symbol: str) -> Matrix:
    m: Matrix = [[(DELETE, leaf("D")) if i == j else None for j in _STATES] for i in _STATES]
    if symbol != "d":
        more = TRUNCATED if symbol.isupper() else 0
        ways = [(REROLE, "R", "u"), (REROLE, "R", "a"), *([(0, "K", symbol.lower())] if symbol.lower() in _NEXT else [])]
        for cost, edit, role in ways:
            for i, j in _NEXT[role].items():
                m[i][j] = _better(m[i][j], (cost + more, leaf(edit)))
    return m


INSERTS = _inserts()


def matrices(rules: grammar.Rules) -> list[Matrix]:
    """Of all symbols and rules, each with the insertions before it.

    Two ways of one cost between the same states never are prefixes of each other (the longer
    one would have more insertions), so the least text of a product is made of least texts.
    """
    found = [_times(INSERTS, _edits(s)) for s in SYMBOLS]
    for a, b in rules:
        found.append(_times(found[a], found[b]))
    return found


def _best(row: list[Entry]) -> tuple[int, str]:
    ends = _row_times(row, INSERTS)
    cost, edits = _better(ends[0], ends[3])
    return cost, text_of(edits)


_START: list[Entry] = [(0, leaf("")), None, None, None]


def audit_sequences(sequences: DataFrame) -> DataFrame:
    """Sequences (``symbols``, different ones, and ``whole``) with ``cost`` and ``audit`` of whole ones and
    the ``matrix`` of parts: the cost and the edits from each state to each, null where there is no way."""
    at = F.transform(F.split("symbols", ""), lambda c: (F.instr(F.lit(SYMBOLS), c) - 1).cast("int"))
    coded, rules = grammar.compress(sequences.withColumn("codes", F.filter(at, lambda c: c >= 0)), len(SYMBOLS))
    entry = "struct<cost: long, edits: string>"
    schema = f"symbols string, whole boolean, cost long, audit string, matrix array<array<{entry}>>"
    broadcast = sequences.sparkSession.sparkContext.broadcast(rules)

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(broadcast.value)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = {"symbols": row["symbols"], "whole": row["whole"], "cost": None, "audit": None, "matrix": None}
                rows = [_START] if row["whole"] else [[(0, leaf("")) if i == j else None for j in _STATES] for i in _STATES]
                for code in row["codes"]:
                    rows = [_row_times(r, known[code]) for r in rows]
                if row["whole"]:
                    own["cost"], own["audit"] = _best(rows[0])
                else:
                    own["matrix"] = [[e and {"cost": e[0], "edits": text_of(e[1])} for e in r] for r in rows]
                out.append(own)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return coded.mapInArrow(audit, schema)


_ARROW = pa.schema([
    ("symbols", pa.string()), ("whole", pa.bool_()), ("cost", pa.int64()), ("audit", pa.string()),
    ("matrix", pa.list_(pa.list_(pa.struct([("cost", pa.int64()), ("edits", pa.string())])))),
])


def _rows(turns: DataFrame) -> DataFrame:
    """The columns that count, without nulls in role and text, and what a text is like."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    return rows.withColumns({
        "digest": F.md5("text"), "blank": last == "", "cut": ~last.isin(".", "!", "?"), "initial": F.substring("role", 1, 1),
    })


def _joined(a: DataFrame, b: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Rows of ``a`` with the other columns of ``b``; nulls are equal."""
    b = b.withColumnsRenamed({c: f"same_{c}" for c in columns})
    on = F.lit(True)
    for c in columns:
        on &= a[c].eqNullSafe(b[f"same_{c}"])
    return a.join(b, on, how).drop(*[f"same_{c}" for c in columns])


def _marked(rows: DataFrame) -> DataFrame:
    """Runs of equal rows of a turn, with their number and whether the first is the first of the conversation."""
    runs = rows.groupBy("conv_id", "turn", "role", "digest", "blank", "cut", "initial").agg(F.count(F.lit(1)).alias("n"))
    runs = written(runs, "runs")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = runs.groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first"))
    marked = _joined(runs, firsts, ["conv_id", "role", "digest"]).withColumn("new", when == F.col("first")).drop("first")
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    good = F.col("new") & ~F.col("blank")
    return marked.withColumns({
        "n": F.col("n").cast("int"), "kind": role, "good": good,
        "symbol": F.when(~good, "d").when(F.col("cut"), F.upper(role)).otherwise(role),
    })


def audit_conversations(turns: DataFrame) -> DataFrame:
    """The faults of each conversation, and the cheapest edits that mend it.

    Turns (conv_id, turn, role, text; other columns are not read) are taken by turn (nulls first),
    then role and MD5 of the text; a null role or text is one space; a null conv_id is a
    conversation.  A row's first fault counts: blank (nothing but white space), duplicate (role and
    text seen before), truncated (no ``.``, ``!`` or ``?`` at its end).  Rows are kept (0), get
    another role (2), are deleted (3; blank and duplicate ones always), and empty turns are inserted
    (2); a truncated row that stays costs 1 more.  The roles' initials must become
    ``(s?(ua)+)?``; of equal cost, the ASCII-least audit (of K, R, D, I, in order) is taken.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.  Equal rows are
    counted before anything is shuffled, sequences that conversations share are solved once, and
    a conversation of more than ``CHUNK_ROWS`` different rows is cut: its parts' matrices are
    multiplied in order, of which only ropes in use are kept.
    """
    return _audited(_rows(turns))


def _audited(rows: DataFrame) -> DataFrame:
    marked = written(_marked(rows), "marked")
    turn = F.col("turn")
    spare = F.max(turn).cast("decimal(38,0)") - F.min(turn) + 1 - F.count_distinct(turn)
    faults = marked.groupBy("conv_id").agg(
        F.coalesce(spare, F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).cast("long").alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.col("new").cast("int"))).cast("long").alias("duplicate"),
        F.sum((F.col("good") & F.col("cut")).cast("int")).cast("long").alias("truncated"),
    )
    order = ["turn", "role", "digest"]
    cut = arrange(marked, "conv_id", order, CHUNK_ROWS)
    part = F.coalesce(F.col(CHUNK), F.lit(0)) if cut.split else F.lit(0)
    pieces = F.struct(*order, F.concat("symbol", F.repeat(F.lit("d"), F.col("n") - 1)).alias("symbols"), F.repeat("kind", F.col("n")).alias("kinds"))
    parts = cut.table.groupBy("conv_id", part.alias("part")).agg(F.array_sort(F.collect_list(pieces)).alias("pieces"))
    parts = parts.select("conv_id", "part", F.array_join("pieces.symbols", "").alias("symbols"), F.array_join("pieces.kinds", "").alias("kinds"))
    in_order = Window.partitionBy("conv_id").orderBy("part")
    edge = F.concat(F.substring(F.lag("kinds").over(in_order), -1, 1), F.substring("kinds", 1, 1))
    legal = lambda c: F.regexp_count(c, F.lit("(?=su|ua|au)"))
    parts = parts.withColumns({
        "illegal": F.length("kinds") - 1 - legal(F.col("kinds")) + F.coalesce(1 - legal(edge), F.lit(0)),
        "whole": F.count(F.lit(1)).over(Window.partitionBy("conv_id")) == 1,
    }).drop("kinds")
    parts = written(parts, "parts")
    solved = broadcast_if_small(audit_sequences(parts.select("symbols", "whole").distinct()))
    joined = parts.join(solved, ["symbols", "whole"])
    whole = joined.where("whole").select("conv_id", F.col("illegal").cast("long").alias("illegal"), "cost", "audit")
    schema = T.StructType([parts.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in ("illegal", "cost")], T.StructField("audit", T.StringType())])
    long = joined.where("NOT whole").select("conv_id", "part", "illegal", "matrix", (F.row_number().over(in_order) == 1).alias("begins"))
    long = long.sortWithinPartitions("conv_id", "part").mapInArrow(_multiplied, schema)
    audits = whole.unionByName(long)
    return _joined(faults, audits, ["conv_id"])


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of each conversation, of its parts' matrices in order."""
    conv = row = None
    illegal = 0

    def out() -> dict:
        cost, audit = _best(row)
        return {"conv_id": conv, "illegal": illegal, "cost": cost, "audit": audit}

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        done = []
        for part in range(batch.num_rows):
            matrix = batch.column("matrix")[part].as_py()
            if batch.column("begins")[part].as_py():
                if row is not None:
                    done.append(out())
                conv, row, illegal = batch.column("conv_id")[part].as_py(), _START, 0
            illegal += batch.column("illegal")[part].as_py()
            row = _row_times(row, [[e and (e["cost"], leaf(e["edits"])) for e in r] for r in matrix])
        yield pa.RecordBatch.from_pylist(done, schema=_audit_schema(kind))
    if row is not None:
        yield pa.RecordBatch.from_pylist([out()], schema=_audit_schema(kind))


def _audit_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", kind), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])


class _Editor:
    """Plays an audit over the rows of one conversation."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _turn(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        if edit != "K":
            role = "assistant" if self.state == 2 else "user"
        self.state = _NEXT[role[0]][self.state]
        return edit, role, text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._turn("I", "", "")

    def taken(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._turn(edit, role, text)


class _Turns:
    """Collects the turns of mended conversations."""

    def __init__(self) -> None:
        self.rows: list[dict] = []

    def begin(self, message: dict) -> None:
        self.conv_id, self.place = message["conv_id"], 0

    def turn(self, edit: str, role: str, text: str) -> None:
        self.rows.append({"conv_id": self.conv_id, "place": self.place, "role": role, "text": text, "edit": edit})
        self.place += 1

    def end(self) -> None:
        pass


class _Digests:
    """Collects what audits say of conversations, and digests of their turns."""

    def __init__(self) -> None:
        self.rows: list[dict] = []

    def begin(self, message: dict) -> None:
        self.message, self.hash, self.between = message, sha256(), b""

    def turn(self, edit: str, role: str, text: str) -> None:
        self.hash.update(self.between + role.encode() + b":" + text.encode())
        self.between = b"\n"

    def end(self) -> None:
        self.rows.append(self.message | {"repaired_sha256": self.hash.hexdigest()})


def _mended(rows: DataFrame, audits: DataFrame, collect: type[_Turns] | type[_Digests], schema: T.StructType) -> DataFrame:
    """Rows behind their conversation's audit, edited as they pass; one turn is held at a time."""
    told = audits.columns
    sent = audits.withColumn("behind", F.lit(0)).unionByName(
        rows.select("conv_id", "turn", "role", "text", "digest", F.lit(1).alias("behind")), allowMissingColumns=True
    )
    sent = sent.repartition("conv_id").sortWithinPartitions("conv_id", "behind", "turn", "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, editor = collect(), None
        arrow = to_arrow_schema(schema)

        def ended() -> None:
            if editor is not None:
                for turn in editor.inserted():
                    out.turn(*turn)
                out.end()

        for batch in batches:
            messages = {c: batch.column(c).to_pylist() for c in told}
            roles, texts = batch.column("role").to_pylist(), batch.column("text")
            for i, behind in enumerate(batch.column("behind").to_pylist()):
                if not behind:
                    ended()
                    out.begin({c: v[i] for c, v in messages.items()})
                    editor = _Editor(messages["audit"][i])
                else:
                    for turn in editor.taken(roles[i], texts[i].as_py()):
                        out.turn(*turn)
            yield pa.RecordBatch.from_pylist(out.rows, schema=arrow)
            out.rows = []
        ended()
        yield pa.RecordBatch.from_pylist(out.rows, schema=arrow)

    return sent.mapInArrow(run, schema)


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


def repair_conversations(turns: DataFrame) -> DataFrame:
    """The turns that the audits of ``audit_conversations`` lead to: conv_id, place (from 0), role, text, edit
    (K, R or I).  Texts are shuffled once, each sorted behind its conversation's audit."""
    rows = _rows(turns)
    texts = [_field(n, T.StringType()) for n in ("role", "text", "edit")]
    schema = T.StructType([rows.schema["conv_id"], _field("place", T.LongType()), *texts])
    return _mended(rows, _audited(rows).select("conv_id", "audit"), _Turns, schema)


def repair_digests(turns: DataFrame) -> DataFrame:
    """``audit_conversations`` with the SHA-256 of the mended turns, as ``role:text`` lines.  A digest of one
    text is one task's work, so a conversation of any length passes through one task, row by row."""
    rows = _rows(turns)
    audits = _audited(rows)
    return _mended(rows, audits, _Digests, T.StructType([*audits.schema.fields, _field("repaired_sha256", T.StringType())]))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults, by the CRC-32 of ``conv_id:turn`` (a null is one space) modulo 20: 0 drops a row, 1
    empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes the role ``user``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def damaged_and_repaired(turns: DataFrame) -> DataFrame:
    """``repair_digests`` of ``damaged`` turns, with a row for every conversation before the damage: one that has
    lost all rows has zeros, an empty audit and the digest of nothing."""
    found = repair_digests(damaged(turns))
    every = turns.select("conv_id").distinct()
    none = {"audit": F.lit(""), "repaired_sha256": F.lit(sha256().hexdigest())}
    return _joined(every, found, ["conv_id"], "left").select(
        "conv_id", *[F.coalesce(F.col(c), none.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns[1:]]
    )

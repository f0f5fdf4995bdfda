"""Operator 12, repair of conversation structure: the cheapest edits that give a dialogue the role initials `(s?(ua)+)?`, found by the
minimum of plain integers over a graph without cycles.

Each row may be kept (K, cost 0), given the role user or assistant (R, 1) or deleted (D, 2, the only way for blank and repeated rows); a
row with empty text of user or assistant may be inserted anywhere (I, 5); a truncated row that isn't deleted adds 5. Of equally cheap
edits those whose letters are least in ASCII order win. A weight is one integer: its high digits are the cost, and each
row has a field of low digits at a fixed place for its letters (inserts before it, then its own), ended by zeros. An
automaton of four states (nothing yet, after s, after u, after a) makes a letter's role follow from the state, and since every field ends with the row's own
letter no field begins another. So the minimum of the integers over the paths is both the cheapest and the least in order.

At scale: rows get their rank by a range sort (varspan.sources.text.ranked), and each run of SPAN ranks of a conversation is a block. A block's
least weights from each state to each (16 numbers) stand for it above, with the order of its texts as its digit; blocks of blocks are solved
alike, and what the whole conversation chooses goes down again to rows. So a conversation that holds a third of all rows is never gathered:
tasks see 256 numbers at a time. Only the digest of query() reads a conversation's rows in order, as a stream.

Defined results: null role and text are one space, an empty role has no initial and can't be kept; rows stand by turn (null first), then role and text, so the order of equal
turns is defined; a null conv_id is a conversation of its own, apart from an empty text; identical rows are duplicates; an empty table gives no rows;
other columns are kept out.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspan.llm.common import tidied, written
from varspan.sources.text import ranked

#: Ranks in a block, and blocks in a block above.
SPAN = 256
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
STATES = 4
#: ASCII order of the letters in fields of three; zero ends a field.
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
#: Bits of a field of letters, and of a block's place among the 16 texts that it may have.
FIELD, PLACE = 9, 4
BLANK, DUPLICATE, CUT = 1, 2, 4

# next state by role; a role is taken from the state where it is inserted or given
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
_ROLE = {"u": "user", "a": "assistant"}


def field_code(letters: str) -> int:
    out = 0
    for k in range(3):
        out = out << 3 | (LETTERS[letters[k]] if k < len(letters) else 0)
    return out


def field_letters(code: int) -> str:
    names = {v: k for k, v in LETTERS.items()}
    return "".join(names[d] for k in (6, 3, 0) if (d := code >> k & 7))


@functools.cache
def row_weights(initial: str, fault: int) -> tuple[int, ...]:
    """The least weight (cost above a field of letters) from each state to each for one row; -1 where no edit leads."""
    best = [-1] * (STATES * STATES)
    for a in range(STATES):
        for inserts in range(3):  # a third would come back to an earlier state at a cost
            state = a
            for _ in range(inserts):
                state = _STEP[state, _WANTED[state]]
            choices = [("D", state, DELETE)]
            if not fault & (BLANK | DUPLICATE):
                more = TRUNCATED if fault & CUT else 0
                if (state, initial) in _STEP:
                    choices.append(("K", _STEP[state, initial], more))
                choices.append(("R", _STEP[state, _WANTED[state]], REROLE + more))
            for letter, b, cost in choices:
                w = (cost + INSERT * inserts) << FIELD | field_code("I" * inserts + letter)
                at = a * STATES + b
                best[at] = w if best[at] < 0 else min(best[at], w)
    return tuple(best)


#: What may follow the last row: inserts that reach an end state. All ways lead to state 3.
END = tuple(v for a, n in ((0, 0), (1, 2), (2, 1), (3, 0)) for v in (-1, -1, -1, (INSERT * n) << PLACE | n))


def least(items: tuple[tuple[int, ...], ...], bits: int, start: int) -> list[int | None]:
    """The least integer of all paths through the items from a state to each: costs summed above all fields, and each item's field at its
    own place, the first highest."""
    width = bits * len(items)
    mask = (1 << bits) - 1
    now: list[int | None] = [None] * STATES
    now[start] = 0
    for k, item in enumerate(items):
        shift = width - bits * (k + 1)
        then: list[int | None] = [None] * STATES
        for a in range(STATES):
            if now[a] is None:
                continue
            for b in range(STATES):
                if (w := item[a * STATES + b]) >= 0:
                    total = now[a] + (w >> bits << width) + ((w & mask) << shift)
                    if then[b] is None or total < then[b]:
                        then[b] = total
        now = then
    return now


@functools.lru_cache(4096)
def block_weights(items: tuple[tuple[int, ...], ...], bits: int) -> tuple[int, ...]:
    """A block as one item: for each pair of states its cost above the place of its text among the block's texts, in order."""
    width = bits * len(items)
    all_ = [w for a in range(STATES) for w in least(items, bits, a)]
    texts = {t: k for k, t in enumerate(sorted({w & ((1 << width) - 1) for w in all_ if w is not None}))}
    return tuple(-1 if w is None else w >> width << PLACE | texts[w & ((1 << width) - 1)] for w in all_)


@functools.lru_cache(4096)
def choices(items: tuple[tuple[int, ...], ...], bits: int, start: int, end: int) -> tuple[tuple[int, int, int], ...]:
    """(state before, state after, field) of each item on the least path from start to end."""
    w = least(items, bits, start)[end]
    out, a = [], start
    for k, item in enumerate(items):
        digit = w >> bits * (len(items) - k - 1) & ((1 << bits) - 1)
        b = next(b for b in range(STATES) if (v := item[a * STATES + b]) >= 0 and v & ((1 << bits) - 1) == digit)
        out.append((a, b, digit))
        a = b
    return tuple(out)


def _items(cell: list[dict]) -> tuple[tuple[int, ...], ...]:
    """Items of a block, in order: weights of blocks below, or a row's initial and fault."""
    cell = sorted(cell, key=lambda x: x["idx"])
    return tuple(tuple(x["w"]) for x in cell) if "w" in cell[0] else tuple(row_weights(x["initial"], x["fault"]) for x in cell)


def _up(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = [block_weights(_items(x), bits) for x in b.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("idx"), pa.array(w, pa.list_(pa.int64()))], ["conv", "idx", "w"])

    return run


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        conv, idx, before, after, cost, tail = [], [], [], [], [], []
        for c, cell in zip(b.column("conv").to_pylist(), b.column("items").to_pylist(), strict=True):
            items = (*_items(cell), END)
            path = choices(items, PLACE, 0, 3)
            total = least(items, PLACE, 0)[3] >> PLACE * len(items)
            for x, (a, z, _) in zip(sorted(cell, key=lambda x: x["idx"]), path, strict=False):
                conv.append(c)
                idx.append(x["idx"])
                before.append(a)
                after.append(z)
                cost.append(total)
                tail.append(path[-1][2])
        yield pa.RecordBatch.from_arrays([pa.array(conv, pa.string()), pa.array(idx, pa.int64()), pa.array(before, pa.int32()), pa.array(after, pa.int32()), pa.array(cost, pa.int64()), pa.array(tail, pa.int32())], ["conv", "idx", "before", "after", "cost", "tail"])


def _down(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, idx, before, after, letters = [], [], [], [], []
            for c, cell, a, z in zip(*(b.column(k).to_pylist() for k in ("conv", "items", "before", "after")), strict=True):
                path = choices(_items(cell), bits, a, z)
                for x, (p, q, digit) in zip(sorted(cell, key=lambda x: x["idx"]), path, strict=True):
                    conv.append(c)
                    idx.append(x["idx"])
                    before.append(p)
                    after.append(q)
                    letters.append(field_letters(digit) if bits == FIELD else None)
            yield pa.RecordBatch.from_arrays([pa.array(conv, pa.string()), pa.array(idx, pa.int64()), pa.array(before, pa.int32()), pa.array(after, pa.int32()), pa.array(letters, pa.string())], ["conv", "idx", "before", "after", "letters"])

    return run


def conv_key(conv_id: Column) -> Column:
    """A conversation's name that is never null: null is apart from every id."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _read(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return df.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, conversations). rows: conv, rank, turn, role, text, fault, letters (its edits), inserted (roles put before it), new_role (null if
    deleted). conversations: conv, cost, audit, tail (roles put at the end), and the counts of faults and of illegal neighbours."""
    c = _read(conversations, conv_col, turn_col, role_col, text_col).withColumn("conv", conv_key(F.col("conv_id"))).drop("conv_id")
    c = ranked(c, "conv", "turn", "role", "text")
    facts = c.select(
        "conv", "rank", "turn", F.substring("role", 1, 1).alias("initial"), F.sha2(F.concat_ws("\0", F.hex("role"), F.col("text")), 256).alias("digest"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"),
    )
    facts = written(facts)
    first = facts.groupBy("conv", "digest").agg(F.min("rank").alias("rank")).select("rank", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("open"), CUT).otherwise(0)
    rows = written(facts.join(first, "rank", "left").select("conv", F.col("rank").alias("idx"), "turn", "initial", fault.alias("fault")))
    gathered = lambda df, *cols: df.groupBy("conv", F.floor(F.col("idx") / SPAN).alias("up")).agg(F.collect_list(F.struct("idx", *cols)).alias("items")).withColumnRenamed("up", "idx")  # noqa: E731  SPAN items at most
    weights = "conv string, idx long, w array<long>"
    path = "conv string, idx long, before int, after int, letters string"
    blocks0 = written(gathered(rows, "initial", "fault"))
    blocks1 = written(gathered(blocks0.mapInArrow(tidied(_up(FIELD)), weights), "w"))
    above = blocks1.mapInArrow(tidied(_up(PLACE)), weights)
    whole = above.groupBy("conv").agg(F.collect_list(F.struct("idx", "w")).alias("items"))  # one for 65536 ranks
    top = written(whole.mapInArrow(tidied(_top), "conv string, idx long, before int, after int, cost long, tail int"))
    down = blocks1.join(top.select("conv", "idx", "before", "after"), ["conv", "idx"]).select("conv", "items", "before", "after").mapInArrow(tidied(_down(PLACE)), path)
    down = blocks0.join(down.drop("letters"), ["conv", "idx"]).select("conv", "items", "before", "after").mapInArrow(tidied(_down(FIELD)), path)
    edits = written(down.select(F.col("idx").alias("rank"), "conv", "before", "letters"))
    # roles follow from the state before: two inserts are user and assistant, in the state's order
    wanted = lambda s: F.when(s == 2, F.lit("assistant")).otherwise(F.lit("user"))
    other = lambda s: F.when(s == 2, F.lit("user")).otherwise(F.lit("assistant"))
    n = F.length("letters") - 1
    inserted = F.slice(F.array(wanted(F.col("before")), other(F.col("before"))), 1, n)
    given = F.when(n % 2 == 0, wanted(F.col("before"))).otherwise(other(F.col("before")))
    new_role = F.when(F.col("letters").endswith("K"), F.col("role")).when(F.col("letters").endswith("R"), given)
    done = c.drop("conv").join(edits, "rank").join(rows.select(F.col("idx").alias("rank"), "fault"), "rank")
    done = done.select("conv", "rank", "turn", "role", "text", "fault", "letters", inserted.alias("inserted"), new_role.alias("new_role"))
    return done, _summary(rows, edits, top)


def _summary(rows: DataFrame, edits: DataFrame, top: DataFrame) -> DataFrame:
    count = lambda f: F.sum((F.col("fault") == f).cast("long"))
    faults = rows.groupBy("conv").agg(count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(CUT).alias("truncated"))
    turns = rows.where("turn is not null").select("conv", "turn").distinct().groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    # neighbours: each row's initial beside that of the rank before it, if that is of the same conversation
    after = rows.select((F.col("idx") + 1).alias("idx"), F.col("conv").alias("c"), F.col("initial").alias("i"))
    pair = rows.select("idx", "conv", "initial").join(after, "idx").where("conv = c")
    illegal = pair.where(~F.concat("i", "initial").isin("su", "ua", "au")).groupBy("conv").agg(F.count("*").alias("illegal"))
    parts = edits.groupBy("conv", F.floor(F.col("rank") / SPAN).alias("b")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "letters"))), lambda x: x["letters"]), "").alias("part"))
    audit = parts.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "part"))), lambda x: x["part"]), "").alias("audit"))  # the result's own column
    ends = top.groupBy("conv").agg(F.first("cost").alias("cost"), F.first("tail").alias("tail"))
    out = faults.join(turns, "conv", "left").join(illegal, "conv", "left").join(audit, "conv").join(ends, "conv")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    tail = F.when(F.col("tail") == 2, F.array(F.lit("user"), F.lit("assistant"))).when(F.col("tail") == 1, F.array(F.lit("assistant"))).otherwise(F.array().cast("array<string>"))
    return out.select("conv", zero("gaps"), "blank", "duplicate", "truncated", zero("illegal"), "cost", F.concat("audit", F.repeat(F.lit("I"), F.col("tail"))).alias("audit"), tail.alias("tail"))


def repaired_rows(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, rank, n, role, text): the repaired conversations, in order of rank and n; inserted rows have empty text, those at the end a null rank's place after all."""
    empty = lambda roles: F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    own = F.when(F.col("new_role").isNotNull(), F.array(F.struct(F.col("new_role").alias("role"), F.col("text").alias("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    body = rows.select("conv", "rank", F.posexplode(F.concat(empty(F.col("inserted")), own)).alias("n", "r"))
    end = conversations.select("conv", F.lit((1 << 63) - 1).alias("rank"), F.posexplode(empty(F.col("tail"))).alias("n", "r"))
    return body.unionByName(end).select("conv", "rank", "n", "r.role", "r.text")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, sha256) of rows that come in order: a stream, of which one digest is held."""
    conv, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], ["conv", "repaired_sha256"])

    for b in batches:
        for s in range(0, b.num_rows, 256):
            part = b.slice(s, 256)
            for c, role, text in zip(*(part.column(k).to_pylist() for k in ("conv", "role", "text")), strict=True):
                if digest is None or c != conv:
                    if digest is not None:
                        yield row()
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield row()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32 of `conv_id:turn` modulo 20: dropped, emptied, without `.!?`, repeated, given to user. Null is one space."""
    c = _read(conversations, "conv_id", "turn", "role", "text")
    space = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    c = c.withColumn("h", F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).where("h <> 0")
    text = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return c.select("conv_id", "turn", F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def query(conversations: DataFrame) -> DataFrame:
    rows, done = repair(damaged(conversations))
    done = written(done)
    digests = repaired_rows(rows, done).repartition("conv").sortWithinPartitions("conv", "rank", "n").select("conv", "role", "text").mapInArrow(tidied(_digests), "conv string, repaired_sha256 string")
    every = conversations.select("conv_id").distinct().withColumn("conv", conv_key(F.col("conv_id")))
    out = every.join(done.drop("tail"), "conv", "left").join(digests, "conv", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

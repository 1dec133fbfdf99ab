"""Chat formatting by quotation linking: quoted passages are traced to the messages that said them first, and taken out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fanflow.llm.common import written
from fanflow.llm.components import components

_QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.S)
_CREDIT = re.compile(r".*(?:wrote|schrieb|a écrit|escribió)\s*:\s*$", re.I)
#: Turns of a block of a conversation that are counted together.
TURNS = 256


def normalised(passage: str) -> str:
    """Lower-cased, white space collapsed."""
    return " ".join(passage.lower().split())


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text, and its quoted passages as (level, text), in order.

    A passage is a run of lines of one quote level; `> > x` and `>> x` are level 2. The line that names whom a quote is
    from (`... wrote:`) goes with the quote.
    """
    own: list[str] = []
    passages: list[tuple[int, str]] = []
    last = 0
    for line in (text or "").split("\n"):
        found = _QUOTE.fullmatch(line)
        level, body = (found[1].count(">"), found[2]) if found else (0, line)
        if level:
            if not last and own and _CREDIT.fullmatch(own[-1]):
                own.pop()
            if level == last:
                passages[-1] = (level, f"{passages[-1][1]}\n{body}")
            else:
                passages.append((level, body))
        else:
            own.append(line)
        last = level
    return "\n".join(own).strip("\n"), passages


def passage_hashes(passage: str) -> list[str]:
    """128-bit hashes of a normalised passage and, after it, of each of its paragraphs and lines, longest first; empty ones have none."""
    parts = sorted({normalised(x) for x in [*re.split(r"\n\s*\n", passage), *passage.split("\n")]} - {""}, key=lambda x: (-len(x), x))
    whole = normalised(passage)
    return [xxhash.xxh3_128_hexdigest(x.encode("utf-8", "surrogatepass")) for x in dict.fromkeys([whole, *parts]) if x]


def messages(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, own, said: hashes of own passages, quotes: (level, hashes)) of each message; null texts are empty."""
    kind = [turns.schema[c].dataType.simpleString() for c in (conv_col, turn_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            read = [parse(t.as_py()) for t in b.column("text")]
            said = [passage_hashes(own) for own, _ in read]
            quotes = [[{"level": level, "hashes": passage_hashes(p)} for level, p in passages] for _, passages in read]
            kind = pa.list_(pa.struct([("level", pa.int32()), ("hashes", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("conv", "turn", "role")), pa.array([o for o, _ in read], pa.string()), pa.array(said, pa.list_(pa.string())), pa.array(quotes, kind)], ["conv", "turn", "role", "own", "said", "quotes"])

    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"conv {kind[0]}, turn {kind[1]}, role string, own string, said array<string>, quotes array<struct<level:int,hashes:array<string>>>")


def link(parsed: DataFrame) -> DataFrame:
    """(conv, turn, quote, level, from_conv, from_turn) of each quoted passage with an original.

    The original is the first message of the same conversation, before the quoting one, that said the whole passage or
    else its longest paragraph or line that any did; failing that, the first of all other conversations. Originals are
    reduced to the first of each hash, and the first of another conversation than that, before the join, so common
    passages make no pairs.
    """
    said = parsed.filter("conv is not null and turn is not null").select("conv", "turn", F.explode("said").alias("hash"))
    inside = said.groupBy("conv", "hash").agg(F.min("turn").alias("from_turn"))
    outside = inside.groupBy("hash").agg(F.min(F.struct("conv", "from_turn")).alias("first"))
    others = inside.join(outside, "hash").filter(F.col("conv") != F.col("first.conv")).groupBy("hash").agg(F.min(F.struct("conv", "from_turn")).alias("second"))
    outside = outside.join(others, "hash", "left")
    quotes = parsed.select("conv", "turn", F.posexplode("quotes").alias("quote", "q"))
    keys = quotes.select("conv", "turn", "quote", "q.level", F.posexplode("q.hashes").alias("rank", "hash"))
    here = keys.join(inside, ["conv", "hash"]).filter("from_turn < turn").select("conv", "turn", "quote", "level", F.struct(F.lit(0).alias("far"), "rank", F.col("conv").alias("from_conv"), "from_turn").alias("o"))
    other = F.when(F.col("conv").isNull() | (F.col("first.conv") != F.col("conv")), F.col("first")).otherwise(F.col("second"))
    there = keys.join(outside, "hash").withColumn("other", other).filter("other is not null").select("conv", "turn", "quote", "level", F.struct(F.lit(1).alias("far"), "rank", F.col("other.conv").alias("from_conv"), F.col("other.from_turn").alias("from_turn")).alias("o"))
    best = here.unionByName(there).groupBy("conv", "turn", "quote", "level").agg(F.min("o").alias("o"))
    return best.select("conv", "turn", "quote", "level", "o.from_conv", "o.from_turn")


def _previous(nodes: DataFrame) -> DataFrame:
    """nodes (conv, turn: distinct, not null) with prev_turn, the next lower turn of the conversation: sorted in blocks of TURNS turns. Turns that are no numbers have none before."""
    cut = nodes.withColumn("block", F.floor(F.col("turn").cast("string").try_cast("double") / TURNS))
    odd = cut.filter("block is null").select("conv", "turn", F.col("turn").alias("prev_turn")).withColumn("prev_turn", F.when(F.lit(False), F.col("prev_turn")))
    cut = cut.filter("block is not null")
    last = cut.groupBy("conv", "block").agg(F.max("turn").alias("last"))
    before = last.withColumn("before", F.lag("last").over(Window.partitionBy("conv").orderBy("block"))).drop("last")
    inside = cut.withColumn("prev_turn", F.lag("turn").over(Window.partitionBy("conv", "block").orderBy("turn")))
    return inside.join(before, ["conv", "block"]).select("conv", "turn", F.coalesce("prev_turn", "before").alias("prev_turn")).unionByName(odd)


def depths(parents: DataFrame) -> DataFrame:
    """(conv, turn, depth) from distinct messages (conv, turn, up: struct of conv and turn, or null): how many replies lead to each.

    Rounds of joins double the distance to the ancestor that each message knows, so their number grows with the
    logarithm of the longest chain. Where replies run in a circle, the least message of the circle counts as its first:
    a message is on a circle only if its replies lead back to it. Messages that lead into a circle are none of it: rounds go on
    until the messages that pointers end at don't become fewer, which are then those of the circles, and until the
    least message on each way stands.
    """
    me = F.struct("conv", "turn")
    state = written(parents.select("conv", "turn", "up", F.col("up").isNotNull().cast("long").alias("depth"), F.when(F.col("up").isNull(), me).otherwise(F.least(me, "up")).alias("least")), "quote-depth")
    seen = None
    while (now := state.filter("up is not null").agg(F.count(F.lit(1)), F.sum(F.xxhash64("least") % 2**31), F.count_distinct("up.conv", "up.turn")).first())[0] and now != seen:
        ends = state.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("up").alias("far"), F.col("depth").alias("more"), F.col("least").alias("low"))
        far = state.filter("up is not null").join(ends, (F.col("up.conv") == F.col("c")) & (F.col("up.turn") == F.col("t")))
        far = far.select("conv", "turn", F.col("far").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.least("least", "low").alias("least"))
        state, seen = written(state.filter("up is null").unionByName(far), "quote-depth"), now
    if not now[0]:
        return state.select("conv", "turn", "depth")
    ends = state.filter("up is not null").select("up.conv", "up.turn").distinct()  # the messages on circles
    first = state.join(ends, ["conv", "turn"], "left_semi").select("least.*").distinct()
    return depths(parents.join(first.withColumn("first", F.lit(True)), ["conv", "turn"], "left").select("conv", "turn", F.when(F.col("first").isNull(), F.col("up")).alias("up")))


def placed(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """rows with position: their number from 1 within by, in this order. Rows are dealt by ranges of all of these, so that no group lies in one task."""
    n = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(n, by, *order).sortWithinPartitions(by, *order).withColumn("at", F.monotonically_increasing_id())
    dealt = written(dealt, "quote-placed").withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit(2**33 - 1)))
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    parts = parts.select("part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    dealt = dealt.join(F.broadcast(parts), "part").withColumn("at", F.col("at") + F.col("before"))
    start = dealt.groupBy(F.col(by).alias("group")).agg(F.min("at").alias("start"))
    return dealt.join(start, F.col(by).eqNullSafe(F.col("group"))).withColumn("position", F.col("at") - F.col("start") + 1).drop("part", "before", "at", "start", "group")


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each message: (conv_col, turn_col, role, conversation, position, depth, reply_conv, reply_turn, quotes, linked, text, formatted).

    text is the message without quotes, formatted the same under its role's header. A message replies to the original
    of its last outermost quote, else to the turn before it in its conversation, else to none. Conversations that quote
    one another are one (conversation: the smallest id that links reach), in which position counts the messages by
    depth, the number of replies that lead to them, then conversation, turn and text: a reply comes after what it
    replies to, whichever conversation that is of. (If replies run in a circle, its least message counts as its first.)
    Turns that are no numbers have no turn before. Null texts are empty, null conversations stay apart from all others as one, null turns come first; repeated rows stay.
    """
    parsed = written(messages(turns, conv_col, turn_col, role_col, text_col), "quote-parsed")
    links = written(link(parsed), "quote-links")
    edges = links.filter("from_conv <> conv").select(F.col("conv").alias("a"), F.col("from_conv").alias("b"))
    roots = written(components(edges), "quote-roots")
    reply = links.groupBy("conv", "turn").agg(F.max_by(F.struct("from_conv", "from_turn"), F.struct(-F.col("level"), "quote")).alias("o"), F.count(F.lit(1)).alias("linked"))
    nodes = _previous(parsed.select("conv", "turn").filter("conv is not null and turn is not null").distinct())
    previous = F.when(F.col("prev_turn").isNotNull(), F.struct("conv", F.col("prev_turn").alias("turn")))
    original = F.when(F.col("o").isNotNull(), F.struct(F.col("o.from_conv").alias("conv"), F.col("o.from_turn").alias("turn")))
    parents = written(nodes.join(reply, ["conv", "turn"], "left").select("conv", "turn", F.coalesce(original, previous).alias("up")), "quote-parents")
    facts = depths(parents).join(parents, ["conv", "turn"]).select("conv", "turn", "depth", "up")
    odd = reply.filter("conv is null or turn is null").select("conv", "turn", F.lit(0).cast("long").alias("depth"), F.struct(F.col("o.from_conv").alias("conv"), F.col("o.from_turn").alias("turn")).alias("up"))
    facts = facts.unionByName(odd).join(reply.select(F.col("conv").alias("rc"), F.col("turn").alias("rt"), "linked"), F.col("conv").eqNullSafe(F.col("rc")) & F.col("turn").eqNullSafe(F.col("rt")), "left")
    facts = facts.select(F.col("conv").alias("c"), F.col("turn").alias("t"), "depth", "up", "linked")
    rows = parsed.select("conv", "turn", "role", "own", F.size("quotes").alias("quotes"))
    rows = rows.join(facts, F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left").drop("c", "t")
    rows = rows.join(roots, F.col("conv") == F.col("a"), "left").withColumn("conversation", F.coalesce("root", "conv")).drop("a", "root")
    rows = placed(rows.withColumn("depth", F.coalesce("depth", F.lit(0))), "conversation", ["depth", "conv", "turn", "own"])
    text = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "own", F.lit("\n"))
    return rows.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "role", "conversation", "position", "depth",
        F.col("up.conv").alias("reply_conv"), F.col("up.turn").alias("reply_turn"), "quotes", F.coalesce("linked", F.lit(0)).alias("linked"), F.col("own").alias("text"), text.alias("formatted"),
    )


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of `conversations`, linked, placed and without quotes."""
    return conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

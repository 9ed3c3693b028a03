"""Chat formatting by quotation links: replies find their originals, quotes go.

Lines that begin with ``>`` are quoted, as deep as there are marks. A run of lines of one
level is a passage. Passages and their single lines are hashed in a normal form and joined
to the hashes of what messages say themselves: first to messages of the same conversation,
then to the first message anywhere. The join is to one message per hash, so a line that
thousands of messages share makes no pairs. The original with most quoted words wins.

A message replies to what it quotes at the first level in its own conversation, else to
the message before it. Following the replies gives each message its root and depth.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import pick
from ledgerloom.operators.slices import cut, with_previous

MARKS = re.compile(r"^[ \t]{0,3}((?:>[ \t]?)+)")
# Lines that introduce a quotation, in the languages of the conversations.
INTRODUCTION = re.compile(
    r"^(on .{1,200} wrote|am .{1,200} schrieb.{0,100}|le .{1,200} a écrit|el .{1,200} escribió) ?:$",
    re.IGNORECASE,
)
UNIT = "struct<passage:int,level:int,hash:binary,words:int>"
PARSED = (
    f"conv_id bigint, turn bigint, role string, text string, quoted array<{UNIT}>, "
    "said array<binary>, n_quotes int"
)


def normal_hash(text: str) -> tuple[bytes, int]:
    """A hash of a text in lower case with single spaces, and its number of words."""
    words = text.lower().split()
    return blake2b(" ".join(words).encode(), digest_size=16).digest(), len(words)


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """What a message says itself, and its quoted passages as (level, text)."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for line in text.split("\n"):
        marks = MARKS.match(line)
        level = marks[1].count(">") if marks else 0
        if not level:
            own.append(line)
        else:
            if not before and own and INTRODUCTION.match(own[-1].strip()):
                own.pop()
            if level != before:
                passages.append((level, []))
            passages[-1][1].append(line[marks.end() :])
        before = level
    found = [(level, "\n".join(lines)) for level, lines in passages]
    return "\n".join(own).strip("\n"), [(level, said) for level, said in found if said.strip()]


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with their own text, hashes of what they say, and of what they quote."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        units = pa.list_(
            pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("hash", pa.binary()), ("words", pa.int32())])
        )
        for batch in batches:
            texts, quoted, said, counts = [], [], [], []
            for text in batch.column("text").to_pylist():
                own, passages = parse(text)
                rows = []
                for number, (level, passage) in enumerate(passages):
                    whole, words = normal_hash(passage)
                    # the whole passage counts more than its lines together
                    rows.append((number, level, whole, 2 * words))
                    lines = [line for line in passage.split("\n") if line.strip()]
                    if len(lines) > 1:
                        rows += [(number, level, *normal_hash(line)) for line in lines]
                spoken = {normal_hash(unit)[0] for unit in [own, *own.split("\n")] if unit.strip()}
                texts.append(own)
                quoted.append([dict(zip(("passage", "level", "hash", "words"), r)) for r in rows])
                said.append(sorted(spoken))
                counts.append(len(passages))
            columns = [batch.column(c) for c in ("conv_id", "turn", "role")]
            columns += [
                pa.array(texts, pa.string()),
                pa.array(quoted, units),
                pa.array(said, pa.list_(pa.binary())),
                pa.array(counts, pa.int32()),
            ]
            names = ["conv_id", "turn", "role", "text", "quoted", "said", "n_quotes"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = pick(messages, ("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))
    return rows.na.fill("", ["text"]).mapInArrow(run, PARSED)


def quote_links(rows: DataFrame) -> DataFrame:
    """conv_id, turn, level, from_conv, from_turn, linked: each level's best original.

    ``rows`` come from ``parsed``; linked is the number of its passages that were found.
    """
    named = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    said = named.select("conv_id", "turn", F.explode("said").alias("hash"))
    inside = said.groupBy("hash", "conv_id").agg(F.min("turn").alias("in_turn"))
    anywhere = said.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    quoted = named.select("conv_id", "turn", F.explode("quoted").alias("q"))
    quoted = quoted.select("conv_id", "turn", "q.*")
    near = quoted.join(inside, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
    earlier = F.col("in_turn") < F.col("turn")
    itself = (F.col("first.conv_id") == F.col("conv_id")) & (F.col("first.turn") == F.col("turn"))
    source = F.when(earlier, F.struct("conv_id", F.col("in_turn").alias("turn"))).when(
        ~itself, F.col("first")
    )
    found = near.withColumn("source", source).where("source IS NOT NULL")
    votes = found.groupBy("conv_id", "turn", "level", "source").agg(
        F.sum("words").alias("words"), F.count_distinct("passage").alias("linked")
    )
    own = F.col("source.conv_id") == F.col("conv_id")
    rank = F.struct("words", own.alias("own"), (-F.col("source.turn")).alias("t"), "source", "linked")
    best = votes.groupBy("conv_id", "turn", "level").agg(F.max(rank).alias("best"))
    return best.select(
        "conv_id",
        "turn",
        "level",
        F.col("best.source.conv_id").alias("from_conv"),
        F.col("best.source.turn").alias("from_turn"),
        F.col("best.linked").alias("linked"),
    )


def roots(replies: DataFrame) -> DataFrame:
    """conv_id, turn, root_turn, depth from (conv_id, turn, up), up being earlier or null.

    Pointers double each round, so a chain of n replies takes log n rounds; every round is
    written to the shared folder.
    """
    state = cut(
        replies.select(
            "conv_id",
            "turn",
            "up",
            F.coalesce("up", "turn").alias("root_turn"),
            F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
        )
    )
    while not (moving := state.where("up IS NOT NULL")).isEmpty():
        above = state.select(
            "conv_id",
            F.col("turn").alias("up"),
            F.col("up").alias("next"),
            F.col("root_turn").alias("root"),
            F.col("depth").alias("more"),
        )
        moved = moving.join(above, ["conv_id", "up"], "left").select(
            "conv_id",
            "turn",
            F.col("next").alias("up"),
            F.coalesce("root", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )
        # messages that have reached their root stay as they are
        state = cut(state.where("up IS NULL").unionByName(moved))
    return state.drop("up")


def conversations(messages: DataFrame) -> DataFrame:
    """Conversations in reply order, without quotes.

    ``messages``: conv_id, turn, role, text. One row per row of it: conv_id, turn, role,
    text (own lines only), parent_turn, root_turn, depth, n_quotes, n_linked. Sorted by
    conv_id, root_turn, depth, turn every reply comes after what it replies to.

    Null texts are empty. Rows with a null conv_id or turn belong to no conversation: their
    parent, root and depth are null and nothing is linked to them. Repeated rows of one turn
    are one message to replies, and are all returned. An empty table gives no rows.
    """
    rows = cut(parsed(messages))
    links = cut(quote_links(rows))
    turns = rows.select("conv_id", "turn").where("conv_id IS NOT NULL AND turn IS NOT NULL")
    before = with_previous(turns.distinct(), "conv_id", ["turn"], ["turn"])
    first = links.where("level = 1 AND from_conv = conv_id AND from_turn < turn")
    up = before.join(first.select("conv_id", "turn", "from_turn"), ["conv_id", "turn"], "left")
    replies = up.select("conv_id", "turn", F.coalesce("from_turn", "previous_turn").alias("up"))
    replies = cut(replies)
    linked = links.groupBy("conv_id", "turn").agg(F.sum("linked").alias("n_linked"))
    facts = (
        replies.withColumnRenamed("up", "parent_turn")
        .join(roots(replies), ["conv_id", "turn"])
        .join(linked, ["conv_id", "turn"], "left")
    )
    return rows.join(facts, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        "parent_turn",
        "root_turn",
        "depth",
        F.col("n_quotes").cast("bigint").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )


def as_mail(messages: DataFrame) -> DataFrame:
    """Messages as mail clients send them: the turn before is quoted, and the one before it
    at a second level."""
    text = F.coalesce("text", F.lit(""))
    rows = messages.select("conv_id", "turn", "role", text.alias("text"))

    def earlier(by: int) -> DataFrame:
        mark = ">" * by + " "
        said = F.when(F.trim("text") != "", F.regexp_replace("text", "(?m)^", mark))
        turns = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn")
        kept = turns.agg(F.min(F.struct("text", "role")).alias("m")).select("conv_id", "turn", "m.*")
        return kept.select(
            "conv_id", (F.col("turn") + by).alias("turn"), said.alias(f"said{by}"), F.col("role").alias(f"by{by}")
        )

    both = rows.join(earlier(1), ["conv_id", "turn"], "left").join(
        earlier(2), ["conv_id", "turn"], "left"
    )
    who = F.coalesce("by1", "by2", F.lit("someone"))
    intro = F.when(
        F.coalesce("said1", "said2").isNotNull(), F.concat(F.lit("On this thread "), who, F.lit(" wrote:"))
    )
    return both.select(
        "conv_id", "turn", "role", F.concat_ws("\n", intro, "said2", "said1", "text").alias("text")
    )

"""Chat formatting with one training example for each assistant turn.

A turn becomes one segment of its conversation's stream. Every assistant turn is exploded
into an example of its own: all turns before it are its context and only its reply is
trainable. An example is a row of its conversation, the length of its prefix of the stream
and its target. Contexts are thus stored by reference: the examples of a conversation share
one stream. `example_texts` writes them out to rows; `read_back` writes out each in turn and
parses it, which costs a long conversation its square.

The template marks a turn as <|im_start|>role, newline, text, <|im_end|>, newline. Inside
roles and texts a backslash follows each "<" and "[", which breaks up the control strings
of this and other templates; taking it away again gives the text back. A line break
inside a role is written as "[n", which nothing else gives.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from tempfile import SpooledTemporaryFile
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.functions.scans import Running, null_safe_join, running
from legalops.llm.common import ship, staged
from legalops.session import shuffles_dropped

ship(__name__)

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"

# Code points of examples that one block of a conversation writes out.
WRITTEN = 1 << 28
# Bytes of a stream that a task holds in memory, and of an example that it parses at once.
HELD, PIECE = 1 << 24, 1 << 20


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


def segments(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn: conv, turn, segment, and for a reply its example.

    segment: the formatted turn. start: code points of the stream before it. mask_from and
    mask_to: the trainable code points of the segment, null where nothing is. example: the
    number of the example whose target it is, null for other turns. Turns go by their
    number, nulls first, then role and text; repeated turns are repeated. A null text or
    role is empty. Rows without a conversation id form one conversation. Turns after the
    last reply are in no example but stay in the stream. Other columns are not read; an
    empty table gives an empty table.
    """
    name = F.replace(escape(F.coalesce(F.col(role), F.lit(""))), F.lit("\n"), F.lit("[n"))
    head = F.concat(F.lit(OPEN), name, F.lit("\n"))
    body = escape(F.coalesce(F.col(text), F.lit("")))
    trained = F.col(role).eqNullSafe(TRAINED)
    made = df.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.concat(head, body, F.lit(CLOSE)).alias("segment"),
        F.when(trained, F.length(head)).alias("mask_from"),
        F.when(trained, F.length(head) + F.length(body)).alias("mask_to"),
    )
    # In blocks of rows, so that a conversation may be of any length.
    counted = running(
        made,
        ["conv_id"],
        ["turn", "segment"],
        [Running("end", F.length("segment").cast("long")), Running("replies", F.col("mask_from").isNotNull().cast("long"))],
    )
    return counted.select(
        "conv_id",
        "turn",
        "segment",
        "mask_from",
        "mask_to",
        (F.col("end") - F.length("segment")).alias("start"),
        F.when(F.col("mask_from").isNotNull(), F.col("replies")).alias("example"),
    )


def examples(made: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, example, prefix_chars, target, mask_from and mask_to.

    The context is the first prefix_chars code points of the conversation's stream, which
    are all turns before the target. mask_from and mask_to are places in the target.
    """
    return made.where("example IS NOT NULL").select(
        "conv_id", "example", F.col("start").alias("prefix_chars"), F.col("segment").alias("target"), "mask_from", "mask_to"
    )


def example_texts(made: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, context and target, written out.

    The size of the result grows with the square of a conversation's turns.
    """
    goals = examples(made).drop("mask_from", "mask_to")
    parts = made.select("conv_id", "start", "segment")
    same = goals["conv_id"].eqNullSafe(parts["conv_id"])
    joined = goals.join(parts, same & (parts["start"] < goals["prefix_chars"]), "left")
    return joined.groupBy(goals["conv_id"], "example", "target").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("start", "segment"))), lambda s: s["segment"]), ""
        ).alias("context")
    )


def _by_block(made: DataFrame) -> DataFrame:
    """Turns and examples with the block of examples they go to, one row for each block.

    An example's block is that of its prefix times its number, so examples of one block are
    some WRITTEN code points together at most, or one example. Each block has the turns up to
    its last target, and a conversation's last block has all its turns and all its examples,
    of which it writes out its own. Most conversations have one block.
    """
    number = F.floor(F.col("prefix_chars") * F.col("example") / F.lit(float(WRITTEN)))
    own = examples(made).withColumn("own", number)
    ends = own.groupBy("conv_id", "own").agg(F.max("prefix_chars").alias("upto"))
    ends = ends.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("own", "upto"))).alias("ends"))
    # Only conversations of more than WRITTEN code points of examples have several.
    several = F.broadcast(ends.where(F.size("ends") > 1))
    alone, last = F.col("ends").isNull(), F.element_at("ends", -1)["own"]
    one = F.array(F.lit(0).cast("long"))
    needed = F.transform(F.filter("ends", lambda e: (e["upto"] >= F.col("start")) | (e["own"] == last)), lambda e: e["own"])
    none = F.lit(None).cast("int")
    turns = null_safe_join(made.select("conv_id", "start", "segment"), several, ["conv_id"], "left").select(
        "conv_id",
        "start",
        F.lit(1).alias("side"),
        "segment",
        none.alias("mask_from"),
        none.alias("mask_to"),
        F.lit(None).cast("long").alias("own"),
        F.coalesce(last, F.lit(0)).alias("last"),
        F.explode(F.when(alone, one).otherwise(needed)).alias("block"),
    )
    own = null_safe_join(own, several, ["conv_id"], "left").withColumn("own", F.when(alone, 0).otherwise(F.col("own")))
    own = own.select(
        "conv_id",
        F.col("prefix_chars").alias("start"),
        F.lit(0).alias("side"),
        F.col("target").alias("segment"),
        "mask_from",
        "mask_to",
        "own",
        F.coalesce(last, F.lit(0)).alias("last"),
        F.explode(F.when(alone, one).otherwise(F.array_distinct(F.array("own", last)))).alias("block"),
    )
    rows = turns.unionByName(own)
    return rows.select(
        "conv_id",
        "block",
        "start",
        "side",
        "segment",
        "mask_from",
        "mask_to",
        F.coalesce(F.col("own") == F.col("block"), F.lit(False)).alias("written"),
        (F.col("block") == F.col("last")).alias("whole"),
    )


def read_example(stream: IO[bytes], upto: int, target: bytes) -> tuple[int, bytes, int]:
    """Write an example out, the first `upto` bytes of the stream and then the target, and parse it.

    Gives the number of its turns, the digest of these as in `read_back`, and its code
    points. It is read a piece at a time, so that it may be of any length. A text that is
    not made of whole turns is an error.
    """
    opened, closed = OPEN.encode(), CLOSE.encode()
    n, said, chars, rest, given = 0, sha256(), 0, b"", False
    stream.seek(0)
    while not given:
        # A turn longer than a piece is read in pieces that double.
        piece = stream.read(min(upto, max(PIECE, len(rest)))) if upto else target
        given, upto = not upto, upto - len(piece) if upto else 0
        rest += piece
        cut = rest.rfind(closed) + len(closed)
        if cut < len(closed):
            continue
        turns, rest = rest[:cut], rest[cut:]
        count = turns.count(closed)
        if not turns.startswith(opened) or turns.count(opened) != count or turns.count(closed + opened) != count - 1:
            raise ValueError("an example is not made of whole turns")
        text = turns[len(opened) : -len(closed)].replace(closed + opened, b"\n")
        # Only roles have line breaks written so.
        text = text.replace(b"[n", b"\n").replace(b"<\\", b"<").replace(b"[\\", b"[")
        said.update(text + b"\n")
        n, chars = n + count, chars + len(turns.decode())
    if rest:
        raise ValueError("an example is not made of whole turns")
    return n, said.digest(), chars


def read_back(made: DataFrame) -> DataFrame:
    """One row per conversation, parsed from the formatted segments and the examples.

    conv_id, n_turns, turns_sha256 (of role, newline, text, newline for each turn),
    loss_chars and loss_sha256 (of all trainable text of the examples, unescaped, in
    order), and formatted_chars (code points of the stream).

    Each example is written out once with its whole context, and parsed by the control
    strings alone; its turns must be the conversation's turns up to and including its target.
    One whose prefix does not end with a turn, whose target is not the turn that follows, or
    whose text does not read back is an error, as is a reply without an example. That costs a
    conversation's square, so a long conversation's examples are dealt in blocks of some
    WRITTEN code points. A task holds a piece of an example and one stream, which is on its
    disk where it is long. Hashes are fed turn by turn, so a long conversation is never held
    whole, though its own hashes are one task's.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    with shuffles_dropped(made.sparkSession):
        made = staged(made, "segments")
    ordered = _by_block(made).repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "start", "side")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, target, rows, stream, example = None, None, None, [], None, None

        def end() -> None:
            if target is not None:
                raise ValueError(f"an example of conversation {now[0]} is not followed by its target")
            stream.close()
            if now[2]:
                rows.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if "sha" in n else pa.int64()) for c, n in zip(zip(*rows), names)], names=names
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "block", "whole", "start", "side", "segment", "mask_from", "mask_to", "written")]
            for conv, block, whole, start, side, segment, mask_from, mask_to, written in zip(*columns):
                if now != (conv, block, whole):
                    if now:
                        end()
                    now, state, target, example = (conv, block, whole), [0, sha256(), 0, sha256(), 0], None, None
                    stream = SpooledTemporaryFile(max_size=HELD)
                if side == 0:
                    if target is not None or start != state[4]:
                        raise ValueError(f"an example of conversation {conv} has no whole turns before it")
                    target = segment
                    if written:
                        example = read_example(stream, stream.seek(0, 2), segment.encode())
                    trained = unescape(segment[mask_from:mask_to])
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                    continue
                if target is not None and target != segment:
                    raise ValueError(f"an example of conversation {conv} is not followed by its target")
                role, _, body = segment[len(OPEN) : -len(CLOSE)].partition("\n")
                role = unescape(role.replace("[n", chr(10)))
                if whole and target is None and role == TRAINED:
                    raise ValueError(f"a reply of conversation {conv} is in no example")
                state[0] += 1
                state[1].update(f"{role}\n{unescape(body)}\n".encode())
                state[4] += len(segment)
                if example and example != (state[0], state[1].digest(), state[4]):
                    raise ValueError(f"an example of conversation {conv} does not read back as its turns")
                stream.seek(0, 2)
                stream.write(segment.encode())
                target, example = None, None
            if rows:
                yield batch_of()
                rows = []
        if now:
            end()
        if rows:
            yield batch_of()

    return ordered.mapInArrow(
        digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )

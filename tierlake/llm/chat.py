"""Chat formatting at token level: turns between reserved ids, with a loss mask."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tierlake.llm.common import Scratch
from tierlake.llm.tokens import SPECIAL, TOKENIZER, decoder, encoder, vocabulary_size

#: Control strings of the template, each one reserved id behind the vocabulary's, in this order.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]"]
#: Role -> opening and closing control; other roles are spelled out between [ROLE] and [TEXT].
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": (None, "</s>")}
LEARNED = "assistant"
# Every control string begins with one of these, and has them nowhere else. So no control
# string can begin in a text and end in a mark, or the other way round.
_FIRST = r"[<\[]"
_REST = "|".join(re.escape(control[1:]) for control in [*CONTROLS, SPECIAL])
_ESCAPE = re.compile(rf"({_FIRST})(\\*)({_REST})")
_UNESCAPE = re.compile(rf"({_FIRST})\\(\\*)({_REST})")


def escape(text):
    """``text`` with a backslash more in every control string, after its first character.

    Control strings that hold backslashes there already get one more as well, so
    :func:`unescape` gives back the text, whatever it was.
    """
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text):
    return _UNESCAPE.sub(r"\1\2\3", text)


def id_kind(tokenizer=TOKENIZER):
    """Type of the stored ids: two bytes where all ids fit, else four; little-endian."""
    return np.dtype("<u2" if vocabulary_size(tokenizer) + len(CONTROLS) <= 1 << 16 else "<u4")


class Assembler:
    """Tokens and loss mask of single turns, and the way back."""

    def __init__(self, tokenizer=TOKENIZER):
        self.encode, self.decode = encoder(tokenizer), decoder(tokenizer)
        self.reserved, self.kind = vocabulary_size(tokenizer), id_kind(tokenizer)
        self.ids = {control: self.reserved + i for i, control in enumerate(CONTROLS)}

    def turn(self, role, text):
        """``(ids, mask)`` of a turn: its segments encoded one by one, reserved ids between them."""
        role, content = role or "", self.encode(escape(text or ""))
        if role in MARKS:
            opening, closing = MARKS[role]
            segments = [([self.ids[opening]], 0)] if opening else []
        else:
            closing = "[/ROLE]"
            named = [self.ids["[ROLE]"], *self.encode(escape(role)), self.ids["[TEXT]"]]
            segments = [(named, 0)]
        segments += [(content, int(role == LEARNED)), ([self.ids[closing]], 0)]
        ends = np.cumsum([len(ids) for ids, _ in segments])
        # +1 where a learned segment begins, -1 behind its end: the running sum is the mask.
        steps = np.zeros(ends[-1] + 1, np.int8)
        for end, (ids, learned) in zip(ends, segments):
            steps[end - len(ids)] += learned
            steps[end] -= learned
        ids = np.concatenate([np.array(ids, self.kind) for ids, _ in segments])
        return ids, np.cumsum(steps[:-1], dtype=np.int8)

    def turns(self, ids, mask):
        """``(role, text, learned text, characters)`` of each turn in some whole turns' tokens.

        ``characters`` are those of the formatted text, marks and escapes included.
        """
        role, at, chars = LEARNED, 0, 0
        for mark in np.flatnonzero(ids >= self.reserved).tolist():
            control = CONTROLS[int(ids[mark]) - self.reserved]
            content = self.decode(ids[at:mark].tolist())
            chars += len(content) + len(control)
            if control in ("</s>", "[/INST]", "[/SYS]", "[/ROLE]"):
                learned = ids[at:mark][mask[at:mark] > 0]
                yield role, unescape(content), unescape(self.decode(learned.tolist())), chars
                role, chars = LEARNED, 0
            elif control == "[TEXT]":
                role = unescape(content)
            elif control in ("[INST]", "[SYS]"):
                role = "user" if control == "[INST]" else "system"
            at = mark + 1


def _encoded(tokenizer):
    def run(batches):
        made = Assembler(tokenizer)
        for batch in batches:
            given = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            rows = [made.turn(r.as_py(), t.as_py()) for r, t in zip(given["role"], given["text"])]
            yield pa.RecordBatch.from_arrays([
                given["conv"], given["turn"], given["role"],
                pa.array([len(ids) for ids, _ in rows], pa.int64()),
                pa.array([ids.tobytes() for ids, _ in rows], pa.binary()),
                pa.array([mask.tobytes() for _, mask in rows], pa.binary()),
            ], names=["conv", "turn", "role", "length", "ids", "mask"])

    return run


def _counted(batches):
    """Adds ``part``, and by conversation within the partition ``rank`` and ``before`` (tokens).

    ``first`` tells the rows of the conversation with which the partition begins.
    """
    part, own, rank, total, first = TaskContext.get().partitionId(), None, 0, 0, True
    seen = False
    for batch in batches:
        given = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        ranks, before, firsts = [], [], []
        for conv, length in zip(given["conv"].to_pylist(), given["length"].to_pylist()):
            if seen and conv != own:
                rank, total, first = 0, 0, False
            seen, own = True, conv
            ranks.append(rank)
            before.append(total)
            firsts.append(first)
            rank, total = rank + 1, total + length
        added = {
            "part": pa.array([part] * len(ranks), pa.int32()), "rank": pa.array(ranks, pa.int64()),
            "before": pa.array(before, pa.int64()), "first": pa.array(firsts, pa.bool_())}
        yield pa.RecordBatch.from_arrays([*given.values(), *added.values()], names=[*given, *added])


def _begins(ordered):
    """``(part, ranks, tokens)``: rows and tokens that a partition's first conversation has before it.

    Only the last conversation of a partition can go on in the next one; two rows for each
    partition of the range sort, whose number is a setting, reach the driver.
    """
    ends = ordered.groupBy("part").agg(
        F.min("conv").alias("first"), F.max("conv").alias("last"),
        F.count_if(F.col("conv").isNull()).alias("nulls"), F.count("*").alias("n"))
    last = F.max("conv").alias("own")
    sums = (
        ordered.join(F.broadcast(ends.select("part", "last")), "part")
        .where(F.col("conv").eqNullSafe(F.col("last"))).groupBy("part")
        .agg(last, F.count("*").alias("rows"), F.sum("length").alias("tokens")))
    found = {row["part"]: row for row in ends.collect()}
    tails = {row["part"]: row for row in sums.collect()}
    begins, before = [], None
    for part in sorted(found):
        row, tail = found[part], tails[part]
        starts = None if row["nulls"] else row["first"]
        goes_on = before is not None and before[0] == starts
        ranks, tokens = before[1:] if goes_on else (0, 0)
        begins.append((part, ranks, tokens))
        whole = tail["rows"] == row["n"]
        before = (tail["own"], tail["rows"] + ranks * whole, tail["tokens"] + tokens * whole)
    return ordered.sparkSession.createDataFrame(begins, "part int, ranks long, tokens long")


def format_turns(conversations, id_column="conv_id", turn_column="turn", role_column="role",
                 text_column="text", tokenizer=TOKENIZER):
    """The tokens of all conversations, one row per turn in its place.

    Returns ``(id, position, start, length, ids, mask)``: ``position`` counts the turns of a
    conversation from 0, ``start`` is how many of its tokens stand before, ``ids`` are
    token ids of the type :func:`id_kind`, and ``mask`` has a byte of 1 for each token to be learned:
    those of assistants' texts, without marks. A conversation's rows joined by ``position`` are
    its token sequence. Its first row begins with ``<s>``; turns are ``[SYS]text[/SYS]``,
    ``[INST]text[/INST]``, ``text</s>`` for assistants, ``[ROLE]role[TEXT]text[/ROLE]`` for
    others. Every mark is one reserved id, which no text can encode to; control strings in
    texts and roles are also escaped, so that the decoded text is unambiguous, too.

    Turns go by ``turn`` (nulls first), equal ones by role, then by a hash of their tokens.
    Repeated rows stay. A null text or role is empty; rows without a conversation id make up one
    conversation. Other columns are ignored.

    Rows are range-sorted, so a conversation with very many turns lies in many partitions; its
    places are running counts within them, plus what the partitions before hold of it.
    """
    scratch = Scratch(conversations.sparkSession)
    given = conversations.select(
        F.col(id_column).alias("conv"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
        F.col(text_column).cast("string").alias("text"))
    kinds = {name: given.schema[name].dataType.simpleString() for name in ("conv", "turn")}
    shape = f"conv {kinds['conv']}, turn {kinds['turn']}, role string, length long, ids binary, mask binary"
    encoded = given.mapInArrow(_encoded(tokenizer), shape)
    encoded = scratch.write(
        encoded.withColumns({"tie": F.xxhash64("ids"), "uid": F.monotonically_increasing_id()}), "encoded")
    order = ["conv", "turn", "role", "tie", "uid"]
    ordered = encoded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _counted, f"{shape}, tie long, uid long, part int, rank long, before long, first boolean")
    ordered = scratch.write(ordered.drop("tie", "uid", "role", "turn"), "turns")
    scratch.drop("encoded")
    placed = ordered.join(F.broadcast(_begins(ordered)), "part")
    position = F.col("rank") + F.when(F.col("first"), F.col("ranks")).otherwise(0)
    start = F.col("before") + F.when(F.col("first"), F.col("tokens")).otherwise(0)
    opens = F.col("position") == 0
    begin = np.array([vocabulary_size(tokenizer) + CONTROLS.index("<s>")], id_kind(tokenizer)).tobytes()

    def with_begin(column, prefix):
        return F.when(opens, F.concat(F.lit(prefix), column)).otherwise(F.col(column)).alias(column)

    return placed.withColumns({"position": position, "start": start}).select(
        F.col("conv").alias(id_column), "position",
        F.when(opens, 0).otherwise(F.col("start") + 1).alias("start"),
        F.when(opens, F.col("length") + 1).otherwise(F.col("length")).alias("length"),
        with_begin("ids", begin), with_begin("mask", b"\0"))


def read_back(formatted, id_column="conv_id", tokenizer=TOKENIZER):
    """``(id, position, role, text, learned)`` of every turn, from the tokens and the mask alone.

    ``learned`` is the text under the loss mask, unescaped; every row is read by itself.
    """
    def run(batches):
        made = Assembler(tokenizer)
        for batch in batches:
            given = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            at, found = [], []
            for i, (ids, mask) in enumerate(zip(given["ids"], given["mask"])):
                for turn in made.turns(*_tokens(ids, mask, made.kind)):
                    at.append(i)
                    found.append(turn)
            rows = pa.array(at, pa.int64())
            columns = list(zip(*found)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [given["conv"].take(rows), given["position"].take(rows),
                 *[pa.array(c, pa.string()) for c in columns[:3]]],
                names=["conv", "position", "role", "text", "learned"])

    rows = formatted.select(F.col(id_column).alias("conv"), "position", "ids", "mask")
    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"conv {kind}, position long, role string, text string, learned string"
    ).withColumnRenamed("conv", id_column)


def digests(formatted, id_column="conv_id", tokenizer=TOKENIZER):
    """One row per conversation, read back from its tokens in order.

    ``(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``: SHA-256 of
    role, \\n, text, \\n of all turns, and length and SHA-256 of all text under the mask.
    A SHA-256 needs its bytes in order, so a conversation passes through one task; it does so
    as a stream of sorted rows, of which no more than a batch is held at a time.
    """
    def run(batches):
        made, own, state = Assembler(tokenizer), None, None
        for batch in batches:
            given = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            done = []
            for i, conv in enumerate(given["conv"].to_pylist()):
                if state is None or conv != own:
                    if state is not None:
                        done.append(_closed(own, state))
                    own, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, learned, chars in made.turns(*_tokens(given["ids"][i], given["mask"][i], made.kind)):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                    state[4] += chars
            if done:
                yield _digest_rows(done, given["conv"].type)
        if state is not None:
            yield _digest_rows([_closed(own, state)], given["conv"].type)

    rows = formatted.select(F.col(id_column).alias("conv"), "position", "ids", "mask")
    kind = rows.schema["conv"].dataType.simpleString()
    return rows.repartition("conv").sortWithinPartitions("conv", "position").mapInArrow(
        run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long").withColumnRenamed("conv", id_column)


def _tokens(ids, mask, kind):
    return np.frombuffer(ids.as_buffer(), kind), np.frombuffer(mask.as_buffer(), np.int8)


def _closed(conv, state):
    turns, text, chars, learned, formatted = state
    return conv, turns, text.hexdigest(), chars, learned.hexdigest(), formatted


def _digest_rows(done, kind):
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

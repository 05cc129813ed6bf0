"""Chat formatting with a prefix tree.

A turn is written as ``### role: text</turn>`` and a line feed. Inside roles and texts a backslash goes before every
backslash and before ``### `` and ``</turn>`` (in roles also before ``:``), so that any text, control strings and
escapes included, is read back as it was.

A turn is tokenized in three parts, what comes before its text, the text and what comes after, so that the loss mask falls between tokens.

Conversations are sorted by the digests of their prefixes, which puts those with the same first turns side by side. A task
walks its range in that order, depth first, and keeps the path of the last conversation: turns
shared with it are not emitted again. Emitted turns go into packs of about ``PACK_TOKENS`` added tokens or 4,096 conversations; a pack
starts with an empty path, so what the conversations of several packs share is emitted once in each. Each turn in a pack has its stretch of
tokens [start, end), the position id of its first token (as many tokens as its ancestors have; the others follow one by one), the stretches
of its ancestors, which are the only others that it may attend to,
and its loss stretches: the texts of assistant turns. A range is split at any conversation, so
conversations that share a first turn, or are equal, never have to meet in one task.

Turns of a conversation are ordered by turn (null first), then role and text; repeated rows are turns of their own. Null roles
and texts are empty. Of rows without conv_id nothing says which belong together: each is a conversation of its own. One conversation is
held whole. An empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textbatch as tb
from tessera.llm.token_scan import TOKENIZER, shipped, shipped_encoder

PACK_TOKENS = 1 << 16
MARK, END, LOSS_ROLE = "### ", "</turn>", "assistant"

_TEXT = re.compile(r"\\|### |</turn>")
_ROLE = re.compile(r"\\|### |</turn>|:")
_PIECE = re.compile(r"\\(\\|### |</turn>|:)|(</turn>)|(### )|(: )", re.S)


def escape(text: str) -> str:
    return _TEXT.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|### |</turn>|:)", lambda m: m[1], text, flags=re.S)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """The formatted turn: what comes before its text, the text, and what comes after."""
    return f"{MARK}{_ROLE.sub(lambda m: chr(92) + m[0], role)}: ", escape(text), f"{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    out, at, n = [], 0, len(formatted)
    while at < n:
        assert formatted.startswith(MARK, at)
        at += len(MARK)
        role = text = None
        start = at
        for m in _PIECE.finditer(formatted, at):
            if m[1] is not None:
                continue
            if m[4] and role is None:
                role, start = unescape(formatted[start : m.start()]), m.end()
            elif m[2] and role is not None:
                text, at = unescape(formatted[start : m.start()]), m.end() + 1
                break
        assert role is not None and text is not None
        out.append((role, text))
    return out


_NODE = "struct<parent: int, start: long, end: long, position: long, ancestors: array<struct<start: long, end: long>>, loss: array<struct<start: long, end: long>>>"
PACK_SCHEMA = f"pack string, tokens array<int>, turns array<{_NODE}>, conversations array<struct<conv_id: long, last: int>>"


def _span(n):
    return [{"start": a, "end": b} for a, b in n]


def _packer(pack_tokens: int, vocabulary: str):
    stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    node = pa.struct([("parent", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()), ("ancestors", stretch), ("loss", stretch)])
    schema = pa.schema([("pack", pa.string()), ("tokens", pa.list_(pa.int32())), ("turns", pa.list_(node)), ("conversations", pa.list_(pa.struct([("conv_id", pa.int64()), ("last", pa.int32())])))])

    def each(batches):
        from pyspark import TaskContext

        part, made, code = TaskContext.get().partitionId(), 0, None
        tokens: list[np.ndarray] = []
        turns: list[dict] = []
        convs: list[dict] = []
        size = fresh = 0  # fresh: without what the conversation before has too, so that a long shared start does not fill a pack
        before: list[tuple[str, str]] = []
        path: list[tuple[tuple[str, str], int]] = []
        frames: dict[str, np.ndarray] = {}  # of the few roles, and of the end of a turn

        def framed(text: str) -> np.ndarray:
            if text not in frames:
                if len(frames) > 1000:
                    frames.clear()
                frames[text] = encoded(text)
            return frames[text]

        def encoded(text: str) -> np.ndarray:
            return code.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

        def closed():
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            values = [pa.array([f"{part:06d}-{made:06d}"]), pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat)), pa.array([turns], schema.field(2).type), pa.array([convs], schema.field(3).type)]
            return pa.RecordBatch.from_arrays(values, schema=schema)

        for b in batches:
            if b.num_rows and code is None:
                code = shipped_encoder(vocabulary)
            for conv, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = [(t["role"], t["text"]) for t in own]
                k = 0
                while k < min(len(own), len(path)) and own[k] == path[k][0]:
                    k += 1
                path = path[:k]
                shared = 0  # with the conversation before, in this pack or the last one
                while shared < min(len(own), len(before)) and own[shared] == before[shared]:
                    shared += 1
                before = own
                for at, (role, words) in enumerate(own[k:], k):
                    head, body, tail = turn_parts(role, words)
                    parts = [framed(head), encoded(body), framed(tail)]
                    a, z = len(parts[0]), len(parts[0]) + len(parts[1])
                    whole = z + len(parts[2])
                    above = path[-1][1] if path else -1
                    up = [] if above < 0 else [*turns[above]["ancestors"], {"start": turns[above]["start"], "end": turns[above]["end"]}]
                    if len(up) > 1 and up[-2]["end"] == up[-1]["start"]:  # neighbouring stretches are one
                        up = [*up[:-2], {"start": up[-2]["start"], "end": up[-1]["end"]}]
                    position = 0 if above < 0 else turns[above]["position"] + turns[above]["end"] - turns[above]["start"]
                    loss = _span([(size + a, size + z)]) if role == LOSS_ROLE else []
                    path.append(((role, words), len(turns)))
                    turns.append({"parent": above, "start": size, "end": size + whole, "position": position, "ancestors": up, "loss": loss})
                    tokens += parts
                    size += whole
                    fresh += whole if at >= shared else 0
                convs.append({"conv_id": conv, "last": path[-1][1] if path else -1})
                if fresh >= pack_tokens or len(convs) >= 4096:
                    yield closed()
                    made += 1
                    tokens, turns, convs, size, fresh, path = [], [], [], 0, 0, []
        if convs:
            yield closed()

    return each


def pack_conversations(turns: DataFrame, pack_tokens: int = PACK_TOKENS, tokenizer: str = TOKENIZER) -> DataFrame:
    """Packs (pack, tokens, turns, conversations) of rows (conv_id, turn, role, text); ``last`` is a conversation's last turn."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("own"))
    convs = convs.unionByName(turns.where(F.col("conv_id").isNull()).select("conv_id", F.array(row).alias("own")))
    # digest of each prefix: 8 hex digits of a running MD5 for each turn; equal prefixes sort together, parents first
    step = F.aggregate(
        "own",
        F.struct(F.lit("").alias("all"), F.lit("").alias("last")),
        lambda acc, t: F.struct(
            F.concat(acc["all"], F.substring(F.md5(F.concat(acc["last"], F.lit("\0"), t["role"], F.lit("\0"), t["text"])), 1, 8)).alias("all"),
            F.md5(F.concat(acc["last"], F.lit("\0"), t["role"], F.lit("\0"), t["text"])).alias("last"),
        ),
    )["all"]
    convs = convs.withColumn("path", step).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return tb.small_batches(convs).select("conv_id", "own").mapInArrow(_packer(pack_tokens, shipped(turns.sparkSession, tokenizer)), PACK_SCHEMA)


def _turn_stretches(turns: list[dict], last: int) -> list[int]:
    """Turns from the first to ``last``, by parents."""
    out = []
    while last >= 0:
        out.append(last)
        last = turns[last]["parent"]
    return out[::-1]


def conversations(packs: DataFrame) -> DataFrame:
    """(conv_id, tokens, loss): each conversation as a model sees it, its last turn and the stretches that it attends to.

    loss lists the stretches of ``tokens`` under the loss mask.
    """
    schema = "conv_id long, tokens array<int>, loss array<struct<start: long, end: long>>"
    stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def each(batches):
        for b in batches:
            for i in range(b.num_rows):
                flat = b.column(1)[i].values.to_numpy()
                turns, out = b.column(2)[i].as_py(), []
                for c in b.column(3)[i].as_py():
                    if c["last"] < 0:
                        out.append((c["conv_id"], flat[:0], []))
                        continue
                    node = turns[c["last"]]
                    seen = [(s["start"], s["end"]) for s in node["ancestors"]] + [(node["start"], node["end"])]
                    loss = []
                    for k in _turn_stretches(turns, c["last"]):
                        t = turns[k]
                        loss += [(s["start"] - t["start"] + t["position"], s["end"] - t["start"] + t["position"]) for s in t["loss"]]
                    out.append((c["conv_id"], np.concatenate([flat[a:z] for a, z in seen]), _span(loss)))
                for x in range(0, len(out), 512):
                    ids, tokens, loss = zip(*out[x : x + 512], strict=True)
                    edge = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate(tokens), pa.int32())), pa.array(loss, stretch)], names=["conv_id", "tokens", "loss"])

    return packs.mapInArrow(each, schema)


def read_back(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Digests of conversations, parsed from the text of (conv_id, tokens, loss)."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    vocabulary = shipped(formatted.sparkSession, tokenizer)

    def each(batches):
        code = None
        for b in batches:
            if b.num_rows and code is None:
                code = shipped_encoder(vocabulary)
            rows = []
            for i, conv in enumerate(b.column(0).to_pylist()):
                tokens = b.column(1)[i].values.to_numpy()
                whole = code.decode_bytes(tokens.tolist()).decode()
                turns = parse(whole)
                h = hashlib.sha256()
                for role, text in turns:
                    h.update(f"{role}\n{text}\n".encode())
                loss = "".join(unescape(code.decode_bytes(tokens[s["start"] : s["end"]].tolist()).decode()) for s in b.column(2)[i].as_py())
                rows.append((conv, len(turns), h.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole), len(tokens)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"])

    return formatted.mapInArrow(each, schema)

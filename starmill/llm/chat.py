"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered whole and encoded once, with the place of every token in the text. The spans
of the assistant's words are known from rendering; both kinds of spans are sorted, so the tokens inside a
span are found by binary search. Control strings are tokens of their own, so no token crosses the border
of a turn.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.sources.tables import read_table

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
CONTROLS = (START, MESSAGE, END)
TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MESSAGE) + "(.*?)" + re.escape(END), re.S)

Span = tuple[int, int]


def escape(text: str) -> str:
    """``text`` without any ``<|``: a backslash more between the two, however many are there already."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def render(turns: Sequence[tuple[str, str]]) -> tuple[str, list[Span]]:
    """The formatted conversation of (role, text) turns, and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{MESSAGE}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def mask_of(starts: np.ndarray, ends: np.ndarray, spans: Sequence[Span]) -> np.ndarray:
    """Which tokens lie inside one of the spans; tokens and spans in order of their place."""
    mask = np.zeros(len(starts), dtype=bool)
    for begin, end in spans:
        if begin < end:
            mask[np.searchsorted(starts, begin, "left"):np.searchsorted(ends, end, "right")] = True
    return mask


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that a formatted conversation was made of."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def text_under_mask(formatted: str, starts: Sequence[int], ends: Sequence[int],
                    mask: Sequence[bool]) -> str:
    """What the masked tokens cover, each stretch unescaped by itself."""
    stretches: list[list[int]] = []
    for begin, end, masked in zip(starts, ends, mask):
        if masked:
            if stretches and begin <= stretches[-1][1]:
                stretches[-1][1] = max(end, stretches[-1][1])
            else:
                stretches.append([begin, end])
    return "".join(unescape(formatted[begin:end]) for begin, end in stretches)


def load_tokenizer(path: str):
    """The tokenizer in ``path`` with the control strings as tokens of their own."""
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens(list(CONTROLS))
    return tokenizer


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """Conversations of rows sorted by id; a row without id is one by itself."""
    held, turns = None, []
    for batch in batches:
        for name, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
            if turns and (name is None or name != held):
                yield held, turns
                turns = []
            held = name
            turns.append((role or "", text or ""))
    if turns:
        yield held, turns


# Characters of conversations that are encoded together.
ENCODED_TOGETHER = 1 << 20


def _formatted(path: str, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)

        def encoded(group) -> pa.RecordBatch:
            names, counts, texts, spans = zip(*group)
            found = tokenizer.encode_batch(list(texts), add_special_tokens=False)
            ids, starts, ends, masks = [], [], [], []
            for encoding, own in zip(found, spans):
                places = np.asarray(encoding.offsets, dtype=np.int32).reshape(-1, 2)
                ids.append(np.asarray(encoding.ids, dtype=np.int32))
                starts.append(places[:, 0])
                ends.append(places[:, 1])
                masks.append(mask_of(places[:, 0], places[:, 1], own))
            numbers = pa.list_(pa.int32())
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array(names, id_type), "n_turns": pa.array(counts, pa.int64()),
                "formatted": pa.array(texts, pa.string()), "token_ids": pa.array(ids, numbers),
                "token_starts": pa.array(starts, numbers), "token_ends": pa.array(ends, numbers),
                "loss_mask": pa.array(masks, pa.list_(pa.bool_()))})

        group, chars = [], 0
        for name, turns in _conversations(batches):
            text, spans = render(turns)
            group.append((name, len(turns), text, spans))
            chars += len(text)
            if chars >= ENCODED_TOGETHER:
                yield encoded(group)
                group, chars = [], 0
        if group:
            yield encoded(group)
    return run


def format_chats(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Conversations rendered, encoded and masked for training on the assistant's words.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are not looked at. Returns a row
    per conversation: ``conv_id``, ``n_turns``, ``formatted``, ``token_ids``, ``token_starts``,
    ``token_ends`` (code points in ``formatted``) and ``loss_mask``. Turns come in the order of ``turn``
    (NULL last), equal ones by role and text; repeated rows are turns of their own. NULL roles and texts
    are empty. Rows with a NULL ``conv_id`` are conversations of one turn. An empty table gives an empty
    result. One conversation is held by one task at a time; a partition is streamed.
    """
    kind = turns.schema["conv_id"].dataType
    apart = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    ordered = (turns.repartition("conv_id", apart).select("conv_id", "turn", role, text)
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text"))
    from pyspark.sql.pandas.types import to_arrow_type

    return ordered.select("conv_id", "role", "text").mapInArrow(
        _formatted(tokenizer_path, to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, n_turns long, formatted string, token_ids array<int>, "
        "token_starts array<int>, token_ends array<int>, loss_mask array<boolean>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    for batch in batches:
        turns, loss, formatted = [], [], batch.column("formatted").to_pylist()
        columns = [batch.column(c) for c in ("token_starts", "token_ends", "loss_mask")]
        for row, text in enumerate(formatted):
            turns.append("".join(f"{role}\n{said}\n" for role, said in turns_of(text)))
            loss.append(text_under_mask(text, *[c[row].as_py() for c in columns]))
        yield pa.RecordBatch.from_pydict({
            "conv_id": batch.column("conv_id"), "n_turns": batch.column("n_turns"),
            "turns_sha256": pa.array(map(sha, turns), pa.string()),
            "loss_chars": pa.array(map(len, loss), pa.int64()),
            "loss_sha256": pa.array(map(sha, loss), pa.string()),
            "formatted_chars": pa.array(map(len, formatted), pa.int64())})


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# A conversation whose words look like another template's marks.
PROBE = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    chats = format_chats(turns.unionByName(probe), tokenizer_path())
    kind = turns.schema["conv_id"].dataType.simpleString()
    return chats.mapInArrow(_digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


OP8_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}'))),
measured AS (
  SELECT *, length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'))
            + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))
            + {sum(map(len, CONTROLS))} AS chars
  FROM turns)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id
"""

QUERIES = {"op8_chat_format": op8_chat_format}
ORACLE = {"op8_chat_format": OP8_SQL}

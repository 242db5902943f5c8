"""Preference formatting of chat pairs.

A pair is two conversations, chosen and rejected.  Their longest common
prefix of turns (equal role and text) is rendered once as the prompt; what
follows on either side is its completion, with a mask that marks what is
trained on: the assistant's words and end mark, never headers or other
roles' turns.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import ship_by_value

TRAINED_ROLE = "assistant"
END = "<|end|>\n"


def header(role: str) -> str:
    return f"<|{role}|>\n"


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns and its trained spans [start, end) in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = header(role), text + END
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body]
        at += len(head) + len(body)
    return "".join(parts), spans


def common_prefix(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def conversations(turns: DataFrame, pair_id: str, turn: str, role: str, text: str, name: str) -> DataFrame:
    """(pair, name): each conversation's turns as one array in order of turn
    number (nulls last), role, text.  A conversation is one record."""
    one = F.struct(F.col(turn).isNull().alias("z"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                   F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = F.sort_array(F.collect_list(one))
    return turns.groupBy(F.col(pair_id).alias("__pair")).agg(
        F.transform(ordered, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(name))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair_id: str = "conv_id", turn: str = "turn",
                     role: str = "role", text: str = "text") -> DataFrame:
    """One row per pair id: the id, prompt_turns, prompt, chosen, rejected
    (texts), chosen_spans, rejected_spans (trained spans of the completions,
    code points), differs (whether there is anything to prefer).

    A pair missing on one side has no turns there: its prompt is empty.
    Equal conversations are all prompt, with empty completions.  Null roles
    and texts are empty ones; turns with equal numbers are ordered by role
    and text, repeated rows stay repeated turns, null numbers come last.
    Null pair ids form one pair.  Turns are rendered whole.  Empty tables
    give an empty result; other columns are not looked at.
    """
    ship_by_value(__name__)
    args = (pair_id, turn, role, text)
    a, b = conversations(chosen, *args, "chosen"), conversations(rejected, *args, "rejected").withColumnRenamed("__pair", "__other")
    none = F.array().cast(a.schema["chosen"].dataType)
    pairs = a.join(b, F.col("__pair").eqNullSafe(F.col("__other")), "full").select(
        F.coalesce("__pair", "__other").alias(pair_id), F.coalesce("chosen", none).alias("chosen"),
        F.coalesce("rejected", none).alias("rejected"))
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    out = T.StructType([pairs.schema[pair_id], T.StructField("prompt_turns", T.IntegerType()),
                        *[T.StructField(c, T.StringType()) for c in ("prompt", "chosen", "rejected")],
                        T.StructField("chosen_spans", spans), T.StructField("rejected_spans", spans),
                        T.StructField("differs", T.BooleanType())])
    arrow_spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(7)]
            for x, y in zip(batch.column(1), batch.column(2)):
                x, y = ([(t["role"], t["text"]) for t in side.as_py()] for side in (x, y))
                n = common_prefix(x, y)
                (p, _), (c, cs), (r, rs) = render(x[:n]), render(x[n:]), render(y[n:])
                for col, v in zip(cols, (n, p, c, r, cs, rs, len(x) > n or len(y) > n)):
                    col.append(v)
            for k in (4, 5):
                cols[k] = [[{"start": s, "end": e} for s, e in v] for v in cols[k]]
            types = [pa.int32(), pa.string(), pa.string(), pa.string(), arrow_spans, arrow_spans, pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=out.names)

    return pairs.mapInArrow(run, out)


def swapped_ending(turns: DataFrame) -> DataFrame:
    """Rejected counterparts for conversations (conv_id, turn, role, text):
    every conversation with the last assistant turn's text replaced by that
    of the conversation with the next id, or left out if there is none."""
    last = (turns.where(F.col("role") == TRAINED_ROLE).groupBy("conv_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    own = last.select(F.col("conv_id").alias("c"), F.col("last.turn").alias("last_turn"))
    other = last.select((F.col("conv_id") - 1).alias("d"), F.col("last.text").alias("other_text"))
    swap = own.join(other, F.col("c") == F.col("d"), "left").select("c", "last_turn", "other_text")
    is_last = F.coalesce((F.col("turn") == F.col("last_turn")) & (F.col("role") == TRAINED_ROLE), F.lit(False))
    return (turns.join(swap, F.col("conv_id") == F.col("c"), "left")
            .where(~is_last | F.col("other_text").isNotNull())
            .select("conv_id", "turn", "role", F.when(is_last, F.col("other_text")).otherwise(F.col("text")).alias("text")))

"""Preference pairs from conversations: one prompt, two masked completions.

A pair holds two conversations, chosen and rejected. Their longest common prefix of turns (same role, same text) is
rendered once as the prompt; the turns behind it are rendered as the two completions. Loss masks are spans of
characters of a completion: the texts of assistant turns are learned, everything else, and the whole prompt, is not.

A turn is rendered as <|role|> newline text <|end|> newline; the mark "<|" inside a text becomes "<\\|", so no text can
forge a turn. A conversation is one row of the result, so its turns are gathered; nothing else is.

Defined results: null roles count as "user", null texts as empty; turns are ordered by (turn, role, text), so repeated
rows stand side by side and all count; rows without a conversation id are left out; conversations that agree wholly
have empty completions; an empty side has an empty completion; very long texts and conversations are rendered whole; an
empty table gives an empty table; extra columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "struct<role:string,text:string>"


def gathered(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, turns: the turns of each conversation in order, as an array of (role, text)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("user")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = F.sort_array(F.collect_list(F.struct(F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))))
    whole = turns.where(F.col(key).isNotNull()).groupBy(key).agg(rows.alias("__rows"))
    return whole.select(key, F.transform("__rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def with_last_answer(turns: Column, answer: Column) -> Column:
    """turns with the text of the last assistant turn put in place of its own (nothing changes without one)."""
    last = F.array_max(F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", i)))
    return F.transform(turns, lambda t, i: F.when(i == last, F.struct(t["role"].alias("role"), F.coalesce(answer, F.lit("")).alias("text"))).otherwise(t))


def last_answer(turns: Column) -> Column:
    return F.get(F.reverse(F.filter(turns, lambda t: t["role"] == "assistant")), F.lit(0))["text"]


def common_turns(one: Column, two: Column) -> Column:
    same = F.zip_with(one, two, lambda a, b: a.eqNullSafe(b))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def _shown(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), F.replace(turn["text"], F.lit("<|"), F.lit("<\\|")), F.lit("<|end|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _shown), "")


def learned_spans(turns: Column) -> Column:
    """(start, stop) in the rendered turns of each assistant text."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(t["role"]) + 5
        stop = begin + F.length(F.replace(t["text"], F.lit("<|"), F.lit("<\\|")))
        spans = F.when(t["role"] == "assistant", F.concat(a["spans"], F.array(F.struct(begin.alias("start"), stop.alias("stop"))))).otherwise(a["spans"])
        return F.struct((stop + 8).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda a: a["spans"])


def format_pairs(pairs: DataFrame, *keep: str) -> DataFrame:
    """keep, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans from columns chosen and rejected (arrays of turns; null: empty)."""
    none = F.array().cast(f"array<{TURN}>")
    sides = pairs.select(*keep, F.coalesce("chosen", none).alias("__c"), F.coalesce("rejected", none).alias("__r"))
    split = sides.select("*", common_turns(F.col("__c"), F.col("__r")).alias("n_common"))
    tails = split.select(*keep, "n_common", F.slice("__c", F.lit(1), F.col("n_common")).alias("__p"), *[F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0))).alias(c) for c in ("__c", "__r")])
    return tails.select(*keep, "n_common", rendered(F.col("__p")).alias("prompt"), rendered(F.col("__c")).alias("chosen"), rendered(F.col("__r")).alias("rejected"), learned_spans(F.col("__c")).alias("chosen_spans"), learned_spans(F.col("__r")).alias("rejected_spans"))


def against_neighbours(turns: DataFrame) -> DataFrame:
    """conv_id, chosen, rejected: each conversation, against itself with the last answer of the conversation whose number differs in the last bit.

    conv_id is an integer. Turns are shuffled once, by the number without its last bit.
    """
    ids, role, text = F.col("conv_id").cast("bigint"), F.coalesce(F.col("role").cast("string"), F.lit("user")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(ids.alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    both = turns.where("conv_id is not null").groupBy(ids.bitwiseAND(F.lit(-2)).alias("__pair")).agg(F.sort_array(F.collect_list(row)).alias("__rows"))

    def side(conv_id: Column) -> Column:
        return F.transform(F.filter("__rows", lambda t: t["conv_id"] == conv_id), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    sides = both.select("__pair", side(F.col("__pair")).alias("__a"), side(F.col("__pair") + 1).alias("__b"))
    each = F.array(
        F.struct(F.col("__pair").alias("conv_id"), F.col("__a").alias("turns"), last_answer(F.col("__b")).alias("answer")),
        F.struct((F.col("__pair") + 1).alias("conv_id"), F.col("__b").alias("turns"), last_answer(F.col("__a")).alias("answer")),
    )
    one = sides.select(F.explode(each).alias("__s")).where(F.size("__s.turns") > 0)
    kind = turns.schema["conv_id"].dataType
    return one.select(F.col("__s.conv_id").cast(kind).alias("conv_id"), F.col("__s.turns").alias("chosen"), with_last_answer(F.col("__s.turns"), F.col("__s.answer")).alias("rejected"))

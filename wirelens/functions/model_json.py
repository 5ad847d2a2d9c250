"""Answers of a language model: the JSON array in a reply, and its rows with defaults.  Native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import DEAL_TYPES, STAGES

ANSWER = "array<struct<deal_type:string,stage:string,target_company:string,seller:string,buyer:string,confidence:double,reasoning:string>>"
SCORED = "array<struct<fit:double,separation_complexity:double,pe_buyer:double,size:double,sector:double,geography:double,pe_firm:string,recommended_action:string,reasoning:string>>"


def json_array(reply: Column) -> Column:
    """The text of the outermost array: code fences go, then brackets are counted from the first one (also inside strings); null if there is none or it does not close.

    The pieces after each ] are walked, with the depth that the brackets before leave.
    """
    bare = F.trim(F.regexp_replace(F.regexp_replace(reply, r"```json\s*", ""), r"```\s*", ""))
    at = F.instr(bare, "[")
    rest = F.substring(bare, at, F.length(bare))
    pieces = F.split(rest, r"\]", -1)

    def step(acc: Column, piece: Column) -> Column:
        opens = F.length(piece) - F.length(F.replace(piece, F.lit("["), F.lit("")))
        depth = acc["depth"] + opens - 1
        done = acc["end"] > 0
        length = acc["length"] + F.length(piece) + 1
        return F.struct(F.when(done, acc["depth"]).otherwise(depth).alias("depth"), F.when(done, acc["length"]).otherwise(length).alias("length"), F.when(~done & (depth == 0), length).otherwise(acc["end"]).alias("end"))

    # the last piece has no ] after it
    walked = F.aggregate(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"), F.lit(0).alias("end")), step, lambda a: a["end"])
    return F.when((at > 0) & (walked > 0), F.left(rest, walked))


def deal_type(c: Column) -> Column:
    """One of the known types, else null (not a deal)."""
    return F.when(c.isin(*DEAL_TYPES), c)


def stage(c: Column) -> Column:
    return F.when(c.isin(*STAGES), c)


def whole(c: Column) -> Column:
    """A whole number, else null: a fraction is no valid score."""
    return F.when(c == F.floor(c), c.cast("int"))

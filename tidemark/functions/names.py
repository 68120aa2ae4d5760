"""Time frames, symbols and coded names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86_400, "w": 604_800}


def seconds_of(frame: str) -> int:
    """The length of a time frame such as 15m; anything else raises."""
    found = re.fullmatch(r"([1-9]\d*)([smhdw])", frame)
    if not found:
        raise ValueError(f"not a time frame: {frame!r}")
    return int(found[1]) * UNITS[found[2]]


def frames_in_order(frames: list[str]) -> list[str]:
    """Finest first; two of one length raise."""
    order = sorted(frames, key=seconds_of)
    if len({seconds_of(f) for f in frames}) != len(frames):
        raise ValueError(f"time frames of one length: {frames}")
    return order


def bare_symbol(symbol: Column, venues: tuple[str, ...], kinds: tuple[str, ...]) -> Column:
    """Leading venue names and then instrument kinds are taken off, as often as they repeat; upper case, without separators."""
    off = F.regexp_replace(F.upper(symbol), f"^(?:(?:{'|'.join(venues)})[_:-])+", "")
    return F.regexp_replace(F.regexp_replace(off, f"^(?:(?:{'|'.join(kinds)})[_:-])+", ""), "[_/-]", "")


FEATURE = re.compile(r"(\d+[smhd]_)?(.*?)(_roll\d+_\w+)?")


class Codes:
    """Names by code and back. Two names of one code raise: decoding would be a guess.

    What frames a name stays as it is: a time-frame prefix and a rolling suffix of a feature; a predicate's prefixes, its
    `_and_` and `_or_`, and a trailing side.
    """

    def __init__(self, codes: dict[str, str]):
        self.codes, self.names = dict(codes), {v: k for k, v in codes.items()}
        if len(self.names) != len(self.codes):
            raise ValueError("two names share a code")

    def _columns(self, columns: list[str], of: dict[str, str]) -> dict[str, str]:
        parts = {c: FEATURE.fullmatch(c) for c in columns}
        return {c: (m[1] or "") + of[m[2]] + (m[3] or "") for c, m in parts.items() if m[2] in of}

    def coded_columns(self, columns: list[str]) -> dict[str, str]:
        """Code of each column that has one; other columns are left out."""
        return self._columns(columns, self.codes)

    def named_columns(self, columns: list[str]) -> dict[str, str]:
        return self._columns(columns, self.names)

    def encoded(self, frame: DataFrame) -> DataFrame:
        return renamed(frame, self.coded_columns(frame.columns))

    def decoded(self, frame: DataFrame) -> DataFrame:
        return renamed(frame, self.named_columns(frame.columns))

    def with_aliases(self, frame: DataFrame) -> DataFrame:
        """frame with its coded columns beside the real ones, so that models trained on either find theirs; columns that are there already stay."""
        new = {c: code for c, code in self.coded_columns(frame.columns).items() if code not in frame.columns}
        return frame.select("*", *[F.col(f"`{c}`").alias(code) for c, code in new.items()])

    def _predicate(self, name: str, of: dict[str, str], strict: bool) -> str:
        side = re.search(r"_(long|short)$", name)
        body, end = (name[: side.start()], side[0]) if side and name not in of else (name, "")
        out = []
        for i, part in enumerate(re.split(r"(_and_|_or_)", body)):
            frame, atom = re.fullmatch(r"(\d+[smhd]_)?(.*)", part).groups()
            if i % 2 == 0 and strict and atom not in of:
                raise KeyError(f"{atom!r} is not in the code map")
            out.append(part if i % 2 else (frame or "") + of.get(atom, atom))
        return "".join(out) + end

    def encoded_predicate(self, name: str) -> str:
        """An unknown atom raises."""
        return self._predicate(name, self.codes, True)

    def decoded_predicate(self, name: str, strict: bool = True) -> str:
        """An unknown code raises, or stays as it is if not strict (a name that is decoded already)."""
        return self._predicate(name, self.names, strict)


def renamed(frame: DataFrame, to: dict[str, str]) -> DataFrame:
    return frame.select(*[F.col(f"`{c}`").alias(to.get(c, c)) for c in frame.columns])


def coded(frame: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Columns renamed by code; a time-frame prefix and a rolling suffix stay as they are."""
    return renamed(frame, Codes(codes).coded_columns(frame.columns))


def with_new_codes(known: DataFrame, names: DataFrame, prefix: str) -> DataFrame:
    """known (name, number) and, numbered on from its largest number in name order, the names it lacks."""
    top = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("top"))
    new = names.select("name").distinct().join(known, "name", "left_anti")
    numbered = new.select("name", F.row_number().over(Window.orderBy("name")).alias("n")).join(F.broadcast(top))
    whole = known.select("name", "number").union(numbered.select("name", F.col("n") + F.col("top")))
    return whole.select("name", "number", F.concat(F.lit(prefix), F.lpad(F.col("number").cast("string"), 3, "0")).alias("code"))


def same_columns(frames: dict[str, DataFrame]) -> list[str]:
    """The columns, in the first frame's order, if all frames have the same ones; else an error that names what each lacks."""
    every = {c for f in frames.values() for c in f.columns}
    lacking = {name: sorted(every - set(f.columns)) for name, f in frames.items() if every - set(f.columns)}
    if lacking:
        raise ValueError(f"columns that are not in all tables: {lacking}")
    return list(next(iter(frames.values())).columns)


def with_frames(frame: DataFrame, frames: list[str]) -> DataFrame:
    """frame, if it has a column of each time frame (`<frame>_...`); else an error that names those it lacks."""
    lacking = [f for f in frames if not any(c.startswith(f"{f}_") for c in frame.columns)]
    if lacking:
        raise ValueError(f"no columns of the time frames {lacking}")
    return frame

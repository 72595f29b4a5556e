"""CSV records over lines that Spark reads in parallel splits.

A quoted field may run over line ends, so where a line starts (outside or inside a quoted field) depends
on everything before it in its part file.  A line is therefore lexed for both starts, and a stretch
of lines is summed up for both: where it ends, its first record, its last open one, and the widths
of the records between.  Two neighbouring stretches merge into one, so lines are folded to one small
row per split in the task that reads them, and the splits of a part to one row per part.  The
same goes for loading: a task puts the records of its split together for both starts until they
agree, which they do at the first line that holds a whole quoted field, and only the pieces that
cross splits meet in a shuffle.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import scratch_path

BOM = "﻿"
# A longer header record is unreadable, as a field of this size is to the usual csv reader.
HEADER_CHARS = 131_072
# A complete quoted field with what follows its closing quote, and its start
CLOSED_FIELD = r'(?s)(^|,)"[^"]*+(?:""[^"]*+)*+"[^,]*+'
OPEN_FIELD = r'(?s)(^|,)"'
BEFORE_OPEN_FIELD = r'(?s)^(.*?(?:^|,))"'
REST_OF_OPEN_FIELD = r'(?s)^[^"]*+(?:""[^"]*+)*+"[^,]*+(.*)\z'
ANY_FIELD = r'(?s)(?:^|,)("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'

PROFILE_KINDS = (
    "part string, lines long, header_text string, header_fields long, header_too_long boolean, "
    "records long, ragged long, has_line_breaks boolean, valid_text boolean"
)
_PIECE_KINDS = (
    "part string, split_start long, seq long, branch int, piece string, text string, ended boolean, inside boolean"
)


# --- lines ----------------------------------------------------------------------------------


def _separators(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def _lex(text: Column) -> tuple[Column, Column]:
    """(leaves a quote open, field separators) of a line that starts outside quotes."""
    quoted = F.contains(text, F.lit('"'))
    bare = F.when(quoted, F.regexp_replace(text, CLOSED_FIELD, "$1")).otherwise(text)
    opened = quoted & F.regexp_like(bare, F.lit(OPEN_FIELD))
    counted = F.when(opened, F.regexp_extract(bare, BEFORE_OPEN_FIELD, 1)).otherwise(bare)
    return opened, _separators(counted)


def lexed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file or folder in their order, with their effect on the quote state.

    ``opens`` and ``separators`` hold for a line that starts outside a quoted field, ``opens_inside`` and
    ``separators_inside`` for one that starts inside.
    """
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.make_valid_utf8(
            F.when(F.col("value").startswith(BOM), F.substr("value", F.lit(2))).otherwise(F.col("value"))
        ).alias("text"),
        F.is_valid_utf8("value").alias("valid_text"),
    )
    text = F.col("text")
    opens, separators = _lex(text)
    closes = F.contains(text, F.lit('"')) & F.regexp_like(text, F.lit(REST_OF_OPEN_FIELD))
    inner_opens, inner_separators = _lex(F.concat(F.lit("x"), F.regexp_extract(text, REST_OF_OPEN_FIELD, 1)))
    return lines.select(
        "*",
        opens.alias("opens"),
        separators.alias("separators"),
        F.when(closes, inner_opens).otherwise(F.lit(True)).alias("opens_inside"),
        F.when(closes, inner_separators).otherwise(F.lit(0)).alias("separators_inside"),
    )


def header_names(header: Column) -> Column:
    """Column names of a header record: quotes around a name are dropped, doubled ones halved."""
    fields = F.regexp_extract_all(header, F.lit(ANY_FIELD), F.lit(1))

    def unquoted(name: Column) -> Column:
        inner = F.regexp_replace(name, r'(?s)^"(.*)"([^"]*)\z', "$1$2")
        return F.when(name.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(name)

    return F.when(header == "", F.array().cast("array<string>")).otherwise(F.transform(fields, unquoted))


# --- stretches of lines ---------------------------------------------------------------------


@dataclass
class Stretch:
    """Lines from one start state on; the head runs to the first record end, the tail from the last."""

    inside: bool
    lines: int = 0
    ended: bool = False
    breaks: bool = False
    head_separators: int = 0
    head_blank: bool = False
    head_text: str = ""
    tail_lines: int = 0
    tail_separators: int = 0
    widths: Counter = field(default_factory=Counter)

    def then(self, outside: Stretch, inside: Stretch) -> Stretch:
        """This stretch and the next one, given for both starts."""
        later = inside if self.inside else outside
        if not self.lines:
            return later
        if not later.lines:
            return self
        whole = Stretch(later.inside, self.lines + later.lines, self.ended or later.ended, self.breaks or later.breaks)
        whole.widths = self.widths + later.widths
        if self.ended:
            whole.head_separators, whole.head_blank, whole.head_text = self.head_separators, self.head_blank, self.head_text
            whole.tail_lines, whole.tail_separators = later.tail_lines, later.tail_separators
            if later.ended:
                blank = later.head_blank and not self.tail_lines
                whole.widths[0 if blank else self.tail_separators + later.head_separators + 1] += 1
            else:
                whole.tail_lines = self.tail_lines + later.lines
                whole.tail_separators = self.tail_separators + later.head_separators
        else:
            whole.head_separators = self.head_separators + later.head_separators
            whole.head_text = f"{self.head_text}\n{later.head_text}"[: HEADER_CHARS + 1]
            whole.tail_lines, whole.tail_separators = later.tail_lines, later.tail_separators
        return whole


def _inside_after(start: bool, opens: np.ndarray, opens_inside: np.ndarray) -> np.ndarray:
    """State behind each line: that of the last line which fixes it, changed by each swap since."""
    swaps = np.cumsum(opens & ~opens_inside)
    fixing = np.where(opens == opens_inside, np.arange(len(opens)), -1)
    last = np.maximum.accumulate(fixing)
    fixed = last >= 0
    base = np.where(fixed, opens[last], start)
    flips = swaps - np.where(fixed, swaps[last], 0)
    return base ^ (flips % 2 == 1)


def _stretch(start: bool, lines: dict[str, np.ndarray], texts: pa.Array) -> Stretch:
    after = _inside_after(start, lines["opens"], lines["opens_inside"])
    before = np.concatenate([[start], after[:-1]])
    separators = np.where(before, lines["separators_inside"], lines["separators"])
    blank = lines["blank"] & ~before
    ends = np.flatnonzero(~after)
    found = Stretch(bool(after[-1]), len(after), len(ends) > 0, bool(after.any()))
    head = int(ends[0]) + 1 if len(ends) else len(after)
    found.head_separators = int(separators[:head].sum())
    found.head_blank = bool(blank[0]) and head == 1 and not start
    size, pieces = 0, []
    for text in texts[:head]:
        pieces.append(text.as_py())
        size += len(pieces[-1]) + 1
        if size > HEADER_CHARS:
            break
    found.head_text = "\n".join(pieces)[: HEADER_CHARS + 1]
    if len(ends):
        found.tail_lines = len(after) - 1 - int(ends[-1])
        found.tail_separators = int(separators[ends[-1] + 1 :].sum())
        if len(ends) > 1:
            sums = np.add.reduceat(separators[: ends[-1] + 1], np.concatenate([[0], ends[:-1] + 1]))[1:]
            widths = np.where(blank[ends[1:]], 0, sums + 1)
            values, counts = np.unique(widths, return_counts=True)
            found.widths = Counter(dict(zip(values.tolist(), counts.tolist())))
    return found


def _split_runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(part, split start, rows) for each run of lines of one split."""
    if not batch.num_rows:
        return
    part, start = batch.column("part"), batch.column("split_start").to_numpy()
    changed = start[1:] != start[:-1]
    if part[0] != part[len(part) - 1] or changed.any():
        names = part.dictionary_encode().indices.to_numpy()
        changed |= names[1:] != names[:-1]
    cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield part[a].as_py(), int(start[a]), batch.slice(a, b - a)


def _effects(rows: pa.RecordBatch) -> dict[str, np.ndarray]:
    names = ("opens", "opens_inside", "separators", "separators_inside", "blank")
    return {n: rows.column(n).to_numpy(zero_copy_only=False) for n in names}


def _to_json(stretch: Stretch) -> str:
    return json.dumps(vars(stretch))


def _from_json(text: str) -> Stretch:
    made = Stretch(**json.loads(text))
    made.widths = Counter({int(k): v for k, v in made.widths.items()})
    return made


def split_stretches(lexed: DataFrame) -> DataFrame:
    """(part, split_start, outside, inside, valid_text): one row per split, from one pass."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(place, outside, inside, valid):
            return pa.RecordBatch.from_pydict(
                {"part": [place[0]], "split_start": [place[1]], "outside": [_to_json(outside)],
                 "inside": [_to_json(inside)], "valid_text": [valid]}
            )

        place, outside, inside, valid = None, Stretch(False), Stretch(True), True
        for batch in batches:
            for part, start, rows in _split_runs(batch):
                if place is not None and place != (part, start):
                    yield row(place, outside, inside, valid)
                    outside, inside, valid = Stretch(False), Stretch(True), True
                place, lines, texts = (part, start), _effects(rows), rows.column("text")
                later = [_stretch(s, lines, texts) for s in (False, True)]
                outside, inside = outside.then(*later), inside.then(*later)
                valid &= bool(rows.column("valid_text").to_numpy(zero_copy_only=False).all())
        if place is not None:
            yield row(place, outside, inside, valid)

    wanted = lexed.withColumn("blank", F.col("text") == "")
    return wanted.mapInArrow(
        fold, "part string, split_start long, outside string, inside string, valid_text boolean"
    )


def part_profiles(lexed: DataFrame) -> DataFrame:
    """Header, records and widths of every part: its splits, one small row each, merged in order."""

    def merge(key, table):
        whole, valid = Stretch(False), True
        for r in sorted(table.to_pylist(), key=lambda r: r["split_start"]):
            whole = whole.then(_from_json(r["outside"]), _from_json(r["inside"]))
            valid &= r["valid_text"]
        widths, header = whole.widths, 0 if whole.head_blank else whole.head_separators + 1
        if whole.ended and whole.tail_lines:  # a last record that the file leaves open
            widths[whole.tail_separators + 1] += 1
        return pa.Table.from_pydict(
            {
                "part": [key[0].as_py()], "lines": [whole.lines], "header_text": [whole.head_text],
                "header_fields": [header], "header_too_long": [len(whole.head_text) > HEADER_CHARS],
                "records": [sum(widths.values())], "ragged": [sum(n for w, n in widths.items() if w != header)],
                "has_line_breaks": [whole.breaks], "valid_text": [valid],
            }
        )

    return split_stretches(lexed).groupBy("part").applyInArrow(merge, PROFILE_KINDS)


# --- whole records --------------------------------------------------------------------------


class _Pieces:
    """The rows of one split while it is read."""

    def __init__(self, part: str, start: int):
        self.place = (part, start)
        self.rows: list[tuple] = []
        # Per start: its state, the lines of the open record and the records ended so far
        self.state, self.open, self.count = [False, True], [[], []], [0, 0]
        self.agreed = False

    def take(self, branch: int, texts: list[str], after: np.ndarray, shown: int) -> None:
        start = 0
        for end in np.flatnonzero(~after).tolist():
            text = "\n".join([*self.open[branch], *texts[start : end + 1]])
            piece = "head" if branch == 1 and not self.agreed and not self.count[branch] else "whole"
            self.rows.append((*self.place, self.count[branch], shown, piece, text, None, None))
            self.open[branch], start = [], end + 1
            self.count[branch] += 1
        self.open[branch].extend(texts[start:])
        if len(after):
            self.state[branch] = bool(after[-1])

    def add(self, lines: dict[str, np.ndarray], texts: list[str]) -> None:
        opens, opens_inside, done = lines["opens"], lines["opens_inside"], 0
        if not self.agreed:
            after = [_inside_after(s, opens, opens_inside) for s in self.state]
            common = np.flatnonzero((after[0] == after[1]) & ~after[0])
            done = int(common[0]) + 1 if len(common) else len(texts)
            for branch in (0, 1):
                self.take(branch, texts[:done], after[branch][:done], branch)
            self.agreed = len(common) > 0
        if self.agreed and done < len(texts):
            after = _inside_after(self.state[0], opens[done:], opens_inside[done:])
            self.take(0, texts[done:], after, -1)

    def finish(self) -> list[tuple]:
        if self.agreed:
            self.state[1] = self.state[0]
        for branch in (0,) if self.agreed else (0, 1):
            if self.open[branch]:
                piece = "head" if branch == 1 and not self.count[1] else "tail"
                text = "\n".join(self.open[branch])
                self.rows.append((*self.place, self.count[branch], -1 if self.agreed else branch, piece, text, None, None))
        for branch in (0, 1):
            self.rows.append((*self.place, 0, branch, "state", None, self.count[branch] > 0, self.state[branch]))
        return self.rows


def _pieces(lexed: DataFrame) -> DataFrame:
    names = [part.split()[0] for part in _PIECE_KINDS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            for part, start, rows in _split_runs(batch):
                if split is not None and split.place != (part, start):
                    yield batch_of(split.finish())
                    split = None
                split = split or _Pieces(part, start)
                split.add(_effects(rows), rows.column("text").to_pylist())
                if split.rows:
                    yield batch_of(split.rows)
                    split.rows = []
        if split is not None:
            yield batch_of(split.finish())

    return lexed.withColumn("blank", F.col("text") == "").mapInArrow(assemble, _PIECE_KINDS)


def _starts(states: DataFrame) -> DataFrame:
    """(part, split_start, start, chain): the true start of every split and the split whose open
    record it goes on with."""

    def compose(key, table):
        ends: dict[int, dict[int, tuple[bool, bool]]] = {}
        for r in table.to_pylist():
            ends.setdefault(r["split_start"], {})[r["branch"]] = (r["ended"], r["inside"])
        inside, chain, rows = False, None, []
        for split in sorted(ends):
            rows.append((key[0].as_py(), split, int(inside), chain if inside else None))
            ended, after = ends[split][int(inside)]
            if not inside or ended:
                chain = split
            inside = after
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.int64()))],
            names=["part", "split_start", "start", "chain"],
        )

    wanted = states.select("part", "split_start", "branch", "ended", "inside")
    return wanted.groupBy("part").applyInArrow(compose, "part string, split_start long, start int, chain long")


def whole_records(spark: SparkSession, path: str) -> DataFrame:
    """(part, header, text): the records of a file or folder, blank lines left out, in one scan.

    ``header`` marks the first record of a part.  The pieces are stored once in the shared folder;
    the starts that are joined to them are one row of about 100 bytes per split of 128 MB.
    """
    stored = scratch_path(spark, "record-pieces")
    _pieces(lexed_lines(spark, path)).write.partitionBy("piece").option("compression", "zstd").parquet(stored)
    pieces = spark.read.schema(_PIECE_KINDS).parquet(stored)
    starts = _starts(pieces.where("piece = 'state'"))
    true = pieces.where("piece <> 'state'").join(F.broadcast(starts), ["part", "split_start"]).where(
        (F.col("branch") == -1) | (F.col("branch") == F.col("start"))
    )
    first = (F.col("split_start") == 0) & (F.col("seq") == 0)
    whole = true.where("piece = 'whole'").select("part", first.alias("header"), "text")
    chain = F.when(F.col("piece") == "head", F.col("chain")).otherwise(F.col("split_start"))
    crossing = true.where("piece IN ('head', 'tail')").groupBy("part", chain.alias("chain")).agg(
        F.max(first & (F.col("piece") == "tail")).alias("header"),
        F.array_sort(F.collect_list(F.struct("split_start", "text"))).alias("texts"),
    )
    joined = crossing.select("part", "header", F.array_join("texts.text", "\n").alias("text"))
    return whole.unionByName(joined).where("text <> ''")

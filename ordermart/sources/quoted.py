"""CSV files whose quoted fields hold line feeds, read split by split.

A line is read in one of two states: at a record's begin, or inside a
quoted field that an earlier line left open.  So each split is a function
from the state it begins in to the state it ends in, and that function and
the number of records begun are found without knowing the splits before it
(``split_states``).  A running composition over a file's splits, one row a
split, tells where each begins (``split_starts``).  Then every split is
parsed in a task of its own (``split_records``); only the pieces of a
record that reaches over a split's end are brought together by its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A field with its quotes closed (what follows the closing quote belongs to it), or one without a quote at its begin.
_CLOSED = '(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
_OPEN_TAIL = '"(?:[^"]++|"")*+'
#: A line at a record's begin leaves a quote open; one inside a quoted field leaves it, or a later one, open.
#: Possessive throughout: no backtracking and no recursion, whatever the length.
LINE_OPENS = f"^(?:{_CLOSED},)*+{_OPEN_TAIL}" + r"\z"
LINE_STAYS = f'^(?:[^"]++|"")*+(?:' + r"\z" + f'|"[^,]*+,(?:{_CLOSED},)*+{_OPEN_TAIL}' + r"\z)"


def opens(line: Column) -> Column:
    """Whether a line that begins a record ends inside a quoted field."""
    return line.contains('"') & line.rlike(LINE_OPENS)


def _line_tools():
    """(opens, stays, parse) for Python tasks; made by value, so workers need no import of this package."""
    import re

    opening, staying = (re.compile(p.replace(r"\z", r"\Z")) for p in (LINE_OPENS, LINE_STAYS))

    def line_opens(line):
        return '"' in line and opening.match(line) is not None

    def line_stays(line):
        return '"' not in line or staying.match(line) is not None

    def parse(lines):
        import csv

        csv.field_size_limit(2 ** 31 - 1)
        return next(csv.reader(v + "\n" for v in lines))

    return line_opens, line_stays, parse


def split_states(lines: DataFrame) -> DataFrame:
    """(path, block, ends_plain, ends_inside, n_plain, n_inside) of each split of ``lines`` (path, block, value).

    The end state and the records begun, for a split that begins at a
    record and for one that begins inside a quoted field.
    """
    tools = _line_tools

    def run(batches):
        import pyarrow as pa

        line_opens, line_stays, _ = tools()
        split, out = None, []
        for batch in batches:
            for path, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, block) != split:
                    split = (path, block)
                    out.append([path, block, False, True, 0, 0])
                s = out[-1]
                if line:
                    s[4] += not s[2]
                    s[5] += not s[3]
                if '"' in line:
                    s[2] = line_stays(line) if s[2] else line_opens(line)
                    s[3] = line_stays(line) if s[3] else line_opens(line)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)],
                                             names=["path", "block", "ends_plain", "ends_inside", "n_plain", "n_inside"])

    return lines.select("path", "block", "value").mapInArrow(
        run, "path string, block long, ends_plain boolean, ends_inside boolean, n_plain long, n_inside long")


def split_starts(states: DataFrame) -> DataFrame:
    """(path, block, inside, n, offset): the state each split begins in, its records and those before it.

    Functions on two states are constant, the identity or a swap: the state
    is that of the last constant split before, swapped as often as swaps follow.
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("ends_plain") == F.col("ends_inside")
    swap = F.col("ends_plain") & ~F.col("ends_inside")
    s = states.withColumn("swaps", F.sum(swap.cast("long")).over(upto))
    last = F.coalesce(F.last(F.when(constant, F.col("ends_plain").cast("long")), True).over(before), F.lit(0))
    since = (F.coalesce(F.max("swaps").over(before), F.lit(0))
             - F.coalesce(F.last(F.when(constant, F.col("swaps")), True).over(before), F.lit(0)))
    s = s.withColumn("inside", (last + since) % 2 == 1)
    s = s.withColumn("n", F.when(F.col("inside"), F.col("n_inside")).otherwise(F.col("n_plain")))
    return s.select("path", "block", "inside", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def split_records(lines: DataFrame) -> DataFrame:
    """(path, record_number, fields, block, piece) of ``lines`` (path, block, value, inside, offset) in file order.

    ``fields`` of the records that begin and end in one split; ``piece``
    for parts of the others, to be joined in the order of ``block``.
    """
    tools = _line_tools

    def run(batches):
        import pyarrow as pa

        line_opens, line_stays, parse = tools()
        types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.string()]
        out, size = [], 0
        split, number, held, whole = None, 0, None, True

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["path", "record_number", "fields", "block", "piece"])

        def left_open():
            if held:
                out.append((split[0], number, None, split[1], "\n".join(held)))

        for batch in batches:
            for path, block, line, inside, offset in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, block) != split:
                    left_open()
                    # ``held``: lines of an open record; ``whole``: it began in this split
                    split, number, held, whole = (path, block), offset, [] if inside else None, not inside
                if held is not None:
                    held.append(line)
                    if not line_stays(line):
                        out.append((path, number, parse(held), block, None) if whole
                                   else (path, number, None, block, "\n".join(held)))
                        held = None
                elif line:
                    number += 1
                    whole = True
                    if line_opens(line):
                        held = [line]
                    else:
                        out.append((path, number, parse([line]) if '"' in line else line.split(","), block, None))
                size += len(line)
                if size > 4 << 20 and out:
                    yield batch_of(out)
                    out, size = [], 0
        left_open()
        if out:
            yield batch_of(out)

    return lines.select("path", "block", "value", "inside", "offset").mapInArrow(
        run, "path string, record_number long, fields array<string>, block long, piece string")


def join_pieces(parts: DataFrame) -> DataFrame:
    """(path, record_number, fields): whole records as they are, pieces of one record joined and parsed."""
    tools = _line_tools
    whole = parts.where("piece IS NULL").select("path", "record_number", "fields")
    # one record's pieces: one for each split that it reaches into
    cut = (parts.where("piece IS NOT NULL").groupBy("path", "record_number")
           .agg(F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("p"))
           .select("path", "record_number", F.array_join("p.piece", "\n").alias("text")))

    def run(batches):
        import pyarrow as pa

        _, _, parse = tools()
        for batch in batches:
            fields = [parse(t.split("\n")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fields, pa.list_(pa.string()))],
                                             names=["path", "record_number", "fields"])

    return whole.unionByName(cut.mapInArrow(run, "path string, record_number long, fields array<string>"))

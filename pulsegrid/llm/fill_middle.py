"""Fill-in-the-middle transformation by an indexable skip list.

A text is a chain of units (a run of ASCII letters, or any other single code point). Above the chain lie
express lanes: every lane holds about a quarter of the units of the lane below, and each link carries two
widths, the units and the code points that it spans. A cut is given as a rank in units; descending from
the top lane, a link is taken while the units passed so far and its width stay within the rank, and
the code points of the links taken add up to the place of the cut. So both cuts are reached exactly in
logarithmic time, and cuts never split a unit.

Hashes of the row's id choose the cuts and the form. Forms: ``plain`` (unchanged), ``psm`` (prefix,
suffix, middle) and ``spm`` (suffix, prefix, middle), with a mark before each part. A text that holds a
mark stays plain, so ``restore`` finds the parts again from output and form alone.

Defined results: null and empty texts are plain and have no units; a null id hashes as the empty text;
texts of any length are transformed whole; rows with equal ids and texts are transformed alike, rows
with equal ids and other texts share their hashes. Empty tables give empty tables, other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import map_arrow, mix

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

SEED = 1
TRANSFORMED = 90  # of 100 rows
SUFFIX_FIRST = 20  # of 100 transformed rows
TOP_LANE = 8  # no lane is put above one with at most so many units

_LETTER = np.zeros(128, dtype=bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


class SkipList:
    """A static chain of units with express lanes; positions are counted in units and in code points.

    ``ends`` are the code points up to the end of each unit. Lane ``k`` holds the head and the units
    whose mixed number ends with ``2 k`` zero bits. ``units[k][i]`` and ``points[k][i]`` are the widths of
    the link behind the lane's node ``i``, and ``down[k][i]`` is that node's place in the lane below.
    """

    def __init__(self, ends: np.ndarray):
        self.size = len(ends)
        reach = np.concatenate([[0], ends])  # code points up to each node, the head included
        at = np.arange(self.size + 1)
        chance = mix(at.astype(np.uint64))
        self.units, self.points, self.down = [], [], []
        down = at
        while True:
            self.units.append(np.diff(at))
            self.points.append(np.diff(reach[at]))
            self.down.append(down)
            if len(at) <= TOP_LANE:
                break
            bits = np.uint64((1 << 2 * len(self.units)) - 1)
            raised = (chance[at] & bits) == 0
            raised[0] = True  # the head stands in every lane
            down = np.flatnonzero(raised)
            at = at[down]

    def offset(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        passed = points = node = 0
        for units, widths, down in zip(self.units[::-1], self.points[::-1], self.down[::-1]):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                points += int(widths[node])
                node += 1
            node = int(down[node])
        return points


def unit_ends(text: str) -> np.ndarray:
    """Code points up to the end of each unit."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    letter = _LETTER[np.minimum(codes, 127)] & (codes < 128)
    last = np.ones(len(codes), dtype=bool)
    last[:-1] = ~(letter[:-1] & letter[1:])
    return np.flatnonzero(last) + 1


def rearrange(
    key: str, text: str, seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST,
) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and middle, output) of a text; ``key`` is its id as text."""
    ends = unit_ends(text)
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= transformed or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    chain = SkipList(ends)
    first, second = (chain.offset(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < suffix_first:
        form, output = SPM, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = PSM, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, first, second - first, output


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
    transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """(id column, n, form, prefix_chars, middle_chars, output) of every row."""

    def over(batch: pa.RecordBatch):
        made = [
            rearrange(key, text, seed, transformed, suffix_first)
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist())
        ]
        n, form, prefix, middle, output = zip(*made) if made else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
             pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
            names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    none = F.lit("")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), none).alias("key"),
        F.coalesce(F.col(text_col), none).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    out = map_arrow(
        rows, over, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )
    return out.withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text again. No mark can arise where parts meet, as no mark begins inside another one."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")

    def joined(*order: int) -> Column:
        return F.concat(*[F.get(part, F.lit(i)) for i in order])

    return F.when(form == PSM, joined(1, 3, 2)).when(form == SPM, joined(2, 3, 1)).otherwise(output)

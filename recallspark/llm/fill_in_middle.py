"""Fill-in-middle: each text is cut at two unit borders, and its three parts are put in another order.

A text is looked at as UTF-8 in fixed blocks of BLOCK bytes. A Fenwick tree over the blocks holds how many
units end and how many code points begin in each. The descent by powers of two finds the block of a cut;
only that block is read for the exact place. So a cut costs the logarithm of the blocks and one block,
whatever the length of the text.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recallspark.llm.batches import pieces, texts

BLOCK = 4096
#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def line_ends(data: np.ndarray) -> np.ndarray:
    """Whether a line ends behind each byte: a line is all up to a line feed, or what is left."""
    ends = data == 10
    if len(ends):
        ends[-1] = True
    return ends


class CutTree:
    """Units and code points of one text, by block.

    ``ends`` marks the bytes that end a unit; the last byte must be one.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, block: int = BLOCK):
        self.ends, self.starts, self.block = ends, (data & 0xC0) != 0x80, block
        edges = np.arange(0, len(data), block)
        self.size = len(edges)
        counts = np.zeros((self.size + 1, 2), dtype=np.int64)
        if self.size:
            counts[1:, 0] = np.add.reduceat(ends, edges, dtype=np.int64)
            counts[1:, 1] = np.add.reduceat(self.starts, edges, dtype=np.int64)
        sums = np.cumsum(counts, axis=0)
        at = np.arange(self.size + 1)
        self.tree = sums - sums[at - (at & -at)]  # entry i sums up the lowest-bit(i) blocks that end with block i
        self.units, self.chars = (int(x) for x in sums[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """``(byte, code point)`` behind the first ``units`` units."""
        if not units:
            return 0, 0
        at, left, chars = 0, units, 0
        step = 1 << self.size.bit_length()
        while step:
            over = at + step
            if over <= self.size and self.tree[over, 0] < left:
                at, left, chars = over, left - int(self.tree[over, 0]), chars + int(self.tree[over, 1])
            step >>= 1
        begin = at * self.block
        end = begin + int(np.flatnonzero(self.ends[begin:begin + self.block])[left - 1]) + 1
        return end, chars + int(np.count_nonzero(self.starts[begin:end]))


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: the first digits of the SHA-256 of ``seed:id`` (no id: nothing behind the colon)."""
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:16])


def transform(text: str, numbers: tuple[int, int, int, int], rate: int = 100, suffix_first: int = 50,
              marks: tuple[str, str, str] = MARKS, unit_ends: Callable[[np.ndarray], np.ndarray] = line_ends) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text; characters are None where the form is plain."""
    encoded = text.encode()
    data = np.frombuffer(encoded, np.uint8)
    tree = CutTree(data, unit_ends(data))
    first, second, chance, order = numbers
    if not text or any(mark in text for mark in marks) or chance % 100 >= rate:
        return tree.units, "plain", None, None, text
    few, many = sorted((first % (tree.units + 1), second % (tree.units + 1)))
    (a, chars_a), (b, chars_b) = tree.cut(few), tree.cut(many)
    prefix, middle, suffix = (part.decode() for part in (encoded[:a], encoded[a:b], encoded[b:]))
    p, s, m = marks
    if order % 100 < suffix_first:
        form, output = "spm", f"{s}{suffix}{p}{prefix}{m}{middle}"
    else:
        form, output = "psm", f"{p}{prefix}{s}{suffix}{m}{middle}"
    return tree.units, form, chars_a, chars_b - chars_a, output


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be readable wherever text meets them: none may begin with an end of another or of itself."""
    if len(set(marks)) < 3 or any(not mark for mark in marks):
        raise ValueError("three different marks are needed")
    if any(b.startswith(a[-k:]) for a in marks for b in marks for k in range(1, len(a) + (a != b))):
        raise ValueError(f"the marks {marks} overlap")


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, suffix_first: int = 50, marks: tuple[str, str, str] = MARKS,
                   unit_ends: Callable[[np.ndarray], np.ndarray] = line_ends, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: one row per row, whole texts, no shuffle.

    Of the ``n`` units the prefix ends behind the smaller of two drawn numbers, the middle behind the
    larger. ``rate`` of a hundred documents are transformed, ``suffix_first`` of a hundred of these as
    spm, the others as psm; the rest stay plain, and so do empty texts and those that hold a mark.
    Null texts are empty. The draws hang on the seed and the id alone, so equal ids are cut by
    the same numbers, and rows without an id are all cut by those of no id. Ids must be whole numbers.
    Very long texts are worked on one at a time; other columns, whatever their names, are ignored.
    """
    check_marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        for batch in pieces(batches):
            ids = batch.column(0).to_pylist()
            rows = [(i, *transform(t, draws(seed, i), rate, suffix_first, marks, unit_ends)) for i, t in zip(ids, texts(batch))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA)


def restored(form: Column, output: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    parts = F.split(output, "|".join(rf"\Q{mark}\E" for mark in marks), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
